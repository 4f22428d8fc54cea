"""Best-fit packing of tokenised documents into sequences by hierarchical residual packing.

A document longer than a sequence is cut into full pieces behind a shorter first piece; full pieces are sequences already.
The other pieces are dealt over partitions of at most `LOCAL` pieces. A partition packs its own by best-fit decreasing, emits
the bins that are full up to `slack` tokens, and passes the others on. Underfull bins are items of the next round, over fewer
partitions, until one partition holds them all or a round joins no two bins at all; then the rest is emitted. So no task ever holds more than `LOCAL` items, however large the table, and a bin holds at most as many
pieces as a sequence has tokens.

Every round is written to the shared folder, so a lost executor repeats one partition of one round.

Defined results: a null text is the empty text, whose only token is the end id; repeated rows are packed each for itself;
null ids stay null; an empty table gives no sequences. Extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import ship
from drawdown.llm.encoding import IDS, encoder
from drawdown.session import materialise

#: Items that one task packs.
LOCAL = 20_000
PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, own_id BIGINT"
BINS = "bin BIGINT, size INT, done BOOLEAN, members ARRAY<BIGINT>, lengths ARRAY<INT>"


def pieces(documents: DataFrame, path: str, kind: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, own_id (a number of its own) of each piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, end = encoder(path, kind), np.array([end_id], dtype=IDS).tobytes()
        own = TaskContext.get().partitionId() << 32
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = made.encode(text.as_py()) + end
                total = len(ids) // 4
                first = total % capacity or capacity
                for k, start in enumerate([0, *range(first, total, capacity)]):
                    length = first if k == 0 else capacity
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), own))
                    own += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of the items of each bin, largest items first, each into the fullest bin that takes it."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free room
    rooms = 0  # bit r: some bin has room r
    bins: list[list[int]] = []
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[at]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(at)
        left = room - size
        open_bins[left].append(chosen)
        rooms |= 1 << left
    return bins


def _round(bins: DataFrame, number: int, parts: int, capacity: int, slack: int, last: bool) -> DataFrame:
    """Bins of a round; those that are not done are the next round's items."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat([pd.DataFrame({"bin": [], "size": [], "members": [], "lengths": []}), *frames])
        frame = frame.sort_values("bin")
        sizes, members, lengths = frame["size"].astype(int).tolist(), frame["members"].tolist(), frame["lengths"].tolist()
        # Above all numbers of pieces.
        own = 1 << 62 | number << 44 | TaskContext.get().partitionId() << 24
        made = best_fit(sizes, capacity)
        total = [sum(sizes[i] for i in items) for items in made]
        if made:
            yield pd.DataFrame(
                {
                    "bin": [own + k for k in range(len(made))],
                    "size": np.array(total, dtype="int32"),
                    "done": [last or size >= capacity - slack for size in total],
                    "members": [np.concatenate([members[i] for i in items]) for items in made],
                    "lengths": [np.concatenate([lengths[i] for i in items]) for items in made],
                }
            )

    dealt = bins.repartition(1) if parts == 1 else bins.repartition(parts, F.xxhash64("bin"))
    return materialise(dealt.select("bin", "size", "members", "lengths").mapInPandas(pack, BINS), "packing-round")


def pack(
    documents: DataFrame, path: str, kind: str, end_id: int, capacity: int = 2048, slack: int = 2, local: int = LOCAL
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    every = materialise(pieces(documents, path, kind, end_id, capacity), "packing-pieces")
    small = every.filter(F.col("length") < capacity)
    length = F.col("length").cast("int")
    items = small.select(
        F.col("own_id").alias("bin"), length.alias("size"), F.array("own_id").alias("members"), F.array(length).alias("lengths")
    )
    many, number, emitted = items.count(), 0, []
    while many:
        number += 1
        parts = -(-many // local)
        last = parts == 1
        made = _round(items, number, parts, capacity, slack, last)
        items = made.filter(~F.col("done"))
        left = items.count()
        emitted.append(made.filter("done"))
        if left == many:
            emitted.append(items)
            left = 0
        many = left
    out = every.filter(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("own_id").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    if emitted:
        offsets = F.transform(
            "lengths", lambda x, i: F.aggregate(F.slice("lengths", 1, i), F.lit(0).cast("long"), lambda a, b: a + b)
        )
        bins = reduce(DataFrame.unionByName, emitted)
        placed = bins.select("bin", F.explode(F.arrays_zip("members", offsets.alias("offsets"))).alias("m"))
        placed = placed.select(F.col("bin").alias("sequence_id"), F.col("m.members").alias("own_id"), F.col("m.offsets").alias("offset"))
        out = out.unionByName(
            small.join(placed, "own_id").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
        )
    return out
