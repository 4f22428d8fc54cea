"""Hard negatives of anchor vectors, by a secondary-sort shuffle of pair scores.

Scores are exact integer inner products. An anchor's positives are its best rows of its own label; each positive opens a window
of scores, a share of its own, and the best rows of other labels inside that window are its hard negatives.

A pair becomes a packed key: anchor, descending score, positives before negatives at one score, id. Keys are dealt to partitions
by anchor and sorted inside them (`repartition` and `sortWithinPartitions`, the DataFrame form of
repartitionAndSortWithinPartitions, so the sort spills and no Python row is sorted). An iterator then streams a partition once:
a positive opens its window, a negative goes to every open window it falls into, a window closes when it is full or scores fall
below it. It holds the open windows of one anchor, never the anchor's pairs.

Pairs are combined before they are shuffled. Anchors are the stated query set and are broadcast in blocks of at most `BLOCK`;
each task scores its rows against a block, keeps what can still be among an anchor's best and sends that: the `positives` best of
a label, then, with the windows known from a first run over all rows, the `negatives` best of each window. Both cuts are exact,
since the best of all rows are among the best of each task. So a shuffle holds at most tasks * anchors * positives * negatives
keys, however many rows share a vector or a label.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part, nor do vectors whose
length differs from the commonest (the longer one, if two are as common), nor rows without an id. Rows that repeat an id count as
one, the least by (label, vector). Equal scores are ordered by id. An empty table, or one without anchors, has no results.
Windows of negative scores are empty. Extra columns play no part. A score outside 64 bits stops the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import ship
from drawdown.session import materialise, work_dir

#: Anchors broadcast at once, at most, and the bytes of their vectors; cells of the score matrix a task holds at once.
BLOCK = 4096
BLOCK_BYTES = 16 << 20
CELLS = 1 << 21

PAIRS = "anchor_id BIGINT, key BINARY"
FOUND = "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, positive_score BIGINT, negative_score BIGINT"
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
FLIP = np.uint64(1 << 63)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Signed integers as unsigned ones of the same order."""
    return values.astype(np.int64).view(np.uint64) ^ FLIP


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> list[bytes]:
    """Keys whose byte order is anchor, score from high to low, positives (0) before negatives (1), id."""
    keys = np.empty(len(anchor), dtype=KEY)
    keys["anchor"], keys["score"], keys["kind"], keys["id"] = _ordered(anchor), ~_ordered(score), kind, _ordered(ids)
    raw = keys.tobytes()
    return [raw[i : i + KEY.itemsize] for i in range(0, len(raw), KEY.itemsize)]


def unpack(keys: pa.Array) -> tuple[list[int], list[int], list[int], list[int]]:
    """anchor, score, kind, id of packed keys."""
    got = np.frombuffer(b"".join(keys.to_pylist()), dtype=KEY)
    back = lambda x: (x.astype(np.uint64) ^ FLIP).view(np.int64).tolist()
    return back(got["anchor"]), back(~got["score"].astype(np.uint64)), got["kind"].tolist(), back(got["id"])


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows held as doubles: by BLAS where no sum can leave 53 bits, else in Python's integers."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), dtype=np.int64)
    if np.abs(left).max() * np.abs(right).max() * left.shape[1] < 2.0**53:
        return (left @ right.T).astype(np.int64)
    exact = lambda x: np.array([[int(c) for c in row] for row in x], dtype=object)
    return (exact(left) @ exact(right).T).astype(np.int64)


class Best:
    """The `k` best (score high, id low) of each of n groups, fed block by block."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.group = self.score = self.id = np.zeros(0, dtype=np.int64)
        self.least = np.full(n, np.iinfo(np.int64).min)
        self.last = np.full(n, np.iinfo(np.int64).max)

    def feed(self, scores: np.ndarray, ids: np.ndarray, may: np.ndarray) -> None:
        least, last = self.least[:, None], self.last[:, None]
        row, col = np.nonzero(may & ((scores > least) | ((scores == least) & (ids[None, :] < last))))
        if not len(row):
            return
        group = np.concatenate([self.group, row])
        score = np.concatenate([self.score, scores[row, col]])
        chosen = np.concatenate([self.id, ids[col]])
        order = np.lexsort((chosen, -score, group))
        group, score, chosen = group[order], score[order], chosen[order]
        first = np.searchsorted(group, group)
        kept = np.arange(len(group)) - first < self.k
        self.group, self.score, self.id = group[kept], score[kept], chosen[kept]
        full = np.arange(len(group)) - first == self.k - 1
        self.least[group[full]], self.last[group[full]] = score[full], chosen[full]


def vectors(table: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label, q (array of whole doubles) of the rows that take part, one for each id."""
    c = lambda name: F.col(f"`{name}`")
    usable = c(vector).isNotNull() & ~F.exists(c(vector), _unusable) & c("vec_id").isNotNull() & c("label").isNotNull()
    vec_id, label = c("vec_id").cast("bigint"), c("label").cast("bigint")
    rows = table.filter(usable).select(
        vec_id.alias("vec_id"),
        F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(c(vector), lambda x: _floor(x.cast("double") * scale)).alias("q"),
    )
    common = rows.groupBy(F.size("q").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("q") == (common["d"] if common else 0))
    repeated = materialise(rows.groupBy("vec_id").count().filter("count > 1").select("vec_id"), "repeated-ids")
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row"))
    return materialise(rows.join(repeated, "vec_id", "left_anti").unionByName(one.select("vec_id", "row.*")), "vectors")


def _floor(x: Column) -> Column:
    """Doubles from 2^53 on are whole."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def _unusable(x: Column) -> Column:
    x = x.cast("double")
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def _matrix(batch: pa.RecordBatch, name: str = "q") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _pairs(rows: DataFrame, block, kind: int, k: int) -> DataFrame:
    """anchor_id, key of each task's best pairs with one block of anchors (ids, labels, vectors, then each window's bounds)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_ids, labels, anchors, windows = block.value
        if not len(anchor_ids):
            return
        holders = [Best(len(anchor_ids), k) for _ in range(1 if kind == 0 else windows.shape[1])]
        step = max(1, CELLS // len(anchor_ids))
        for whole in batches:
            for at in range(0, len(whole), step):
                batch = whole.slice(at, step)
                ids, own = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("vec_id", "label"))
                scores = products(anchors, _matrix(batch))
                alike = labels[:, None] == own[None, :]
                if kind == 0:
                    holders[0].feed(scores, ids, alike & (anchor_ids[:, None] != ids[None, :]))
                    continue
                other = ~alike & (anchor_ids[:, None] != ids[None, :])
                for j, holder in enumerate(holders):
                    low, high = windows[:, j, 0][:, None], windows[:, j, 1][:, None]
                    holder.feed(scores, ids, other & (scores >= low) & (scores <= high))
        for holder in holders:
            anchor = anchor_ids[holder.group]
            keys = pack(anchor, holder.score, kind, holder.id)
            yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(keys, pa.binary())], ["anchor_id", "key"])

    return rows.mapInArrow(score, PAIRS)


def _sorted(pairs: DataFrame) -> DataFrame:
    return pairs.repartition("anchor_id").sortWithinPartitions("key").select("key")


def _positives(pairs: DataFrame, positives: int) -> DataFrame:
    """anchor_id, score, id of the first pairs of each anchor."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, taken = None, 0
        for batch in batches:
            out = []
            for anchor, score, _, vec_id in zip(*unpack(batch.column(0))):
                current, taken = (current, taken) if anchor == current else (anchor, 0)
                if taken < positives:
                    out.append((anchor, score, vec_id))
                    taken += 1
            yield pa.RecordBatch.from_pylist([dict(zip(("anchor_id", "score", "id"), x)) for x in out], schema=POSITIVES)

    return _sorted(pairs).mapInArrow(take, "anchor_id BIGINT, score BIGINT, id BIGINT")


POSITIVES = pa.schema([("anchor_id", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])


def _streamed(pairs: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """The negatives of each window, from sorted keys of positives and candidates."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    schema = pa.schema([(x, pa.int32() if x == "rank" else pa.int64()) for x in names])

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows, before = None, [], None
        for batch in batches:
            out = []
            for pair in zip(*unpack(batch.column(0))):
                anchor, score, kind, vec_id = pair
                if anchor != current:
                    current, windows, before = anchor, [], None
                if kind == 0:
                    windows.append([vec_id, score, 0])
                    continue
                if pair[1:] == before:  # the same row, sent for another window
                    continue
                before = pair[1:]
                for window in windows:
                    if low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], vec_id, window[1], score))
                windows = [w for w in windows if w[2] < negatives and 100 * score >= low * w[1]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(list(zip(*out)) or [[]] * len(names), schema)], schema=schema)

    return _sorted(pairs).mapInArrow(mine, FOUND)


def _blocks(anchors: DataFrame) -> Iterator[pa.Table]:
    """The anchors in blocks of bounded size, one at a time."""
    first = anchors.select(F.size("q").alias("d")).first()
    if first is None:
        return
    limit = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, first["d"]))))
    n = 1
    while True:
        dealt = F.pmod(F.xxhash64("vec_id"), F.lit(n))
        if anchors.groupBy(dealt.alias("block")).count().agg(F.max("count")).first()[0] <= limit:
            break
        n *= 2
    for k in range(n):
        block = anchors.filter(dealt == k).toArrow()
        if block.num_rows:
            yield block


def _windows(anchor_ids: np.ndarray, found: DataFrame, positives: int, low: int, high: int) -> np.ndarray:
    """Least and greatest score of each window of each anchor of a block; a missing positive has an empty one."""
    place = {x: i for i, x in enumerate(anchor_ids.tolist())}
    bounds = np.tile(np.array([1, 0], dtype=np.int64), (len(place), positives, 1))
    opened = [0] * len(place)
    for row in found.collect():  # at most `positives` rows for each anchor of one block
        i = place[row["anchor_id"]]
        bounds[i, opened[i]] = (-(-low * row["score"] // 100), high * row["score"] // 100)
        opened[i] += 1
    return bounds


def _keyed(found: DataFrame) -> DataFrame:
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, score, ids = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("anchor_id", "score", "id"))
            keys = pa.array(pack(anchor, score, 0, ids), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("anchor_id"), keys], ["anchor_id", "key"])

    return found.mapInArrow(key, PAIRS)


def mine(
    table: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, every: int = 50
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `every`; a window is `low` to `high` per cent of its positive's score.
    """
    spark = table.sparkSession
    ship(spark)
    rows = vectors(table)
    anchors = materialise(rows.filter(F.col("vec_id") % every == 0), "anchors")
    path = work_dir(spark, "hard-negatives")
    spark.createDataFrame([], FOUND).write.parquet(path)
    for block in _blocks(anchors):
        ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
        matrix = np.concatenate([_matrix(x) for x in block.to_batches()])
        known = spark.sparkContext.broadcast((ids, labels, matrix, None))
        found = materialise(_positives(_pairs(rows, known, 0, positives), positives), "positives")
        opened = spark.sparkContext.broadcast((ids, labels, matrix, _windows(ids, found, positives, low, high)))
        pairs = _keyed(found).unionByName(_pairs(rows, opened, 1, negatives))
        _streamed(pairs, negatives, low, high).write.mode("append").parquet(path)
        known.destroy()
        opened.destroy()
    return spark.read.schema(FOUND).parquet(path)
