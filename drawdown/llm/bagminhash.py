"""Near-duplicate documents by BagMinHash signatures of weighted shingles.

A document is the multiset of its `SHINGLE`-word shingles (words between ASCII white space, lower case; a shorter text is one
shingle). For a shingle the weight axis is cut into the intervals [0, 1), [1, 2), [2, 4), [4, 8), ...; each holds a Poisson
process of unit density, seeded by the shingle and the interval, whose points carry a time, a place on the axis and a register.
A point counts for a document if its place is under the shingle's weight there. A register keeps its earliest point. Two
documents agree in a register with exactly the probability of their weighted Jaccard similarity. Points are generated in order
of time and a process is left as soon as its time is over that of the document's last register.

`BANDS` bands of `ROWS` registers make candidates: at a similarity of 0.8 a pair escapes all bands with probability 3e-6. Documents
with the same multiset are one node beforehand. In each band bucket every node is compared with the bucket's first node, so that
a group of copies costs as many comparisons as it has members. Where a bucket still holds several components after that, the
nodes outside its first node's component are compared with all others of the bucket, in the first bucket a pair shares. Two
tests come before that, inside the join: 1 - similarity is a metric, so both must be about as far from the bucket's first node
(exact), and they must agree in `AGREE` registers (at 0.8 the chance to agree in fewer is 1e-6). Nodes of buckets with `CROWD`
rows or more left get a second signature of `LONG` registers for a sharper test of the same kind (`LONG_AGREE`, 1e-6 again), as
short ones can't tell a group whose members are two thirds alike from one of near-duplicates. Pairs that it takes for similar
(`LIKELY`) are verified first; what they link needs no more comparisons inside. Similarities are verified on
the multisets themselves: sum of minima over sum of maxima. A class is a connected component of verified links.

Defined results: a document without words is alone in its class; rows that repeat id and text are one document; a class is named
after its first document (least id, null last, then a hash of the text); an empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import free_names, ship, whole
from drawdown.llm.graph import components, extended
from drawdown.session import materialise

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 42, 6
REGISTERS = BANDS * ROWS
#: A pair agreeing in fewer registers is not compared; a binomial of 252 draws at 0.8 is lower with probability 1e-6.
AGREE = 170
#: Registers are compared by their lowest bits, bit by bit, in so many 64-bit words a bit.
BITS, WORDS = 8, 4
#: The second signature keeps one bit a register, so registers agree with probability 1 - (1 - similarity) / 2: 0.9 at 0.8, where
#: a binomial of 4096 draws is under `LONG_AGREE` with probability 1e-6. Buckets of fewer than `CROWD` rows have few pairs,
#: which are verified without it.
LONG, LONG_AGREE, LIKELY = 4096, 3592, 3686
CROWD = 24
#: Processes handled at once.
BLOCK = 150_000
NODES = "doc_id BIGINT, text_key BIGINT, n_shingles BIGINT, bag1 BIGINT, bag2 BIGINT, bands ARRAY<BIGINT>, planes ARRAY<BIGINT>"

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_words = Words()


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and how often each occurs."""
    h = word_hashes(text)
    if not len(h):
        return h, np.zeros(0, dtype=np.int64)
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(min(SHINGLE, len(h))):
        out = mix(out * _B + h[k : k + n])
    return np.unique(out, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    high = a[1].sum() + b[1].sum() - low
    return float(low / high) if high else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """One row of registers per (non-empty) bag; equal registers hold the same point."""
    seeds, weights, starts, sizes, owner = [], [], [], [], []
    for k, (shingles, count) in enumerate(bags):
        level, low, high = 0, 0, 1
        while len(shingles):
            seeds.append(mix(shingles + np.array([level], dtype=np.uint64) * _A))
            weights.append(count.astype(float))
            starts.append(np.full(len(shingles), low, dtype=float))
            sizes.append(np.full(len(shingles), high - low, dtype=float))
            owner.append(np.full(len(shingles), k))
            more = count > high
            shingles, count = shingles[more], count[more]
            level, low, high = level + 1, high, 2 * high
    best = np.full(len(bags) * registers, ~np.uint64(0))
    if not seeds:
        return best.reshape(len(bags), registers)
    state, weight, low, size, own = map(np.concatenate, (seeds, weights, starts, sizes, owner))
    time = np.zeros(len(state), dtype=np.float64)
    while len(state):
        state = mix(state)
        # A point: exponential gap by the upper bits, register, place and name by a second scrambling.
        time = time - np.log(((state >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / size
        point = mix(state ^ _C)
        place = low + size * (point & np.uint64(0xFFFFF)) * 2.0**-20
        at = own * registers + ((point >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        # Earlier points have smaller numbers: the bits of a positive float keep its order.
        value = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (mix(point) >> np.uint64(32))
        good = (place < weight) & (value < best[at])
        np.minimum.at(best, at[good], value[good])
        last = best.reshape(len(bags), registers).max(axis=1)
        more = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) < last[own]
        if not more.all():
            state, time, weight, low, size, own = (x[more] for x in (state, time, weight, low, size, own))
    return best.reshape(len(bags), registers)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One key per band, which also tells the bands apart."""
    parts = rows.reshape(len(rows), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(rows), BANDS))
    for k in range(ROWS):
        key = mix(key * _B + parts[:, :, k])
    return key.view(np.int64)


def bit_planes(rows: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The lowest bits of all registers: words of 64 with the registers' first bits, then with their second ones, and so on."""
    registers = rows.shape[1]
    words = -(-registers // 64)
    lowest = np.unpackbits(rows.astype(np.uint8)[:, :, None], axis=2)[:, :, 8 - bits :].transpose(0, 2, 1)
    filled = np.zeros((len(rows), bits, words * 64), dtype=np.uint8)
    filled[:, :, :registers] = lowest
    return np.packbits(filled, axis=2).reshape(len(rows), bits * words * 8).view(np.int64)


def agreement(a: Column, b: Column) -> Column:
    """In how many registers two nodes agree, by the registers' lowest `BITS` bits; never less than they do."""
    differ = F.lit(0)
    for word in range(WORDS):
        parts = [a.getItem(k).bitwiseXOR(b.getItem(k)) for k in range(word, BITS * WORDS, WORDS)]
        differ = differ + F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), parts))
    return F.lit(REGISTERS) - differ


def long_agreement(a: Column, b: Column) -> Column:
    """In how many bits the second signatures agree; null where a node has none."""
    differ = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.lit(LONG) - F.aggregate(differ, F.lit(0), lambda total, x: total + x)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in NODES.split(", ")]

    def block(rows: list) -> pa.RecordBatch:
        full = [r for r in rows if len(r[2][0])]
        registers = signatures([r[2] for r in full])
        digest = []
        for _, _, (shingles, count) in full:
            both = mix(shingles ^ mix(count.astype(np.uint64)))
            digest.append((int(both.sum(dtype=np.uint64).view(np.int64)), int(mix(both).sum(dtype=np.uint64).view(np.int64))))
        columns = [
            [r[0] for r in full],
            [r[1] for r in full],
            [int(r[2][1].sum()) for r in full],
            [x[0] for x in digest],
            [x[1] for x in digest],
        ]
        lists = [
            pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * width), pa.array(values.ravel()))
            for values, width in ((band_keys(registers), BANDS), (bit_planes(registers), BITS * WORDS))
        ]
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), *lists], names)

    for batch in batches:
        rows, held = [], 0
        for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            rows.append((doc_id, key, bag(text.as_py())))
            held += len(rows[-1][2][0])
            if held > BLOCK:
                yield block(rows)
                rows, held = [], 0
        if rows:
            yield block(rows)


def _lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second signatures (node, long) of nodes and their texts."""

    def block(nodes: list, bags: list) -> pa.RecordBatch:
        planes = bit_planes(signatures(bags, LONG), 1)
        offsets = pa.array(np.arange(len(bags) + 1, dtype=np.int32) * planes.shape[1])
        lists = pa.ListArray.from_arrays(offsets, pa.array(planes.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists], ["node", "long"])

    for batch in batches:
        nodes, bags, held = [], [], 0
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            nodes.append(node)
            bags.append(bag(text.as_py()))
            held += len(bags[-1][0])
            if held > BLOCK:
                yield block(nodes, bags)
                nodes, bags, held = [], [], 0
        if nodes:
            yield block(nodes, bags)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: dict[int, tuple] = {}
        found = []
        ids = [batch.column(k).to_pylist() for k in (0, 1)]
        for k, (a, b) in enumerate(zip(*ids)):
            for node, column in ((a, 2), (b, 3)):
                if node not in seen:
                    if len(seen) > 200:
                        seen.clear()
                    seen[node] = bag(batch.column(column)[k].as_py())
            first = seen.get(a) or bag(batch.column(2)[k].as_py())
            found.append(similarity(first, seen[b]))
        columns = [batch.column(0), batch.column(1), pa.array(found, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "similarity"])


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole("text")).alias("text_key"), F.col("text")
    )


def classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, text_key, node) of all documents with words, and components (node, label) of nodes with links."""
    ship(documents.sparkSession)
    rows = _keyed(documents)
    described = materialise(rows.mapInArrow(_describe, NODES), "bags")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(9223372036854775807)).alias("id"), "text_key"))
    nodes = described.groupBy("bag1", "bag2", "n_shingles").agg(first.alias("rep"))
    # Numbered in the order of their first documents within a task; any numbers do, once written.
    nodes = materialise(nodes.select("*", F.monotonically_increasing_id().alias("node")), "bag-nodes")
    same_bag = ["bag1", "bag2", "n_shingles"]
    members = described.join(nodes, same_bag).select("doc_id", "text_key", "node", "rep", "bands", "planes")
    is_rep = (F.coalesce("doc_id", F.lit(9223372036854775807)) == F.col("rep.id")) & (F.col("text_key") == F.col("rep.text_key"))
    reps = members.filter(is_rep).dropDuplicates(["node"])
    banded = reps.select("node", F.explode("bands").alias("key"))
    crowded = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = materialise(banded.join(crowded.select("key", "hub"), "key"), "bands")

    stars = met.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    wanted = met.select("node").distinct().join(nodes.select("node", "rep"), "node")
    texts = rows.select(
        F.coalesce("doc_id", F.lit(9223372036854775807)).alias("id"), F.col("text_key"), "text"
    ).join(wanted.select("node", "rep.*"), ["id", "text_key"])
    texts = materialise(texts.select("node", "text").dropDuplicates(["node"]), "texts")
    compared = _verified(stars, texts)
    known = components(compared.filter(F.col("similarity") >= SIMILAR))

    # What a bucket's first node did not settle.
    label = F.coalesce("label", "node")
    placed = met.join(known, "node", "left").select("key", "node", "hub", label.alias("label"))
    hubs = known.toDF("hub", "hub_label")
    placed = materialise(
        placed.join(hubs, "hub", "left").select(
            "key", "node", "hub", "label", F.coalesce("hub_label", "hub").alias("hub_label")
        ),
        "placed",
    )
    contested = placed.filter(F.col("label") != F.col("hub_label")).select("key").distinct()
    disputed = placed.join(contested, "key", "left_semi")
    crowds = disputed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= CROWD).select("key")
    crowded = disputed.join(crowds, "key", "left_semi").select("node").distinct()
    longer = texts.join(crowded, "node", "left_semi").mapInArrow(_lengthen, "node BIGINT, long ARRAY<BIGINT>")
    longer = materialise(longer, "long")
    far = compared.select(F.col("a").alias("hub"), F.col("b").alias("node"), (1 - F.col("similarity")).alias("far"))
    contested = materialise(
        disputed.join(far, ["hub", "node"], "left")
        .join(reps.select("node", "bands", "planes"), "node")
        .join(longer, "node", "left")
        .select("key", "node", "label", "hub_label", F.coalesce("far", F.lit(0.0)).alias("far"), "bands", "planes", "long"),
        "contested",
    )
    agree = long_agreement(F.col("l.long"), F.col("r.long"))
    likely = _similar(_pairs(contested, F.coalesce(agree >= LIKELY, F.lit(False))), texts)
    known = extended(known, likely)
    contested = contested.join(known.toDF("node", "settled"), "node", "left").withColumn("settled", F.coalesce("settled", "node"))
    open_still = (F.col("l.settled") != F.col("r.settled")) & F.coalesce(agree.between(LONG_AGREE, LIKELY - 1), F.lit(True))
    more = _similar(_pairs(contested, open_still), texts)
    return members.select("doc_id", "text_key", "node"), extended(known, more)


def _pairs(contested: DataFrame, wanted: Column) -> DataFrame:
    """Pairs of one bucket that its first node left open and that may be similar, each in the first bucket it shares."""
    left = contested.filter(F.col("label") != F.col("hub_label")).alias("l")
    return left.join(
        contested.alias("r"),
        (F.col("l.key") == F.col("r.key"))
        & (F.col("l.label") != F.col("r.label"))
        & ((F.col("l.node") < F.col("r.node")) | (F.col("r.label") == F.col("r.hub_label")))
        & (F.abs(F.col("l.far") - F.col("r.far")) <= 1 - SIMILAR + 1e-9)
        & (agreement(F.col("l.planes"), F.col("r.planes")) >= AGREE)
        & (F.element_at(F.array_intersect("l.bands", "r.bands"), 1) == F.col("l.key"))
        & wanted,
    ).select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return _verified(pairs, texts).filter(F.col("similarity") >= SIMILAR)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs and their similarities, written once."""
    left, right = texts.toDF("a", "a_text"), texts.toDF("b", "b_text")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")
    return materialise(both.mapInArrow(_verify, "a BIGINT, b BIGINT, similarity DOUBLE"), "links")


def _classed(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, class (doc_id and text_key of its first document), class_size of documents with words."""
    members, linked = classes(documents)
    key = F.struct(F.coalesce("doc_id", F.lit(9223372036854775807)).alias("id"), "text_key")
    labelled = members.join(linked, "node", "left").select(
        "doc_id", "text_key", F.coalesce("label", "node").alias("label"), key.alias("key")
    ).distinct()
    heads = labelled.groupBy("label").agg(F.min("key").alias("class"), F.count(F.lit(1)).alias("class_size"))
    return labelled.join(heads, "label").select("doc_id", "text_key", "key", "class", "class_size")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of its near-duplicates and itself), class_size, kept of each document."""
    found = _classed(documents).select(
        "doc_id",
        F.when(F.col("class.id") != 9223372036854775807, F.col("class.id")).alias("class_id"),
        "class_size",
        (F.col("key") == F.col("class")).alias("kept"),
    )
    empty = F.btrim(whole("text"), F.lit(" \t\n\x0b\f\r")) == ""
    alone = documents.filter(empty).select(F.col("doc_id").cast("long").alias("doc_id")).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return found.unionByName(alone)


def dedup(documents: DataFrame) -> DataFrame:
    """One document of each class, with all its columns; texts without words stay."""
    doc, key = free_names(documents.columns, "_id", "_key")
    gone = _classed(documents).filter(F.col("key") != F.col("class")).select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(key)
    )
    same = documents["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(whole(documents["text"])) == F.col(key))
    return documents.join(gone, same, "left_anti")
