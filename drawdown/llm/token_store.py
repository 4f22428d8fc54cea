"""Token ids on disk: one shared zstandard dictionary, every document compressed by itself, found through an offset index.

Documents are range-partitioned and sorted by id. A task encodes its documents and writes shards; a shard is one binary image

    b"IDS1"  sha256 of the dictionary (32)  n (u4)
    doc ids (i8 * n)  id is null (u1 * n)  numbers of ids (u4 * n)  frame offsets (u8 * (n + 1))  frames

with one zstandard frame per document over its ids as little-endian u4. One document is read by decompressing one frame. Shards
are the rows of a Parquet table, so that Spark's writers commit them (a lost executor leaves no half file) and any store Spark
reaches will do; the rows also carry the range of ids and the counts that a reader needs to skip shards.

The dictionary is trained on the serialized ids of about `SAMPLE` documents, chosen by a hash of their id, with at most
`SAMPLE_BYTES` of each; it changes sizes, never contents.

Defined results: null text is the empty text; null ids come first; documents that share an id stand in the order of a hash of
their text; an empty table gives an empty store. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawdown.llm.common import ship, whole
from drawdown.llm.encoding import IDS, encoder
from drawdown.session import work_dir

MAGIC = b"IDS1"
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16_384, 65_536
#: Ids of a shard, unless one document has more.
SHARD_IDS = 1_000_000
LEVEL = 1
SHARDS = "part INT, first_doc_id BIGINT, last_doc_id BIGINT, n_docs INT, start BIGINT, n_ids BIGINT, image BINARY"
ROWS = "doc_id BIGINT, part INT, start BIGINT, ids BINARY"


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def train(documents: DataFrame, path: str, kind: str, end_id: int) -> bytes:
    """A dictionary from a bounded sample; empty where there is too little to learn from."""
    import zstandard

    rows = documents.count()
    share = min(1.0, SAMPLE / max(1, rows))
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = documents.filter(order <= int(share * (1 << 30))).select(order.alias("o"), F.col("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, kind)
        for batch in batches:
            raw = [_serial(made, t, end_id)[:SAMPLE_BYTES] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["o", "raw"])

    found = [r.raw for r in chosen.mapInArrow(encode, "o BIGINT, raw BINARY").sort("o", "raw").limit(4 * SAMPLE).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(x) for x in found]).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples
        return b""


def _serial(made, text: str | None, end_id: int) -> bytes:
    return made.encode(text) + np.array([end_id], dtype=IDS).tobytes()


def pack_shard(ids: list[int | None], counts: list[int], frames: list[bytes], digest: bytes) -> bytes:
    n = len(ids)
    offsets = np.zeros(n + 1, dtype="<u8")
    np.cumsum([len(x) for x in frames], out=offsets[1:])
    keys = np.array([x or 0 for x in ids], dtype="<i8")
    null = np.array([x is None for x in ids], dtype="u1")
    head = [MAGIC, digest, np.array([n], dtype="<u4"), keys, null, np.array(counts, dtype="<u4"), offsets]
    return b"".join([x if isinstance(x, bytes) else x.tobytes() for x in head] + frames)


class Shard:
    """A shard's image; `ids(k)` decompresses the k-th document alone."""

    def __init__(self, image: bytes, dictionary: bytes):
        import zstandard

        if image[:4] != MAGIC or image[4:36] != hashlib.sha256(dictionary).digest():
            raise ValueError("not a shard of this dictionary")
        n = int(np.frombuffer(image, "<u4", 1, 36)[0])
        keys = np.frombuffer(image, "<i8", n, 40)
        null = np.frombuffer(image, "u1", n, 40 + 8 * n)
        self.doc_ids = [None if gone else int(k) for k, gone in zip(keys, null)]
        self.counts = np.frombuffer(image, "<u4", n, 40 + 9 * n)
        self.offsets = np.frombuffer(image, "<u8", n + 1, 40 + 13 * n).astype(np.int64)
        self.frames = memoryview(image)[40 + 13 * n + 8 * (n + 1) :]
        given = _dictionary(dictionary)
        self.unpack = zstandard.ZstdDecompressor(dict_data=given) if given else zstandard.ZstdDecompressor()

    def ids(self, k: int) -> bytes:
        return self.unpack.decompress(self.frames[self.offsets[k] : self.offsets[k + 1]])


def write(documents: DataFrame, root: str, path: str, kind: str, end_id: int) -> None:
    """Writes the ids of all documents, each followed by `end_id`, to `root`/shards and the dictionary beside them."""
    spark = documents.sparkSession
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train(rows, path, kind, end_id)
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary BINARY").coalesce(1).write.parquet(f"{root}/dictionary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        made, given = encoder(path, kind), _dictionary(dictionary)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=given) if given else zstandard.ZstdCompressor(level=LEVEL)
        digest, part = hashlib.sha256(dictionary).digest(), TaskContext.get().partitionId()
        ids, counts, frames, start, size = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            known = [x for x in ids if x is not None] or [None]
            row = [part, known[0], known[-1], len(ids), start, size, pack_shard(ids, counts, frames, digest)]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in SHARDS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = _serial(made, text.as_py(), end_id)
                ids.append(doc_id)
                counts.append(len(raw) // 4)
                frames.append(squeeze.compress(raw))
                size += len(raw) // 4
                if size >= SHARD_IDS:
                    yield shard()
                    start += size
                    ids, counts, frames, size = [], [], [], 0
        if ids:
            yield shard()

    by_id = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64(whole("text")))
    by_id.mapInArrow(encode, SHARDS).write.option("compression", "none").parquet(f"{root}/shards")


def _parts(spark: SparkSession, root: str) -> DataFrame:
    """part, before: the ids in all parts before. One row per task that wrote."""
    sizes = spark.read.parquet(f"{root}/shards").groupBy("part").agg(F.sum("n_ids").alias("n")).sort("part").collect()
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    return spark.createDataFrame(rows, "part INT, before BIGINT")


def read(spark: SparkSession, root: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, ids (u4) of all documents, or of some, for which only their shards and frames are opened."""
    ship(spark)
    dictionary = bytes(spark.read.parquet(f"{root}/dictionary").first()[0])
    shards = spark.read.schema(SHARDS).parquet(f"{root}/shards")
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        inside = F.exists(
            F.array(*[F.lit(x).cast("long") for x in sorted(wanted)]),
            lambda x: x.between(F.col("first_doc_id"), F.col("last_doc_id")),
        )
        if wanted:
            shards = shards.filter((F.col("last_doc_id") >= min(wanted)) & (F.col("first_doc_id") <= max(wanted)))
        shards = shards.filter(inside if wanted else F.lit(False))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, image in zip(*[batch.column(x).to_pylist() for x in ("part", "start", "image")]):
                shard = Shard(image, dictionary)
                starts = start + np.concatenate([[0], np.cumsum(shard.counts[:-1], dtype=np.int64)])
                keep = [k for k, x in enumerate(shard.doc_ids) if wanted is None or x in wanted]
                if not keep:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.doc_ids[k] for k in keep], pa.int64()),
                        pa.array([part] * len(keep), pa.int32()),
                        pa.array([int(starts[k]) for k in keep], pa.int64()),
                        pa.array([shard.ids(k) for k in keep], pa.binary()),
                    ],
                    ["doc_id", "part", "start", "ids"],
                )

    found = shards.select("part", "start", "image").mapInArrow(rows, ROWS)
    # One row per task that wrote: bounded by the number of partitions, not by the data.
    parts = F.broadcast(_parts(spark, root))
    return found.join(parts, "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "ids")


def report(documents: DataFrame, path: str, kind: str, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from a store written and read back."""
    spark = documents.sparkSession
    root = work_dir(spark, "token-store")
    write(documents, root, path, kind, end_id)
    return read(spark, root).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
