"""Language identification by the nearest of several centroids per language.

A text is the counts of its character 1- to 3-grams (letters of any script in lower case, everything else one blank), hashed to
`DIMS` places, damped by log(1 + count), weighted by inverse document frequency and normalised. Per language, spherical k-means
over at most about `per_language` training texts gives up to `clusters` centroids. A text gets the language of the centroid
with the highest cosine; it is rejected, that is too far from all centroids, when that cosine is under the `reject_share`
quantile of what the language's own training texts reach.

Document frequencies cover all training texts: each task sums its own and one row per place goes on. The driver sees `DIMS`
frequencies and the centroids, both bounded by parameters and the number of languages.

Defined results: null texts and texts without a letter are `und` with score 0; rows with a null language or id, or without a
letter, are not learned from; ties go to the language first in order; without training rows everything is `und`. Repeated
rows are learned from and predicted each by itself. Extra columns play no part.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import BROADCAST_ROWS, ship

DIMS = 4096
ROWS = 256


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for code points of letters, up to the last plane in use."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x32000)], dtype=bool)


def counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of a text's n-grams; None if it has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = _letters()
    known = letters[np.minimum(codes, len(letters) - 1)] if codes.max() >= len(letters) else letters[codes]
    if not known.any():
        return None
    c = np.where(known, codes, 32).astype(np.uint32)
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]])
    # Runs of other characters are one blank.
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    pairs = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    out = np.bincount((c * np.uint32(0x9E3779B1)) >> shift, minlength=DIMS)
    out += np.bincount(pairs >> shift, minlength=DIMS)
    out += np.bincount(triples >> shift, minlength=DIMS)
    return out


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, texts = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            row = counts(text.as_py())
            if row is not None:
                found += row > 0
                texts += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, DIMS, dtype=np.int32)), pa.array(np.concatenate([[texts], found]))], ["place", "n"]
    )


def _vectors(texts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised rows, and which texts have letters."""
    rows, known = np.zeros((len(texts), DIMS), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    for i, text in enumerate(texts):
        row = counts(text)
        if row is not None:
            rows[i] = np.log1p(row) * idf
            known[i] = True
    return _normal(rows), known


def k_means(x: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Centroids of unit rows by cosine; the first are spread out, each the row farthest from those before."""
    centres = _normal(x.mean(axis=0, keepdims=True))
    centres = x[[int(np.argmax(x @ centres[0]))]]
    while len(centres) < min(clusters, len(x)):
        centres = np.vstack([centres, x[int(np.argmin((x @ centres.T).max(axis=1)))]])
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        centres = np.vstack([_normal(x[nearest == k].mean(axis=0)) if (nearest == k).any() else centres[k] for k in range(len(centres))])
    return centres


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    limits: np.ndarray  # least cosine of each centroid's language
    idf: np.ndarray


def fit(
    training: DataFrame, clusters: int = 4, per_language: int = 250, reject_share: float = 0.005
) -> Model:
    """Learns from doc_id, text, lang; only the centroids are fitted on a sample, which `per_language` bounds."""
    ship(training.sparkSession)
    rows = training.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    found = rows.select("text").mapInArrow(_frequencies, "place INT, n BIGINT").groupBy("place").agg(F.sum("n").alias("n"))
    df = {r.place: r.n for r in found.collect()}
    idf = np.array([np.log((1 + df.get(-1, 0)) / (1 + df.get(k, 0))) + 1 for k in range(DIMS)], dtype=np.float32)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per language; as a shuffle join it would gather a language's texts in one task.
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes
    share = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.join(sizes, "lang").filter(share * F.col("_rows") < per_language)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x, known = _vectors(part.column(2).to_pylist(), idf)
                keep = np.flatnonzero(known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keep)), part.column(1).take(pa.array(keep)), pa.array([x[i].tobytes() for i in keep], pa.binary())],
                    ["lang", "doc_id", "x"],
                )

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        # A sample has about per_language rows; a language whose ids repeat may have more, all of one id.
        frame = frame.sort_values(["doc_id", "x"]).head(4 * per_language)
        x = np.vstack([np.frombuffer(v, dtype=np.float32) for v in frame["x"]])
        centres = k_means(x, clusters)
        limit = float(np.quantile((x @ centres.T).max(axis=1), reject_share))
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "limit": limit, "c": [v.astype(np.float32).tobytes() for v in centres]})

    kinds = f"lang STRING, doc_id {rows.schema['doc_id'].dataType.simpleString()}, x BINARY"
    made = chosen.select("lang", "doc_id", "text").mapInArrow(embed, kinds)
    got = made.groupBy("lang").applyInPandas(cluster, "lang STRING, limit DOUBLE, c BINARY").collect()
    got = sorted(got, key=lambda r: r.lang)
    centres = np.vstack([np.frombuffer(r.c, dtype=np.float32) for r in got]) if got else np.zeros((0, DIMS), dtype=np.float32)
    return Model([r.lang for r in got], centres, np.array([r.limit for r in got]), idf)


def predict(documents: DataFrame, model: Model, keep: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, the columns in `keep`, lang_pred, score, rejected of each document."""
    ship(documents.sparkSession)
    given = documents.select("doc_id", *keep, F.col("text").alias("_text"))
    out = given.drop("_text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(False)}).schema
    titles = out.names

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x, known = _vectors(part.column(part.num_columns - 1).to_pylist(), model.idf)
                near = x @ model.centroids.T if len(model.languages) else np.zeros((len(x), 1))
                best = near.argmax(axis=1) if len(model.languages) else np.zeros(len(x), dtype=int)
                known &= len(model.languages) > 0
                score = np.where(known, np.clip(near[np.arange(len(x)), best], 0, 1), 0.0).astype(float)
                far = ~known | (score < (model.limits[best] if len(model.languages) else 0.0))
                picked = names[np.where(known, best, len(model.languages))]
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                columns += [pa.array(picked.tolist(), pa.string()), pa.array(score), pa.array(far)]
                yield pa.RecordBatch.from_arrays(columns, titles)

    return given.mapInArrow(judge, out)


def held_out(folds: int = 5) -> Column:
    """Whether a document is in the fold kept from training; documents without id are."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))


def report(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each document, learned from the other folds."""
    training = documents.filter(~held_out()).select("doc_id", "text", "lang")
    return predict(documents, fit(training), (held_out().alias("held_out"),))
