"""Benchmark decontamination: prefix-filtered containment of item windows in documents.

A window is ``size`` consecutive words of an item; a shorter item with words is one window. A window is contained in a
document where all its words stand in order. Containment of the whole window means that each of its words must be in the
document, so the prefix that a set join has to look at is one token: the window's rarest word over all documents. Documents
are probed with that word only, the window's place follows from the word's offset in it (positional bound), windows that
would begin before or end after the text are left out (length bound), and what remains is compared word by word.

Everything is DataFrame operations. Hot words do not matter: the rarest word of a window is used, counts are combined before
the shuffle, and the window table is broadcast only while it has at most ``BROADCAST_ROWS`` rows; beyond that, and only then,
words are shuffled.

Defined results: a null text has no words; a document without words gets zero counts and the digest of the empty string;
rows that repeat both id and text count once; items without id or without words are left out; an item whose window occurs
twice counts once; with an empty benchmark every document is clean. Extra columns of either table play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import BROADCAST_ROWS, LOWER, UPPER, free_names, whole

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z."""
    pieces = F.split(F.translate(whole(text), UPPER, LOWER), SEPARATORS)
    # Only the first and the last piece can be empty.
    return F.array_remove(pieces, "")


def windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """item_id, window (array of words), once per item and window."""
    words = benchmark.select(F.col("item_id"), item_words(F.col("text")).alias("words")).filter(
        F.col("item_id").isNotNull() & (F.size("words") > 0)
    )
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (size - 1)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.slice("words", F.col("at"), F.lit(size)).alias("window"))
        .distinct()
    )


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def occurrences(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, text_key, start, length, item_id of each window found in a document.

    Each document also has one row with length 0 whose start is its number of words and whose item is null.
    """
    grams = windows(benchmark, size)
    many = benchmark.select(F.size(item_words(F.col("text"))).alias("n")).agg(F.sum("n")).first()[0] or 0
    docs = documents.select(
        "doc_id", F.xxhash64(whole("text")).alias("text_key"), item_words(F.col("text")).alias("words")
    )
    vocabulary = grams.select(F.explode("window").alias("word")).distinct()
    counts = (
        docs.select(F.explode("words").alias("word"))
        .join(_bounded(vocabulary, many), "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    # A word that no document has rules its window out: the inner join drops the word, the count below the window.
    tokens = grams.select("item_id", "window", F.posexplode("window").alias("offset", "word")).join(counts, "word")
    rarest = (
        tokens.groupBy("item_id", "window")
        .agg(
            F.min_by(F.struct("word", "offset"), F.struct("frequency", "word", "offset")).alias("rare"),
            F.count(F.lit(1)).alias("present"),
        )
        .filter(F.col("present") == F.size("window"))
        .select("item_id", "window", F.col("rare.word").alias("word"), F.col("rare.offset").alias("offset"))
    )
    spark = documents.sparkSession
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    # The empty word is no word: it stands once behind each text and meets the empty window.
    closing = spark.range(1).select(
        F.lit(None).cast(item_type).alias("item_id"),
        F.array().cast("array<string>").alias("window"),
        F.lit("").alias("word"),
        F.lit(0).alias("offset"),
    )
    places = docs.select(
        "doc_id", "text_key", "words", F.posexplode(F.array_append("words", F.lit(""))).alias("at", "word")
    )
    begin = F.col("at") - F.col("offset")
    length = F.size("window")
    return (
        places.join(_bounded(rarest.unionByName(closing), many), "word")
        .filter(
            (begin >= 0)
            & (begin + length <= F.size("words"))
            & (F.slice("words", begin + 1, length) == F.col("window"))
        )
        .select("doc_id", "text_key", begin.alias("start"), length.alias("length"), "item_id")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, items (sorted texts of item ids) per document."""
    spots = F.when(F.col("length") > 0, F.sequence("start", F.col("start") + F.col("length") - 1))
    return (
        occurrences(documents, benchmark, size)
        .groupBy("doc_id", "text_key")
        .agg(
            F.max(F.when(F.col("length") == 0, F.col("start"))).cast("long").alias("n_words"),
            F.size(F.array_distinct(F.flatten(F.collect_set(spots)))).cast("long").alias("n_hit"),
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
    )


def report(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document."""
    return contamination(documents, benchmark, size).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    doc, key = free_names(documents.columns, "_dirty", "_key")
    dirty = (
        contamination(documents, benchmark, size)
        .filter(F.col("n_hit") > 0)
        .select(F.col("doc_id").alias(doc), F.col("text_key").alias(key))
    )
    same = documents["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(whole(documents["text"])) == F.col(key))
    return documents.join(dirty, same, "left_anti")
