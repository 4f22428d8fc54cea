"""Near-duplicate lines by a segment-partition edit join.

Lines of at least ``min_chars`` code points are joined when at most ``edits`` insertions, deletions or substitutions lead
from one to the other; shorter ones only when they are equal. Equal lines collapse to one class first. A class of length l is
cut into edits + 1 segments; among them at least one survives `edits` edits unchanged. The segments are the index, keyed by
(l, segment number, content). A line probes it for each length from its own down to `edits` less, with the substrings that
can align with the segment when the edits are shared out between its two sides (multi-match-aware selection). Pairs that
meet, and whose counts of some letters are no further apart than `edits` edits can bring them, are verified with a banded
bit-parallel edit distance.

Everything is DataFrame operations. The first shuffle combines equal lines beforehand, so a line that fills a third of the
table arrives as one row per task; the key of the join holds the length, so that a frequent beginning of lines does not
gather all of them; skewed partitions of the join can be split.

Defined results: lines are what stands between \\n; a line without a word is no line here and always stays; order is
(doc_id, line number), with null ids last; null texts have no lines; rows that repeat id and text are one document and all
keep what it keeps. A class is the lines of one 64-bit hash; where a second hash shows that two texts share it, none of that
class's lines is linked or removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.llm.common import NOT_BLANK, free_names, let, whole
from drawdown.session import materialise

NO_ID = 9223372036854775807
#: Frequent letters of Latin scripts, whose counts a line carries.
LETTERS = "etaonsrdilhcumpg"
# Room for the line number in the order key.
LINES = 10_000_000_000


def lines(documents: DataFrame, *more: Column) -> DataFrame:
    """doc_id, line_no, line, hash, check of each line with a word, and what else of the document is asked for."""
    split = documents.select("doc_id", *more, F.posexplode(F.split(whole("text"), "\n")).alias("line_no", "line"))
    return split.filter(F.col("line").rlike(NOT_BLANK)).select(
        "*", F.xxhash64("line").alias("hash"), F.xxhash64(F.lit(1), "line").alias("check")
    )


def _order() -> Column:
    return F.coalesce("doc_id", F.lit(NO_ID)).cast("decimal(20,0)") * F.lit(LINES).cast("decimal(11,0)") + F.col(
        "line_no"
    ).cast("decimal(11,0)")


def classes(documents: DataFrame, texts: bool = True) -> DataFrame:
    """hash, first (order of the first copy), n_copies, pure (one text only) and, if asked for, line and marks per class."""
    order = lines(documents).select("hash", "check", "line", _order().cast("decimal(38,0)").alias("order"))
    if texts:
        order = order.withColumn("marks", marks(F.col("line")))
    line = [F.first("line").alias("line"), F.first("marks").alias("marks")] if texts else []
    return order.groupBy("hash").agg(
        *line,
        F.min("order").alias("first"),
        F.count(F.lit(1)).alias("n_copies"),
        (F.min("check") == F.max("check")).alias("pure"),
    )


def _segment(length: Column, i: Column, edits: int) -> tuple[Column, Column]:
    """1-based place and length of a segment; the last ones are longer by one where the line does not divide."""
    parts = F.lit(edits + 1)
    longer = length % parts
    short = ((length - longer) / parts).cast("int")
    return short * i + F.greatest(F.lit(0), longer - (parts - i)) + 1, short + (parts - i <= longer).cast("int")


def marks(line: Column) -> Column:
    """Counts of some letters, modulo 4, two bits each; an edit changes one count, or two of them, by one."""
    size = F.octet_length(line)
    return F.aggregate(
        F.array(*[F.lit(x) for x in LETTERS]),
        F.lit(0),
        lambda bits, x: F.shiftleft(bits, 2).bitwiseOR((size - F.octet_length(F.replace(line, x, F.lit("")))) % 4),
    )


def _apart(a: Column, b: Column) -> Column:
    """Least number of letters that must change by one to lead from one line's marks to the other's."""
    total = F.lit(0)
    for k in range(len(LETTERS)):
        x, y = (F.shiftrightunsigned(m, 2 * k).bitwiseAND(F.lit(3)) for m in (a, b))
        gap = F.abs(x - y)
        total = total + F.least(gap, 4 - gap)
    return total


def index_keys(long_lines: DataFrame, edits: int) -> DataFrame:
    """key, hash, marks of each segment of each line."""
    rows = long_lines.select("hash", "marks", "line", "length", F.explode(F.sequence(F.lit(0), F.lit(edits))).alias("i"))
    at, size = _segment(F.col("length"), F.col("i"), edits)
    return rows.select(F.xxhash64("length", "i", F.substring(F.col("line"), at, size)).alias("key"), "hash", "marks")


def probe_keys(long_lines: DataFrame, edits: int) -> DataFrame:
    """key, hash, marks of each substring to look up among lines of the same length or up to `edits` shorter.

    How much shorter stands above the 32 bits of the marks.
    """
    looks = [
        F.struct(F.lit(less).alias("less"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
        for less in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)
    ]
    rows = long_lines.select("hash", "marks", "line", "length", F.explode(F.array(*looks)).alias("look"))
    rows = rows.select("hash", "marks", "line", "length", "look.*", (F.col("length") - F.col("look.less")).alias("other"))
    at, size = _segment(F.col("other"), F.col("i"), edits)
    begin = at + F.col("shift")
    return rows.filter((begin >= 1) & (begin + size - 1 <= F.col("length"))).select(
        F.xxhash64("other", "i", F.substring(F.col("line"), begin, size)).alias("key"),
        "hash",
        F.shiftleft(F.col("less").cast("long"), 32).bitwiseOR(F.col("marks").bitwiseAND(F.lit(0xFFFFFFFF))).alias("marks"),
    )


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether at most `edits` edits lead from `a` to `b`, arrays of more than `edits` characters.

    Bit-parallel edit distance in a band: the band of column j holds rows j - edits to j + edits as the bits of one integer.
    `plus` and `minus` say where the distance rises or falls by one from a row to the next; a column costs a few word
    operations over all rows of the band at once. The score follows the band's lower edge down the diagonal until that
    leaves the last row, and then runs along the last row.
    """
    full = (1 << 2 * edits + 1) - 1
    top = 1 << 2 * edits

    def negated(bits: Column) -> Column:
        return bits.bitwiseXOR(F.lit(full))

    def body(pair: Column) -> Column:
        m = F.size(pair["a"])

        def column(state: Column, j: Column) -> Column:
            match = F.lit(0)
            for k in range(2 * edits + 1):
                same = F.get(pair["a"], j + (k - edits - 1)) == F.get(pair["b"], j - 1)
                match = match.bitwiseOR(F.when(same, 1 << k).otherwise(0))
            return let(match, lambda hits: diagonal(state, hits, j))

        def diagonal(state: Column, hits: Column, j: Column) -> Column:
            plus, minus = state["plus"], state["minus"]
            carry = (hits.bitwiseAND(plus) + plus).bitwiseXOR(plus)
            stay = carry.bitwiseOR(hits).bitwiseOR(minus).bitwiseAND(F.lit(full))
            return let(stay, lambda d: moved(state, d, j))

        def moved(state: Column, d: Column, j: Column) -> Column:
            plus, minus = state["plus"], state["minus"]
            rise = minus.bitwiseOR(negated(d.bitwiseOR(plus)))
            fall = d.bitwiseAND(plus)
            down = F.shiftright(d, 1)
            row = F.shiftright(F.lit(top), 1)
            for k in range(1, 2 * edits):
                row = F.when(j + edits - m > k, top >> k + 1).otherwise(row)
            along = F.when(rise.bitwiseAND(row) != 0, 1).when(fall.bitwiseAND(row) != 0, -1).otherwise(0)
            slant = F.when(d.bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)
            return F.struct(
                fall.bitwiseOR(negated(down.bitwiseOR(rise))).alias("plus"),
                down.bitwiseAND(rise).alias("minus"),
                (state["score"] + F.when(j + edits <= m, slant).otherwise(along)).alias("score"),
            )

        start = F.struct(
            F.lit(full ^ (1 << edits) - 1).alias("plus"), F.lit(0).alias("minus"), F.lit(edits).alias("score")
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(pair["b"])), start, column, lambda s: s["score"] <= edits)

    return let(F.struct(a.alias("a"), b.alias("b")), body)


def links(documents: DataFrame, edits: int = 2, min_chars: int = 20) -> DataFrame:
    """Pairs of classes within `edits`: a, a_first, b, b_first (hashes and orders)."""
    # Both the keys and the verification read this one shuffle, so both name all that it carries.
    long_lines = (
        classes(documents)
        .filter(F.col("pure") & F.col("first").isNotNull() & F.col("marks").isNotNull() & (F.length("line") >= min_chars))
        .select("hash", "line", "marks", "first", F.length("line").alias("length"))
    )
    found = index_keys(long_lines, edits).toDF("key", "b", "b_marks")
    asked = probe_keys(long_lines, edits).toDF("key", "a", "a_marks")
    less = F.shiftright("a_marks", 32)
    # Lines that share a segment and little else are told apart inside the join; of two lines of one length one asks. Where
    # one is shorter, that many edits are insertions, and an insertion changes one count only.
    close = _apart(F.col("a_marks"), F.col("b_marks")) <= 2 * edits - less
    once = (F.col("a") < F.col("b")) | ((F.col("a") != F.col("b")) & (less > 0))
    pairs = found.join(asked, "key").filter(once & close).select("a", "b").distinct()
    left = long_lines.select(F.col("hash").alias("a"), F.col("line").alias("a_line"), F.col("first").alias("a_first"))
    right = long_lines.select(F.col("hash").alias("b"), F.col("line").alias("b_line"), F.col("first").alias("b_first"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(within_edits(F.split("a_line", ""), F.split("b_line", ""), edits))
        .select("a", "a_first", "b", "b_first")
    )


def judged(documents: DataFrame, edits: int = 2, min_chars: int = 20) -> DataFrame:
    """hash, first, n_copies, pure, n_links, first_link per class; a class with an earlier link goes."""
    pairs = materialise(links(documents, edits, min_chars), "line-links")
    there = pairs.select(F.col("a").alias("hash"), F.col("b").alias("to"), F.col("b_first").alias("other"))
    back = pairs.select(F.col("b").alias("hash"), F.col("a").alias("to"), F.col("a_first").alias("other"))
    linked = (
        there.unionByName(back)
        .distinct()
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n_links"), F.min("other").alias("first_link"))
    )
    return classes(documents, texts=False).join(linked, "hash", "left")


def _goes() -> Column:
    return F.coalesce(F.col("first_link") < F.col("first"), F.lit(False))


def _place(order: Column) -> list[Column]:
    """doc_id and line number of an order."""
    number = F.pmod(order, F.lit(LINES).cast("decimal(11,0)"))
    key = ((order - number) / F.lit(LINES).cast("decimal(11,0)")).cast("long")
    return [F.when(key != NO_ID, key), number.cast("long")]


def report(documents: DataFrame, edits: int = 2, min_chars: int = 20) -> DataFrame:
    """One row per class of equal lines: where it begins, its copies and links, the earliest link, and whether it stays."""
    own, other = _place(F.col("first")), _place(F.col("first_link"))
    return judged(documents, edits, min_chars).select(
        own[0].alias("doc_id"),
        own[1].alias("line_no"),
        F.col("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        other[0].alias("link_doc_id"),
        other[1].alias("link_line_no"),
        (~_goes()).alias("kept"),
    )


def members(documents: DataFrame, edits: int = 2, min_chars: int = 20) -> DataFrame:
    """One row per line: its class (place of the first copy), the class's copies, links and earliest link, and whether the line stays."""
    # A class of one line without links is the line itself, so only the others meet their lines.
    told = judged(documents, edits, min_chars).filter((F.col("n_copies") > 1) | F.col("n_links").isNotNull())
    told = materialise(told, "line-classes")
    joined = lines(documents).select("doc_id", "line_no", "hash").join(told, "hash", "left")
    own, first, other = _order(), _place(F.col("first")), _place(F.col("first_link"))
    alone = F.col("first").isNull()
    copy = F.coalesce(F.col("pure") & (own != F.col("first")), F.lit(False))
    return joined.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("line_no").cast("long").alias("line_no"),
        F.when(alone, F.col("doc_id").cast("long")).otherwise(first[0]).alias("class_doc_id"),
        F.when(alone, F.col("line_no").cast("long")).otherwise(first[1]).alias("class_line_no"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        other[0].alias("link_doc_id"),
        other[1].alias("link_line_no"),
        (~copy & ~_goes()).alias("kept"),
    )


def dedup(documents: DataFrame, edits: int = 2, min_chars: int = 20, emptied: bool = True) -> DataFrame:
    """The documents without lines that repeat an earlier line or are within `edits` of one; all columns stay.

    A document whose every line with a word went stays without words, or goes too where `emptied` is false.
    """
    doc, key, out = free_names(documents.columns, "_id", "_key", "_out")
    verdict = judged(documents, edits, min_chars).filter("pure").select("hash", "first", _goes().alias("goes"))
    marked = (
        lines(documents.select("doc_id", "text"), F.xxhash64(whole("text")).alias(key))
        .select("doc_id", key, "line_no", "hash")
        .join(verdict, "hash")
        .filter(F.col("goes") | (_order() != F.col("first")))
        .groupBy(F.col("doc_id").alias(doc), key)
        .agg(F.collect_set("line_no").alias(out))
    )
    same = documents["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(whole(documents["text"])) == F.col(key))
    joined = documents.join(marked, same, "left")

    def without(pieces: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.col(out))
        return F.array_join(F.transform(stay, lambda i: F.get(pieces, i)), "\n")

    text = F.when(F.col(out).isNull(), documents["text"]).otherwise(let(F.split(whole(documents["text"]), "\n"), without))
    gone = F.col(out).isNotNull() & ~F.col("text").rlike(NOT_BLANK)
    cut = joined.select(*[text.alias(c) if c == "text" else documents[c] for c in documents.columns], out)
    return (cut if emptied else cut.filter(~gone)).drop(out)
