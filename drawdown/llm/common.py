"""Expressions and settings the text operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, for `btrim`, and as a regular expression.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Tables of at most this many rows of bounded width are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened where a table already has such a column (in any case of letters)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def whole(text: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def split_clean(text: Column, separators: str, trim: str) -> Column:
    """Pieces of a text between separator runs; the empty text has none."""
    inner = F.btrim(text, F.lit(trim))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, separators))


def blank_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return split_clean(text, BLANK_RUN, BLANKS)


def ship(spark: SparkSession) -> None:
    """Gives the package to the executors' Python, once per session; a cluster that has it installed is not harmed."""
    context = spark.sparkContext
    if getattr(context, "_drawdown_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="drawdown-")) / "drawdown.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._drawdown_shipped = True
