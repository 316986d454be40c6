"""Column helpers: lines, counts, hashes, floor percentages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a declared list may have, to be sent to every task.
FEW = 10_000


def few(table: DataFrame) -> DataFrame:
    """A declared list, broadcast once its size has been seen; a longer one raises an error."""
    if table.limit(FEW + 1).count() > FEW:
        raise ValueError(f"a declared list may have {FEW} rows at most")
    return F.broadcast(table)


def lines(text: Column | str) -> Column:
    return F.split(text, "\n")


def count_lines(text: Column | str, pattern: str) -> Column:
    """How many lines match: lines, not occurrences."""
    return F.size(F.filter(lines(text), lambda x: x.rlike(pattern))).cast("long")


def floor_percent(part: Column, whole: Column) -> Column:
    """``100 part / whole`` rounded down; null where there is nothing to divide by."""
    return F.when(whole > 0, F.floor(part * 100 / whole)).cast("long")


def fingerprint(text: Column | str) -> Column:
    """SHA-256 of a sentence without comments, in lower case, its white space collapsed."""
    bare = F.regexp_replace(text, r"<!--[^>]*-->", "")
    return F.sha2(F.trim(F.regexp_replace(F.lower(bare), r"[ \t\n\r\f\x0b]+", " ")), 256)


def clip(text: Column, most: int = 60) -> Column:
    """Longer values end in three dots at ``most`` characters."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)
