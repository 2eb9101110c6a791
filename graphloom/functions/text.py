"""Column functions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "<SEP>"
#: Source ids that are no evidence.
NO_EVIDENCE = ("manual_creation", "UNKNOWN")


def strip(c: Column) -> Column:
    """Without white space at both ends (of any kind, not only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def parts(c: Column, sep: str = SEP) -> Column:
    """The non-blank trimmed parts of a joined list, in order, first mention only; null gives an empty list."""
    cut = F.transform(F.split(F.coalesce(c, F.lit("")), sep.replace("|", r"\|"), -1), lambda x: strip(x))
    return F.array_distinct(F.filter(cut, lambda x: x != ""))


def evidence(ids: Column) -> Column:
    """The ids that name a real source."""
    return F.array_except(ids, F.array(*map(F.lit, NO_EVIDENCE)))


def tokens(c: Column) -> Column:
    """Size in tokens of the one-to-one character tokenizer."""
    return F.length(c)


def tokens4(c: Column) -> Column:
    """Size in tokens of four characters, rounded up."""
    return F.ceil(F.length(c) / 4).cast("int")
