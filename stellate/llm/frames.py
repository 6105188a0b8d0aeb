"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or ``wanted_1``, ``wanted_2`` ... if the frame already has such a column."""
    taken = {c.lower() for c in df.columns}
    name, i = wanted, 0
    while name.lower() in taken:
        i += 1
        name = f"{wanted}_{i}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column, gap: str) -> Column:
    """The pieces of ``text`` between matches of ``gap``; an empty array for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def content_key(key: str, text: str) -> Column:
    """Names a row by its id and text, so rows that only share the id stay apart."""
    return F.struct(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text"))
