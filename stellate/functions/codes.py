"""Value maps, flags and small conditional expressions as Spark ``Column`` builders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal_map(mapping: Mapping, key_type: str | None = None) -> Column:
    keys = [F.lit(k).cast(key_type) if key_type else F.lit(k) for k in mapping]
    return F.create_map(*chain.from_iterable(zip(keys, map(F.lit, mapping.values()))))


def map_strict(c: Column, mapping: Mapping) -> Column:
    """Mapped value; NULL for a value without an entry."""
    return F.try_element_at(_literal_map(mapping), c)


def replace_values(c: Column, mapping: Mapping) -> Column:
    """Mapped value; a value without an entry stays, an entry of None gives NULL."""
    if any(v is None for v in mapping.values()):
        known = {k: v for k, v in mapping.items() if v is not None}
        kept = F.when(~c.isin([k for k, v in mapping.items() if v is None]), c)
        return F.coalesce(map_strict(c, known), kept) if known else kept
    return F.coalesce(map_strict(c, mapping), c)


def replace_codes(c: Column, mapping: Mapping[int, int], kind: str = "bigint") -> Column:
    """``replace_values`` for integer codes in a column of type ``kind``.

    A value without an entry stays as it is, whole number or not; converting is another step.
    """
    return F.coalesce(F.try_element_at(_literal_map(mapping, "bigint"), as_code(c)).cast(kind), c)


def as_code(c: Column) -> Column:
    """Integer code; NULL for text that is not a whole number."""
    return c.try_cast("bigint")


def is_in(c: Column, values: Iterable) -> Column:
    """Membership that answers false, not NULL, for a NULL value."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def member_flag(c: Column, values: Iterable) -> Column:
    return is_in(c, values).cast("int")


def override_when(target: Column, condition: Column, value) -> Column:
    return F.when(condition, F.lit(value)).otherwise(target)


def is_null_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def case_code(c: Column, code: int, then, otherwise) -> Column:
    """``then`` if the value equals an integer code; NULL and other text give ``otherwise``."""
    return F.when(as_code(c) == code, F.lit(then)).otherwise(F.lit(otherwise))


def case_text(c: Column, branches: Mapping[str, str], otherwise=None) -> Column:
    """First matching branch on the text form of a value."""
    result = F.when(F.lit(False), F.lit(None).cast("string"))
    for text, label in branches.items():
        result = result.when(c.cast("string") == text, F.lit(label))
    return result.otherwise(F.lit(otherwise).cast("string"))
