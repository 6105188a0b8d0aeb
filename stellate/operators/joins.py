"""The left join that all lookups use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    FractionalType,
    IntegralType,
    MapType,
    StringType,
    TimestampType,
    VariantType,
)

SOURCE, PROBE, MATCH = "__source", "__probe", "__match"
SPREAD = 1 << 20
# Keys that a 64-bit number stands for without loss.
NUMBERED = (IntegralType, DateType, TimestampType)


def _number(c: Column, key_type: DataType) -> Column:
    if isinstance(key_type, DateType):
        return F.unix_date(c).cast("bigint")
    return F.unix_micros(c) if isinstance(key_type, TimestampType) else c.cast("bigint")


def own_exchange(c: Column, key_type: DataType) -> Column:
    """The same key in a form that no earlier shuffle is partitioned by.

    A key map is partitioned by its key from the aggregate that made it, and Spark would join on
    that partitioning. The adaptive skew join only splits a hot key when both sides come straight
    from a shuffle, so the narrow key map is shuffled once more under this form of the key.
    """
    if isinstance(key_type, StringType):
        return F.concat(c, F.lit(""))
    return F.bitwise_not(_number(c, key_type)) if isinstance(key_type, NUMBERED) else c


def in_key_type(df: DataFrame, source: Column, key_type: DataType) -> Column:
    """The source as a key; NULL where the conversion would lose something, as for 1.5."""
    given = df.select(source.alias(SOURCE)).schema[SOURCE].dataType
    if isinstance(key_type, IntegralType) and isinstance(given, FractionalType):
        source = F.when(source == F.floor(source), source)
    return source.try_cast(key_type)


def left_lookup(
    df: DataFrame, source: Column, right: DataFrame, key: str, spread_nulls: bool = True
) -> DataFrame:
    """Left join on ``source == right[key]``; the key column of the right side is dropped.

    A NULL source never matches. When the right side is too large to broadcast, all NULLs would
    meet in one shuffle partition; they get a filler value instead, made from a hash of the row,
    that spreads them evenly. A filler cannot match, since the join also asks for a source. Keys
    that are neither text nor whole numbers, dates or timestamps have no filler: rows without a
    source do not take part in their join. Spark broadcasts the right side only where its known
    size is below the session's threshold; hot sources are split by the adaptive skew join.
    """
    key_type = right.schema[key].dataType
    right = right.withColumn(MATCH, own_exchange(F.col(f"`{key}`"), key_type)).drop(key)
    source = in_key_type(df, source, key_type)
    matched = F.col(PROBE) == F.col(MATCH)
    # Source and probe are columns of their own: computed once per row, and short join keys.
    left = df.select("*", source.alias(SOURCE))
    if not spread_nulls:
        left = left.withColumn(PROBE, own_exchange(F.col(SOURCE), key_type))
        return left.join(right, matched, "left").drop(SOURCE, PROBE, MATCH)
    if not isinstance(key_type, (StringType, *NUMBERED)):
        sought = left.where(F.col(SOURCE).isNotNull()).withColumnRenamed(SOURCE, PROBE)
        found = sought.join(right, matched, "left").drop(PROBE, MATCH)
        absent = left.where(F.col(SOURCE).isNull()).drop(SOURCE)
        return found.unionByName(absent, allowMissingColumns=True)
    hashed = [f"`{f.name}`" for f in df.schema if not _holds(f.dataType, (MapType, VariantType))]
    row_hash = F.pmod(F.xxhash64(*hashed), F.lit(SPREAD)) if hashed else F.lit(0).cast("bigint")
    if isinstance(key_type, StringType):
        filler = F.concat(F.lit("\0"), row_hash.cast("string"))
        probe = own_exchange(F.coalesce(SOURCE, filler), key_type)
    else:
        probe = F.bitwise_not(F.coalesce(_number(F.col(SOURCE), key_type), -1 - row_hash))
    left = left.select("*", probe.alias(PROBE))
    joined = left.join(right, matched & F.col(SOURCE).isNotNull(), "left")
    return joined.drop(SOURCE, PROBE, MATCH)


def _holds(kind: DataType, unwanted: tuple) -> bool:
    """Whether a type is, or has inside it, one of the unwanted types."""
    if isinstance(kind, unwanted):
        return True
    inner = [f.dataType for f in getattr(kind, "fields", [])]
    inner += [kind.elementType] if hasattr(kind, "elementType") else []
    return any(_holds(k, unwanted) for k in inner)


def one_per_key(df: DataFrame, key: str, values: list[str], order_by: list[str]) -> DataFrame:
    """One row per non-NULL key: the last one in the given order."""
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    row = F.max_by(F.struct(*values), order)
    last = df.where(F.col(key).isNotNull()).groupBy(key).agg(row.alias("__row"))
    return last.select(key, *(F.col(f"__row.{v}").alias(v) for v in values))
