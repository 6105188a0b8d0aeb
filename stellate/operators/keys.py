"""Surrogate keys and the joins that turn natural keys into them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.operators.joins import left_lookup
from stellate.sources.staging import PACKED, stage

PART, POSITION = "__part", "__position"
# Where a row is stored: the file, as a hash of its path, and the number of the row in it.
FILE, ROW = "__file", "__row"
# Rows up to which a table of keys is sent to the tasks that read the texts.
SENT_ROWS = 1 << 19
# Rows are numbered within a partition in the low 33 bits of ``monotonically_increasing_id``.
POSITION_BITS = (1 << 33) - 1


def surrogate_key(
    df: DataFrame, pk: str, order_by: Sequence[str], bounded: bool = False
) -> DataFrame:
    """Add a key 1..n in the given order, as the first column.

    The rows are range-partitioned and sorted, and written once with their partition and their
    position in it. A row's key is then its position plus the number of rows in the partitions
    before it; those totals are one row per partition. No task sees more than its own range, and
    the keys cannot change when a task is run again, because both numbers are read back.

    The order should be total. ``bounded`` tables (dates, option codes, phases) are known to be
    small and are numbered by one ordered window.
    """
    if bounded:
        number = F.row_number().over(Window.orderBy(*order_by)).cast("bigint")
        return df.select(number.alias(pk), "*")
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumns(
            {
                PART: F.spark_partition_id(),
                POSITION: F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_BITS)),
            }
        )
    )
    staged = stage(placed, pk, PACKED)
    totals = staged.groupBy(PART).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        PART, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    # Bound: one row per partition of the staged table.
    keyed = staged.join(F.broadcast(offsets), PART)
    key = F.col("__offset") + F.col(POSITION) + 1
    numbered = keyed.select(key.cast("bigint").alias(pk), *(f"`{c}`" for c in df.columns))
    numbered.staged_at = staged.staged_at  # all that it reads
    return numbered


def with_location(stored: DataFrame) -> DataFrame:
    """Rows of a table that is read from Parquet files, with the place where each is stored."""
    return stored.select(
        "*", F.xxhash64(F.col("_metadata.file_path")).alias(FILE), F.col("_metadata.row_index").alias(ROW)
    )


def attach_stored(narrow: DataFrame, located: DataFrame, columns: dict[str, Column], n_rows: int) -> DataFrame:
    """Add columns of the stored rows that ``narrow``, of ``n_rows`` rows, names by ``FILE`` and ``ROW``.

    The stored columns may be long texts, so they should not travel. Up to ``SENT_ROWS`` rows the
    narrow rows are sent to the tasks that read the texts. Beyond that both sides are shuffled by their
    place, which is the only time that a text is moved.
    """
    wide = located.select(FILE, ROW, *(c.alias(n) for n, c in columns.items()))
    if n_rows <= SENT_ROWS:
        narrow = F.broadcast(narrow)
    return wide.join(narrow, [FILE, ROW]).drop(FILE, ROW)


def surrogate_key_in_place(stored: DataFrame, pk: str, order_by: Sequence[str]) -> DataFrame:
    """``surrogate_key`` for a table that is read from Parquet files.

    Only the order columns and the places of the rows are ranged, sorted and written; the keys then
    return to the rows by their places. Places also settle ties, so the order need not be total.
    """
    located = with_location(stored)
    order = [*order_by, FILE, ROW]
    numbers = surrogate_key(located.select(*(f"`{c}`" for c in dict.fromkeys(order))), pk, order)
    numbers = numbers.select(pk, FILE, ROW)
    keyed = attach_stored(numbers, located, {c: F.col(f"`{c}`") for c in stored.columns}, numbers.count())
    return keyed.select(pk, *(f"`{c}`" for c in stored.columns))


def last_per_key(df: DataFrame, keys: Sequence[str], value: str, order_by: str) -> DataFrame:
    """One row per key with the value of its last row, NULL included."""
    return df.groupBy(*keys).agg(F.max_by(value, order_by).alias(value))


def key_map(dimension: DataFrame, natural: str, pk: str) -> DataFrame:
    """Natural key to surrogate key. Keys follow load order, so the last loaded row has the
    largest one. Rows without a natural key are left out."""
    known = dimension.where(F.col(natural).isNotNull())
    return known.groupBy(natural).agg(F.max(pk).alias(pk))


def composite_key_map(dimension: DataFrame, natural: Sequence[str], pk: str) -> DataFrame:
    """As ``key_map`` for several columns, any of which may be NULL."""
    return dimension.groupBy(*natural).agg(F.max(pk).alias(pk))


def fk_resolve(
    df: DataFrame, source: Column, dimension: DataFrame, natural: str, pk: str, out: str
) -> DataFrame:
    """Add the surrogate key of a natural key; NULL when there is none."""
    keys = key_map(dimension, natural, pk).withColumnRenamed(pk, out)
    return left_lookup(df, source, keys, natural)


def fk_composite(
    df: DataFrame,
    sources: dict[str, Column],
    dimension: DataFrame,
    pk: str,
    out: str,
) -> DataFrame:
    """Surrogate key of a tuple of values; ``sources`` maps dimension columns to source values.
    NULL equals NULL."""
    keys = composite_key_map(dimension, list(sources), pk)
    right = keys.select(
        F.col(pk).alias(out), *(F.col(n).alias(f"__match_{n}") for n in sources)
    )
    left = df.withColumns({f"__probe_{n}": c for n, c in sources.items()})
    condition = F.lit(True)
    for n in sources:
        condition = condition & F.col(f"__probe_{n}").eqNullSafe(F.col(f"__match_{n}"))
    helpers = [f"__{side}_{n}" for n in sources for side in ("probe", "match")]
    return left.join(right, condition, "left").drop(*helpers)


def fk_via_fact(
    df: DataFrame, fact: DataFrame, key: str, columns: Sequence[str], order_by: str
) -> DataFrame:
    """Columns of the last fact row with the same key, NULL values included."""
    last = fact.where(F.col(key).isNotNull()).groupBy(key)
    last = last.agg(*(F.max_by(c, order_by).alias(c) for c in columns))
    return left_lookup(df, F.col(key), last, key)


def fk_today(
    df: DataFrame, run_date: str, dimension: DataFrame, natural: str, pk: str, out: str
) -> DataFrame:
    """Key of the run date, the same for every row.

    The key is one value, so it is read as a scalar subquery instead of joined.
    """
    key = dimension.where(F.col(natural) == run_date).agg(F.max(pk).alias(out))
    return df.withColumn(out, key.scalar())
