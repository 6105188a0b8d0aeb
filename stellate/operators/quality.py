"""Checks and reports on finished tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from stellate.functions import codes
from stellate.operators.cleanup import col
from stellate.operators.joins import in_key_type

# Stands for a check in the rows that a key can be found by.
PARENT = -1


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str


def _union(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, reports)


def _comparable(kinds: Sequence[DataType]) -> bool:
    return all(isinstance(k, IntegralType) for k in kinds)


def fk_integrity(frames: Mapping[str, DataFrame], checks: Sequence[ForeignKey]) -> DataFrame:
    """Number of non-NULL foreign keys without a parent, one row per check.

    Every table is read once, whatever number of keys it has: each row becomes the keys it refers to
    and the keys it can be found by, as (parent, key, check) rows, which are counted where they are
    read. A key is an orphan if no row of its parent is among them; a frequent key travels once per task.
    """
    parents = list(dict.fromkeys((c.parent, c.parent_column) for c in checks))
    number = {p: i for i, p in enumerate(parents)}
    kinds: dict[tuple[str, str], list[DataType]] = {p: [frames[p[0]].schema[p[1]].dataType] for p in parents}
    for c in checks:
        kinds[c.parent, c.parent_column].append(frames[c.child].schema[c.column].dataType)

    whole = all(map(_comparable, kinds.values()))

    def key(table: str, column: str, parent: tuple[str, str]) -> Column:
        # Whole numbers compare as such; other keys in the type of the parent's column.
        if whole:
            return col(column).cast("bigint")
        if _comparable(kinds[parent]):
            return col(column).cast("bigint").cast("string")
        found = in_key_type(frames[table], col(column), kinds[parent][0]).cast("string")
        # What is no value of that type is a key without a parent.
        return F.when(col(column).isNotNull(), F.coalesce(found, F.concat(F.lit("\0"), col(column).cast("string"))))

    used = []
    for table in dict.fromkeys([*(c.child for c in checks), *(p for p, _ in parents)]):
        refers = [
            F.struct(F.lit(number[c.parent, c.parent_column]).alias("parent"), key(table, c.column, (c.parent, c.parent_column)).alias("key"), F.lit(i).alias("check"))
            for i, c in enumerate(checks)
            if c.child == table
        ]
        found_by = [
            F.struct(F.lit(number[p]).alias("parent"), key(table, p[1], p).alias("key"), F.lit(PARENT).alias("check"))
            for p in parents
            if p[0] == table
        ]
        rows = frames[table].select(F.inline(F.array(*refers, *found_by)))
        used.append(rows.where("key IS NOT NULL"))
    counted = reduce(DataFrame.unionAll, used).groupBy("parent", "key", "check").agg(F.count("*").alias("n"))
    # At most one entry for each check.
    uses = F.collect_list(F.struct("check", "n")).alias("uses")
    keys = counted.groupBy("parent", "key").agg(uses).where(~F.exists("uses", lambda u: u["check"] == PARENT))
    orphans = keys.select(F.inline("uses")).groupBy("check").agg(F.sum("n").alias("orphans"))
    rows = [
        F.struct(
            F.lit(i).alias("check"), F.lit(c.child).alias("child"), F.lit(c.column).alias("fk_column"), F.lit(c.parent).alias("parent")
        )
        for i, c in enumerate(checks)
    ]
    spark = next(iter(frames.values())).sparkSession
    every = spark.range(1).select(F.inline(F.array(*rows)))
    joined = every.join(orphans, "check", "left")
    return joined.select("child", "fk_column", "parent", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans"))


def pk_unique(frames: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Number of primary-key values that occur more than once, one row per table."""
    reports = []
    for table, pk in keys.items():
        counted = frames[table].groupBy(col(pk).alias("k")).agg(F.count("*").alias("n"))
        repeated = F.coalesce(F.sum((F.col("n") > 1).cast("bigint")), F.lit(0))
        reports.append(
            counted.agg(repeated.alias("repeated_keys")).select(
                F.lit(table).alias("table_name"), F.lit(pk).alias("pk"), "repeated_keys"
            )
        )
    return _union(reports)


def scd2_checks(
    df: DataFrame, valid_from: str = "valid_from", valid_to: str = "valid_to"
) -> DataFrame:
    """One row: all rows, rows that end before they start, open rows, rows without a start."""
    start, end = col(valid_from), col(valid_to)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(start > end).alias("start_after_end"),
        F.count_if(end.isNull()).alias("open_rows"),
        F.count_if(start.isNull()).alias("without_start"),
    )


def domain_check(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Number of non-NULL values outside the allowed set, one row per column, from one scan."""
    outside = [
        F.count_if(col(c).isNotNull() & ~codes.is_in(col(c), allowed)).alias(c)
        for c, allowed in domains.items()
    ]
    counts = df.agg(*outside)
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), col(c).alias("outside")) for c in domains)
    )
    return counts.select(F.inline(pairs))


def last_sync(
    log: DataFrame,
    end_time: str = "end_time",
    status: str = "status",
    changes: Sequence[str] = ("records_added", "records_updated"),
    completed: str = "completed",
) -> DataFrame:
    """Newest end of a completed run that changed something, as ``last_sync_date``.

    An absent column counts as NULL: generic cleanup drops columns without any value.
    """
    present = [col(c) > 0 for c in changes if c in log.columns]
    if not present or not {status, end_time} <= set(log.columns):
        return log.agg(F.max(F.lit(None).cast("string")).alias("last_sync_date"))
    changed = reduce(lambda a, b: a | b, present)
    done = log.where((col(status) == completed) & changed)
    return done.agg(F.max(col(end_time)).alias("last_sync_date"))
