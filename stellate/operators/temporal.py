"""Histories: yearly columns to dated rows, in-fill of reporting years, fills and leads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.functions.text import year_of
from stellate.operators import segments
from stellate.operators.cleanup import col

CHUNK = "__chunk"


@dataclass(frozen=True)
class YearlyGroup:
    """Yearly source columns that together are the history of one output column."""

    out: str
    dates: Mapping[str, str]
    dtype: str = "string"


def scd2_expand(df: DataFrame, groups: Sequence[YearlyGroup]) -> DataFrame:
    """One row per date at which any group has a value.

    Each group shows its last known value; ``valid_to`` is the next date of the same source row.
    A row without any value gives one row of NULLs; values that are none of the group's type count
    as NULL. The number of dates is fixed by the groups,
    so everything is plain expressions inside one row: no shuffle, no window.
    """
    dates = sorted({d for g in groups for d in g.dates.values()})
    values = {
        (g.out, d): col(c).try_cast(g.dtype)
        for g in groups
        for c, d in g.dates.items()
        if c in df.columns
    }

    def value(group: YearlyGroup, date: str) -> Column:
        return values.get((group.out, date), F.lit(None).cast(group.dtype))

    present = {d: _any([value(g, d).isNotNull() for g in groups]) for d in dates}
    slices = []
    for i, date in enumerate(dates):
        later = [F.when(present[d], F.lit(d)) for d in dates[i + 1:]]
        known = {g.out: [value(g, d) for d in reversed(dates[: i + 1])] for g in groups}
        slices.append(
            F.struct(
                present[date].alias("keep"),
                *(F.coalesce(*known[g.out]).alias(g.out) for g in groups),
                F.lit(date).alias("valid_from"),
                F.coalesce(*later, F.lit(None).cast("string")).alias("valid_to"),
            )
        )
    slices.append(
        F.struct(
            (~_any(list(present.values()))).alias("keep"),
            *(F.lit(None).cast(g.dtype).alias(g.out) for g in groups),
            F.lit(None).cast("string").alias("valid_from"),
            F.lit(None).cast("string").alias("valid_to"),
        )
    )
    outputs = [g.out for g in groups] + ["valid_from", "valid_to"]
    consumed = {c for g in groups for c in g.dates} | set(outputs)
    kept = [col(c) for c in df.columns if c not in consumed]
    expanded = df.select(*kept, F.explode(F.array(*slices)).alias("__slice"))
    expanded = expanded.where("__slice.keep")
    return expanded.select(*kept, *(F.col(f"__slice.{o}").alias(o) for o in outputs))


def _any(tests: list[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def reporting_years(df: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    """One row: the sorted distinct years of both ends of all rows."""
    ends = df.select(F.explode(F.array(year_of(col(valid_from)), year_of(col(valid_to)))).alias("y"))
    return ends.agg(F.sort_array(F.collect_set("y")).alias("years"))


def year_infill(
    df: DataFrame,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    flag: str = "is_active_flag",
    out: str = "infill_year",
    years: DataFrame | None = None,
) -> DataFrame:
    """Add a copy of a row for every reporting year strictly between its two ends.

    ``out`` is the year of a copy and NULL on originals. An open row ends after the last
    reporting year; if it gets copies, the last one is the active row. The set of years is a
    single value (at most one per four-digit number), read as a scalar subquery.
    """
    years = years if years is not None else reporting_years(df, valid_from, valid_to)
    start = year_of(col(valid_from))
    end = F.coalesce(year_of(col(valid_to)), F.try_element_at("__years", F.lit(-1)) + 1)
    dated = df.withColumn("__years", years.scalar())
    dated = dated.withColumns({"__start": start, "__end": end})
    inner = F.filter("__years", lambda y: (y > F.col("__start")) & (y < F.col("__end")))
    dated = dated.withColumn("__infill", inner)
    copies = F.concat(F.array(F.lit(None).cast("int")), F.col("__infill"))
    exploded = dated.withColumn(out, F.explode(copies))
    active = (
        F.when(
            col(out).isNotNull(),
            (col(valid_to).isNull() & (col(out) == F.try_element_at("__infill", F.lit(-1)))),
        )
        .when(col(valid_to).isNull() & (F.size("__infill") > 0), F.lit(False))
        .cast(df.schema[flag].dataType)
    )
    exploded = exploded.withColumn(flag, F.coalesce(active, col(flag)))
    return exploded.drop("__years", "__start", "__end", "__infill")


def _marked(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").alias(f"__of_{c}") for c in (*keys, CHUNK)]


def _same(keys: Sequence[str]) -> Column:
    """Equal keys and chunk; NULL is a key and a chunk like any other, as it is for windows."""
    tests = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__of_{c}`")) for c in (*keys, CHUNK)]
    return reduce(lambda a, b: a & b, tests)


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    columns: Sequence[str],
    chunk: Column | None = None,
) -> DataFrame:
    """Replace NULLs by the last value before them, per key. NULL is a key of its own.

    Rows are ranged by key and order, so a key with very many rows stands in many tasks; see
    ``segments``. Where the order has a coarse form, such as the month of a timestamp, that is dense,
    it can be given as ``chunk``: the rows of one key are then filled chunk by chunk, and only the last
    value of every chunk travels to the next. That needs no written table.
    """
    if chunk is None:
        return segments.fill_forward(df, keys, order_by, columns)
    rows = df.withColumn(CHUNK, chunk)
    local = Window.partitionBy(*keys, CHUNK).orderBy(order_by)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(local) for c in columns})
    known = {c: F.when(F.col(c).isNotNull(), F.col(order_by)) for c in columns}
    ends = rows.groupBy(*keys, CHUNK).agg(*(F.max_by(c, known[c]).alias(c) for c in columns))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *_marked(keys), *(F.last(c, ignorenulls=True).over(before).alias(f"__{c}") for c in columns)
    )
    joined = filled.join(carried, _same(keys), "left")
    joined = joined.withColumns({c: F.coalesce(c, f"__{c}") for c in columns})
    return joined.select(*df.columns)


def next_boundary(
    df: DataFrame, keys: Sequence[str], start: str, out: str, chunk: Column | None = None
) -> DataFrame:
    """Add the following start of the same key, NULL on the last row. ``chunk`` as above."""
    if chunk is None:
        return segments.next_start(df, keys, start, out)
    rows = df.withColumn(CHUNK, chunk)
    local = F.lead(start).over(Window.partitionBy(*keys, CHUNK).orderBy(start))
    heads = rows.groupBy(*keys, CHUNK).agg(F.min(start).alias("__head"))
    following = F.lead("__head").over(Window.partitionBy(*keys).orderBy(CHUNK))
    heads = heads.select(*_marked(keys), following.alias("__next"))
    joined = rows.withColumn(out, local).join(heads, _same(keys), "left")
    return joined.withColumn(out, F.coalesce(out, "__next")).select(*df.columns, out)


def date_dimension(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per day: ISO text, year and quarter."""
    day = F.explode(F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                               F.make_date(F.lit(last_year), F.lit(12), F.lit(31))))
    days = spark.range(1).select(day.alias("day"))
    return days.select(
        F.date_format("day", "yyyy-MM-dd").alias("full_date"),
        F.year("day").cast("bigint").alias("year"),
        F.quarter("day").cast("bigint").alias("quarter"),
    )
