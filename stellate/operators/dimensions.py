"""Dimension builders. Each returns the rows of a dimension without its surrogate key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.config import phases
from stellate.functions import codes, text
from stellate.operators.cleanup import col, col_or_null
from stellate.operators.lookups import option_labels


def distinct_rows(df: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Distinct combinations of the source columns; a missing column counts as NULL."""
    return df.select(*(col_or_null(df, c).alias(c) for c in sources)).distinct()


def delimited_values(df: DataFrame, source: str, out: str, delimiter: str = ";") -> DataFrame:
    """Distinct non-empty parts of a delimited text column."""
    parts = F.explode(text.split_parts(col_or_null(df, source), delimiter)).alias(out)
    return df.select(parts).distinct()


def option_rows(option_set: DataFrame, label: str, code: str) -> DataFrame:
    """Label and code of an option set."""
    labels = option_labels(option_set)
    return labels.select(F.col("label").alias(label), F.col("code").alias(code))


def phase_name(c: Column) -> Column:
    """Phase of a stage text such as ``Phase I - Drugs``, under its usual name."""
    return codes.replace_values(text.before_first(c), phases.ALIASES)


def referenced_values(df: DataFrame, source: str, out: str) -> DataFrame:
    """Distinct phases named by a stage column."""
    stage = F.nullif(col_or_null(df, source), F.lit(""))
    return df.select(phase_name(stage).alias(out)).where(F.col(out).isNotNull()).distinct()


def first_per_name(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of every non-empty name."""
    others = [c for c in df.columns if c != name]
    named = df.where(F.col(name) != "").groupBy(name)
    first = named.agg(F.min_by(F.struct(*others), F.struct(*order_by)).alias("__row"))
    return first.select(name, *(F.col(f"__row.{c}").alias(c) for c in others))


def phase_rows(
    stages: DataFrame,
    referenced: DataFrame,
    stage_id: str,
    name: str,
    order_by: Sequence[str],
    sort_order: Mapping[str, int] = phases.SORT_ORDER,
    default: int = phases.DEFAULT_SORT_ORDER,
) -> DataFrame:
    """Referenced phases: those of the stage table (first row per name), then the ones only the
    display order knows. ``referenced`` has one column, ``phase_name``."""
    rank = F.coalesce(codes.map_strict(F.col("phase_name"), sort_order), F.lit(default))
    listed = stages.withColumn("phase_name", col(name))
    listed = first_per_name(listed, "phase_name", order_by)
    listed = listed.join(referenced, "phase_name", "left_semi")
    listed = listed.select(
        col(stage_id).alias("vin_rdstageid"), "phase_name", rank.cast("bigint").alias("sort_order")
    )
    added = referenced.where(F.col("phase_name").isin(list(sort_order)))
    added = added.join(listed, "phase_name", "left_anti").select(
        F.lit(None).cast("string").alias("vin_rdstageid"),
        "phase_name",
        rank.cast("bigint").alias("sort_order"),
    )
    return listed.unionByName(added)
