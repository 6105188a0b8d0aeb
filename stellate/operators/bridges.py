"""Bridge builders: pairs of surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.functions import text
from stellate.operators.cleanup import col, col_or_null
from stellate.operators.joins import own_exchange


def attach_key(df: DataFrame, source: str, keys: DataFrame, natural: str, out: str) -> DataFrame:
    """Keep the rows whose source value has a key, and add it as ``out``.

    ``keys`` has two columns: the natural key and the surrogate key.
    """
    pk = next(c for c in keys.columns if c != natural)
    key_type = keys.schema[natural].dataType
    right = keys.select(own_exchange(col(natural), key_type).alias("__match"), col(pk).alias(out))
    probe = own_exchange(col(source).try_cast(key_type), key_type)
    left = df.withColumn("__probe", probe)
    return left.join(right, F.col("__probe") == F.col("__match")).drop("__probe", "__match")


def bridge(
    df: DataFrame,
    keys: Mapping[str, tuple[str, DataFrame, str]],
    constants: Mapping[str, str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Rows whose every key resolves, not deduplicated.

    ``keys`` maps an output column to its source column, the key map and its natural key. With
    ``distinct``, repeated source pairs are folded before the joins, where tasks do it on their own.
    """
    narrow = df.select(*{source: col(source) for source, _, _ in keys.values()}.values())
    if distinct:
        narrow = narrow.distinct()
    for out, (source, key_map, natural) in keys.items():
        narrow = attach_key(narrow, source, key_map, natural, out)
    fixed = [F.lit(v).alias(n) for n, v in (constants or {}).items()]
    return narrow.select(*keys, *fixed)


def delimited_bridge(
    df: DataFrame,
    entity: tuple[str, str, DataFrame, str],
    part: tuple[str, str, DataFrame, str],
    delimiter: str = ";",
) -> DataFrame:
    """One row per entity row and part of its delimited text, if both resolve.

    ``entity`` and ``part`` are (output column, source column, key map, natural key).
    """
    entity_out, entity_source, entity_keys, entity_natural = entity
    part_out, part_source, part_keys, part_natural = part
    parts = F.explode(text.split_parts(col_or_null(df, part_source), delimiter)).alias("__part")
    rows = df.select(col(entity_source), parts)
    return bridge(
        rows,
        {
            entity_out: (entity_source, entity_keys, entity_natural),
            part_out: ("__part", part_keys, part_natural),
        },
    )


def union_bridge(branches: Sequence[DataFrame]) -> DataFrame:
    """All branches together, without repeated rows."""
    return reduce(DataFrame.unionByName, branches).distinct()
