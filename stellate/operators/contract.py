"""The declared columns of star tables, and the key/value metadata table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from stellate.operators.cleanup import col

# Names that make a column a number.
NUMBER_SUFFIXES = ("_key", "_id", "_flag", "_count")
NUMBER_NAMES = ("sort_order", "year", "quarter", "enrollment_count", "option_code")

# Columns whose content differs from what their name says.
TYPES = {"parent_product_id": StringType(), "include_in_pipeline": IntegerType()}


def column_type(name: str) -> DataType:
    if name in TYPES:
        return TYPES[name]
    lowered = name.lower()
    if lowered.endswith(NUMBER_SUFFIXES) or lowered in NUMBER_NAMES:
        return LongType()
    return StringType()


def table_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, column_type(c)) for c in columns])


def _converted(df: DataFrame, field: StructField) -> Column:
    """Numbers may arrive as text or as fractions of value zero, such as 100.0; 1.5 is bad."""
    value = col(field.name)
    if not isinstance(field.dataType, IntegralType):
        return value.try_cast(field.dataType)
    given = df.schema[field.name].dataType
    if isinstance(given, (StringType, FractionalType)):
        wide = value.try_cast("decimal(38, 10)")
        whole = F.when(wide == F.floor(wide), wide).try_cast(field.dataType)
        return F.coalesce(value.try_cast(field.dataType), whole) if isinstance(given, StringType) else whole
    return value.try_cast(field.dataType)


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the declared columns and types; absent columns are NULL, bad numbers too."""
    schema = table_schema(columns)
    return df.select(
        *(
            (_converted(df, f) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def empty_table(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], table_schema(columns))


def metadata_rows(spark: SparkSession, entries: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(entries.items()), "key string, value string")


def metadata_upsert(current: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Insert or replace key/value rows."""
    if current is None:
        return changes.select("key", "value")
    kept = current.select("key", "value").join(changes, "key", "left_anti")
    return kept.unionByName(changes.select("key", "value"))
