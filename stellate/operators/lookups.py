"""Lookups by identifier, name and code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from stellate.config import countries as country_values
from stellate.config import iso3166
from stellate.functions import codes, text
from stellate.operators.cleanup import col
from stellate.operators.joins import left_lookup, one_per_key

LOCATION_DELIMITERS = "[|;]"
IN_PARENTHESES = r"\(([^)]+)\)"


def lookup_name(
    df: DataFrame,
    source: Column,
    lookup: DataFrame,
    key: str,
    value: Column,
    out: str,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Value of the lookup row with the source's key, NULL when there is none.

    Repeated keys of the lookup are settled by the given order (by default, the value's own).
    """
    rows = lookup.select("*", value.alias("__value"))
    named = one_per_key(rows, key, ["__value"], list(order_by or ["__value"]))
    return left_lookup(df, source, named.withColumnRenamed("__value", out), key)


def left_enrich(
    df: DataFrame, source: Column, right: DataFrame, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Add columns of every matching row of ``right``; repeated keys there repeat the row."""
    picked = right.select(col(key).alias("__key"), *(col(c).alias(n) for c, n in columns.items()))
    return left_lookup(df, source, picked, "__key")


def option_code(df: DataFrame, name: str) -> Column:
    """A column as option-set code. Fractions are no code."""
    c = col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.when(c == F.floor(c), codes.as_code(c))
    return codes.as_code(c)


def option_labels(option_set: DataFrame) -> DataFrame:
    """Code and label, the first two columns of an option set; one row per code."""
    code, label = option_set.columns[:2]
    pairs = option_set.select(
        codes.as_code(col(code)).alias("code"), col(label).cast("string").alias("label")
    )
    order = next((c for c in ("row_id", "source_row_id") if c in option_set.columns), None)
    if order:
        pairs = pairs.withColumn("__order", option_set[order])
    return one_per_key(pairs, "code", ["label"], ["__order" if order else "label"])


def option_label(df: DataFrame, name: str, option_set: DataFrame | None, out: str) -> DataFrame:
    """Label of an option-set code; NULL for a missing column, set or code."""
    if option_set is None or name not in df.columns:
        return df.withColumn(out, F.lit(None).cast("string"))
    labels = option_labels(option_set).withColumnRenamed("label", out)
    return left_lookup(df, option_code(df, name), labels, "code")


def resolve_country(
    df: DataFrame,
    source: Column,
    countries: DataFrame,
    out: str,
    name: str = "vin_name",
    number: str = "vin_countryno",
    aliases: Mapping[str, str | None] = country_values.ALIASES,
) -> DataFrame:
    """Canonical country name of free text: by alias, by name in any case, by country number.

    An alias that stands for no country is final.
    """
    raw = F.nullif(text.strip(source.cast("string")), F.lit(""))
    blocked = [a for a, target in aliases.items() if target is None]
    df = df.withColumn("__raw", raw)
    df = df.withColumn("__text", F.lower(codes.replace_values(F.col("__raw"), aliases)))
    by_name = countries.select(F.lower(name).alias("__name"), F.col(name).alias("__by_name"))
    by_name = one_per_key(by_name, "__name", ["__by_name"], ["__by_name"])
    df = left_lookup(df, F.col("__text"), by_name, "__name")
    found = F.col("__by_name")
    if number in countries.columns:
        by_number = countries.select(
            codes.as_code(col(number)).alias("__number"), F.col(name).alias("__by_number")
        )
        by_number = one_per_key(by_number, "__number", ["__by_number"], ["__by_number"])
        # Java also reads 4d and 4f as numbers, so the form is tested first.
        is_number = F.col("__raw").rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
        as_number = F.when(is_number, F.col("__raw")).try_cast("double").try_cast("bigint")
        df = left_lookup(df, as_number, by_number, "__number")
        found = F.coalesce(found, F.col("__by_number"))
    if blocked:
        found = F.when(~codes.is_in(F.col("__raw"), blocked), found)
    return df.withColumn(out, found).drop("__raw", "__text", "__by_name", "__by_number")


def iso_table(spark: SparkSession) -> DataFrame:
    """Country name and three-letter code of the standard; usual short names are extra rows."""
    return spark.createDataFrame(iso3166.NAMES, "name string, iso3 string")


def iso_code(
    df: DataFrame,
    source: Column,
    out: str,
    standard: DataFrame | None = None,
    overrides: Mapping[str, str | None] = country_values.ISO_OVERRIDES,
) -> DataFrame:
    """Three-letter code of an exact country name; overrides win, also those that say "none".

    ``standard`` is the reference table (``name``, ``iso3``), by default ``iso_table``.
    """
    spark = df.sparkSession
    standard = standard if standard is not None else iso_table(spark)
    fixed = spark.createDataFrame(list(overrides.items()), "name string, iso3 string")
    rest = standard.select("name", "iso3").where(~F.col("name").isin(list(overrides)))
    table = one_per_key(rest.unionByName(fixed), "name", ["iso3"], ["iso3"])
    return left_lookup(df, source, table.withColumnRenamed("iso3", out), "name")


def country_keys_by_text(
    countries: DataFrame,
    key: str,
    name: str,
    aliases: Mapping[str, str | None] = country_values.ALIASES,
) -> DataFrame:
    """Lower-case text to country key: aliases in any case, then names."""
    spark = countries.sparkSession
    lowered = {a.lower(): t for a, t in aliases.items()}
    # An empty attempt must not match, so an empty name is no spelling.
    names = countries.where(F.col(name) != "").groupBy(F.lower(name).alias("text"))
    names = names.agg(F.max(key).alias(key))
    targets = [(a, t.lower()) for a, t in lowered.items() if t is not None]
    alias_rows = spark.createDataFrame(targets, "alias string, text string")
    by_alias = alias_rows.join(names, "text").select(F.col("alias").alias("text"), key)
    return names.where(~F.col("text").isin(list(lowered))).unionByName(by_alias)


def parse_locations(
    df: DataFrame,
    entity: str,
    locations: Column,
    countries: DataFrame,
    key: str,
    name: str,
    aliases: Mapping[str, str | None] = country_values.ALIASES,
) -> DataFrame:
    """Distinct (entity, country key) pairs named in free-text locations.

    The text is split on ``|`` and ``;``. A segment is tried as a whole, then by the text after
    its last comma, then by the text in its first parentheses.
    """
    table = country_keys_by_text(countries, key, name, aliases)
    segment = F.explode(F.split(locations, LOCATION_DELIMITERS)).alias("__segment")
    rows = df.select(col(entity), segment)
    rows = rows.withColumn("__segment", text.strip(F.col("__segment"))).where("__segment != ''")
    seg = F.col("__segment")
    attempts = {
        "__whole": seg,
        "__tail": F.when(seg.contains(","), text.strip(F.substring_index(seg, ",", -1))),
        "__inner": text.strip(F.regexp_extract(seg, IN_PARENTHESES, 1)),
    }
    for out, attempt in attempts.items():
        rows = left_lookup(rows, F.lower(attempt), table.withColumnRenamed(key, out), "text")
    resolved = rows.select(col(entity), F.coalesce(*attempts).alias(key))
    return resolved.where(F.col(key).isNotNull()).dropDuplicates([entity, key])
