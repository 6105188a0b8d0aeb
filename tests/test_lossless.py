"""Values and rows that conversions, chunks and lookups must not lose."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stellate.functions import codes
from stellate.operators import cleanup, contract, lookups, quality
from stellate.operators.joins import left_lookup
from stellate.operators.temporal import forward_fill, next_boundary
from stellate.plans import star
from stellate.sources.layers import Layer
from stellate.sources.staging import shared_folder, stage, staging_run


@pytest.mark.parametrize("seed", range(3))
def test_chunks_do_not_change_the_answer(spark, seed):
    r = random.Random(seed)
    times = r.sample(range(200), 60)
    rows = [(r.choice([None, 1, 2]), t if i else None, r.choice([None, None, t])) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    chunk = F.floor(F.col("t") / 10)

    def sets(out):
        return sorted(map(tuple, out.collect()), key=repr)

    assert sets(forward_fill(df, ["k"], "t", ["v"], chunk)) == sets(forward_fill(df, ["k"], "t", ["v"]))
    known = df.where("t IS NOT NULL")
    assert sets(next_boundary(known, ["k"], "t", "n", chunk)) == sets(next_boundary(known, ["k"], "t", "n"))


DAY = datetime.date(2024, 2, 29)


@pytest.mark.parametrize(
    "kind,keys,source_kind,sources,found",
    [
        ("bigint", [1, 2], "double", [1.0, 1.5, None, 2.0], [1, None, None, 2]),
        ("bigint", [1, 2], "decimal(5,2)", ["1.00", "1.50", None], [1, None, None]),
        ("bigint", [1], "string", ["1", "1.5", "x", None], [1, None, None, None]),
        ("smallint", [1, 2], "bigint", [1, 70000, None], [1, None, None]),
        ("tinyint", [1, 2], "int", [2, 300, None], [2, None, None]),
        ("date", [DAY], "string", ["2024-02-29", "nonsense", None], [DAY, None, None]),
        ("timestamp", [datetime.datetime(2024, 1, 1)], "timestamp", [datetime.datetime(2024, 1, 1), None], [datetime.datetime(2024, 1, 1), None]),
        ("double", [1.5], "double", [1.5, 2.0, None], [1.5, None, None]),
        ("boolean", [True], "boolean", [True, False, None], [True, None, None]),
    ],
)
@pytest.mark.parametrize("spread", [True, False])
def test_lookup_keys_of_any_type(spark, kind, keys, source_kind, sources, found, spread):
    right = spark.createDataFrame([(str(k),) for k in keys], "k string").select(F.col("k").cast(kind).alias("k"))
    right = right.withColumn("hit", F.col("k"))
    rows = [(i, None if s is None else str(s)) for i, s in enumerate(sources)]
    df = spark.createDataFrame(rows, "id int, s string").select("id", F.col("s").cast(source_kind).alias("s"))
    out = left_lookup(df, F.col("s"), right, "k", spread)
    assert out.columns == ["id", "s", "hit"]
    assert [r.hit for r in out.orderBy("id").collect()] == found


def test_null_sources_are_spread_by_the_whole_row(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        constant = [F.lit(c).alias(c) for c in "abcd"]
        df = spark.range(20_000).select(*constant, "id", F.lit(None).cast("string").alias("s"))
        out = left_lookup(df, F.col("s"), spark.range(3).select(F.col("id").cast("string").alias("k")), "k")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20_000 and len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)


def test_unmapped_codes_stay(spark):
    df = spark.createDataFrame([("1",), ("Maybe",), ("862890000.0",), (None,)], "c string")
    assert [r.c for r in cleanup.replace_codes(df, "c", {1: 2}).collect()] == ["2", "Maybe", "862890000.0", None]
    numbers = spark.createDataFrame([(1,), (7,)], "c int")
    assert cleanup.replace_codes(numbers, "c", {1: 2}).dtypes == [("c", "int")]
    assert [r.c for r in numbers.select(codes.replace_codes(F.col("c"), {1: 2}).alias("c")).collect()] == [2, 7]


def test_whole_numbers_in_other_types(spark):
    rows = [("100.0", 100.0), ("1.5", 1.5), ("7", None), ("x", 2.0)]
    df = spark.createDataFrame(rows, "enrollment_count string, year double")
    found = contract.conform(df, ["enrollment_count", "year"]).collect()
    assert [(r.enrollment_count, r.year) for r in found] == [(100, 100), (None, None), (7, None), (None, 2)]


def test_country_numbers_only(spark):
    countries = spark.createDataFrame([("Chile", 4)], "vin_name string, vin_countryno int")
    df = spark.createDataFrame([("4",), ("4.0",), ("4d",), ("4f",), ("4.5",)], "c string")
    out = lookups.resolve_country(df, F.col("c"), countries, "found").collect()
    assert {r.c: r.found for r in out} == {"4": "Chile", "4.0": "Chile", "4d": None, "4f": None, "4.5": "Chile"}


def test_standard_countries(spark):
    names = {r["name"]: r.iso3 for r in lookups.iso_table(spark).collect()}
    assert names["Bosnia and Herzegovina"] == "BIH" and names["Côte d'Ivoire"] == "CIV" and names["Saint Lucia"] == "LCA"
    assert len(set(names.values())) == 249


def test_last_sync_with_dropped_columns(spark):
    log = spark.createDataFrame([("completed", 3, "2024-01-02"), ("failed", 9, "2025-01-01")], "status string, records_added int, end_time string")
    assert quality.last_sync(log).first().last_sync_date == "2024-01-02"
    assert quality.last_sync(log.drop("records_added")).first().last_sync_date is None


def test_star_folder(spark):
    assert Layer(spark, "clean").beside("star") == "star"
    assert Layer(spark, "/data/x/clean/").beside("star") == "/data/x/star"
    with pytest.raises(ValueError):
        star.star_layer(spark, "/nowhere/star")


def test_staged_tables_go_after_success(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(shared_folder(spark)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    with staging_run(spark) as done:
        assert stage(spark.range(3)).count() == 3 and files.exists(path(done))
    assert not files.exists(path(done))
    with pytest.raises(RuntimeError), staging_run(spark) as failed:
        stage(spark.range(3))
        raise RuntimeError
    assert files.exists(path(failed))
