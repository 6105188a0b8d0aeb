"""Fills and leads of histories that stand in many partitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stellate.operators import segments, temporal

MANY = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def many_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in MANY}
    for k, v in MANY.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sets(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_fill_equals_the_window_form(spark, many_partitions, seed):
    r = random.Random(seed)
    keys = [None, 1, 2] if seed % 2 else [None, "hot", "hot", "hot", "hot", "x"]
    times = r.sample(range(1000), 300)
    data = [(r.choice(keys), r.choice([None, 1.5, float("nan")]), t if i else None, r.choice([None] * 9 + [t]), r.choice([None, "", f"v{t}"]))
            for i, t in enumerate(times)]
    kind = "int" if seed % 2 else "string"
    df = spark.createDataFrame(data, f"k {kind}, d double, t int, v int, s string").repartition(5)
    for by in (["k"], ["k", "d"], []):
        w = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
        expected = df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("v", "s")})
        assert sets(segments.fill_forward(df, by, "t", ["v", "s"])) == sets(expected)
        expected = df.withColumn("n", F.lead("t").over(Window.partitionBy(*by).orderBy("t")))
        assert sets(segments.next_start(df, by, "t", "n")) == sets(expected)


def test_a_value_crosses_partitions_without_any(spark, many_partitions):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.col("id").alias("t"), F.when(F.col("id") == 3, "first").alias("v"))
    out = segments.fill_forward(df, ["k"], "t", ["v"])
    assert out.groupBy("v").count().sort("count").collect() == [(None, 3), ("first", 1997)]


def test_one_key_of_a_million_rows_is_many_tasks(spark, many_partitions):
    df = spark.range(1_000_000).select(F.lit(7).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 1000 == 0, F.col("id")).alias("v"))
    placed = []
    stage = segments.stage
    try:
        segments.stage = lambda *a: placed.append(stage(*a)) or placed[-1]
        filled = segments.fill_forward(df, ["k"], "t", ["v"])
        led = segments.next_start(df, ["k"], "t", "n")
    finally:
        segments.stage = stage
    for table in placed:
        sizes = [r["count"] for r in table.groupBy(segments.PART).count().collect()]
        assert len(sizes) == 13 and max(sizes) < 200_000
    assert filled.where("v != t - t % 1000").count() == 0 and filled.count() == 1_000_000
    assert led.where("n = t + 1").count() == 999_999 and led.where("n IS NULL").collect() == [(7, 999_999, None, None)]


def test_ties_take_the_value_of_their_place(spark, many_partitions):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5), ("a", 1, None), ("a", 2, None)], "k string, t int, v int")
    assert {tuple(r) for r in segments.fill_forward(df, ["k"], "t", ["v"]).collect()} == {("a", 1, 5), ("a", 2, 5)}
    led = segments.next_start(df.drop("v"), ["k"], "t", "n")
    assert sets(led) == sorted(map(repr, [("a", 1, 1), ("a", 1, 1), ("a", 1, 2), ("a", 2, None)]))


def test_empty_tables_and_wide_rows(spark, many_partitions):
    df = spark.createDataFrame([(1, 2, None, {"m": 1}, [1])], "k int, t int, v int, m map<string,int>, a array<int>")
    for rows in (df, df.limit(0)):
        assert sets(segments.fill_forward(rows, ["k"], "t", ["v"])) == sets(rows)
        assert segments.next_start(rows, ["k"], "t", "n").columns == [*df.columns, "n"]
        assert segments.next_start(rows, ["k"], "t", "n").count() == rows.count()


def test_chunks_are_still_an_option(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"))
    chunk = F.floor(F.col("t") / 10)
    assert sets(temporal.forward_fill(df, ["k"], "t", ["v"], chunk)) == sets(temporal.forward_fill(df, ["k"], "t", ["v"]))
