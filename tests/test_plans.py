"""Plans that must hold at any size: no cross joins, no Python rows, pruned and filtered scans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stellate.operators import keys, temporal
from stellate.operators.bridges import attach_key
from stellate.plans import silver
from stellate.queries.inputs import base, raw
from stellate.sources import staging


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "name",
    ["fk_resolve", "fk_composite", "fk_via_fact", "year_infill", "parse_locations", "left_enrich",
     "resolve_country", "fk_integrity", "scd2_expand", "silver_trials", "forward_fill"],
)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    text = plan(contract.queries()[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text


def test_expansion_needs_no_shuffle(spark, sf_dir):
    orders = base(spark, sf_dir, "orders").withColumn("y", F.col("o_orderstatus"))
    group = temporal.YearlyGroup("status", {"o_orderstatus": "2019-01-01", "y": "2021-01-01"})
    text = plan(temporal.scd2_expand(orders, [group]))
    assert "Exchange" not in text.split("== Physical Plan ==")[1]


def test_trial_cleanup_is_one_scan_without_shuffle(spark, sf_dir):
    trials = base(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("vin_ctphase"), F.col("o_orderkey").alias("vin_clinicaltrialid")
    )
    df, _ = silver.clinical_trials(trials)
    physical = plan(df).split("== Physical Plan ==")[1]
    assert "Exchange" not in physical and "o_orderpriority" in physical
    assert "o_totalprice" not in physical


def test_filter_reaches_the_scan(spark, sf_dir):
    from stellate.operators import cleanup

    lines = base(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "statecode")
    physical = plan(cleanup.keep_active(lines).select("l_orderkey", "statecode"))
    assert "EqualTo(l_linenumber,0)" in physical
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in physical


def test_large_lookup_is_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        dim = spark.range(1000).select(F.col("id").alias("pk"), F.col("id").cast("string").alias("n"))
        df = spark.range(10).select(F.col("id").cast("string").alias("s"))
        text = plan(keys.fk_resolve(df, F.col("s"), dim, "n", "pk", "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in text


def test_raw_tables_are_whole(spark, sf_dir):
    assert raw(spark, sf_dir, "raw_developers").count() == base(spark, sf_dir, "lineitem").count()


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("kind", ["resolve", "composite", "bridge", "integer"])
def test_a_hot_key_is_split(spark, kind):
    """A third of the rows share one key and nothing may be broadcast."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(1000)
        dim = ids.select(
            (F.col("id") + 1).alias("pk"), F.concat(F.lit("n"), "id").alias("n"), F.col("id").alias("i")
        )
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
        df = spark.range(150000, numPartitions=8).select(
            "id", hot.cast("bigint").alias("t"), F.concat(F.lit("n"), hot).alias("s")
        )
        if kind == "resolve":
            out = keys.fk_resolve(df, F.col("s"), dim, "n", "pk", "k")
        elif kind == "composite":
            out = keys.fk_composite(df, {"n": F.col("s")}, dim, "pk", "k")
        elif kind == "integer":
            out = keys.fk_resolve(df, F.col("t"), dim, "i", "pk", "k")
        else:
            out = attach_key(df, "s", keys.key_map(dim, "n", "pk"), "n", "k")
        found = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(found) == 150000 and all(r.k == r.t + 1 for r in found)
    assert "skew=true" in final


def test_foreign_keys_read_every_table_once(spark, tmp_path):
    from stellate.operators import quality

    frames = {}
    for name in ("a", "b", "c"):
        rows = spark.range(50).selectExpr("id AS k", "id * 2 AS x", "CAST(id AS STRING) AS y", "IF(id > 3, 'none', NULL) AS z")
        rows.write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    check = quality.ForeignKey
    checks = [check("a", "x", "b", "k"), check("a", "y", "b", "k"), check("b", "x", "c", "k"), check("b", "z", "c", "y"), check("c", "z", "b", "k")]
    out = quality.fk_integrity(frames, checks)
    assert plan(out).split("== Physical Plan ==")[1].count("FileScan") == 3
    assert [r.orphans for r in out.sort("child", "fk_column").collect()] == [25, 0, 25, 46, 46]


@pytest.mark.parametrize("name", ["fact_publication", "fact_trial"])
def test_texts_are_in_no_exchange(name, spark, sf_dir, monkeypatch):
    """Numbering and lookups work on keys and places; texts are read where they end up."""
    texts = {"title", "description", "url", "vin_description", "vin_url", "locations", "name", "trial_title"}
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, *a: (staged.append(df), staging.stage(df, *a))[1])
    frames = [contract.queries()[name](spark, sf_dir)]
    exchanges = 0
    for df in frames + staged:
        nodes = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        for node in nodes.split("\n\n"):
            head = node.strip().split("\n")[0]
            if "Exchange" in head and head.startswith("("):
                exchanges += 1
                columns = {c.split("#")[0].strip("[ ") for line in node.split("\n") if line.startswith("Input") for c in line.split(":", 1)[1].split(",")}
                assert not columns & texts, node
    assert exchanges >= 2 and staged


def test_each_key_map_is_made_once(spark, sf_dir, monkeypatch):
    from stellate.plans import star
    from stellate.queries.star import required, star_table

    made = []
    key_map = keys.key_map
    monkeypatch.setattr(star.keys, "key_map", lambda df, natural, pk: made.append((natural, pk)) or key_map(df, natural, pk))
    assert len(required(["bridge_candidate_priority"])) > 4
    star_table(spark, sf_dir, "bridge_candidate_priority")
    assert len(made) == len(set(made)) >= 4


def test_keys_in_place_beyond_the_broadcast(spark, sf_dir, monkeypatch, rows):
    monkeypatch.setattr(keys, "SENT_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = keys.surrogate_key_in_place(base(spark, sf_dir, "documents"), "k", ["lang"])
        assert "BroadcastHashJoin" not in plan(far.select("text")).split("FileScan")[0]
        found = sorted(rows(far, "k", "doc_id", "lang"), key=lambda r: r[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r[0] for r in found] == list(range(1, len(found) + 1))
    assert [r[2] for r in found] == sorted(r[2] for r in found)
