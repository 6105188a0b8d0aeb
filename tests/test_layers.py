"""Versions of a layer, and tables that are counted while they are written."""

import os
import time

import pytest

from raw_layer import write_raw_layer
from stellate.operators.cleanup import EmptyWhenWritten
from stellate.operators.contract import empty_table
from stellate.plans import silver
from stellate.plans import spec as kinds
from stellate.plans import star as star_plan
from stellate.plans.silver import clean_layer
from stellate.plans.star import StarReport, star_layer
from stellate.plans.star_map import TABLES
from stellate.queries import star as star_queries
from stellate.sources.layers import VERSIONS, Layer
from stellate.sources.staging import DROP_SHUFFLES, stage


@pytest.fixture
def layer(spark, tmp_path):
    return Layer(spark, str(tmp_path / "layer"))


def versions(layer):
    return len([s for s in layer._files().listStatus(layer._path(VERSIONS))])


def test_readers_see_whole_versions(spark, layer):
    with layer.rebuild() as run:
        run.write("a", spark.range(3))
        run.write("b", spark.range(1))
        assert layer.tables() == [] and Layer(spark, layer.folder).tables() == []
    reader = Layer(spark, layer.folder)
    assert reader.tables() == ["a", "b"] and reader.read("a").count() == 3
    started = reader.read("a")
    with layer.rebuild() as run:
        run.write("a", spark.range(5))
    # The second run leaves no table of the first, a new reader sees it, and old ones read on.
    assert Layer(spark, layer.folder).tables() == ["a"] and layer.read("a").count() == 5
    assert started.count() == 3 and reader.read("b").count() == 1
    with layer.rebuild() as run:
        run.write("a", spark.range(7))
    assert versions(layer) == 2 and Layer(spark, layer.folder).read("a").count() == 7


def test_a_failed_run_changes_nothing(spark, layer):
    with layer.rebuild() as run:
        run.write("a", spark.range(3))
    with pytest.raises(RuntimeError), layer.rebuild() as run:
        run.write("a", spark.range(9))
        run.write("b", spark.range(9))
        raise RuntimeError
    assert layer.tables() == ["a"] and layer.read("a").count() == 3 and versions(layer) == 1
    with pytest.raises(ValueError):
        layer.write("a", spark.range(1))


def test_hidden_columns_and_forgotten_tables(spark, layer):
    with layer.rebuild() as run:
        run.write("a", spark.range(3).selectExpr("id", "id AS `odd name`", "id AS gone"))
        run.leave_out("a", ["gone", "never there"])
        run.write("b", spark.range(0))
        run.forget("b")
    assert layer.tables() == ["a"] and layer.locate("b") is None
    assert layer.read("a").columns == ["id", "odd name"] and layer.read("a", ["id"]).columns == ["id"]


def test_jobs_that_fail_midway_and_run_again(spark, tmp_path, monkeypatch):
    raw, clean, star = (str(tmp_path / n) for n in ("raw", "clean", "star"))
    write_raw_layer(spark, raw)
    clean_layer(spark, raw, clean)
    star_layer(spark, clean)
    before = {t: Layer(spark, star).read(t).count() for t in Layer(spark, star).tables()}
    tables = Layer(spark, clean).tables()

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(silver, "REGISTRY", {**silver.REGISTRY, "vin_developers": silver.Registered(broken)})
        with pytest.raises(RuntimeError):
            clean_layer(spark, raw, clean)
        m.setattr("stellate.plans.star.country_branch", broken)
        with pytest.raises(RuntimeError):
            star_layer(spark, clean)
    assert Layer(spark, clean).tables() == tables
    assert {t: Layer(spark, star).read(t).count() for t in Layer(spark, star).tables()} == before

    # The second run has a product more and no publications.
    inputs = Layer(spark, raw)
    products = inputs.read("vin_products").cache()
    more = products.limit(1).selectExpr("*").replace("p1", "p9")
    products.unionByName(more).write.mode("overwrite").parquet(f"{raw}/more")
    spark.read.parquet(f"{raw}/more").write.mode("overwrite").parquet(f"{tmp_path}/copy")
    inputs.write("vin_products", spark.read.parquet(f"{tmp_path}/copy"))
    inputs.write("vin_sources", inputs.read("vin_products").limit(0))
    clean_layer(spark, raw, clean)
    star_layer(spark, clean)
    again = Layer(spark, star)
    assert again.read("dim_product").count() == before["dim_product"] + 1
    assert again.read("fact_publication").count() == 0 and set(again.tables()) == set(before)
    assert "vin_sources" not in Layer(spark, clean).tables()


def test_a_plain_table_is_one_job(spark, tmp_path):
    raw = Layer(spark, str(tmp_path / "raw"))
    for i in range(4):
        columns = ["id AS row_id", "CAST(NULL AS STRING) AS nothing", f"'x{i}' AS name", "CAST(NULL AS STRING) AS valid_to"]
        raw.write(f"table_{i}", spark.range(50).selectExpr(*columns))
    raw.write("table_none", spark.range(0).selectExpr("id AS row_id"))
    raw.write("_optionset_x", spark.range(3).selectExpr("id AS code", "'l' AS label"))
    status = spark.sparkContext.statusTracker()
    before = max(status.getJobIdsForGroup(None))
    written = clean_layer(spark, raw.folder, str(tmp_path / "clean"), parallel=1)
    clean = Layer(spark, str(tmp_path / "clean"))
    # Besides one job for each table, Spark reads the schemas of the six tables.
    assert max(status.getJobIdsForGroup(None)) - before == 2 * 6
    assert sorted(written) == clean.tables() == ["_optionset_x", "table_0", "table_1", "table_2", "table_3"]
    assert clean.read("table_2").columns == ["row_id", "name", "valid_to"]


def test_counted_columns_go_with_what_is_made_of_them(spark, tmp_path):
    df = spark.range(4).selectExpr("id", "CAST(NULL AS INT) AS a", "CAST(NULL AS INT) AS b", "IF(id = 3, 1, NULL) AS c")
    counted = EmptyWhenWritten()
    passed = counted(df, preserve=["b"], into={"a": ["renamed", "made_of_it"]})
    passed.selectExpr("id", "a AS renamed", "0 AS made_of_it", "b", "c").write.parquet(str(tmp_path / "t"))
    assert counted.rows == 4 and counted.left_out() == {"renamed", "made_of_it"}


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in blocks.getAllFiles().mkString("\n").split("\n") if name.endswith(".data")}


def test_shuffle_files_go_with_the_write(spark, layer):
    before, setting = shuffle_files(spark), spark.conf.get(DROP_SHUFFLES, None)
    shuffled = spark.range(1000).repartition(3, "id")
    assert stage(shuffled).count() == layer.write("a", shuffled).count() == 1000
    with Layer(spark, f"{layer.folder}-b").rebuild() as run:
        assert run.write("b", shuffled).count() == 1000
    files = os.listdir(f"{layer.folder}/a")
    assert any(f.endswith(".zstd.parquet") for f in files) and not any("snappy" in f for f in files)
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    until = time.time() + 20  # the files are deleted in the background; the counts above keep one row each
    while (left := [f for f in shuffle_files(spark) - before if os.path.exists(f) and os.path.getsize(f) > 500]) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_a_layer_goes_when_the_next_one_stands(spark, monkeypatch):
    seen = []

    def clean_layer(spark, raw, clean):
        seen.append(os.listdir(os.path.dirname(raw)))
        with Layer(spark, clean).rebuild() as run:
            run.write("a", spark.range(1))

    def star_layer(spark, clean):
        seen.append(sorted(os.listdir(os.path.dirname(clean))))
        with Layer(spark, Layer(spark, clean).beside("star")).rebuild() as run:
            for name, table in TABLES.items():
                run.write(name, empty_table(spark, table.declared()))
        told = spark.createDataFrame([("last_sync_date", "x")], "key string, value string")
        seen.append(clean)
        return StarReport(told, told.selectExpr("0L AS orphans"), told)

    monkeypatch.setattr(star_queries, "raw", lambda *a: spark.range(2))
    monkeypatch.setattr(star_queries, "derive", lambda *a: spark.range(2))
    monkeypatch.setattr(star_queries.silver, "clean_layer", clean_layer)
    monkeypatch.setattr(star_queries.star, "star_layer", star_layer)
    assert star_queries.layers_load(spark, "unused").count() == len(TABLES) + 2
    assert seen[:2] == [["raw"], ["clean"]] and os.listdir(os.path.dirname(seen[2])) == ["star"]


def test_few_large_tables_are_written_at_once(spark, monkeypatch):
    large = (kinds.Fact, kinds.Bridge, kinds.CountryBridge, kinds.DelimitedBridge)
    running, most = [], []

    def rows(star, table):
        if isinstance(table, large):
            running.append(table.name)
            time.sleep(0.2)
            most.append(len(running))
            running.remove(table.name)
        return empty_table(spark, table.declared())

    monkeypatch.setattr(star_plan, "table_rows", rows)
    done = star_plan.build(star_plan.Star(spark, lambda name: None, lambda name, df: df), parallel=8)
    assert list(done) == list(TABLES) and 1 <= max(most) <= star_plan.LARGE_AT_ONCE
