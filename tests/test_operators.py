import random

import pytest
from pyspark.sql import functions as F

from stellate.operators import cleanup, contract, dimensions, keys, lookups, quality, temporal
from stellate.operators.temporal import YearlyGroup
from stellate.sources.layers import Layer, nan_to_null
from stellate.sources.staging import shared_folder, stage


def test_column_cleanup(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", None, None), (2, "b", None, None)], "x_id int, x_n string, e string, valid_to string"
    )
    assert cleanup.drop_columns(df, ["e", "absent"]).columns == ["x_id", "x_n", "valid_to"]
    assert cleanup.drop_empty_columns(df, ["valid_to"]).columns == ["x_id", "x_n", "valid_to"]
    assert cleanup.drop_empty_columns(df, among=["x_n", "e"]).columns == ["x_id", "x_n", "valid_to"]
    assert cleanup.strip_prefix(df, "x_").columns == ["id", "n", "e", "valid_to"]
    assert cleanup.rename_columns(df, {"e": "f", "absent": "g"}).columns[2] == "f"


def test_a_late_value_keeps_a_column(spark):
    late = spark.range(5000).select("id", F.when(F.col("id") == 4999, 1).alias("rare"))
    assert cleanup.empty_columns(late) == []
    assert cleanup.empty_columns(late.where("id < 4999")) == ["rare"]
    assert cleanup.empty_columns(late.where("id < 0")) == ["id", "rare"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r.v for r in nan_to_null(df).collect()] == [None, 1.0]
    assert cleanup.empty_columns(nan_to_null(df.limit(1))) == ["v"]


def test_active_and_codes(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id int, statecode int")
    assert rows(cleanup.keep_active(df), "id") == [(1,)]
    assert cleanup.keep_active(df.drop("statecode")).count() == 3
    options = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "code bigint, label string")
    assert rows(cleanup.drop_codes(options, [2]), "label") == [("a",), ("c",)]


@pytest.mark.parametrize("n, partitions", [(1000, 7), (1, 3), (0, 2)])
def test_surrogate_key_is_dense_and_ordered(spark, n, partitions):
    values = list(range(n))
    random.Random(5).shuffle(values)
    df = spark.createDataFrame([(v // 400, v) for v in values], "hot int, v int")
    keyed = keys.surrogate_key(df.repartition(partitions), "k", ["hot", "v"])
    assert [(r.k, r.v) for r in keyed.orderBy("k").collect()] == [(i + 1, i) for i in range(n)]
    assert keyed.columns == ["k", "hot", "v"]


def test_surrogate_key_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000, numPartitions=9).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("h"), "id")
        keyed = keys.surrogate_key(df, "k", ["h", "id"]).orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r.k for r in keyed] == list(range(1, 5001))
    assert [(r.h, r.id) for r in keyed] == sorted((r.h, r.id) for r in keyed)


def test_fk_last_loaded_wins_and_null_never_matches(spark, rows):
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "pk bigint, n string")
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "s string")
    out = keys.fk_resolve(df, F.col("s"), dim, "n", "pk", "key")
    assert rows(out) == sorted([("a", 2), ("b", 4), ("z", None), (None, None)], key=repr)


def test_fk_survives_a_shuffle_join_with_many_nulls(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = spark.range(100).select((F.col("id") + 1).alias("pk"), F.concat(F.lit("n"), "id").alias("n"))
        df = spark.range(3000).select(
            "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("n"), F.col("id") % 120)).alias("s")
        )
        out = keys.fk_resolve(df, F.col("s"), dim, "n", "pk", "key").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(out) == 3000
    for r in out:
        known = r.id % 3 > 0 and r.id % 120 < 100
        assert r.key == (r.id % 120 + 1 if known else None)


def test_fk_composite_null_equals_null(spark, rows):
    dim = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, None, None)], "pk bigint, x string, y string"
    )
    df = spark.createDataFrame([("a", None), (None, None), ("a", "b")], "x string, y string")
    out = keys.fk_composite(df, {"x": F.col("x"), "y": F.col("y")}, dim, "pk", "key")
    assert rows(out, "key") == sorted([(2,), (3,), (None,)], key=repr)


def test_fk_via_fact_takes_the_last_row_with_its_nulls(spark, rows):
    fact = spark.createDataFrame(
        [(1, 7, 70, 5), (2, 7, None, 6), (3, None, 1, 1)], "id bigint, k bigint, d bigint, p bigint"
    )
    df = spark.createDataFrame([(7,), (8,), (None,)], "k bigint")
    out = keys.fk_via_fact(df, fact, "k", ["d", "p"], "id")
    assert rows(out, "k", "d", "p") == sorted(
        [(7, None, 6), (8, None, None), (None, None, None)], key=repr
    )


def test_fk_today(spark, rows):
    dates = keys.surrogate_key(temporal.date_dimension(spark, 2015, 2030), "k", ["full_date"], True)
    assert dates.count() == 5844
    out = keys.fk_today(spark.range(2), "2015-01-02", dates, "full_date", "k", "today")
    assert rows(out, "today") == [(2,), (2,)]


def test_lookup_with_repeated_keys(spark, rows):
    lookup = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, v string, o int")
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    out = lookups.lookup_name(df, F.col("s"), lookup, "k", F.col("v"), "out", ["o"])
    assert rows(out) == [("a", "y"), ("b", None)]


def test_option_labels(spark, rows):
    options = spark.createDataFrame([(5, "five"), (None, "none")], "code bigint, label string")
    df = spark.createDataFrame([(" 5", 5.0), ("5.0", 5.5), ("x", None)], "t string, d double")
    out = lookups.option_label(df, "t", options, "tl")
    out = lookups.option_label(out, "d", options, "dl")
    out = lookups.option_label(out, "absent", options, "al")
    out = lookups.option_label(out, "t", None, "nl")
    assert rows(out, "tl", "dl", "al", "nl") == sorted(
        [("five", "five", None, None), (None, None, None, None), (None, None, None, None)], key=repr
    )


def test_resolve_country(spark):
    countries = spark.createDataFrame(
        [("Turkey", 90), ("France", 33), ("United Kingdom", None)], "vin_name string, vin_countryno int"
    )
    cases = {
        "Türkiye": "Turkey", "türkiye": None, " FRANCE\t": "France", "33": "France", "33.9": "France",
        "Not specified": None, "Northern Ireland": "United Kingdom", "": None, None: None, "1e99": None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, raw string")
    out = lookups.resolve_country(df, F.col("raw"), countries, "c").orderBy("i").collect()
    assert [r.c for r in out] == list(cases.values())


def test_iso_codes(spark, rows):
    names = ["France", "Kosovo", "European Union", "Turkey", "United States of America", "Nowhere", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = dict(rows(lookups.iso_code(df, F.col("n"), "iso")))
    assert [found[n] for n in names] == ["FRA", "XKX", None, "TUR", "USA", None, None]
    own = spark.createDataFrame([("Nowhere", "NWH")], "name string, iso3 string")
    assert dict(rows(lookups.iso_code(df, F.col("n"), "iso", own)))["Nowhere"] == "NWH"


def brute_locations(text, names):
    from stellate.config.countries import ALIASES

    canonical = {n.lower(): k for n, k in names.items()}
    aliases = {a.lower(): t for a, t in ALIASES.items()}

    def find(part):
        part = part.strip().lower()
        if part in aliases:
            return canonical.get(aliases[part].lower()) if aliases[part] else None
        return canonical.get(part)

    found = set()
    for segment in text.replace(";", "|").split("|"):
        tries = [segment]
        if "," in segment:
            tries.append(segment.rsplit(",", 1)[1])
        if "(" in segment and ")" in segment.split("(", 1)[1][1:]:
            tries.append(segment.split("(", 1)[1].split(")", 1)[0])
        hits = [k for k in map(find, tries) if k]
        found |= set(hits[:1])
    return found


def test_parse_locations_equals_brute_force(spark):
    names = {"France": 1, "United Kingdom": 2, "Vietnam": 3, "Unknown": 4}
    pieces = ["France", "uk", "Viet Nam", "Site, Lyon, FRANCE", "Lab (England)", "Unknown", "x, y",
              "Unknown (France)", "", " ", "France (UK)", "A (b) (uk)", "N/A, Vietnam"]
    rng = random.Random(3)
    texts = ["".join(p + rng.choice("|;") for p in rng.sample(pieces, 4)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(999, None)], "id int, t string")
    geo = spark.createDataFrame([(k, n) for n, k in names.items()], "key int, name string")
    out = lookups.parse_locations(df, "id", F.col("t"), geo, "key", "name").collect()
    expected = {(i, k) for i, t in enumerate(texts) for k in brute_locations(t, names)}
    assert len(out) == len(expected) and {(r.id, r.key) for r in out} == expected


def brute_history(stages, answers):
    dates = sorted(d for d in stages if stages[d] is not None or answers[d] is not None)
    out, last = [], (None, None)
    for i, d in enumerate(dates):
        last = (stages[d] or last[0], answers[d] if answers[d] is not None else last[1])
        out.append((*last, d, dates[i + 1] if i + 1 < len(dates) else None))
    return out or [(None, None, None, None)]


def test_scd2_expand_equals_brute_force(spark):
    years = ["2019", "2021", "2023", "2024", "2025"]
    rng = random.Random(1)
    data = [
        [i] + [rng.choice([None, None, "a", "b"]) for _ in years] + [rng.choice([None, 0, 1]) for _ in years]
        for i in range(300)
    ]
    names = ["id", *(f"s{y}" for y in years), *(f"f{y}" for y in years)]
    schema = "id int, " + ", ".join(f"s{y} string" for y in years) + ", " + ", ".join(
        f"f{y} bigint" for y in years
    )
    df = spark.createDataFrame(data, schema)
    groups = [
        YearlyGroup("stage", {f"s{y}": f"{y}-01-01" for y in years}),
        YearlyGroup("flag", {f"f{y}": f"{y}-01-01" for y in years}, "bigint"),
    ]
    out = temporal.scd2_expand(df, groups)
    assert out.columns == ["id", "stage", "flag", "valid_from", "valid_to"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    expected = []
    for row in data:
        r = dict(zip(names, row))
        stages = {f"{y}-01-01": r[f"s{y}"] for y in years}
        flags = {f"{y}-01-01": r[f"f{y}"] for y in years}
        expected += [(r["id"], *h) for h in brute_history(stages, flags)]
    assert got == sorted(expected, key=repr)


def test_year_infill_cases(spark, rows):
    data = [
        (1, "2019-01-01", "2023-01-01", 0), (2, "2021-01-01", None, 1), (3, None, None, 1),
        (4, "2023-01-01", None, 1), (5, "2021-01-01", "soon", 0),
    ]
    df = spark.createDataFrame(data, "id int, valid_from string, valid_to string, is_active_flag int")
    out = rows(temporal.year_infill(df), "id", "infill_year", "is_active_flag")
    assert out == sorted(
        [
            (1, None, 0), (1, 2021, 0), (2, None, 0), (2, 2023, 1), (3, None, 1), (4, None, 1),
            (5, None, 0), (5, 2023, 0),
        ],
        key=repr,
    )
    years = spark.createDataFrame([([2020, 2022],)], "years array<int>")
    out = rows(temporal.year_infill(df.where("id = 1"), years=years), "infill_year")
    assert out == [(2020,), (2022,), (None,)]


def test_year_infill_without_any_year(spark, rows):
    df = spark.createDataFrame([(1, None, None, 1)], "id int, valid_from string, valid_to string, is_active_flag int")
    assert rows(temporal.year_infill(df), "id", "infill_year", "is_active_flag") == [(1, None, 1)]


@pytest.mark.parametrize("chunked", [False, True])
def test_fill_and_lead_by_chunks_equal_brute_force(spark, chunked):
    chunk = F.floor(F.col("t") / 10) if chunked else None
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", "x"]), t, rng.choice([None, None, t])) for t in range(200)]
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(5)
    filled, last = {}, {}
    for k, t, v in data:
        last[k] = v if v is not None else last.get(k)
        filled[t] = last[k]
    out = temporal.forward_fill(df, ["k"], "t", ["v"], chunk)
    assert {r.t: r.v for r in out.collect()} == filled
    following, ahead = {}, {}
    for k, t, _ in reversed(data):
        following[t] = ahead.get(k)
        ahead[k] = t
    out = temporal.next_boundary(df, ["k"], "t", "n", chunk)
    assert {r.t: r.n for r in out.collect()} == following


def test_phase_rows(spark, rows):
    stages = spark.createDataFrame(
        [(1, "s1", "Phase II"), (2, "s2", "Phase II"), (3, "s3", "Odd"), (4, "s4", ""), (5, "s5", "Unused")],
        "row_id int, id string, n string",
    )
    named = spark.createDataFrame(
        [("Phase II - Drugs",), ("Approved product",), ("Odd",), ("Strange",), ("",), (None,)], "s string"
    )
    referenced = dimensions.referenced_values(named, "s", "phase_name")
    out = dimensions.phase_rows(stages, referenced, "id", "n", ["row_id"])
    assert rows(out) == sorted(
        [("s1", "Phase II", 40), ("s3", "Odd", 500), (None, "Approved", 80)], key=repr
    )


def test_contract(spark):
    df = spark.createDataFrame([("7", "x", 1)], "a_key string, n_count string, extra int")
    out = contract.conform(df, ["a_key", "n_count", "title", "year", "parent_product_id"])
    assert out.dtypes == [
        ("a_key", "bigint"), ("n_count", "bigint"), ("title", "string"), ("year", "bigint"),
        ("parent_product_id", "string"),
    ]
    assert tuple(out.first()) == (7, None, None, None, None)
    assert contract.empty_table(spark, ["a_key"]).count() == 0


def test_metadata_upsert(spark, rows):
    old = contract.metadata_rows(spark, {"a": "1", "b": "2"})
    new = contract.metadata_rows(spark, {"b": "3", "c": "4"})
    assert rows(contract.metadata_upsert(old, new)) == [("a", "1"), ("b", "3"), ("c", "4")]
    assert rows(contract.metadata_upsert(None, new)) == [("b", "3"), ("c", "4")]


def test_quality_reports(spark, rows):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk int")
    frames = {"c": child, "p": parent}
    check = quality.ForeignKey("c", "fk", "p", "pk")
    assert rows(quality.fk_integrity(frames, [check])) == [("c", "fk", "p", 2)]
    assert rows(quality.pk_unique(frames, {"p": "pk"})) == [("p", "pk", 1)]
    df = spark.createDataFrame([("x", None), ("y", "z"), (None, "z")], "a string, b string")
    assert rows(quality.domain_check(df, {"a": ["x"], "b": ["z"]})) == [("a", 1), ("b", 0)]


def test_layer(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "layer"))
    assert layer.tables() == []
    layer.write("t", spark.range(3).toDF("x"))
    layer.write("t", spark.range(2).toDF("x"))
    layer.write("_optionset_o", spark.range(1).toDF("code"))
    assert layer.read("t").count() == 2
    assert layer.data_tables() == ["t"] and layer.option_sets() == ["_optionset_o"]
    assert list(layer.read_optional(["t", "absent"])) == ["t"]
    with pytest.raises(FileNotFoundError):
        layer.read("absent")
    layer.views()
    assert spark.sql("SELECT count(*) AS n FROM t").first().n == 2


def test_staging_uses_the_named_folder(spark):
    folder = shared_folder(spark)
    staged = stage(spark.range(3).toDF("x"))
    assert staged.count() == 3
    assert all(f.startswith(("file:" + folder, folder)) or folder in f for f in staged.inputFiles())
