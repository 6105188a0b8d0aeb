"""Both jobs on a small raw layer, with results worked out by hand."""

import pytest

from raw_layer import write_raw_layer
from stellate.operators import quality
from stellate.plans.silver import clean_layer, clinical_trials
from stellate.plans.star import star_layer
from stellate.plans.star_map import TABLES, foreign_keys
from stellate.sources.layers import Layer


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("layers"))
    write_raw_layer(spark, f"{folder}/raw")
    written = clean_layer(spark, f"{folder}/raw", f"{folder}/clean")
    report = star_layer(spark, f"{folder}/clean")
    return written, Layer(spark, f"{folder}/clean"), Layer(spark, f"{folder}/star"), report


def test_clean_layer_tables(layers):
    written, clean, _, _ = layers
    assert sorted(written) == clean.tables()
    assert "empty_table" not in written
    assert "_optionset_ctstatus" in written and "_optionset_vin_ctstatus" not in written


def test_clean_candidates(layers, rows):
    clean = layers[1].read("vin_candidates")
    assert "json_response" not in clean.columns and "new_allempty" not in clean.columns
    assert rows(clean, "candidateid", "new_currentrdstage", "include_in_pipeline", "valid_from", "valid_to") == sorted(
        [
            ("c1", "Discovery & Preclinical", 1, "2019-01-01", "2021-01-01"),
            ("c1", "Discovery & Preclinical", 1, "2021-01-01", "2025-01-01"),
            ("c1", "Phase III", 1, "2025-01-01", None),
            ("c2", "Phase II", 0, "2023-01-01", None),
            ("c4", None, 0, None, None),
        ],
        key=repr,
    )
    assert rows(clean.where("valid_to IS NULL"), "candidateid", "pressuretype", "product", "approvalstatus", "ctregistrylink") == sorted(
        [
            ("c1", "Negative pressure", "Drugs", 909670000, "https://clinicaltrials.gov/study/nct001"),
            ("c2", None, "Vaccine", 909670000, "http://a"),
            ("c4", None, None, None, None),
        ],
        key=repr,
    )


def test_clean_developers(layers, rows):
    clean = layers[1].read("vin_developers")
    assert rows(clean, "developerid", "org_name", "org_type", "country_name") == sorted(
        [
            ("v1", "Acme", None, "Turkey"), ("v2", "Beta", "NGO", "France"), ("v3", "Gamma", None, None),
            ("v4", "Delta", "1e3", "United Kingdom"), ("v5", "Beta", "NGO", "France"), ("v6", None, None, None),
        ],
        key=repr,
    )


def test_clean_diseases_and_options(layers, rows):
    clean = layers[1]
    assert rows(clean.read("vin_diseases"), "diseaseid", "disease_filter", "secondary_disease_name") == sorted(
        [("d1", "STIs", "Gonorrhea"), ("d2", "Malaria", None), ("d3", "A - B", None)], key=repr
    )
    assert "valid_to" in clean.read("vin_diseases").columns
    assert "valid_from" not in clean.read("vin_diseases").columns
    assert rows(clean.read("_optionset_globalhealtharea"), "label") == [("Neglected",), ("Womens Health",)]
    assert rows(clean.read("_optionset_approvalstatus"), "code") == [(909670000,)]
    assert rows(clean.read("_optionset_ctstatus"), "code") == [(909670001,)]
    assert rows(clean.read("vin_rdpriorities"), "author") == [("Other",), ("WHO",)]


def test_clean_trials(layers, rows):
    assert rows(layers[1].read("vin_clinicaltrials"), "clinicaltrialid", "ctphase", "age", "sex", "studytype", "ctstatus") == sorted(
        [
            ("t1", "Phase II/III", "Older adults: 45 >", "Both", "Interventional", 909670001),
            ("t2", "Phase I", "Children", "Female", "other", 909670001),
            ("t3", "Unknown", "Unknown", "Unknown", None, None),
        ],
        key=repr,
    )


def test_a_trial_column_without_values_is_unknown(spark, rows):
    df = spark.createDataFrame(
        [("t1", None, None)], "vin_clinicaltrialid string, new_age string, new_studytype string"
    )
    cleaned, _ = clinical_trials(df)
    assert cleaned.columns == ["clinicaltrialid", "age"]
    assert rows(cleaned) == [("t1", "Unknown")]


def test_star_has_all_tables_with_declared_columns(layers):
    _, _, star, _ = layers
    assert set(TABLES) <= set(star.tables()) and len(TABLES) == 25
    for name, table in TABLES.items():
        assert star.read(name).columns == table.declared()


def test_snapshots(layers, rows):
    fact = layers[2].read("fact_pipeline_snapshot")
    dates = layers[2].read("dim_date").select("date_key", "full_date")
    phases = layers[2].read("dim_phase").select("phase_key", "phase_name")
    shown = fact.join(dates, "date_key", "left").join(phases, "phase_key", "left")
    assert rows(shown, "snapshot_id", "candidate_key", "full_date", "phase_name", "is_active_flag", "include_in_pipeline") == sorted(
        [
            (1, 3, "2019-01-01", "Discovery & Preclinical", 0, 1),
            (2, 3, "2021-01-01", "Discovery & Preclinical", 0, 1),
            (3, 3, "2023-01-01", "Discovery & Preclinical", 0, 1),
            (4, 3, "2025-01-01", "Phase III", 1, 1),
            (5, 4, "2023-01-01", "Phase II", 0, 0),
            (6, 4, "2025-01-01", "Phase II", 1, 0),
            (7, 5, None, None, 1, 0),
        ],
        key=repr,
    )
    assert rows(fact, "product_key", "disease_key", "technology_key", "regulatory_key")[0] == (1, 1, 2, 2)


def test_trials_and_publications(layers, rows):
    star = layers[2]
    assert rows(star.read("fact_clinical_trial_event"), "trial_id", "candidate_key", "disease_key", "product_key", "start_date_key", "enrollment_count", "status") == sorted(
        [
            (1, 3, 1, 1, 1828, 0, "Active"),
            (2, 4, None, 2, None, 12, "Active"),
            (3, None, None, None, None, 3, None),
        ],
        key=repr,
    )
    assert rows(star.read("fact_publication"), "publication_id", "candidate_key") == [(1, 3), (2, None)]


@pytest.mark.parametrize("table, expected", [
    ("bridge_candidate_developer", [(3, 1), (3, 1), (3, 1), (3, 2), (3, 2), (3, 2), (4, 2)]),
    ("bridge_candidate_funder", [(3, 1), (3, 1), (3, 1)]),
    ("bridge_candidate_priority", [(3, 1), (3, 1)]),
    ("bridge_candidate_age_group", [(3, 2)]),
    ("bridge_candidate_approving_authority", [(4, 1)]),
    ("bridge_candidate_organization", [(4, 2)]),
    ("bridge_trial_geography", [(1, 1), (1, 2), (1, 3), (2, 3)]),
    ("bridge_candidate_geography", [
        (3, 1, "Developer Location"), (3, 2, "Developer Location"), (3, 2, "Target Country"),
        (4, 3, "Developer Location"),
    ]),
])
def test_bridges(layers, rows, table, expected):
    assert rows(layers[2].read(table)) == expected


def test_dimensions(layers, rows):
    star = layers[2]
    assert rows(star.read("dim_phase"), "phase_key", "vin_rdstageid", "phase_name") == sorted(
        [(1, None, "Discovery & Preclinical"), (2, "st3", "Phase II"), (3, "st1", "Phase III")], key=repr
    )
    assert rows(star.read("dim_geography"), "country_name", "iso_code") == sorted(
        [("Turkey", "TUR"), ("France", "FRA"), ("United Kingdom", "GBR"), ("European Union", None)], key=repr
    )
    assert rows(star.read("dim_candidate_regulatory"), "approval_status") == sorted(
        [("Approved",), (None,)], key=repr
    )
    assert rows(star.read("dim_product"), "vin_productid", "product_level", "parent_product_id") == sorted(
        [("p1", "top-level", None), ("p2", "sub-product", "p1")], key=repr
    )


def test_reports(layers, rows):
    _, _, star, report = layers
    assert len(foreign_keys()) == 34
    assert {r.orphans for r in report.fk_integrity.collect()} == {0}
    assert dict(rows(report.row_counts))["dim_date"] == 5844
    assert rows(report.metadata) == [("last_sync_date", "2024-02-01")]
    pks = {t.name: t.pk for t in TABLES.values() if t.pk}
    frames = {n: star.read(n) for n in pks}
    assert {r.repeated_keys for r in quality.pk_unique(frames, pks).collect()} == {0}


def test_a_missing_source_gives_an_empty_declared_table(spark, tmp_path):
    clean = Layer(spark, str(tmp_path / "clean"))
    clean.write("vin_products", spark.createDataFrame([("p1",)], "vin_productid string"))
    report = star_layer(spark, clean.folder)
    counts = {r.table_name: r.n_rows for r in report.row_counts.collect()}
    assert counts["dim_product"] == 1 and counts["dim_date"] == 5844
    assert counts["fact_pipeline_snapshot"] == 0 and counts["bridge_trial_geography"] == 0
