import pytest
from pyspark.sql import functions as F

from stellate.functions import classify, codes, text


def values(spark, function, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def check(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


def test_whitespace_set_is_pythons():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_normalize_whitespace(spark):
    check(spark, text.normalize_whitespace, {
        None: None, "": None, " \t\n ": None, "a  b": "a b", " a<br>b<BR>c ": "a b c",
        "a<br/>b<Br>": "a<br/>b<Br>", "x\xa0 y\x1cz": "x y z", "plain": "plain",
    })
    keep_tags = lambda c: text.normalize_whitespace(c, remove_html=False)
    check(spark, keep_tags, {"a <br>  b": "a <br> b"})


def test_strip_and_suffixes(spark):
    check(spark, text.strip, {"\xa0 a b　\n": "a b", " ": "", None: None})
    check(spark, text.before_last, {"a - b - c": "a - b", "a": "a", "a-b": "a-b", None: None})
    check(spark, text.before_first, {"a - b - c": "a", "a": "a", None: None})
    check(spark, text.after_first, {"a - b - c": "b - c", "a": None, None: None})


def test_collapse_to_parent(spark):
    rows = [("P - S", "S"), ("P - S", "T"), ("P - S", None), ("P", "P"), (None, "S"),
            ("P - A - B", "A - B")]
    df = spark.createDataFrame(rows, "p string, s string")
    out = df.select(text.collapse_to_parent(F.col("p"), F.col("s"))).collect()
    assert [r[0] for r in out] == ["P", "P - S", "P - S", "P", None, "P"]


def test_registry_link(spark):
    check(spark, text.registry_link, {
        " http://x ": "http://x", "NCT01": "https://clinicaltrials.gov/study/NCT01",
        "ISRCTN\n nct02 \nNCT03": "https://clinicaltrials.gov/study/nct02",
        "none": None, " ": None, None: None,
    })


def test_numeric_text(spark):
    check(spark, text.numeric_text_to_null, {
        "5001": None, " -1.5 ": None, "5.": None, ".5": None, "1e3": "1e3", "1-2": "1-2",
        "+5": "+5", "-": "-", "NGO": "NGO", "inf": "inf", None: None,
    })


def test_dates(spark):
    check(spark, text.iso_date_prefix, {
        "2020-01-02T00": "2020-01-02", "2020-01": None, None: None, "": None,
    })
    check(spark, text.year_of, {"2020-01-01": 2020, "n/a!": None, "99": None, None: None})


def test_split_parts(spark):
    check(spark, text.split_parts, {" a ;b;; ;\xa0c": ["a", "b", "c"], "": [], None: None})
    check(spark, lambda c: text.split_parts(c, "|"), {"a|b": ["a", "b"]})


@pytest.mark.parametrize("function, cases", [
    (classify.phase, {
        None: "Unknown", "None": "Unknown", "n/a": "N/A", "Phase 0": "N/A", "other": "Unknown",
        "Phase III/IV": "Phase III/IV", "3/4": "Phase III/IV", "Phase2|Phase3": "Phase II/III",
        "1 and 2": "Phase I/II", "12": "Phase I/II", "Observational I": "Observational",
        "interventional": "Interventional", "Retrospective IV": "Retrospective", "chim": "CHIM",
        "Phase\nIV": "Phase IV", "post-marketing": "Phase IV", "III": "Phase III",
        "phase 3": "Phase III", "Phasr II": "Phase II", "2": "Phase II", " i ": "Phase I",
        "EARLY_PHASE1": "Phase I", "x": "Unknown",
    }),
    (classify.age_group, {
        None: "Unknown", "18 Years and older": "Older adults: 45 >", "(Older)": "Older adults: 45 >",
        "Adult": "Young Adults 18 - 45", "18 months": "Young Adults 18 - 45",
        "Adolescent": "Adolescents", "up to 16": "Adolescents", "Child": "Children",
        "infant": "Infants", "NEONATE": "Neonates", "years\xa0and\xa0over": "Older adults: 45 >",
        "x": "Unknown",
    }),
    (classify.sex, {
        None: "Unknown", "All": "Both", "Male and Female": "Both",
        "Female: yes<br>Male: no": "Female", "Male: Yes Female: No": "Male",
        "Female: Yes, Male: Yes": "Both", "Male: yes": "Unknown", " f ": "Female",
        "Males": "Male", "x": "Unknown",
    }),
    (classify.study_type, {
        None: None, " interventional study": "Interventional", "Intervention": "Interventional",
        "OBSERVATIONAL": "Observational", "Expanded ": "Expanded ",
    }),
])
def test_classifiers(spark, function, cases):
    check(spark, function, cases)


def test_value_maps(spark):
    check(spark, lambda c: codes.replace_values(c, {"a": "b", "b": "a"}), {
        "a": "b", "b": "a", "c": "c", None: None,
    })
    check(spark, lambda c: codes.replace_values(c, {"a": None, "b": "x"}), {
        "a": None, "b": "x", "c": "c", None: None,
    })
    check(spark, lambda c: codes.map_strict(c, {"Yes": 1}), {"Yes": 1, "yes": None, None: None})
    check(spark, lambda c: codes.replace_codes(c, {5: 7}, "string"), {
        "5": "7", "6": "6", "x": "x", None: None,
    })
    check(spark, lambda c: codes.member_flag(c, ["a"]), {"a": 1, "b": 0, None: 0})
    check(spark, lambda c: codes.case_code(c, 5, "y", "n"), {"5": "y", "x": "n", None: "n"})
    check(spark, lambda c: codes.case_text(c, {"a": "A"}), {"a": "A", "b": None, None: None})
