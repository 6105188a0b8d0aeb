"""Free-text classifiers: ordered rules over upper-cased text, first match wins."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.functions.text import strip

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Rule:
    """A label and what selects it: a contained term, a LIKE pattern or an exact text."""

    label: str
    contains: tuple[str, ...] = ()
    like: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()

    def matches(self, c: Column) -> Column:
        tests = [c.contains(t) for t in self.contains] + [c.like(p) for p in self.like]
        if self.equals:
            tests.append(c.isin(list(self.equals)))
        return reduce(or_, tests)


# Trial phases.
PHASE_RULES = (
    Rule("N/A", equals=("N/A", "NOT APPLICABLE", "PHASE N/A", "PHASE: N/A", "NA", "0", "PHASE 0")),
    Rule("Unknown", equals=("UNKNOWN", "PHASE UNSPECIFIED", "OTHER", "NOT SELECTED")),
    Rule("Phase III/IV", contains=("III/IV", "3/4")),
    Rule("Phase II/III", contains=("II/III", "2/3", "PHASE2|PHASE3")),
    Rule("Phase I/II", contains=("I/II", "1/2", "1 AND 2", "PHASE1|PHASE2"), equals=("12",)),
    Rule("Observational", contains=("OBSERVATIONAL",)),
    Rule("Interventional", contains=("INTERVENTIONAL",)),
    Rule("Retrospective", contains=("RETROSPECTIVE",)),
    Rule("CHIM", contains=("CHIM",)),
    Rule(
        "Phase IV",
        contains=("PHASE 4", "PHASE IV", "POST-MARKET", "POST MARKETING"),
        equals=("IV", "4"),
    ),
    Rule("Phase III", contains=("PHASE 3", "PHASE III", "PHASE3"), equals=("III", "3")),
    Rule("Phase II", contains=("PHASE 2", "PHASE II", "PHASR II", "PHASE2"), equals=("II", "2")),
    Rule("Phase I", contains=("PHASE 1", "PHASE I", "EARLY_PHASE1", "PHASE1"), equals=("I", "1")),
)

# Age groups.
AGE_RULES = (
    Rule(
        "Older adults: 45 >",
        contains=(
            "OLDER ADULT", "OLDER_ADULT", "(OLDER)", "65", "64", "60", "55", "50", "49", "48",
            "YEARS AND OLDER", "YEARS AND OVER",
        ),
    ),
    Rule("Young Adults 18 - 45", contains=("ADULT", "18", "20", "25", "18-45", "18-40")),
    Rule("Adolescents", contains=("ADOLESCENT", "14", "15", "16", "17")),
    Rule("Children", contains=("CHILD", "CHILDREN")),
    Rule("Infants", contains=("INFANT", "18 MONTHS")),
    Rule("Neonates", contains=("NEONATE",)),
)

# participants' sex. The two yes/no answers are tested separately below.
SEX_KEYWORDS = Rule("Both", contains=("BOTH", "ALL", "AND FEMALE", "AND MALE"))
SEX_FEMALE_YES, SEX_FEMALE_NO = "FEMALE: YES", "FEMALE: NO"
SEX_MALE_YES, SEX_MALE_NO = "MALE: YES", "MALE: NO"
SEX_RULES = (
    Rule("Both", like=("%FEMALE: YES%MALE: YES%",)),
    Rule("Female", equals=("F", "FEMALE", "FEMALES")),
    Rule("Male", equals=("M", "MALE", "MALES")),
)

# Study types.
STUDY_TYPE_RULES = (
    Rule(
        "Interventional",
        equals=(
            "INTERVENTIONAL",
            "INTERVENTIONAL STUDY",
            "INTERVENTION",
            "INTERVENTIONAL CLINICAL TRIAL OF MEDICINAL PRODUCT",
        ),
    ),
    Rule(
        "Observational",
        equals=("OBSERVATIONAL", "OBSERVATIONAL STUDY", "OBSERVATIONAL NON INVASIVE"),
    ),
)


def first_match(c: Column, rules: tuple[Rule, ...]) -> Column:
    """Label of the first rule that matches, else NULL."""
    return F.coalesce(*(F.when(r.matches(c), F.lit(r.label)) for r in rules))


@dataclass(frozen=True)
class Classifier:
    """Prepares a text and decides on its label. As a function it is one expression; ``apply``
    prepares the text once per row for all rules, which is what large tables want."""

    prepare: Callable[[Column], Column]
    decide: Callable[[Column, Column], Column]

    def __call__(self, c: Column) -> Column:
        return self.decide(self.prepare(c), c)


def apply(df: DataFrame, labels: Mapping[str, Classifier]) -> DataFrame:
    """Replace the named columns by their labels; absent columns are ignored.

    One column after the other, so that the generated code of each stays small enough for the
    JVM to compile.
    """
    for name, classifier in labels.items():
        if name in df.columns:
            df = df.withColumn("__text", classifier.prepare(F.col(name)))
            df = df.withColumn(name, classifier.decide(F.col("__text"), F.col(name)))
    return df.drop("__text")


def _sex_label(text: Column) -> Column:
    answers = F.when(
        text.contains(SEX_FEMALE_YES) & text.contains(SEX_MALE_NO), F.lit("Female")
    ).when(text.contains(SEX_MALE_YES) & text.contains(SEX_FEMALE_NO), F.lit("Male"))
    return F.coalesce(
        first_match(text, (SEX_KEYWORDS,)), answers, first_match(text, SEX_RULES), F.lit(UNKNOWN)
    )


phase = Classifier(
    lambda c: F.replace(strip(F.upper(c.cast("string"))), F.lit("\n"), F.lit(" ")),
    lambda text, _: F.coalesce(first_match(text, PHASE_RULES), F.lit(UNKNOWN)),
)
age_group = Classifier(
    lambda c: strip(F.translate(F.upper(c.cast("string")), "\xa0\xc2", "  ")),
    lambda text, _: F.coalesce(first_match(text, AGE_RULES), F.lit(UNKNOWN)),
)
sex = Classifier(
    lambda c: strip(F.replace(F.upper(c.cast("string")), F.lit("<BR>"), F.lit(" "))),
    lambda text, _: _sex_label(text),
)
# A known study type; any other value stays as it is, NULL included.
study_type = Classifier(
    lambda c: F.upper(strip(c.cast("string"))),
    lambda text, original: F.coalesce(first_match(text, STUDY_TYPE_RULES), original),
)
