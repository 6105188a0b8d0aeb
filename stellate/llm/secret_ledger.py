"""Secret scans over every historical version of every file, each content scanned once.

A version is one row: where it lies (any columns) and its text. Its blob is the SHA-256 of the
text. The ledger holds one row per blob and scan: the rule versions that were applied and the
spans they found. A scan reads only blobs for which a rule version is missing from the ledger, and
only with the missing rules; findings then join back to all versions of the blob.

NULL and empty texts are the empty blob and have no findings. Copies share one blob and get the
same findings. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` must not match the empty text; a match counts if its ``group`` is long enough."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        told = f"{self.kind}\n{self.pattern}\n{self.group}\n{self.least}"
        return hashlib.sha256(told.encode()).hexdigest()[:16]


# The patterns that the scan's contract names. Runs of a known least length are asked
# for in the pattern itself; greedy runs are maximal, so this finds the same matches.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    SecretRule("assign", ASSIGN, group=2, least=6),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\r\n\x20]*-----END [A-Z ]*PRIVATE KEY-----"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("bearer", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
)

MATCH = "array<struct<gap:int,length:int,counts:boolean>>"
SPANS = "array<struct<rule_version:string,start:int,end:int>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _matches(text: Column, rule: SecretRule) -> Column:
    """Every match in order: characters since the match before, its length, whether it counts."""
    pattern = F.lit(rule.pattern)
    parts = [F.split(text, rule.pattern), F.regexp_extract_all(text, pattern, F.lit(0))]
    if rule.group:
        parts.append(F.regexp_extract_all(text, pattern, F.lit(rule.group)))
    names = ("gap", "whole", "part")[: len(parts)]
    zipped = F.arrays_zip(*(p.alias(n) for p, n in zip(parts, names)))
    fields = ",".join(f"{n}:string" for n in names)
    matched = F.filter(zipped.cast(f"array<struct<{fields}>>"), lambda m: m["whole"].isNotNull())
    return F.transform(
        matched,
        lambda m: F.struct(
            F.char_length(m["gap"]).alias("gap"),
            F.char_length(m["whole"]).alias("length"),
            (F.char_length(m[names[-1]]) >= rule.least).alias("counts")
            if rule.group
            else F.lit(True).alias("counts"),
        ),
    ).cast(MATCH)


def scan(versions: DataFrame, text: str = "text", ledger: DataFrame | None = None, rules=RULES) -> DataFrame:
    """New ledger rows for the blobs and rules that ``ledger`` lacks."""
    known = [r.version for r in rules]
    blobs = versions.select(blob_id(F.col(f"`{text}`")).alias("blob"), F.col(f"`{text}`").alias("text"))
    missing = F.array(*(F.lit(v) for v in known))
    if ledger is not None:
        seen = (
            ledger.select("blob", F.explode("rule_versions").alias("version"))
            .filter(F.col("version").isin(known))
            .groupBy("blob")
            .agg(F.collect_set("version").alias("seen"))
        )
        blobs = blobs.join(seen, "blob", "left")
        missing = F.array_except(missing, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    unseen = (
        blobs.withColumn("missing", missing)
        .filter(F.size("missing") > 0)
        .groupBy("blob")
        .agg(F.first("text").alias("text"), F.first("missing").alias("missing"))
        .withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    )
    tried = unseen.select(
        "blob",
        F.col("missing").alias("rule_versions"),
        *(
            F.when(
                F.array_contains("missing", r.version) & F.col("text").rlike(r.pattern),
                _matches(F.col("text"), r),
            ).alias(r.kind)
            for r in rules
        ),
    )
    return tried.select("blob", "rule_versions", _placed(rules).alias("spans"))


def _placed(rules) -> Column:
    """Start and end of every match that counts."""

    def of(rule: SecretRule) -> Column:
        # The fold carries where the last match ended; only matches are folded, never characters.
        def step(state: Column, m: Column) -> Column:
            start = state["at"] + m["gap"]
            end = start + m["length"]
            span = F.struct(F.lit(rule.version).alias("rule_version"), start.alias("start"), end.alias("end"))
            longer = F.array_append(state["out"], span)
            return F.struct(
                end.alias("at"), F.when(m["counts"], longer).otherwise(state["out"]).alias("out")
            )

        none = F.array().cast(SPANS)
        first = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.coalesce(F.aggregate(F.col(rule.kind), first, step, lambda s: s["out"]), none)

    return F.concat(*(of(r) for r in rules)).cast(SPANS)


def findings(
    versions: DataFrame, ledger: DataFrame, text: str = "text", into: str = "spans", rules=RULES
) -> DataFrame:
    """Every version, its text replaced by the spans that the current rules find in its blob.

    Spans are structs of kind, start and end, by start and then in the order of the rules.
    """
    current = [r.version for r in rules]
    rank = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))))
    kind = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(i), F.lit(r.kind))))
    spans = F.transform(
        F.filter("spans", lambda s: s["rule_version"].isin(current)),
        lambda s: F.struct(
            s["start"].alias("start"), F.element_at(rank, s["rule_version"]).alias("rank"), s["end"].alias("end")
        ),
    )
    by_blob = (
        ledger.filter(F.size("spans") > 0)
        .groupBy(F.col("blob").alias("_blob"))
        .agg(F.sort_array(F.flatten(F.collect_list(spans))).alias("_spans"))
    )
    named = F.transform(
        F.coalesce("_spans", F.array().cast("array<struct<start:int,rank:int,end:int>>")),
        lambda s: F.struct(
            F.element_at(kind, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
    own = versions.withColumn("_of_blob", blob_id(F.col(f"`{text}`"))).drop(text)
    return (
        own.join(by_blob, F.col("_of_blob") == F.col("_blob"), "left")
        .withColumn(into, named)
        .drop("_blob", "_of_blob", "_spans")
    )
