"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import (
    conversation_repair,
    decontamination,
    html_text,
    line_dedup,
    near_duplicates,
    packing,
    quality_rules,
    repeated_bytes,
    secret_ledger,
    set_join,
    token_alignment,
    token_attribution,
    training_order,
)
from stellate.llm.frames import content_key
from stellate.sources.staging import shared_folder, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Vocabulary files that every worker can open.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_LEVEL_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn the decision list from all labels and apply it to every document."""
    documents = table(spark, sf_dir, "documents")
    statistics = stage(
        quality_rules.with_statistics(documents).select("doc_id", "statistics"), "text-statistics"
    )
    rules = quality_rules.learn(statistics, table(spark, sf_dir, "labels"))
    s = F.col("statistics")
    failed, rule = quality_rules.base_failed(s), rules.rule(s)
    return statistics.select(
        "doc_id",
        *(s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"),
        (~failed & (rule == 0)).alias("kept"),
        rule.alias("rule"),
    )


def _either_case(text: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in text)


_SECRET_SQL_PATTERNS = {r.kind: r.pattern for r in secret_ledger.RULES} | {
    # RE2 folds a few non-ASCII letters into ASCII ones, so the letters are spelled out.
    "assign": "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token"))
    + "|" + _either_case("api") + "_?" + _either_case("key") + ")"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
}


def _secret_sql() -> str:
    parts = []
    for i, rule in enumerate(secret_ledger.RULES):
        pattern = "'" + _SECRET_SQL_PATTERNS[rule.kind].replace("'", "''") + "'"
        parts.append(
            f"SELECT doc_id, '{rule.kind}' AS kind, {i} AS rk, {rule.least} AS least, "
            f"string_split_regex(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}, 0) AS wholes, "
            f"regexp_extract_all(t, {pattern}, {rule.group}) AS parts FROM d"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
x AS (
  SELECT doc_id, kind, rk, least, unnest(gaps[1:len(wholes)]) AS gap, unnest(wholes) AS w,
         unnest(parts) AS p, generate_subscripts(wholes, 1) AS k
  FROM m WHERE len(wholes) > 0),
y AS (
  SELECT *, sum(length(gap) + length(w)) OVER (PARTITION BY doc_id, kind ORDER BY k) AS e FROM x),
s AS (
  SELECT doc_id, kind, rk, (e - length(w))::BIGINT AS st,
         kind || ':' || (e - length(w))::BIGINT || ':' || e::BIGINT AS said
  FROM y WHERE length(p) >= least),
g AS (
  SELECT doc_id,
         count(*) FILTER (WHERE kind = 'assign') AS n_assign,
         count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(said, ',' ORDER BY st, rk) FILTER (WHERE rk < 3) AS base,
         string_agg(said, ',' ORDER BY st, rk) AS spans
  FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


@query(_secret_sql())
def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every document as the one version of its path, with an empty ledger before."""
    versions = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = stage(secret_ledger.scan(versions), "secret-ledger")
    found = secret_ledger.findings(versions, ledger)

    def joined(spans):
        said = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(said, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


_LEAK_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(f"""
WITH d AS (SELECT doc_id, {_LEAK_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_LEAK_WORDS} AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM bi, unnest(range(1, len(w) - m + 2)) AS t(i)),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM d, (SELECT DISTINCT m FROM bw), unnest(range(1, greatest(len(w) - m + 2, 1))) AS t(i)),
h AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, g)),
hw AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, m FROM h), unnest(range(0, m)) AS t(k) GROUP BY doc_id),
hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
""")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word spans of the benchmark in every document."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", content_key("doc_id", "text").alias("key")
    )
    found = decontamination.hits(documents, table(spark, sf_dir, "benchmark"), "key", "item_id")
    items = found.groupBy("document").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"),
    )
    hit = decontamination.hit_words(found).join(items, "document")
    return (
        documents.select("doc_id", "key", decontamination.count_words(F.col("text")).alias("n_words"))
        .join(hit, F.col("key") == F.col("document"), "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


@query()
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after copies of earlier lines, and long lines within one edit of one, have gone."""
    documents = table(spark, sf_dir, "documents").withColumn("key", content_key("doc_id", "text"))
    found = line_dedup.dropped_lines(documents, "key", min_chars=1, min_edit_chars=line_dedup.EDIT_CHARS)
    dropped = stage(found, "lines-dropped")
    return line_dedup.without_lines(documents, dropped, "key").select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack the token ids of all documents into sequences of at most 4096 tokens."""
    pieces = stage(
        packing.token_pieces(table(spark, sf_dir, "documents"), "doc_id", "text", WORD_TOKENIZER), "token-pieces"
    )
    return packing.pack(pieces)


@query()
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 hundredths of their three-word shingles."""
    settings = near_duplicates.Settings(shingle=3, percent=85, bands=32, rows=6, batch=32)
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), settings=settings)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


@query()
def op6_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, from one encoding of the whole document."""
    sections = token_attribution.line_sections(F.col("text"))
    return token_attribution.section_tokens(
        table(spark, sf_dir, "documents"), "doc_id", sections, BYTE_TOKENIZER, public_tokenizers.PATTERN
    )


@query()
def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of 2048 token ids, read back from the shard that holds it."""
    ordered = training_order.training_order(
        table(spark, sf_dir, "documents"), "text", WORD_TOKENIZER, key=2024
    )
    folder = f"{shared_folder(spark)}/staged/training-shards-{uuid.uuid4().hex}"
    training_order.write_shards(ordered, folder)
    return training_order.shard_rows(spark, folder)


@query()
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.fit(pages)).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@query()
def op5_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document outside strings of 400 bytes that start more than once."""
    found = repeated_bytes.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document, with corpus-wide pair counts."""
    names = token_alignment.Tokenizers(BYTE_LEVEL_TOKENIZER, public_tokenizers.PATTERN, PIECE_TOKENIZER)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.alignments(documents, "doc_id", "text", names)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that the checksum of ``conv_id:turn`` names; NULLs count as one space."""
    space = F.lit(" ")
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    hit = F.crc32(named) % 20
    text = F.coalesce("text", space)
    changed = conversations.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        hit.alias("_hit"),
    ).filter("_hit != 0")
    return changed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("_hit") == 3, 2).otherwise(1)))).drop(
        "_hit", "_copy"
    )


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the damage."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.summary(conversation_repair.repair(damaged(conversations)))
    none = F.lit(0).cast("long")
    return (
        conversations.select("conv_id").distinct()
        .join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
        .select(
            "conv_id",
            *(F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


@query()
def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 hundredths of their four-word shingles."""
    documents = table(spark, sf_dir, "documents")
    found = set_join.linked(documents, settings=set_join.Settings(shingle=4, percent=85))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
