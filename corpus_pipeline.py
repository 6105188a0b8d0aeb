"""From raw documents to packed training sequences: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the
docs of the next one. The first four return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import decontamination, line_dedup, near_duplicates, packing, quality_rules
from stellate.llm.frames import content_key, free_name
from stellate.sources.staging import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a learned rule rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    counted = quality_rules.with_statistics(labelled).select("doc_id", "statistics")
    rules = quality_rules.learn(stage(counted, "text-statistics"), labels)
    # Texts are counted again where they are: that moves and stores none of them.
    name = free_name(docs, "_statistics")
    s = F.col(name)
    kept = ~quality_rules.base_failed(s) & (rules.rule(s) == 0)
    return quality_rules.with_statistics(docs, into=name).filter(kept).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line of the corpus equals or, from 30 characters
    on, has within one edit.

    ``n_chars`` follows the new text. A document of which no line is left goes; a document that had
    no line to lose stays as it is.
    """
    columns, key = docs.columns, free_name(docs, "_key")
    keyed = docs.withColumn(key, content_key("doc_id", "text"))
    found = line_dedup.dropped_lines(keyed, key, min_chars=1, min_edit_chars=line_dedup.EDIT_CHARS)
    dropped = stage(found, "lines-dropped")
    n_lines, n_dropped = free_name(docs, "_n_lines"), free_name(docs, "_n_dropped")
    left = line_dedup.without_lines(keyed, dropped, key, into=(n_lines, n_dropped))
    changed = F.col(n_dropped) > 0
    blank = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.filter(~(changed & blank)).withColumn("n_chars", n_chars).select(*columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group that shares 0.8 of its five-word shingles.

    Rows that share a key and hold different texts are different documents; a row without key stays
    unless its group has one with a key.
    """
    return near_duplicates.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no span of ten words with a benchmark item."""
    key = free_name(docs, "_key")
    keyed = docs.withColumn(key, content_key("doc_id", "text"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.hits(keyed, benchmark, key, "item_id")
    return decontamination.clean(keyed, found, key).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place in it."""
    return packing.pack(stage(packing.token_pieces(docs, "doc_id", "text", TOKENIZER), "token-pieces"))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# Learned rules, learned packings and edit distances over the corpus have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
