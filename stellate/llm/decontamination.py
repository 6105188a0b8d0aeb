"""Benchmark decontamination by winnowing.

Both sides are cut into words and k-grams of words. Of every sliding window of k-grams the smallest
hash is kept, so two texts that share ``span`` consecutive words share a kept k-gram. Kept hashes
of documents meet those of the benchmark in one join; the documents that meet are cut into whole
spans, which are compared word by word, and every hit is extended over all its words.

A span is ``span`` consecutive words of an item; an item of fewer words is one span of its own
length, winnowed by that length. NULL and empty texts have no words and are never hit. Repeated
rows each get their own result. A NULL item counts as an item without words. Benchmarks of any
size work: their fingerprints are broadcast only when a count shows them to be few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.frames import ascii_lower, bind, words
from stellate.sources.staging import stage

#: Words are runs of digits, letters and non-ASCII characters; what lies between is a gap.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
WORD_GAP = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
SPAN = 10
GRAM = 5
#: Largest number of benchmark fingerprints (8 bytes each) and spans that are broadcast.
BROADCAST_ROWS = 200_000


def item_words(text: Column) -> Column:
    """Words in their own case."""
    return words(text, WORD_GAP)


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(1 + by), F.greatest(F.size(values) - by, F.lit(0)))


def _grams(word_list: Column, k: int) -> Column:
    """A hash of every k consecutive words, in order.

    Words are hashed in Unicode lower case: words that agree in A-Z lower case agree in it too, and
    the exact comparison comes later.
    """
    hashes = F.transform(word_list, lambda w: F.xxhash64(F.lower(w)))

    def zipped(h: Column) -> Column:
        full = F.greatest(F.size(h) - (k - 1), F.lit(0))
        columns = F.arrays_zip(*(_shifted(h, i).alias(f"g{i}") for i in range(k)))
        return F.transform(F.slice(columns, F.lit(1), full), lambda g: F.xxhash64(g))

    return bind(hashes, zipped)


def fingerprints(word_list: Column, span: int, gram: int) -> Column:
    """Distinct smallest gram hashes of all windows of ``span - gram + 1`` grams."""
    mins, width = _grams(word_list, gram), 1
    window = span - gram + 1
    while width < window:
        step = min(width, window - width)
        mins = bind(
            mins,
            lambda m, step=step: F.zip_with(
                F.slice(m, F.lit(1), F.greatest(F.size(m) - step, F.lit(0))),
                _shifted(m, step),
                lambda a, b: F.least(a, b),
            ),
        )
        width += step
    return F.array_distinct(mins)


def _spans(word_list: Column, span: int) -> Column:
    """Every run of ``span`` words, A-Z in lower case, with its first position."""
    n = F.size(word_list)
    none = F.array().cast("array<int>")
    starts = F.when(n >= span, F.sequence(F.lit(0), F.greatest(n - span, F.lit(0)))).otherwise(none)
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("at"),
            ascii_lower(F.array_join(F.slice(word_list, i + 1, F.lit(span)), " ")).alias("words"),
        ),
    )


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def hits(
    documents: DataFrame,
    items: DataFrame,
    document_key: str,
    item_key: str,
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """One row per document and item that share a span.

    Columns: ``document`` and ``item`` (their keys), ``span`` (its number of words), ``starts``
    (sorted first word positions of all occurrences in the document). Keys name rows with equal
    texts; rows with an equal key are taken as repeats of one row.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.col(f"`{document_key}`").alias("document"), F.col(f"`{text}`").alias("text")
    )
    bench = stage(
        items.select(
            F.col(f"`{item_key}`").alias("item"), item_words(F.col(f"`{text}`")).alias("w")
        )
        .filter(F.size("w") > 0)
        .withColumn("span", F.least(F.size("w"), F.lit(span))),
        "benchmark-words",
    )
    lengths = sorted(r["span"] for r in bench.select("span").distinct().collect())
    found = [_hits_of_length(docs, bench, n, min(gram, n)) for n in lengths]
    if not found:
        kinds = dict(docs.dtypes)["document"], dict(bench.dtypes)["item"]
        schema = "document {}, item {}, span int, starts array<int>".format(*kinds)
        return spark.createDataFrame([], schema)
    return stage(reduce(DataFrame.unionByName, found), "benchmark-hits")


def _hits_of_length(docs: DataFrame, bench: DataFrame, n: int, k: int) -> DataFrame:
    """Hits of the items whose spans have ``n`` words: one length, unless items are very short."""
    own = bench.filter(F.col("span") == n)
    prints = own.select(F.explode(fingerprints(F.col("w"), n, k)).alias("print")).distinct()
    spans = (
        own.select("item", F.explode(_spans(F.col("w"), n)).alias("s"))
        .select("item", F.col("s.words").alias("words"))
        .distinct()
    )
    listed = docs.select("document", item_words(F.col("text")).alias("w"))
    printed = listed.withColumn("prints", fingerprints(F.col("w"), n, k))
    if _few(prints) and _few(spans):
        # Words stay beside their fingerprints: nothing moves but the documents that are hit.
        prints, spans = F.broadcast(prints), F.broadcast(spans)
        suspects = (
            printed.select("document", "w", F.explode("prints").alias("print"))
            .join(prints, "print", "left_semi")
            .dropDuplicates(["document"])
        )
    else:
        keys = (
            printed.select("document", F.explode("prints").alias("print"))
            .join(prints, "print", "left_semi")
            .select("document")
            .distinct()
        )
        suspects = listed.dropDuplicates(["document"]).join(keys, "document")
    return (
        suspects.select("document", F.explode(_spans(F.col("w"), n)).alias("s"))
        .select("document", F.col("s.at").alias("at"), F.col("s.words").alias("words"))
        .join(spans, "words")
        .groupBy("document", "item")
        .agg(F.sort_array(F.collect_set("at")).alias("starts"))
        .select("document", "item", F.lit(n).alias("span"), "starts")
    )


def hit_words(found: DataFrame) -> DataFrame:
    """Number of different word positions that any span covers, per document."""
    position = F.explode(
        F.flatten(
            F.transform(F.col("starts"), lambda i: F.sequence(i, i + F.col("span") - 1))
        )
    )
    return (
        found.select("document", position.alias("position"))
        .distinct()
        .groupBy("document")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )


def clean(documents: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The documents without any hit, with their own columns."""
    return documents.join(
        found.select(F.col("document").alias(key)).distinct(), key, "left_anti"
    )
