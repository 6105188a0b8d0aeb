import collections
import re

from pyspark.sql import functions as F

from stellate.llm import quality_rules as q


def brute(text):
    s = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", s)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in s.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in s), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark, sf_dir, documents):
    odd = [(-1, None), (-2, ""), (-3, "a b c a b c"), (-4, "é x #<\n\n \nb\nb"), (-5, "a a a a"), (-6, "x\x0by\x0cz\rw")]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    df = documents([*odd, *((r.doc_id, r.text) for r in rows)])
    for r in q.with_statistics(df).collect():
        s = r.statistics
        assert brute(r.text) == (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words), r.doc_id


def test_rules_reject_junk_and_keep_clean(spark):
    def text(i):
        junk = i % 4 == 0
        return (i, " ".join(f"w{(i * 7 + k) % 97}x{k}" + ("###" if junk else "") for k in range(80)), int(not junk))

    rows = spark.createDataFrame([text(i) for i in range(400)], "doc_id long, text string, quality int")
    statistics = q.with_statistics(rows).select("doc_id", "statistics")
    rules = q.learn(statistics, rows.select("doc_id", "quality"))
    assert rules.rules
    found = statistics.join(rows, "doc_id").groupBy("quality").agg(F.min(rules.rule(F.col("statistics")) > 0).alias("all"), F.max(rules.rule(F.col("statistics")) > 0).alias("any"))
    assert {r.quality: (r["all"], r["any"]) for r in found.collect()} == {0: (True, True), 1: (False, False)}


def test_covering_goes_on_after_a_rule_that_fails(spark):
    """The first condition with the most gain is not precise; two kinds of rejects lie behind it."""
    def row(i):
        kind = i % 10
        reject = kind in (0, 1) or (kind in (2, 3, 4) and i % 3 > 0)
        # Share of capitals says little, of symbols and of marks all.
        s = (100 + i % 89, 500 + i % 97, 200 * (kind == 0), 0, 0, 5, 150 * (kind in (0, 1, 2, 3, 4)), 180 * (kind == 1))
        return i, int(not reject), s

    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_capitals n_marks".split()
    kind = "struct<" + ",".join(f"{n}:long" for n in names) + ">"
    df = spark.createDataFrame([row(i) for i in range(3000)], f"doc_id long, quality int, statistics {kind}")
    rules = q.learn(df.select("doc_id", "statistics"), df.select("doc_id", "quality"))
    s = F.col("statistics")
    covered = df.filter(rules.rule(s) > 0)
    # Cut points are quantiles, so a part of each kind can stay below the lowest one.
    assert covered.filter("quality = 1").count() == 0 and covered.count() >= 450
    assert {r.k for r in covered.selectExpr("doc_id % 10 AS k").distinct().collect()} == {0, 1}
    assert rules.uncovered == df.filter("quality = 0").count() - covered.count()


def test_without_labels_or_documents(spark, awkward):
    statistics = q.with_statistics(awkward).select("doc_id", "statistics")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert q.learn(statistics, none).rules == ()
    assert q.learn(statistics.limit(0), none).rules == ()
    failed = {r.doc_id: r.failed for r in statistics.select("doc_id", q.base_failed(F.col("statistics")).alias("failed")).collect()}
    assert all(failed[k] for k in (1, 2, 3, 4, 5, 6, 7))


def test_statistics_keep_clashing_columns(documents):
    df = documents([(1, "a b")]).withColumn("_text", F.lit(1)).withColumn("_words", F.lit(2))
    out = q.with_statistics(df)
    assert out.columns == [*df.columns, "statistics"]
    assert out.first()["_words"] == 2


def test_filters_stay_above_the_statistics(documents):
    """A filter on the statistics must not be pushed below them: it would split the text many times."""
    s = F.col("statistics")
    kept = q.with_statistics(documents([(1, "a b c")])).filter(~q.base_failed(s) & (s["n_symbols"] < 5))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "split(" in line]
    assert plan.count("split(") <= 4


def test_long_text_is_filtered_in_linear_time(documents):
    text = " ".join(f"w{i % 9973}x{i % 7}" for i in range(60_000))
    kept = q.with_statistics(documents([(1, text)]), into="s").filter(~q.base_failed(F.col("s")))
    assert kept.count() == 1
