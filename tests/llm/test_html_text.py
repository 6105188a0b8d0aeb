from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import html_text as ht
from stellate.llm.html_tree import Page


@pytest.fixture(scope="module")
def trees(spark, sf_dir):
    return ht.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return ht.passages(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "html")


def test_trees_equal_spark(spark, texts):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    page = [Page(ht.compose(texts, Random(i)), labelled=True) for i in range(20)]
    x, y = np.concatenate([p.features() for p in page]), [v for p in page for v in p.labels]
    df = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "features"])
    model = GBTClassifier(maxIter=3, maxDepth=3, seed=1).fit(df)
    expected = [r.probability[1] for r in model.transform(df).collect()]
    assert np.allclose(ht.read_trees(model).probability(x), expected)


def test_held_out_pages(trees, texts):
    right = total = exact = 0
    for i in range(200):
        page = Page(ht.compose(texts, Random(f"held out {i}")), labelled=True)
        kept = page.decode(trees.probability(page.features()))
        truth = np.array(page.labels, bool)
        truth[0] = True
        right, total = right + (kept == truth).sum(), total + len(truth)
        exact += page.text(kept) == page.text(truth)
    assert right / total > 0.97 and exact > 160


def test_decoding_is_consistent():
    r = np.random.default_rng(3)
    page = Page("<div><p>a<ul><li>b<li>c</ul></div><table><tr><td>d<td>e</table>")
    n = len(page.tags)
    for _ in range(50):
        p = r.random(n)
        kept = page.decode(p)
        assert all(kept[page.parents[i]] or not kept[i] for i in range(1, n))
        best = max(
            (k for k in np.ndindex(*(2,) * (n - 1)) if all(page.parents[i + 1] == 0 or k[page.parents[i + 1] - 1] or not k[i] for i in range(n - 1))),
            key=lambda k: sum(np.log(p[i + 1] if k[i] else 1 - p[i + 1]) for i in range(n - 1)),
        )
        assert kept[1:].tolist() == [bool(k) for k in best]


@pytest.mark.parametrize(
    "html,text",
    [
        ("", ""), ("<", "<"), ("a < b", "a < b"), ("<p>a<b>b</b>c<br>d", "abc d"), ("<p>x&amp;&nbsp;&lt;p&gt;", "x& <p>"),
        ("<script>var t='</p>';</script>z", "z"), ("<style>p{}</style><!-- <p>no --><p>y", "y"), ("<!-- open", ""),
        ("<p title='a>b'>c</p></div></p>d", "c d"), ("<script>never closed", ""), ("<h1>a</h2>b", "a b"), ("<a href=x>u</a>v", "uv"),
    ],
)
def test_markup(html, text):
    page = Page(html)
    assert page.text(np.ones(len(page.tags), bool)) == text


def test_pages_of_the_table(spark, sf_dir, trees):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for r in ht.main_text(pages.withColumn("raw", F.col("html")), trees).collect():
        body = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", r.raw, re.S)[1])
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", body)).split())


def test_awkward_and_empty(spark, trees):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, "u", None, 1), (2, None, "", 2), (2, None, "", 2), (None, "u", "<p>" * 500 + "\u0000", 3), (5, "u", deep, 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").withColumnRenamed("text", "note")
    out = ht.main_text(df, trees)
    assert out.columns == ["page_id", "url", "note", "text"]
    assert {r.note: r.text for r in out.collect() if r.note < 3} == {1: "", 2: ""}
    assert out.limit(0).count() == 0 and ht.main_text(df.limit(0), trees).count() == 0
