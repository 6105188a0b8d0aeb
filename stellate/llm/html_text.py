"""Main text of web pages: boosted trees over DOM nodes and a consistent decoding.

Every block element gets features (text and link density of its subtree, words of its attributes
and of those around it, depth, place among its siblings and what those look like) and, from
gradient-boosted trees, the probability that it holds or surrounds main text. Decoding picks the
most likely choice for the whole tree in which nothing is kept inside a dropped element.

The trees are learned from labelled pages that are composed from a bounded sample of text passages
of the pages themselves: articles of several layouts among menus, headers, side bars, notices,
adverts, forms, comments and footers. Fitting is Spark's; the fitted trees are small and travel
with the tasks, and every page is handled by itself, so nothing is shuffled.

NULL and empty pages give the empty text. Broken markup is read as far as it goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.html_tree import Page

#: Bounds of the training sample: pages that give passages, and pages composed from them.
SAMPLE_PAGES = 200
COMPOSED_PAGES = 500


@dataclass(frozen=True)
class Trees:
    """Fitted trees as flat arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: int

    def probability(self, features: np.ndarray) -> np.ndarray:
        rows = np.arange(len(features))
        margin = np.zeros(len(features))
        for root, weight in zip(self.roots, self.weights):
            node = np.full(len(features), root)
            for _ in range(self.depth):
                low = features[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            margin += weight * self.value[node]
        return 1 / (1 + np.exp(-2 * margin))


_LINE = re.compile(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)|( *)Predict: (\S+)")


def read_trees(model) -> Trees:
    """The arrays of a fitted classifier, from its printed trees."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(f: int, t: float, v: float) -> int:
        me = len(feature)
        feature.append(f), threshold.append(t), left.append(me), right.append(me), value.append(v)
        return me

    for tree in model.trees:
        lines = [m for m in map(_LINE.match, tree.toDebugString.splitlines()) if m]
        at = 0

        def grow() -> int:
            nonlocal at
            m = lines[at]
            at += 1
            if m[6] is not None:
                return add(0, 0.0, float(m[6]))
            me = add(int(m[2]), float(m[4]), 0.0)
            left[me] = grow()
            at += 1  # the Else line of the same split
            right[me] = grow()
            return me

        roots.append(grow())
    arrays = (feature, threshold, left, right, value, roots, list(model.treeWeights))
    return Trees(*(np.array(a) for a in arrays), depth=max(t.depth for t in model.trees))


def passages(pages: DataFrame, key: str, html: str) -> list[str]:
    """Text between tags of at most SAMPLE_PAGES pages, those with the smallest hashes."""
    order = F.xxhash64(key).alias("order")
    chosen = pages.filter(F.col(html).isNotNull()).select(key, order).distinct().orderBy("order", key).limit(SAMPLE_PAGES)
    # Bound: the keys of SAMPLE_PAGES pages. Pages travel only once they are chosen.
    some = (
        pages.join(F.broadcast(chosen), key)
        .groupBy(key)
        .agg(F.min(F.substring(html, 1, 20_000)).alias("html"))
    )
    found: set[str] = set()
    for row in some.collect():
        bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", "\n", row["html"])
        for part in re.split(r"<[^>]*>?|\n", bare):
            text = " ".join(part.split())
            if text:
                found.add(text[:600])
    return sorted(found) or ["Some words, and then a few more of them."]


def compose(texts: list[str], random: Random) -> str:
    """A page with ``data-label="1"`` on the blocks that hold or surround main text."""
    short = [t for t in texts if len(t) < 40] or texts
    long = [t for t in texts if len(t) >= 60] or texts
    pick = random.choice

    def attribute(words: str) -> str:
        word = pick(words.split())
        form = pick(('class="{}"', 'id="{}"', 'class="{} wide"', 'class="site-{}"', 'class="{}-box"', 'class="col {}"', "class={}"))
        return " " + form.format(word)

    def links(n: int, sep: str = " ") -> str:
        return sep.join(f'<a href="/{i}">{pick(short)}</a>' for i in range(n))

    def listed(n: int) -> str:
        return "<ul>" + "".join(f"<li>{links(1)}</li>" for _ in range(n)) + "</ul>"

    def prose(mark: str = "") -> str:
        text = pick(long if random.random() < 0.7 else short)
        if random.random() < 0.25:
            text = f"{text[:20]} {links(1)} {text[20:]}"
        if random.random() < 0.15:
            text = f"<b>{text}</b>"
        end = pick(("</p>", "</p>", "</p>", "", "<br></p>"))
        return f"<p{mark}>{text}{end}"

    def block(words: str, inner: str, tags: str = "div div section") -> str:
        tag = pick(tags.split())
        bare = tag not in ("div", "section") and random.random() < 0.5
        return f"<{tag}{'' if bare else attribute(words)}>{inner}</{tag}>"

    def menu() -> str:
        inner = listed(random.randint(2, 9)) if random.random() < 0.7 else links(random.randint(2, 8), pick((" ", " | ")))
        return block("nav menu navbar navigation breadcrumb pagination", inner, "nav nav div div ul")

    def advert() -> str:
        inner = pick((pick(texts), prose(), links(2), f"<span>{pick(short)}</span>", prose() + links(1)))
        return block("ad ads advert advertisement sponsored promo", inner, "div div div aside section")

    def notice() -> str:
        return block("cookie consent notice alert popup modal", pick((pick(texts), prose() + "<button>OK</button>")), "div div section aside")

    def form() -> str:
        fields = f"<label>{pick(short)}</label><input name=q><select><option>{pick(short)}</option></select>"
        inner = f"<form{pick(('', attribute('search login newsletter')))}>{fields}{pick((prose(), pick(short), ''))}</form>"
        return pick((inner, block("search newsletter signup subscribe", inner)))

    def side() -> str:
        inner = "".join(pick((listed(4), prose(), f"<h3>{pick(short)}</h3>", advert())) for _ in range(random.randint(1, 4)))
        return block("sidebar widget related trending rail", inner, "aside aside div div section")

    def comments() -> str:
        one = pick(("div", "li", "article", "p"))
        each = "".join(
            f"<{one} class=\"{pick(('comment', 'reply', 'comment-body', 'item'))}\">{'' if one == 'p' else f'<span>{pick(short)}</span>'}{pick(texts) if one == 'p' else prose()}</{one}>"
            for _ in range(random.randint(1, 6))
        )
        inner = f"<{pick(('h2', 'h3'))}>{pick(short)}</h3>{each}{form() if random.random() < 0.4 else ''}"
        return block("comments discussion responses replies commentlist", inner, "section section div div ol")

    def head() -> str:
        inner = pick((pick(short), links(3), f"<h1>{pick(short)}</h1>", f"<p>{pick(texts)}</p>")) + pick(("", menu()))
        return block("header masthead topbar banner", inner, "header header div")

    def foot() -> str:
        inner = pick((f"&copy; {pick(short)} &middot; {pick(texts)}", links(5), prose() + links(2), f"<p>{pick(texts)}</p>{listed(3)}"))
        return block("footer copyright legal colophon", inner, "footer footer div")

    def share() -> str:
        return block("share social tags toolbar", links(random.randint(2, 5)), "div div ul p")

    mark = ' data-label="1"'

    def main() -> str:
        inner = f"<{(h := pick(('h1', 'h1', 'h2')))}{mark}>{pick(texts)[:80]}</{h}>" if random.random() < 0.9 else ""
        for _ in range(random.randint(1, 14)):
            inner += pick(
                (prose(mark),) * 12
                + (f"<h2{mark}>{pick(short)}</h2>", f"<blockquote{mark}>{prose(mark)}</blockquote>", f"<pre{mark}>{pick(long)}</pre>")
                + (f"<ul{mark}>" + "".join(f"<li{mark}>{pick(texts)}</li>" for _ in range(3)) + "</ul>",)
                + (f"<div{mark}>{pick(texts)}</div>", f"<table{mark}><tr{mark}><td{mark}>{pick(short)}</td><td{mark}>{pick(short)}</td></tr></table>")
            )
            if random.random() < 0.05:
                inner += pick((advert, share, side, notice))()
        inner += "".join(part() for part in (share, comments, side) if random.random() < 0.12)
        tag = pick("article article article main div div section".split())
        named = attribute("content article post entry story text") if tag in ("div", "section") or random.random() < 0.3 else ""
        out = f"<{tag}{mark}{named}>{inner}</{tag}>"
        if random.random() < 0.4:
            around = pick(("main", "div", "div", "section"))
            before, after = (advert() if random.random() < 0.2 else "" for _ in range(2))
            out = f"<{around}{mark}{attribute('main content page wrapper container')}>{before}{out}{after}</{around}>"
        return out

    before = [part() for part in (head, menu, notice, advert, form, side) if random.random() < 0.4]
    after = [part() for part in (comments, side, advert, notice, form, foot) if random.random() < 0.45]
    random.shuffle(before)
    body = "".join(before) + main() + "".join(after)
    if random.random() < 0.3:
        body = f'<div{mark} class="{pick(("page", "wrapper", "container", "site"))}">{body}</div>'
    return f"<!DOCTYPE html><html{mark}><head><title>{pick(short)}</title><style>p{{}}</style></head><body{mark}>{body}</body></html>"


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", seed: int = 11) -> Trees:
    """Learn from composed pages; the same pages give the same trees."""
    spark: SparkSession = pages.sparkSession
    texts, random = passages(pages, key, html), Random(seed)
    rows = []
    for _ in range(COMPOSED_PAGES):
        page = Page(compose(texts, random), labelled=True)
        rows += ((float(y), Vectors.dense(x)) for x, y in zip(page.features()[1:], page.labels[1:]))
    frame = spark.createDataFrame(rows, ["label", "features"])
    model = GBTClassifier(maxIter=24, maxDepth=5, stepSize=0.3, seed=seed, minInstancesPerNode=5).fit(frame.coalesce(1))
    return read_trees(model)


def main_text(pages: DataFrame, trees: Trees, html: str = "html", into: str = "text") -> DataFrame:
    """The pages with their main text in place of the html."""
    others = [f for f in pages.schema if f.name != html]
    at = pages.columns.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                some = batch.slice(start, 200)
                read = [Page(x or "") for x in some.column(at).to_pylist()]
                scores = trees.probability(np.concatenate([p.features() for p in read])) if read else []
                texts, place = [], 0
                for page in read:
                    n = len(page.tags)
                    texts.append(page.text(page.decode(scores[place : place + n])))
                    place += n
                columns = [some.column(i) for i in range(some.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[f.name for f in others] + [into])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), f"`{into}` string"])
    return pages.mapInArrow(run, schema)
