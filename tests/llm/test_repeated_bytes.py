import collections
import hashlib
import os
import random

import pytest

from stellate.llm import repeated_bytes as rb
from stellate.llm.suffix_order import suffix_order
from stellate.sources.staging import shared_folder, stage


@pytest.mark.parametrize("n,k", [(1, 1), (2, 1), (4, 1), (13, 1), (60, 2), (90, 3)])
def test_suffix_order_equals_sorting(spark, n, k):
    r = random.Random(n)
    s = [r.randint(1, k) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(s)), "at long, symbol long")
    found = {x.at: x["rank"] for x in suffix_order(df).collect()}
    assert found == {p: i for i, p in enumerate(sorted(range(n), key=lambda p: s[p:]), 1)}


def brute(docs):
    n = rb.LENGTH
    data = {k: (t or "").encode() for k, t in docs}
    counts = collections.Counter(b[i : i + n] for b in data.values() for i in range(len(b) - n + 1))
    out = {}
    for k, b in data.items():
        spans = rb.merge([(i, i + n) for i in range(len(b) - n + 1) if counts[b[i : i + n]] > 1])
        kept, at = b"", 0
        for a, e in spans:
            kept, at = kept + b[at:a], e
        out[k] = len(b), sum(e - a for a, e in spans), len(spans), hashlib.sha256(kept + b[at:]).hexdigest()
    return out


def test_removed_bytes_equal_brute_force(spark):
    r = random.Random(1)

    def some(n):
        return "".join(r.choice("abcdeé \n") for _ in range(n))

    passages = [some(n) for n in (399, 400, 401, 450, 700, 1500)]
    docs = []
    for i in range(40):
        t = some(r.randint(0, 900))
        for _ in range(r.randint(0, 3)):
            t += r.choice(passages)[r.choice((0, r.randint(0, 60))) :] + some(r.randint(0, 300))
        docs.append((i, t))
    docs += [(100, None), (101, ""), (102, docs[3][1]), (103, docs[3][1]), (104, "ab" * 700), (105, "ab" * 900 + "x")]
    docs += [(106, "q" * 1200), (107, "heesble, " * 200), (108, some(500) + "heesble, " * 120)]
    for k in range(110, 118):
        changed = list(docs[5][1] + passages[5])
        for _ in range(2):
            changed[r.randrange(len(changed))] = "z"
        docs.append((k, "".join(changed)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {x.doc_id: (x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256) for x in rb.without_repeats(df).collect()}
    assert found == brute(docs)


def test_awkward_and_empty(awkward):
    found = rb.without_repeats(awkward)
    assert found.count() == awkward.count()
    assert {r.n_removed for r in found.filter("doc_id IN (6, 7)").collect()} == {36 * 3000}
    assert rb.without_repeats(awkward.limit(0)).count() == 0


def test_ranges_instead_of_windows_and_nothing_left_behind(spark, monkeypatch):
    r = random.Random(5)

    def some(n):
        return "".join(r.choice("abcdefgh ") for _ in range(n))

    passages = [some(r.randint(450, 900)) for _ in range(12)]
    docs = [(i, some(r.randint(0, 300)) + passages[i % 12] + some(r.randint(0, 300))) for i in range(36)]
    rows = collections.Counter()

    def counted(df, label="table", options=None):
        out = stage(df, label, options)
        rows[label] += out.count()
        return out

    monkeypatch.setattr(rb, "stage", counted)
    folder = f"{shared_folder(spark)}/staged"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    tables = {t.name for t in spark.catalog.listTables()}
    found = rb.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {x.doc_id: (x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256) for x in found.collect()} == brute(docs)
    # Before, every single window before a phrase that the order leaves open had a row.
    repeated = sum(len(p) - rb.LENGTH + 1 for p in passages) * 3
    assert rows["windows"] == 0 and 0 < rows["window-ranges"] < repeated / 2
    assert all(x.startswith("repeat-digests") for x in set(os.listdir(folder)) - before)
    assert {t.name for t in spark.catalog.listTables()} == tables
