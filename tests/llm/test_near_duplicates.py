import random
import re

import numpy as np
import pytest

from stellate.llm import near_duplicates as nd
from stellate.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
THREE = nd.Settings(shingle=3, percent=85, bands=32, rows=6, batch=32)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(docs, s):
    sets = {k: shingles(t, s.shingle) for k, t in docs}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= s.percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {k: (len(sets[k]), find(k)) for k in sets}


def cases(seed, changed):
    r = random.Random(seed)

    def text(n):
        return [f"w{r.randint(0, 400)}" for _ in range(n)]

    docs = []
    for _ in range(12):
        base = text(r.randint(30, 200))
        for _ in range(r.randint(1, 14)):
            own = list(base)
            for _ in range(r.randint(0, max(1, int(len(base) * changed)))):
                own[r.randrange(len(own))] = f"x{r.randint(0, 9)}"
            docs.append(" ".join(own))
    docs += ["", None, "a", "A", "a b", "a  B", "a b c", "é É", "É é", docs[0].upper()]
    order = list(range(len(docs)))
    r.shuffle(order)
    return list(zip(order, docs))


@pytest.mark.parametrize("seed,changed", [(1, 0.03), (2, 0.06)])
def test_components_equal_brute_force(spark, seed, changed):
    docs = cases(seed, changed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for s in (THREE, nd.Settings()):
        found = {r.id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(df, settings=s).collect()}
        assert found == brute(docs, s)


def test_pairs_are_given_up_by_posterior(spark):
    limits = dict(nd.least_matches(THREE))
    draws = np.random.default_rng(1)
    for n, m in limits.items():
        assert m / n < 0.85
        if m:
            similarity = draws.beta(m, n - m + 2, 400_000)  # m - 1 matches
            assert (similarity >= 0.85).mean() < 1e-4
    assert nd._tail(3, 5, 0.4) == pytest.approx((draws.beta(3, 5, 400_000) >= 0.4).mean(), abs=0.005)


def test_long_chain_of_links(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(900, 901)], "a long, b long")
    found = {r.id: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 900: 900, 901: 900}


def test_null_and_shared_keys_lose_no_text(documents):
    texts = ["x y z u v w", "p q r s t u v w", "x y z u v w", "p q r s t u v w", "m n o p q r s", None, "", "m n o p q r s"]
    keys = [5, 5, 7, None, None, None, 5, None]
    df = documents(list(zip(keys, texts)))
    found = sorted(((r.id, r.n_shingles, r.component_id) for r in nd.near_duplicates(df, settings=THREE).collect()), key=repr)
    assert found == sorted([(5, 4, 5), (7, 4, 5), (5, 6, 5), (None, 6, 5), (None, 5, None), (None, 5, None), (None, 0, None), (5, 0, 5)], key=repr)
    kept = sorted(((r.doc_id, r.text) for r in nd.one_of_each(df).collect()), key=repr)
    assert kept == sorted([(5, "x y z u v w"), (5, "p q r s t u v w"), (None, "m n o p q r s"), (None, None), (5, "")], key=repr)


def test_texts_are_written_once(documents, monkeypatch):
    from stellate.llm import sets

    labels = []
    stage = sets.stage
    monkeypatch.setattr(sets, "stage", lambda df, label="table": (labels.append(label), stage(df, label))[1])
    nd.near_duplicates(documents(cases(3, 0.08)), settings=THREE).count()
    assert labels.count("set-texts") == 1 and labels.count("set-links") >= 1


def test_clashing_columns(documents):
    df = documents(cases(4, 0.03)[:40]).selectExpr("*", "1 AS id", "2 AS text_hash", "3 AS class", "4 AS _kept", "5 AS component")
    kept = nd.one_of_each(df)
    assert kept.columns == df.columns and 0 < kept.count() < 40


def test_awkward_and_empty(awkward):
    kept = nd.one_of_each(awkward)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 4), (False, 6), (True, 0),
    ]
    assert kept.columns == awkward.columns
    assert nd.near_duplicates(awkward.limit(0)).count() == 0
