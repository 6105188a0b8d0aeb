import itertools
import random
import re
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import set_join as j
from stellate.llm import sets
from stellate.llm.queries import QUERIES

FOUR = j.Settings(shingle=4, percent=85)


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + words]) for i in range(max(len(w) - words, 0) + 1)) if w else frozenset()


def brute(pairs, s):
    """(key, n, component) of every row, from all pairs of different sets."""
    sets = [shingles(t, s.shingle) for _, t in pairs]
    different = list(set(sets) - {frozenset()})
    parent = {x: x for x in different}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(different, 2):
        if 100 * len(a & b) >= s.percent * len(a | b):
            parent[top(a)] = top(b)
    least = {}
    for (key, _), own in zip(pairs, sets):
        if own and key is not None:
            least[top(own)] = min(key, least.get(top(own), key))
    return sorted(((k, len(x), least.get(top(x)) if x else k) for (k, _), x in zip(pairs, sets)), key=repr)


def found(df, s, **more):
    return sorted((tuple(r) for r in j.linked(df, settings=s, **more).select("id", "n_shingles", "component_id").collect()), key=repr)


def edited(words, edits, rng):
    w = list(words)
    for _ in range(edits):
        at = rng.randrange(len(w))
        w[at : at + rng.choice([0, 1, 1])] = [rng.choice(["x", "y", "z"]) + str(rng.randrange(40))] * rng.choice([0, 1, 1])
    return " ".join(w)


def made_up(seed):
    """Short and long bases with copies around the threshold, and passages that many texts share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 5, 8, 10, 12, 16, 20, 25, 40, 90, 200]))]
        if rng.random() < 0.4:
            base = base + passage
        texts += [edited(base, rng.randrange(0, 2 + len(base) // 20), rng) for _ in range(18)]
    texts += ["", " \n", None, "one", "ONE", "one two", "a b c d", "A b c d"]
    rng.shuffle(texts)
    return [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(3, "quite another text under a key that is taken")]


@pytest.mark.parametrize(("light", "short"), [(None, 16), (0, 1), (0, 100), (9, 4), (24, 2)])
def test_equals_brute_force(spark, documents, light, short):
    pairs, s = made_up(1), j.Settings(shingle=4, percent=85, short=short)
    assert found(documents(pairs), s, light=light) == brute(pairs, s)


@pytest.mark.parametrize(("shingle", "percent", "short"), [(5, 80, 16), (1, 60, 3), (2, 95, 1)])
def test_other_thresholds(documents, shingle, percent, short):
    pairs, s = made_up(shingle), j.Settings(shingle=shingle, percent=percent, short=short)
    assert found(documents(pairs), s) == brute(pairs, s)


def test_sets_are_those_of_the_texts():
    rng = random.Random(4)
    texts = ["", None, " a", "a b c d e a b c d", " \n", "A", "a", "É x y z w", "x\x0by\x0cz", "a" * 5000]
    texts += [" ".join(rng.choice(["a", "b", "A", "B", "ab"]) for _ in range(rng.randrange(10))) for _ in range(400)]
    known = {}
    for text, own in zip(texts, j.shingle_sets(texts, 4)):
        assert (np.diff(own.astype(float)) > 0).all() and len(own) == len(shingles(text, 4))
        assert known.setdefault(shingles(text, 4), own.tobytes()) == own.tobytes()
    assert len(set(known.values())) == len(known)


def test_links_that_no_hub_makes(documents):
    """Members that miss their hub but not each other: what they do not share with it decides."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    pairs, at = [], 0
    for g in range(25):
        own = edited(base, 9, rng).split()
        for _ in range(4):
            pairs.append((at, edited(own, rng.randrange(3), rng)))
            at += 1
    pairs += [(at + i, edited(base, 1, rng)) for i in range(40)]
    expected = brute(pairs, FOUR)
    assert found(documents(pairs), FOUR) == expected
    assert found(documents(pairs), j.Settings(shingle=4, percent=85, short=2)) == expected
    assert 5 < len({r[2] for r in expected}) < len(pairs)


def test_no_pair_is_missed_by_the_fronts_of_differences():
    """The bound of `_differences`, over random sets near the threshold."""
    rng = np.random.default_rng(3)
    s, met = j.Settings(shingle=1, percent=80), 0
    p, q = 100 - s.percent, 100 + s.percent
    for _ in range(3000):
        hub = frozenset(range(40))

        def near(base, most):
            gone = set(rng.choice(40, rng.integers(0, most), replace=False).tolist())
            return (base - gone) | set((100 + rng.choice(30, rng.integers(0, most), replace=False)).tolist())

        x = near(hub, 8)
        y = near(x, 5)

        def linked(a, b):
            return 100 * len(a & b) >= s.percent * len(a | b)

        def front(a, first):
            both = sorted(a - hub) + sorted(hub - a)
            over = q * len(both) - p * (len(a) + len(hub))
            least = -(-over // (2 * q)) if first else (q * len(both) + p * (len(hub) - len(a))) // (2 * q) + 1
            return set(both[: max(len(both) - least + 1, 0)])

        if not linked(x, hub) and linked(x, y):
            met += 1
            assert front(x, True) & front(y, False)
    assert met > 50


def test_boundary_follows_cost():
    counts = np.full(FOUR.buckets, 10)
    # Lists of one entry are cheaper to scan than thousands of subsets are to emit.
    assert j.boundary({7: 1000}, counts, FOUR) == j.boundary({24: 1000}, counts, FOUR) == 0
    counts[0] = 10**9
    # The smallest boundary at which no heavy set can be a partner.
    assert j.boundary({20: 1000}, counts, FOUR) == 23
    assert j.boundary({7: 1000}, counts, FOUR) == 8
    assert j.boundary({}, np.zeros(FOUR.buckets), FOUR) == 0
    assert FOUR.keys(8, 8) == comb(8, 7)


def test_a_large_group_of_near_copies_makes_few_pairs(spark, documents):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    df = documents([(i, edited(base, rng.randrange(1, 4), rng)) for i in range(400)])
    rows, counts = j._sized(df, "doc_id", "text", FOUR)
    members = j._list_members(j._classes(df, "text", FOUR, counts, 0), FOUR)
    assert members.groupBy("shingle").count().agg(F.max("count")).first()[0] < 400
    assert found(df, FOUR) == brute([(r.doc_id, r.text) for r in df.collect()], FOUR)


def test_query_equals_brute_force(spark, sf_dir):
    pairs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted((tuple(r) for r in QUERIES["op11_set_join"](spark, sf_dir).collect()), key=repr)
    assert rows == brute(pairs, FOUR)


def test_awkward_rows_empty_tables_and_clashing_columns(spark, awkward):
    clash = awkward.withColumns({c: F.lit(1) for c in ("id", "n", "set1", "class", "component", "packed", "slice")})
    pairs = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(clash, FOUR) == brute(pairs, FOUR)
    for df in (awkward.limit(0), awkward.filter("text IS NULL")):
        assert found(df, FOUR) == brute([(r.doc_id, r.text) for r in df.collect()], FOUR)


def test_lists_of_a_hub_do_not_hold_all_that_lack_the_rest_of_it(documents):
    """Texts that have one passage in common with their hub, which is longer, all lack the same of it."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(12)]
    hub = passage + [f"h{i}" for i in range(120)]
    own = [passage + [f"o{g}-{i}" for i in range(100)] for g in range(20)]
    pairs = [(0, " ".join(hub))] + [(1 + i, edited(w, i % 3, rng)) for i, w in enumerate(own * 3)]
    df = documents(pairs)
    classes = df.select(F.col("doc_id").alias("class"), "text")
    texts = classes.rdd.map(lambda r: (r["class"], bytearray(sets._compressed(r["text"])))).toDF("class long, packed binary")
    around = classes.filter("class > 0").selectExpr("class", "0L AS hub", "class AS component")
    looking, entries = sets._lists_of_fronts(sets._differences(around, texts, 4, 85))
    longest = entries.groupBy("hub", "kind", "shingle").count().agg(F.max("count")).first()[0]
    assert looking.count() and longest < 30
    linked = {(a, b) for (a, x), (b, y) in itertools.combinations(pairs[1:], 2)
              if 100 * len(shingles(x, 4) & shingles(y, 4)) >= 85 * len(shingles(x, 4) | shingles(y, 4))}
    met = {tuple(r) for r in sets.across(around, texts, 4, 85).collect()}
    assert linked and linked <= met and len(met) < 200
    assert found(df, FOUR) == brute(pairs, FOUR)
