import random
import re

from stellate.llm import decontamination as d

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    out = {}
    for k, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            m = min(len(v), 10)
            windows = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
            for i in range(len(w) - m + 1 if m else 0):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found.add(item)
        if found:
            out[k] = (len(hit), tuple(sorted(found)))
    return out


def found(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    hits = d.hits(docs, items, "doc_id", "item_id")
    n = {r.document: r.n_hit for r in d.hit_words(hits).collect()}
    out = {}
    for r in hits.collect():
        out.setdefault(r.document, set()).add(r.item)
    return {k: (n[k], tuple(sorted(v))) for k, v in out.items()}


def cases():
    r = random.Random(2)
    items = [(i, " ".join(f"w{r.randint(0, 30)}" for _ in range(r.randint(1, 40)))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "?!"), (93, "Élan É"), (94, "w1 W2, w3")]
    docs = []
    for k in range(60):
        t = [f"w{r.randint(0, 30)}" for _ in range(r.randint(0, 60))]
        v = r.choice(items[:12])[1].split()
        a = r.randint(0, max(0, len(v) - 9))
        docs.append((k, " ".join(t) + "-" + ", ".join(v[a : a + r.randint(8, 12)]).upper() + " end"))
    docs += [(100, None), (101, ""), (102, "élan É"), (103, "Élan É"), (104, "Élan É w1_w2/W3")]
    return docs, items


def test_hits_equal_brute_force(spark):
    docs, items = cases()
    assert found(spark, docs, items) == brute(docs, items)


def test_hits_without_broadcast(spark, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    assert found(spark, docs, items) == brute(docs, items)


def test_awkward_and_empty(spark, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.hits(awkward, none, "doc_id", "item_id").count() == 0
    one = spark.createDataFrame([(1, "long text. Many words stand in this long text. Many")], none.schema)
    hits = d.hits(awkward, one, "doc_id", "item_id")
    assert sorted(r.document for r in hits.collect()) == [6, 7]
    assert d.clean(awkward, hits, "doc_id").count() == awkward.count() - 2
    assert d.hits(awkward.limit(0), one, "doc_id", "item_id").count() == 0
