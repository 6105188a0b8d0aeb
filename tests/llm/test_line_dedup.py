import random

import pytest

from stellate.llm import line_dedup as ld
from stellate.llm.queries import op8_line_dedup


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(rows, same):
    seen, out = [], set()
    for k, text in rows:
        for i, line in enumerate([] if text is None else text.split("\n")):
            if line.strip(" \t\n\r\x0b\x0c"):
                if any(same(line, x) for x in seen):
                    out.add((k, i))
                seen.append(line)
    return out


def cases(seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abé ") for _ in range(r.randint(1, 90))) for _ in range(25)]

    def edit(s):
        i, k = r.randint(0, len(s)), r.random()
        return s[:i] + (r.choice("abx") if k < 0.7 else "") + s[i + (k > 0.3) :]

    rows = []
    for k in range(100):
        lines = []
        for _ in range(r.randint(0, 4)):
            s = r.choice(base)
            for _ in range(r.randint(0, 3)):
                s = edit(s)
            lines.append(s)
        rows.append((k, None if k == 7 else "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_dropped_lines_equal_brute_force(spark, seed):
    rows = cases(seed)
    df = spark.createDataFrame(rows, "k long, text string")
    got = {(r.document, r.line) for r in ld.dropped_lines(df, "k", min_chars=1).collect()}
    assert got == brute(rows, within_one)


def test_equal_lines_only(spark):
    rows = cases(3)
    df = spark.createDataFrame(rows, "k long, text string")
    got = {(r.document, r.line) for r in ld.dropped_lines(df, "k", min_chars=1, max_edits=0).collect()}
    assert got == brute(rows, str.__eq__)


def test_texts_are_rebuilt(spark):
    rows = [(1, "first line\nsecond line"), (2, "second line\nthird one"), (3, "first line"), (4, None), (5, ""), (6, "\n\n")]
    df = spark.createDataFrame(rows, "k long, text string")
    out = ld.without_lines(df, ld.dropped_lines(df, "k", min_chars=5), "k")
    assert {r.k: (r.text, r.n_lines, r.n_dropped) for r in out.collect()} == {
        1: ("first line\nsecond line", 2, 0), 2: ("third one", 2, 1), 3: ("", 1, 1), 4: (None, 0, 0), 5: ("", 1, 0), 6: ("\n\n", 3, 0),
    }


def test_awkward_and_empty(awkward):
    dropped = ld.dropped_lines(awkward, "doc_id")
    assert [(r.document, r.line, r.of_document) for r in dropped.collect()] == [(7, 0, 6)]
    assert ld.dropped_lines(awkward.limit(0), "doc_id").count() == 0


def test_copies_of_short_lines_go_too(spark):
    """The floor holds for the one-edit comparison only."""
    rows = cases(4) + [(200, "Les.\n \nLe."), (201, "Les.\n \n7"), (202, "7")]
    df = spark.createDataFrame(rows, "k long, text string")
    found = ld.dropped_lines(df, "k", min_chars=1, min_edit_chars=30)

    def same(a, b):
        return a == b or (min(len(a), len(b)) >= 30 and within_one(a, b))

    assert {(r.document, r.line) for r in found.collect()} == brute(rows, same)


def test_query_drops_copies_of_short_lines(spark, tmp_path):
    rows = [(1, "Les.\nfirst"), (2, "Les.\n\nLe."), (3, "7\nfirst"), (4, "8"), (5, "7")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: (r.n_lines, r.n_dropped) for r in op8_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {1: (2, 0), 2: (3, 1), 3: (2, 1), 4: (1, 0), 5: (1, 1)}
