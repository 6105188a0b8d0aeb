import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stellate.llm import conversation_repair as c
from stellate.llm.queries import QUERIES, damaged

CONVERSATIONS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")


def broken(rows):
    """Rows of a conversation after the damage, in order; written from the rule, not from the query."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """Least (cost, audit) over all edits, by plain recursion on whole audits."""
    found = faults(rows)
    role_of = {1: "user", 2: "assistant"}

    def after(state, initial):
        return {(0, "s"): 3, (0, "u"): 1, (3, "u"): 1, (1, "a"): 2, (2, "u"): 1}.get((state, initial))

    @functools.cache
    def best(i, state, inserted):
        """(cost, audit, turns); at most four insertions in a row can help."""
        ways = []
        if i == len(rows) and state in (0, 2):
            ways.append((0, "", ()))
        if inserted < 4:
            for r in (1, 2):
                to = after(state, role_of[r][0])
                if to is not None:
                    cost, audit, made = best(i, to, inserted + 1)
                    ways.append((cost + 2, "I" + audit, ((role_of[r], ""), *made)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, made = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + audit, made))
            if found[i] not in ("blank", "duplicate"):
                late = found[i] == "truncated"
                for r, said, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    to = after(state, r[:1])
                    if to is not None:
                        cost, audit, made = best(i + 1, to, 0)
                        ways.append((cost + price + late, said + audit, ((r, text), *made)))
        return min(ways, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # from the back, so that long conversations need no deep recursion
        for state in range(4):
            best(i, state, 0)
    cost, audit, made = best(0, 0, 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in made))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def made_up(n, longest, seed):
    random.seed(seed)
    rows = []
    for conv in [*range(n), None]:
        for _ in range(random.randint(1, longest)):
            rows.append(
                (
                    conv,
                    random.choice([None, *range(longest)]),
                    random.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                    random.choice(["Yes.", "No!", "Why?", "cut of", "", " \n", None, "x. \t", f"{random.random()}."]),
                )
            )
    return rows


def compare(found, expected):
    for conv, facts in expected.items():
        assert found[conv] == facts, conv


def run(segments):
    return {r[0]: tuple(r)[1:] for r in c.summary(segments).collect()}


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append((r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
    return {k: brute(ordered(v)) for k, v in out.items()}


@pytest.mark.parametrize(("block", "fan"), [(4096, 1024), (3, 2), (1, 3)])
def test_equals_brute_force(spark, block, fan):
    rows = made_up(60, 9, 1)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    compare(run(c.repair(df, block_rows=block, fan=fan)), grouped(rows))


def test_one_conversation_over_many_tasks_and_levels(spark):
    rows = [(7, t % 150, r, x) for _, t, r, x in ((0, i, *p) for i, p in enumerate(itertools.islice(itertools.cycle(
        [("user", "a."), ("user", "b"), ("assistant", "c."), ("tool", "d!"), ("system", ""), ("assistant", None), ("user", "a.")]), 400)))]
    rows += [(8, None, "user", "same.")] * 50
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(6)
    segments = c.repair(df, block_rows=4, fan=3)
    assert segments.filter("conv = 7").count() > 27
    compare(run(segments), grouped(rows))


def test_turns_spell_the_digest(spark):
    rows = made_up(30, 8, 3)
    segments = c.repair(spark.createDataFrame(rows, CONVERSATIONS), block_rows=4, fan=2)
    said = {}
    for r in sorted(c.turns(segments).collect(), key=lambda r: (r.run or 0, r.pos, r.place)):
        said.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, facts in run(segments).items():
        assert hashlib.sha256("\n".join(said.get(conv, [])).encode()).hexdigest() == facts[-1]


def test_checkpoints_give_the_walk_of_all_vectors():
    random.seed(2)
    for n in (0, 1, 2, 3, 10, 99, 400):
        kinds = bytes(random.choice(range(10)) for _ in range(n))
        vectors = [c.END]
        for kind in reversed(kinds):
            vectors.append(c.back(vectors[-1], kind)[0])
        vectors.reverse()
        state, plain = c.START, ""
        for i, kind in enumerate(kinds):
            edits, _, state = c.step(vectors[i + 1], kind, state)
            plain += edits
        own, end = c.walk(kinds, c.END, c.START)
        assert ("".join(e for e, _ in own), end) == (plain, state)


def test_query_equals_brute_force(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    assert set(found) == {r[0] for r in given}
    for conv in found:
        assert found[conv] == brute(ordered(broken([r for r in given if r[0] == conv]))), conv


def test_damage_equals_its_rule(spark):
    rows = made_up(40, 8, 9)
    made = sorted((tuple(r) for r in damaged(spark.createDataFrame(rows, CONVERSATIONS)).collect()), key=repr)
    expected = sorted(((k, *r) for k in {x[0] for x in rows} for r in broken([x for x in rows if x[0] == k])), key=repr)
    assert made == expected


def test_awkward_rows_empty_tables_and_clashing_columns(spark):
    long = "word " * 200_000
    rows = [(1, 1, "user", long + "."), (1, 2, "assistant", long), (None, None, None, None), (2, 1, "user", "\x00é.")]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    clash = df.withColumns({"conv": F.lit("x"), "kind": F.lit(1), "h1": F.lit(2), "part": F.lit(3), "deal": F.lit(4)})
    found = run(c.repair(clash, block_bytes=100_000))
    assert found == grouped(rows) and found[1][5:7] == (1, "KK")
    for empty in (df.limit(0), clash.limit(0)):
        assert c.summary(c.repair(empty)).count() == 0 and c.turns(c.repair(empty)).count() == 0
