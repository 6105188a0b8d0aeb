"""Cheapest repair of conversations into an optional system turn and pairs of user and assistant turns.

Edits: keep a turn (0), give it the role user or assistant (2), delete it (3), insert an empty turn
of either role (2); a truncated turn that stays adds 1, blank and repeated turns must go. Of the
cheapest edits the ones with the ASCII-least initials (D, I, K, R) are taken.

The grammar has four states, so what lies behind a row is a vector of four costs: the cheapest end
from each state. Square-root checkpointing: one pass backward keeps the vector of every root-th row
only; walking forward, the vectors of one stretch at a time are computed again from its checkpoint.

Rows are ranged by conversation and turn, so a conversation of any length is cut into blocks of
bounded size that stand in many tasks. A conversation that lies inside a task is repaired there. For
the others a block is first a min-plus matrix (cost from each state before it to each state after
it). The matrices are folded in groups, level by level, to the cost vector behind every block and the
state in front of it; these are the checkpoints that let all blocks be walked at once. A turn is a
repeat if an earlier block, or an earlier row of its own block, has its role and text.

Order: by turn, NULL turns first; among equal turns by role and text (its first characters, then a
hash), so that repeated rows are neighbours; any number of equal rows may share a turn. A NULL role or
text counts as one space. NULL is a conversation like others. Texts of any length stay whole; a long
one closes its block. An empty table gives an empty result. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.sources.staging import stage

#: A block of a long conversation is closed at so many rows or bytes of text.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
#: So many blocks, or groups of blocks, are folded in one step.
FAN = 1024

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or re-roled turn; the grammar allows one in every state.
_NEXT = (USER, USER, ASSISTANT, USER)
#: What remains to be paid after the last row: the missing turns of the last pair.
END = (0, 4, 2, 0)
_FAR = 1 << 40
#: Kinds of rows: role initial s, u, a or other; 4 more if truncated; then blank and repeated.
BLANK, REPEATED = 8, 9
_KEPT, _USER, _ASSISTANT, _NEW_USER, _NEW_ASSISTANT = range(5)
_PRICE = {"D": 3, "I": 2, "K": 0, "R": 2}


def _kept(state: int, initial: int) -> int | None:
    """The state after a kept turn, if the grammar allows it there."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _least(vector) -> tuple[tuple[int, ...], int]:
    low = min(vector)
    return tuple(min(x - low, _FAR) for x in vector), low


def _row_costs(after: tuple[int, ...], kind: int) -> list[int]:
    """Costs from each state in front of a row, given those behind it (insertions come before rows)."""
    late = 1 if 4 <= kind < 8 else 0
    out = []
    for q in range(4):
        ways = [3 + after[q]]
        if kind < BLANK:
            ways.append(2 + late + after[_NEXT[q]])
            to = _kept(q, kind % 4)
            if to is not None:
                ways.append(late + after[to])
        out.append(min(ways))
    for _ in range(3):
        out = [min(out[q], 2 + out[_NEXT[q]]) for q in range(4)]
    return out


@lru_cache(maxsize=None)
def back(after: tuple[int, ...], kind: int) -> tuple[tuple[int, ...], int]:
    """The vector in front of a row with least entry 0, and what was taken off. Few vectors exist."""
    return _least(_row_costs(after, kind))


@lru_cache(maxsize=None)
def step(after: tuple[int, ...], kind: int, state: int) -> tuple[str, tuple[int, ...], int]:
    """The least tight edits at one row from a state: initials, turns made, next state."""
    costs, late = _row_costs(after, kind), 1 if 4 <= kind < 8 else 0
    edits, made = "", ()
    while True:
        left, to = costs[state], _kept(state, kind % 4)
        if left == 3 + after[state]:
            return edits + "D", made, state
        if left == 2 + costs[_NEXT[state]]:
            state = _NEXT[state]
            edits, made = edits + "I", (*made, _NEW_USER if state == USER else _NEW_ASSISTANT)
        elif to is not None and left == late + after[to]:
            return edits + "K", (*made, _KEPT), to
        else:
            state = _NEXT[state]
            return edits + "R", (*made, _USER if state == USER else _ASSISTANT), state


def walk(kinds: bytes, end: tuple[int, ...], state: int) -> tuple[list[tuple[str, tuple[int, ...]]], int]:
    """Edits and turns of every row from ``state``, with ``end`` behind the rows; and the state there."""
    n = len(kinds)
    stride = isqrt(n) + 1
    marks, vector = [], end
    for i in range(n - 1, -1, -1):
        if (i + 1) % stride == 0 or i == n - 1:
            marks.append(vector)
        vector = back(vector, kinds[i])[0]
    out = []
    for low in range(0, n, stride):
        high = min(low + stride, n)
        behind = [marks.pop()]
        for i in range(high - 1, low, -1):
            behind.append(back(behind[-1], kinds[i])[0])
        for i in range(low, high):
            edits, made, state = step(behind.pop(), kinds[i], state)
            out.append((edits, made))
    return out, state


def closing(state: int) -> tuple[str, tuple[int, ...]]:
    """The turns inserted after the last row."""
    made = {SYSTEM: (_NEW_USER, _NEW_ASSISTANT), USER: (_NEW_ASSISTANT,)}.get(state, ())
    return "I" * len(made), made


def matrix(kinds: bytes) -> list[int]:
    """Costs from each state in front of the rows to each state behind them, row by row."""
    columns = []
    for to in range(4):
        vector, paid = tuple(0 if q == to else _FAR for q in range(4)), 0
        for kind in reversed(kinds):
            vector, more = back(vector, kind)
            paid += more
        columns.append([min(x + paid, _FAR) for x in vector])
    return [columns[to][q] for q in range(4) for to in range(4)]


# --- rows of a task ------------------------------------------------------------------------------

_TURNS = "conv {kind}, part int, no long, open boolean"
_FACTS = "n long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _schema(kind: str) -> str:
    return (
        _TURNS.format(kind=kind) + f", {_FACTS}, edits string, roles array<string>, texts array<string>, "
        "turns array<long>, kinds binary, hashes binary"
    )


def _changes(column) -> np.ndarray:
    """Whether each value differs from the one before it; the first one does."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a, b = column.slice(0, max(len(column) - 1, 0)), column.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[True], ~same.to_numpy(zero_copy_only=False)])[: len(column)]


def _repeats(run: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Rows whose run has an earlier row with both hashes."""
    order = np.lexsort((h2, h1, run))
    same = np.ones(max(len(order) - 1, 0), bool)
    for x in (run, h1, h2):
        same &= x[order][1:] == x[order][:-1]
    out = np.zeros(len(run), bool)
    out[order[1:][same]] = True
    return out


def _made(ops, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Roles and texts of the turns that (row, code) pairs describe."""
    rows, codes = np.array([r for r, _ in ops], np.int64), np.array([c for _, c in ops], np.int64)
    place = pa.array(rows)
    new = pa.array(codes >= _NEW_USER)
    named = pa.array(["", "user", "assistant", "user", "assistant"]).take(pa.array(codes))
    blank = pa.array([""] * len(ops), pa.string())
    return (
        pc.if_else(pa.array(codes == _KEPT), roles.take(place), named),
        pc.if_else(new, blank, texts.take(place)),
    )


def _lists(values: pa.Array, sizes) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _repaired(table: pa.Table, run: np.ndarray) -> dict[str, pa.Array]:
    """Whole conversations (numbered by ``run``) as one row each."""
    column = {c: table.column(c).combine_chunks() for c in ("turn", "role", "text", "kind", "h1", "h2")}
    kinds = column["kind"].to_numpy().astype(np.uint8)
    repeated = _repeats(run, column["h1"].to_numpy(), column["h2"].to_numpy()) & (kinds < BLANK)
    kinds[repeated] = REPEATED
    initials = pc.utf8_slice_codeunits(column["role"], 0, 1).to_pylist()
    turn = pc.fill_null(column["turn"], 0).to_numpy()
    known = pc.is_valid(column["turn"]).to_numpy(zero_copy_only=False)
    n_runs = int(run[-1]) + 1
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    inner = run[1:] == run[:-1]

    def per_run(mask: np.ndarray, at: np.ndarray = run) -> np.ndarray:
        return np.bincount(at[mask], minlength=n_runs).astype(np.int64)

    new_turn = known.copy()
    new_turn[1:] &= ~(inner & known[:-1] & (turn[1:] == turn[:-1]))
    n_turns, n_known = per_run(new_turn), per_run(known)
    last = np.append(first[1:], len(run)) - 1
    # NULL turns come first, so known ones end the run.
    lowest = turn[np.minimum(last - n_known + 1, last)]
    gaps = np.where(n_known > 0, turn[last] - lowest + 1 - n_turns, 0)
    legal = np.array([a + b in ("su", "ua", "au") for a, b in zip(initials, initials[1:])], bool)

    ops, sizes, edits, costs = [], [], [], []
    raw = kinds.tobytes()
    for low, high in zip(first.tolist(), [*first[1:].tolist(), len(run)]):
        own, state = walk(raw[low:high], END, START)
        tail, more = closing(state)
        said, before = "".join(e for e, _ in own) + tail, len(ops)
        ops += [(i, c) for i, (_, made) in enumerate(own, low) for c in made]
        ops += [(low, c) for c in more]
        sizes.append(len(ops) - before)
        edits.append(said)
        costs.append(_cost(own, raw[low:high], tail))
    roles, texts = _made(ops, column["role"], column["text"])
    return {
        "n": pa.array(per_run(np.ones(len(run), bool))), "gaps": pa.array(gaps.astype(np.int64)),
        "blank": pa.array(per_run(kinds == BLANK)), "duplicate": pa.array(per_run(kinds == REPEATED)),
        "truncated": pa.array(per_run((kinds >= 4) & (kinds < BLANK))),
        "illegal": pa.array(per_run(inner & ~legal, run[1:])), "cost": pa.array(costs, pa.int64()),
        "edits": pa.array(edits), "roles": _lists(roles, sizes), "texts": _lists(texts, sizes),
    }


def _cost(own, kinds: bytes, tail: str) -> int:
    paid = 2 * len(tail)
    for (edits, _), kind in zip(own, kinds):
        paid += sum(_PRICE[e] for e in edits) + (4 <= kind < BLANK and edits[-1] != "D")
    return paid


def _pack(batches: Iterator[pa.RecordBatch], rows: int, size: int, target: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Repaired conversations of a task, and blocks of those that may go on in another task."""
    part = TaskContext.get().partitionId()
    state = {"no": 0, "open": True, "key": None}
    held: pa.Table | None = None

    def emit(fields: dict, keys: pa.Array, is_open: bool) -> pa.RecordBatch:
        n = len(keys)
        fields |= {"conv": keys, "part": pa.array([part] * n, pa.int32()), "open": pa.array([is_open] * n)}
        fields["no"] = pa.array(range(state["no"], state["no"] + n), pa.int64())
        if is_open:
            state["no"] += n
        return pa.RecordBatch.from_arrays([fields.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in target], schema=target)

    def blocks(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(table), rows):
            own = table.slice(low, rows)
            c = {x: own.column(x).combine_chunks() for x in own.column_names}
            hashes = np.concatenate([c["h1"].to_numpy(), c["h2"].to_numpy()]).tobytes()
            yield emit(
                {
                    "roles": _lists(c["role"], [len(own)]), "texts": _lists(c["text"], [len(own)]),
                    "turns": _lists(c["turn"], [len(own)]), "hashes": pa.array([hashes], pa.binary()),
                    "kinds": pa.array([c["kind"].to_numpy().astype(np.uint8).tobytes()], pa.binary()),
                    "n": pa.array([len(own)], pa.int64()),
                },
                c["conv"].slice(0, 1), True,
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if state["key"] is not None:
            # The conversation that was cut before this row may have ended there.
            state["open"] = table.column("conv")[0].as_py() == state["key"][0]
            state["key"] = None
        starts = np.flatnonzero(_changes(table.column("conv")))
        last = int(starts[-1])
        if last:
            whole = 0
            if state["open"]:
                whole = int(starts[1])
                yield from blocks(table.slice(0, whole))
            state["open"] = False
            if whole < last:
                own = table.slice(whole, last - whole)
                run = np.cumsum(_changes(own.column("conv"))) - 1
                keys = own.column("conv").combine_chunks().take(pa.array(np.flatnonzero(np.diff(run, prepend=-1))))
                yield emit(_repaired(own, run), keys, False)
        held = table.slice(last)
        if len(held) >= rows or held.nbytes >= size:
            yield from blocks(held)
            state["open"], state["key"], held = True, (held.column("conv")[0].as_py(),), None
    if held is not None:
        yield from blocks(held)


# --- conversations over several tasks ---------------------------------------------------------------


def _folded(values: np.ndarray) -> np.ndarray:
    """Min-plus product of matrices (n, 4, 4)."""
    out = values[0]
    for m in values[1:]:
        out = np.minimum((out[:, :, None] + m[None]).min(axis=1), _FAR)
    return out


def _carried(items: DataFrame, first: list[int], fan: int) -> DataFrame:
    """The vector in front of every item (run, pos, m): ``first`` times the matrices before it.

    Items of a run have the places 0, 1, 2 ... Groups of ``fan`` items are folded to one, and so on
    until every run is one group; then the vectors come down again.
    """
    keyed = items.withColumn("group", F.floor(F.col("pos") / fan).cast("long"))
    schema = "run long, pos long, v array<long>"

    def down(frame: pd.DataFrame, vector) -> pd.DataFrame:
        frame = frame.sort_values("pos")
        out = []
        for m in frame["m"]:
            out.append(list(map(int, vector)))
            vector = np.minimum((np.asarray(vector)[:, None] + np.reshape(m, (4, 4))).min(axis=0), _FAR)
        return pd.DataFrame({"run": frame["run"], "pos": frame["pos"], "v": out})

    if keyed.agg(F.max("group")).first()[0] in (None, 0):
        return keyed.groupBy("run", "group").applyInPandas(lambda f: down(f, first), schema)

    def up(frame: pd.DataFrame) -> pd.DataFrame:
        values = np.stack([np.reshape(m, (4, 4)) for m in frame.sort_values("pos")["m"]])
        row = {"run": frame["run"].iloc[:1], "pos": frame["group"].iloc[:1], "m": [_folded(values).ravel().tolist()]}
        return pd.DataFrame(row)

    folded = stage(keyed.groupBy("run", "group").applyInPandas(up, "run long, pos long, m array<long>"), "repair-fold")
    above = _carried(folded, first, fan).withColumnRenamed("pos", "group")
    both = keyed.groupBy("run", "group").cogroup(above.groupBy("run", "group"))
    return both.applyInPandas(lambda f, v: down(f, v["v"].iloc[0]), schema)


def _numbered(blocks: DataFrame) -> DataFrame:
    """Open blocks in order: seq over all, pos and last within their conversation, run (its first seq)."""
    totals = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    # One row for each partition that holds open blocks.
    placed = blocks.select("conv", "part", "no").join(F.broadcast(offsets), "part").withColumn("seq", F.col("offset") + F.col("no"))
    runs = placed.groupBy("conv").agg(F.min("seq").alias("run"), F.max("seq").alias("end"))
    whole = placed.join(runs.withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")))
    found = whole.select("part", "no", "seq", "run", (F.col("seq") - F.col("run")).alias("pos"), (F.col("seq") == F.col("end")).alias("last"))
    return stage(found, "repair-blocks")


def _seen(blocks: DataFrame) -> DataFrame:
    """Per block (seq): hashes of role and text that an earlier block of its conversation has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.unique(np.frombuffer(packed, np.int64).reshape(2, -1), axis=1)
                columns = [np.full(own.shape[1], seq, np.int64), own[0], own[1]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["seq", "h1", "h2"])

    # The hashes hold the conversation too, so no other conversation has them.
    each = stage(blocks.select("seq", "hashes").mapInArrow(run, "seq long, h1 long, h2 long"), "repair-hashes")
    first = each.groupBy("h1", "h2").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    again = each.join(first, ["h1", "h2"]).filter("seq > first")
    return again.groupBy("seq").agg(F.collect_list("h1").alias("s1"), F.collect_list("h2").alias("s2"))


_BLOCK_FACTS = (
    "seq long, run long, pos long, last boolean, kinds binary, m array<long>, n long, blank long, duplicate long, truncated long, "
    "illegal long, n_turns long, low long, high long, head string, tail string, first_turn long"
)


def _block_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _BLOCK_FACTS.split(", ")]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            kinds = np.frombuffer(r["kinds"], np.uint8).copy()
            h1, h2 = np.frombuffer(r["hashes"], np.int64).reshape(2, -1)
            repeated = _repeats(np.zeros(len(kinds), np.int8), h1, h2)
            seen = set(zip(r["s1"] or (), r["s2"] or ()))
            if seen:
                repeated |= np.fromiter((x in seen for x in zip(h1.tolist(), h2.tolist())), bool, len(h1))
            kinds[repeated & (kinds < BLANK)] = REPEATED
            turns = [t for t in r["turns"] if t is not None]
            initials = [x[:1] for x in r["roles"]]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
            rows.append(
                (
                    r["seq"], r["run"], r["pos"], r["last"], kinds.tobytes(), matrix(kinds.tobytes()), len(kinds),
                    int((kinds == BLANK).sum()), int((kinds == REPEATED).sum()), int(((kinds >= 4) & (kinds < BLANK)).sum()),
                    illegal, len(set(turns)), min(turns, default=None), max(turns, default=None), initials[0], initials[-1], r["turns"][0],
                )
            )
        if rows:
            kinds_of = [pa.int64()] * 3 + [pa.bool_(), pa.binary(), pa.list_(pa.int64())] + [pa.int64()] * 8 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds_of)], names=names)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every block, a matrix of 0 where the walk from a state ends, given the costs behind it."""
    for batch in batches:
        kinds, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        found = []
        for k, v in zip(kinds, ends):
            to = [walk(k, _least(v)[0], q)[1] for q in range(4)]
            found.append([0 if to[q] == x else _FAR for q in range(4) for x in range(4)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["run", "pos", "m"])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of blocks whose end costs and first state are known."""
    names = ["seq", "cost", "edits", "roles", "texts"]
    for batch in batches:
        column = {c: batch.column(c) for c in batch.schema.names}
        for i in range(batch.num_rows):
            kinds, end = column["kinds"][i].as_py(), _least(column["behind"][i].as_py())[0]
            state = int(np.argmin(column["front"][i].as_py()))
            own, state = walk(kinds, end, state)
            tail, more = closing(state) if column["last"][i].as_py() else ("", ())
            ops = [(k, c) for k, (_, made) in enumerate(own) for c in made] + [(0, c) for c in more]
            roles, texts = _made(ops, column["roles"].slice(i, 1).flatten(), column["texts"].slice(i, 1).flatten())
            edits = "".join(e for e, _ in own) + tail
            row = [
                column["seq"].slice(i, 1), pa.array([_cost(own, kinds, tail)], pa.int64()), pa.array([edits]),
                _lists(roles, [len(ops)]), _lists(texts, [len(ops)]),
            ]
            yield pa.RecordBatch.from_arrays(row, names=names)


def _open_segments(blocks: DataFrame, fan: int) -> DataFrame:
    """Repaired blocks of conversations that may stand in several tasks."""
    places = _numbered(blocks)
    named = blocks.join(places, ["part", "no"])
    narrow = named.select("seq", "run", "pos", "last", "kinds", "hashes", "turns", "roles")
    given = narrow.join(_seen(narrow), "seq", "left")
    facts = stage(given.mapInArrow(_block_facts, _BLOCK_FACTS), "repair-facts")
    # Backward: the transposed matrices in opposite order, from the costs behind the last row.
    ends = facts.filter("last").select("run", F.col("pos").alias("end"))
    turned = facts.join(ends, "run").select(
        "run",
        (F.col("end") - F.col("pos")).alias("pos"),
        F.array(*(F.col("m")[4 * (i % 4) + i // 4] for i in range(16))).alias("m"),
        F.col("end"),
    )
    behind = _carried(stage(turned.select("run", "pos", "m"), "repair-turned"), list(END), fan)
    behind = behind.join(ends, "run").select("run", (F.col("end") - F.col("pos")).alias("pos"), F.col("v").alias("behind"))
    known = stage(facts.select("run", "pos", "seq", "last", "kinds").join(behind, ["run", "pos"]), "repair-behind")
    exits = stage(known.select("run", "pos", "kinds", "behind").mapInArrow(_exits, "run long, pos long, m array<long>"), "repair-exits")
    front = _carried(exits, [0 if q == START else _FAR for q in range(4)], fan).withColumnRenamed("v", "front")
    ready = known.join(front, ["run", "pos"]).select("seq", "last", "kinds", "behind", "front")
    texts = named.select("seq", "roles", "texts").join(ready, "seq")
    made = texts.mapInArrow(_walked, "seq long, cost long, edits string, roles array<string>, texts array<string>")
    # Neighbouring blocks: turns that go on, and roles that meet.
    after = facts.select("run", (F.col("pos") + 1).alias("pos"), F.col("tail").alias("_tail"), F.col("high").alias("_high"))
    met = facts.drop("kinds", "m").join(after, ["run", "pos"], "left")
    meets = F.concat("_tail", "head")
    own = met.select(
        "seq", "run", "pos", "n", "blank", "duplicate", "truncated", "low", "high",
        (F.col("illegal") + F.when(~meets.isin("su", "ua", "au"), 1).otherwise(0)).alias("illegal"),
        (F.col("n_turns") - F.when(F.col("_high") == F.col("first_turn"), 1).otherwise(0)).alias("n_turns"),
    )
    keys = blocks.join(places, ["part", "no"]).select("seq", "conv")
    return keys.join(own, "seq").join(stage(made, "repair-made"), "seq")


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES, fan: int = FAN,
) -> DataFrame:
    """Repaired conversations in segments: conv, run, pos, facts, edits, roles, texts.

    A segment is a whole conversation or one block of a long one; ``pos`` orders the segments of a
    run (``run`` is NULL for whole conversations). ``roles`` and ``texts`` are its repaired turns,
    ``edits`` the initials of its edits. ``low``, ``high`` and ``n_turns`` (known turns) add up to
    gaps, see ``summary``.
    """

    def c(name: str) -> Column:
        return F.col(f"`{name}`")

    space = F.lit(" ")
    plain = rows.select(
        c(conv).alias("conv"), c(turn).cast("long").alias("turn"),
        F.coalesce(c(role), space).alias("role"), F.coalesce(c(text), space).alias("text"),
    )
    mark = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    kind = F.when(mark == "", F.lit(BLANK)).otherwise(letter + F.when(mark.isin(".", "!", "?"), 0).otherwise(4))
    given = plain.withColumns(
        {
            "kind": kind.cast("int"),
            "h1": F.xxhash64("conv", "role", "text"),
            "h2": F.xxhash64(F.lit("again"), "text", F.col("role"), "conv"),
            # Rows that repeat each other are alike; this deals any number of them to several tasks.
            "deal": F.monotonically_increasing_id(),
        }
    )
    order = ["conv", F.asc_nulls_first("turn"), "role", F.substring("text", 1, 64), F.col("h1")]
    ranged = given.repartitionByRange(*order, "deal").sortWithinPartitions(*order)
    kind_of = rows.select(c(conv).alias("conv")).schema["conv"].dataType.simpleString()
    schema = _schema(kind_of)
    spark = rows.sparkSession
    target = _arrow_schema(spark, schema)
    packed = stage(
        ranged.drop("deal").mapInArrow(lambda batches: _pack(batches, block_rows, block_bytes, target), schema), "repaired"
    )
    null = F.lit(None).cast("long")
    columns = ["n", "gaps", "n_turns", "low", "high", "blank", "duplicate", "truncated", "illegal", "cost", "edits", "roles", "texts"]
    whole = packed.filter("NOT open").withColumns({"run": null, "pos": F.lit(0).cast("long"), "n_turns": null, "low": null, "high": null})
    cut = _open_segments(packed.filter("open"), fan).withColumn("gaps", null)
    return whole.select("conv", "run", "pos", *columns).unionByName(cut.select("conv", "run", "pos", *columns))


def _arrow_schema(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def turns(segments: DataFrame) -> DataFrame:
    """Repaired turns as rows: conv, run, pos, place (in the segment), role, text."""
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")
    found = segments.select("conv", "run", "pos", both)
    return found.select("conv", "run", "pos", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each run, which come in order and are not held."""
    run, digest, empty = None, None, True

    def done():
        return pa.RecordBatch.from_arrays([pa.array([run], pa.int64()), pa.array([digest.hexdigest()])], names=["run", "sha256"])

    for batch in batches:
        for own, said in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != run:
                if run is not None:
                    yield done()
                run, digest, empty = own, hashlib.sha256(), True
            if said is not None:
                digest.update((said if empty else "\n" + said).encode())
                empty = False
    if run is not None:
        yield done()


def summary(segments: DataFrame) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256.

    ``sha256`` is the digest of all repaired turns as ``role:text``, joined by line ends. A digest is
    one chain by definition: a long conversation's segments pass one task in order, each dropped once
    it is hashed.
    """
    said = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = segments.filter("run IS NULL").select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.col("edits").alias("audit"), F.sha2(said, 256).alias("sha256")
    )
    cut = segments.filter("run IS NOT NULL")
    chunks = cut.select("run", "pos", F.when(F.size("roles") > 0, said).alias("said"))
    hashed = chunks.repartition("run").sortWithinPartitions("run", "pos").mapInArrow(_digests, "run long, sha256 string")
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("n_turns"), F.lit(0))
    facts = cut.groupBy("run").agg(
        F.first("conv").alias("conv"), gaps.alias("gaps"),
        *(F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "edits"))), lambda x: x["edits"]), "").alias("audit"),
    )
    return whole.unionByName(facts.join(hashed, "run").select(*whole.columns))
