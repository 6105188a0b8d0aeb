"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut. Pieces are
dealt into blocks of bounded size by a hash. Each block starts from best-fit decreasing; a block
that is not yet at its lower bound, the tokens divided by the capacity, evolves on several islands.
An individual is a set of whole bins. Crossover injects well-filled bins of one parent into the
other, removes the bins that hold the same pieces, and best-fits the displaced pieces. After every
epoch each island passes its elite to the next one. Then the bins with room to spare are dissolved
and packed again over all blocks, until one block holds what is left or nothing is gained.

NULL and empty texts are one piece of the end token alone; very long texts are cut into many pieces,
nothing is dropped. Repeated rows are pieces of their own. The packing depends on lengths only, so
pieces of equal length are ties that may change places between runs. An empty table gives an empty
result. Special tokens' strings in a text are the special tokens, as the tokenizer has it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.word_tokens import load
from stellate.sources.staging import stage

CAPACITY = 4096
#: Pieces per block: what one task holds.
BLOCK = 4000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
#: Islands evolve in so many tasks at most; each holds one state at a time.
MOST_TASKS = 4096
#: Bins filled less than this share are packed again over all blocks.
WELL_FILLED = 0.98
END = 1


def token_pieces(
    documents: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 and, if asked for, the ids.

    ``tokenizer`` is the path of a tokenizer file that every worker can open.
    """
    kind = documents.select(key).schema[0].dataType.simpleString()
    names = [key, "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    end = np.array([END], "<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                rows, cuts = [], []
                for i, ids in enumerate(encoder.encode(part.column(1))):
                    ids += end
                    for n, start in enumerate(range(0, len(ids), width)):
                        rows.append(i)
                        cuts.append((n, start // 4, ids[start : start + width]))
                columns = [
                    part.column(0).take(pa.array(rows, pa.int32())),
                    pa.array([c[0] for c in cuts], pa.int32()),
                    pa.array([c[1] for c in cuts], pa.int64()),
                    pa.array([len(c[2]) // 4 for c in cuts], pa.int64()),
                    pa.array([zlib.crc32(c[2]) for c in cuts], pa.int64()),
                ]
                if keep_ids:
                    columns.append(pa.array([c[2] for c in cuts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
    return documents.select(key, text).mapInArrow(cut, schema + (", ids binary" if keep_ids else ""))


# One block: sizes are sorted downwards, a solution is a list of bins, a bin a list of positions.


def best_fit(bins: list[list[int]], loose: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Put every loose piece into the fullest bin that has room, or into a new one."""
    bins = [list(b) for b in bins]
    gaps = sorted((capacity - sum(sizes[i] for i in b), n) for n, b in enumerate(bins))
    for i in loose:
        at = bisect_left(gaps, (sizes[i], -1))
        if at == len(gaps):
            bins.append([i])
            insort(gaps, (capacity - sizes[i], len(bins) - 1))
        else:
            gap, n = gaps.pop(at)
            bins[n].append(i)
            insort(gaps, (gap - sizes[i], n))
    return bins


def _worth(bins, sizes):
    """Fewer bins first; then full and empty ones rather than half-filled ones."""
    return -len(bins), sum(sum(sizes[i] for i in b) ** 2 for b in bins)


def _cross(a, b, sizes, capacity, random: Random):
    fullest = sorted(b, key=lambda own: -sum(sizes[i] for i in own))[: max(1, len(b) // 2)]
    injected = random.sample(fullest, max(1, len(fullest) // 2))
    taken = {i for own in injected for i in own}
    untouched, displaced = [], []
    for own in a:
        if taken.isdisjoint(own):
            untouched.append(own)
        else:
            displaced += (i for i in own if i not in taken)
    return best_fit(injected + untouched, sorted(displaced), sizes, capacity)


def _mutate(bins, sizes, capacity, random: Random):
    """Dissolve the emptiest bins and a few others."""
    ranked = sorted(bins, key=lambda own: sum(sizes[i] for i in own))
    n = max(2, len(bins) // 20)
    gone = ranked[:n] + random.sample(ranked[n:], min(n, len(ranked) - n))
    dissolved = {i for own in gone for i in own}
    loose = sorted(dissolved)
    for _ in range(len(loose) // 10):
        k = random.randrange(len(loose))
        loose[k - 1], loose[k] = loose[k], loose[k - 1]
    return best_fit([own for own in bins if dissolved.isdisjoint(own)], loose, sizes, capacity)


def _evolve(population, sizes, capacity, random: Random, generations: int):
    bound = -(-sum(sizes) // capacity)
    for _ in range(generations):
        population.sort(key=lambda s: _worth(s, sizes), reverse=True)
        if len(population[0]) <= bound:
            break
        children = []
        for _ in range(len(population)):
            a, b = random.sample(population, 2)
            child = _cross(a, b, sizes, capacity, random)
            children.append(_mutate(child, sizes, capacity, random))
        ranked = sorted(population + children, key=lambda s: _worth(s, sizes), reverse=True)
        population = ranked[: len(population)]
    return population


def _labels(bins, n: int) -> bytes:
    out = np.zeros(n, np.int32)
    for k, own in enumerate(bins):
        out[own] = k
    return out.tobytes()


def _bins(labels: bytes) -> list[list[int]]:
    marks = np.frombuffer(labels, np.int32)
    bins: list[list[int]] = [[] for _ in range(int(marks.max()) + 1)] if len(marks) else []
    for i, k in enumerate(marks.tolist()):
        bins[k].append(i)
    return bins


STATE = "block long, island int, sizes binary, population array<binary>, n_bins int, filled double, done boolean"
_STATE = pa.schema(
    [
        ("block", pa.int64()), ("island", pa.int32()), ("sizes", pa.binary()), ("population", pa.list_(pa.binary())),
        ("n_bins", pa.int32()), ("filled", pa.float64()), ("done", pa.bool_()),
    ]
)


def _state(block: int, island: int, sizes: list[int], population, capacity: int) -> dict:
    best = max(population, key=lambda s: _worth(s, sizes))
    ordered = [best] + [s for s in population if s is not best]
    return {
        "block": block, "island": island, "sizes": np.array(sizes, np.int64).tobytes(),
        "population": [_labels(s, len(sizes)) for s in ordered], "n_bins": len(best),
        "filled": float(_worth(best, sizes)[1]), "done": len(best) <= -(-sum(sizes) // capacity),
    }


def _settle(capacity: int, islands: int, population: int):
    """The first populations of a block, one row per island; one row if it is at its bound."""

    def of_block(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        sizes = sorted(table.column("length").to_pylist(), reverse=True)
        first = best_fit([], list(range(len(sizes))), sizes, capacity)
        rows = [_state(block, 0, sizes, [first], capacity)]
        if not rows[0]["done"]:
            rows = []
            for island in range(islands):
                random = Random(f"{block}/{island}")
                others = [_mutate(first, sizes, capacity, random) for _ in range(population - 1)]
                rows.append(_state(block, island, sizes, [first, *others], capacity))
        return pa.Table.from_pylist(rows, schema=_STATE)

    return of_block


def _epoch(capacity: int, generations: int, number: int):
    def evolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["sizes"], np.int64).tolist()
                population = [_bins(p) for p in row["population"]]
                if row.get("migrant"):
                    population[-1] = _bins(row["migrant"])
                if not row["done"]:
                    random = Random(f"{row['block']}/{row['island']}/{number}")
                    population = _evolve(population, sizes, capacity, random, generations)
                out = _state(row["block"], row["island"], sizes, population, capacity)
                yield pa.RecordBatch.from_pylist([out], schema=_STATE)

    return evolve


def _place(capacity: int):
    """Bins and offsets of the pieces of one block, given its best solution."""

    def of_block(key, pieces: pa.Table, best: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("length", "descending")])
        marks = np.frombuffer(best.column("best")[0].as_py(), np.int32)
        lengths = pieces.column("length").to_numpy()
        order = np.argsort(marks, kind="stable")
        sums = np.cumsum(lengths[order])
        first = np.flatnonzero(np.concatenate([[True], np.diff(marks[order]) != 0]))
        before = np.repeat(sums[first] - lengths[order][first], np.diff(np.append(first, len(order))))
        offset = np.empty(len(order), np.int64)
        offset[order] = sums - lengths[order] - before
        filled = np.bincount(marks, weights=lengths)[marks] / capacity
        for name, values in (("bin", marks.astype(np.int64)), ("offset", offset), ("filled", filled)):
            pieces = pieces.append_column(name, pa.array(values))
        return pieces

    return of_block


def _pack_blocks(pieces: DataFrame, capacity: int, islands: int, epochs: int, generations: int, population: int):
    """Pieces with their block packed inside it: adds bin, offset and filled."""
    states = stage(
        pieces.select("block", "length").groupBy("block").applyInArrow(_settle(capacity, islands, population), STATE),
        "packing-islands",
    )
    settled, open_ = [states.filter("done")], states.filter("NOT done")
    for number in range(epochs):
        if open_.isEmpty():
            break
        arriving = open_.select(
            "block", ((F.col("island") + 1) % islands).alias("island"), F.get("population", F.lit(0)).alias("migrant")
        )
        if number:
            open_ = open_.join(arriving, ["block", "island"], "left")
        else:
            open_ = open_.withColumn("migrant", F.lit(None).cast("binary"))
        # A number of its own, so that small states are not folded into one task.
        tasks = min(open_.count(), MOST_TASKS)
        moved = open_.repartition(tasks, "block", "island").mapInArrow(_epoch(capacity, generations, number), STATE)
        open_ = stage(moved, "packing-epoch")
    settled.append(open_)
    best = (
        reduce(DataFrame.unionByName, settled)
        .groupBy("block")
        .agg(
            F.max_by(
                F.get("population", F.lit(0)), F.struct(-F.col("n_bins"), F.col("filled"), -F.col("island"))
            ).alias("best")
        )
    )
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    schema = ", ".join([*kinds, "bin long", "offset long", "filled double"])
    return pieces.groupBy("block").cogroup(best.groupBy("block")).applyInArrow(_place(capacity), schema)


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    block: int = BLOCK,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    generations: int = GENERATIONS,
    population: int = POPULATION,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Pieces are dealt to blocks by a number staged once, so that equal rows are spread as well. Their
    columns travel as one, so any names may occur; columns ``sequence_id`` and ``offset`` are replaced.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    place = "place"
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    rest = stage(pieces.select(row, F.col("length").cast("long").alias("length"), F.monotonically_increasing_id().alias(place)), "pieces-numbered")
    n = rest.count()
    done, level, before = [], 0, None
    while True:
        blocks = max(1, -(-n // block))
        dealt = rest.withColumn("block", F.pmod(F.xxhash64(place, F.lit(level)), F.lit(blocks)))
        packed = stage(
            _pack_blocks(dealt, capacity, islands, epochs, generations, population).withColumn(
                "sequence_id", (F.lit(level).cast("long") * (1 << 36) + F.col("block")) * (1 << 20) + F.col("bin")
            ),
            "packed",
        )
        again = packed.filter(F.col("filled") < WELL_FILLED)
        n = again.count() if blocks > 1 else 0
        if blocks == 1 or not n or (before is not None and n >= before):
            done.append(packed)
            break
        done.append(packed.filter(F.col("filled") >= WELL_FILLED))
        rest, before, level = again.select("row", "length", place), n, level + 1
    return reduce(DataFrame.unionByName, done).select(*(F.col(f"row.`{c}`") for c in names), "sequence_id", "offset")
