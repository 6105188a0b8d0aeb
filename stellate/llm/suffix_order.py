"""Distributed suffix order by difference cover.

Of a string with places 0 .. n - 1, the suffixes at places that are no multiple of three are sorted
by their first three symbols; equal triples get equal names, and the string of names, first those
of places 1, 4, 7 ..., then those of places 2, 5, 8 ..., is ordered the same way. The remaining
suffixes are then merged in: a suffix at a multiple of three is compared with those of the one kind
by one symbol and a known rank, with those of the other kind by two symbols and a known rank. Both
comparisons are plain sorts, so counting positions in two sorted unions gives the place of each
remaining suffix among the sorted ones. Every step is a range sort, a join or an aggregate; there
is no window or group over the whole string. A written table goes when the next one stands, so that the
disk holds the triples of each level and the tables of one step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.operators.keys import surrogate_key
from stellate.sources.staging import PACKED, stage, unstage

#: Stands for the symbol or rank behind the end of the string: before all others.
BEHIND = -(1 << 63)


def _around(rows: DataFrame, value: str, distances: tuple[int, ...], names: tuple[str, ...]) -> DataFrame:
    """For every place, the values at the given distances after it."""
    sent = F.explode(
        F.array(
            *(
                F.struct((F.col("at") - d).alias("at"), F.lit(i).alias("slot"), F.col(value).alias("value"))
                for i, d in enumerate(distances)
            )
        )
    )
    return (
        rows.select(sent.alias("x"))
        .filter("x.at >= 0")
        .groupBy("x.at")
        .agg(*(F.max(F.when(F.col("x.slot") == i, F.col("x.value"))).alias(n) for i, n in enumerate(names)))
    )


def _or_behind(*names: str) -> dict[str, Column]:
    return {n: F.coalesce(n, F.lit(BEHIND)) for n in names}


def suffix_order(string: DataFrame, levels: int | None = None) -> DataFrame:
    """``at`` and ``rank`` (from 1) of every suffix of a string of rows (at, symbol).

    Symbols are whole numbers above the smallest one. With ``levels``, suffixes that agree in
    3 ** levels symbols may come in any order.
    """
    n = string.agg(F.max("at")).first()[0]
    n = 0 if n is None else n + 1
    if levels == 0 or n < 3:
        if n < 3 and levels != 0:
            tail = _around(string, "symbol", (0, 1, 2), ("s0", "s1", "s2")).withColumns(_or_behind("s1", "s2"))
            return surrogate_key(tail, "rank", ["s0", "s1", "s2"], bounded=True).select("at", "rank")
        order = surrogate_key(string.select("at", "symbol"), "rank", ["symbol", "at"])
        ranked = order.select("at", "rank")
        ranked.staged_at = order.staged_at
        return ranked
    triples = _around(string, "symbol", (0, 1, 2), ("s0", "s1", "s2"))
    extra = n % 3 == 1  # keeps the last suffix of the first kind from running into the second
    if extra:
        end = string.sparkSession.range(n, n + 1).select(
            F.col("id").alias("at"), *(F.lit(None).cast("long").alias(c) for c in ("s0", "s1", "s2"))
        )
        triples = triples.unionByName(end)
    triples = stage(triples.withColumns(_or_behind("s0", "s1", "s2")), "suffix-triples", PACKED)
    sample = triples.filter("at % 3 != 0")
    names = surrogate_key(sample.select("s0", "s1", "s2").distinct(), "name", ["s0", "s1", "s2"])
    named = stage(sample.join(names, ["s0", "s1", "s2"]).select("at", "name"), "suffix-names", PACKED)
    unstage(names)
    total, different = named.agg(F.count(F.lit(1)), F.max("name")).first()
    inner = named
    if different == total:
        ranks = named.select("at", F.col("name").alias("r"))
    else:
        first_kind = (n + 1) // 3 + (1 if n % 3 == 1 else 0)  # places 1, 4, ... up to n
        place = F.floor(F.col("at") / 3).cast("long")
        shorter = named.select(
            F.when(F.col("at") % 3 == 1, place).otherwise(place + first_kind).alias("at"), F.col("name").alias("symbol")
        )
        inner = suffix_order(shorter, None if levels is None else levels - 1)
        back = F.when(F.col("at") < first_kind, 3 * F.col("at") + 1).otherwise(3 * (F.col("at") - first_kind) + 2)
        ranks = inner.select(back.cast("long").alias("at"), F.col("rank").alias("r"))
        if "staged_at" in vars(inner):
            unstage(named)
    known = _around(ranks, "r", (0, 1, 2), ("r0", "r1", "r2"))
    # What the comparisons below do not ask for stays empty.
    kind = F.col("at") % 3
    asked = {"s1": kind != 1, "r0": kind != 0, "r1": kind != 2, "r2": kind != 1}
    full = stage(
        triples.join(known, "at", "left").withColumns(_or_behind("r1", "r2")).filter(F.col("at") < n)
        .select("at", "s0", *(F.when(c, F.col(x)).alias(x) for x, c in asked.items())),
        "suffix-merge",
        PACKED,
    )
    unstage(triples, named, inner)
    rest = full.filter("at % 3 = 0").select("at", "s0", "s1", "r1", "r2")
    own = surrogate_key(rest.select("at", "s0", "r1"), "k0", ["s0", "r1"])
    with_first = surrogate_key(full.filter("at % 3 != 2").select("at", "s0", "r1"), "k1", ["s0", "r1", "at"])
    with_second = surrogate_key(
        full.filter("at % 3 != 1").select("at", "s0", "s1", "r2"), "k2", ["s0", "s1", "r2", "at"]
    )
    before = (F.col("k1") - F.col("k0")) + (F.col("k2") - F.col("k0"))
    merged = (
        own.select("at", "k0").join(with_first.select("at", "k1"), "at").join(with_second.select("at", "k2"), "at")
        .select("at", (2 * before + 1).alias("key"), "k0")
    )
    sorted_ones = full.filter("at % 3 != 0").select(
        "at", (2 * (F.col("r0") - (1 if extra else 0))).alias("key"), F.lit(0).cast("long").alias("k0")
    )
    order = surrogate_key(merged.unionByName(sorted_ones), "rank", ["key", "k0"])
    unstage(full, own, with_first, with_second)
    ranked = order.select("at", "rank")
    ranked.staged_at = order.staged_at
    return ranked
