"""Size-aware heavy-light Jaccard join: which documents are linked by the similarity of their shingles.

A document is the set of its distinct shingles (runs of words). Documents with equal sets form a
class; classes are numbered once and everything below is between classes, so copies need no pairs.

* Light sets. For every pair of sizes (s, l) within the threshold, two sets are linked if and only if
  they share c = c(s, l) shingles. All subsets of c shingles are enumerated as keys; sets that meet
  under a key of their sizes are linked, all of one side with all of the other, and one member of
  each side as a hub gives the same components as all those pairs.
* Heavy sets. Shingles have one global order, rare ones first; sets that are linked share one of the
  first n - c + 1, and their inverted lists are scanned. Members of a short list are compared with each
  other, unless sizes or the places of the shingles they share rule a link out. In a long list every
  member is compared with the list's hub, the member that meets most others. Pairs are confirmed on
  the full sets.
* What hubs leave apart: members of a long list that are linked with each other but not with the hub
  share some of what they do not share with it; lists of these differences give the pairs (``sets``).

The boundary between light and heavy is the size at which the number of keys that enumeration would
emit and the list entries that scanning would read add up to the least, from the histogram of sizes
and from a count of all shingles in a fixed number of buckets. That count also orders the shingles;
the order changes the lengths of lists, never the answer.

Rows are documents, whatever their key: rows with one key and different texts are two documents, a
NULL key is no smallest key. NULL texts, and texts without words, have no shingles and are linked
with nothing; a text with fewer words than a shingle is one shingle. Texts are read whole. Equal texts
and repeated rows are one class. An empty table gives an empty result, and no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.sets import (
    IDENTITY,
    class_texts,
    confirm_across,
    confirmed_components,
    identity,
    least_common,
    mix,
    named_components,
    ordered,
    shingle_sets,
)
from stellate.sources.staging import stage

_SLICES = 64


@dataclass(frozen=True)
class Settings:
    """shingle: words; percent: least similarity in hundredths.

    most_light: no boundary above this size is tried. short: the longest list whose members are
    compared with each other; longer ones have a hub. buckets: counters of the shingle count, a
    multiple of 64; it is the one table that every task gets, 4 bytes a counter. A shingle stands out
    in it if it is counted more often than a few times the root of what chance puts in a bucket.
    """

    shingle: int = 5
    percent: int = 80
    most_light: int = 24
    short: int = 16
    buckets: int = 1 << 22

    def common(self, n: int, m: int) -> int:
        """The least common shingles of linked sets of these sizes."""
        return least_common(self.percent, n, m)

    def fits(self, n: int, m: int) -> bool:
        return 100 * min(n, m) >= self.percent * max(n, m)

    def smallest(self, n: int) -> int:
        """The size of the smallest partner."""
        return -(-self.percent * n // 100)

    def size_pairs(self, n: int, boundary: int) -> list[tuple[int, int]]:
        """Sizes (small, large) under which a light set of size n has to enumerate its subsets."""
        found = [(min(n, m), max(n, m)) for m in range(1, boundary + 1) if self.fits(n, m)]
        # Where all of the larger set would be common the two are equal, thus one class.
        return [p for p in found if self.common(*p) < p[1] and self.common(*p) <= p[0]]

    def keys(self, n: int, boundary: int) -> int:
        return sum(comb(n, self.common(*p)) for p in self.size_pairs(n, boundary))


def _sized(documents: DataFrame, key: str, text: str, s: Settings) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, n, set1, set2) of all documents, and the count of all shingles by bucket."""
    schema = f"id long, {IDENTITY}, slice int, counts binary"
    arrow = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])
    each = s.buckets // _SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(s.buckets, np.int64)
        with np.errstate(over="ignore"):
            for batch in batches:
                rows, met = [], []
                for own in shingle_sets(batch.column(1).to_pylist(), s.shingle):
                    met.append((own % np.uint64(s.buckets)).astype(np.int64))
                    rows.append(identity(own))
                n = len(rows)
                counts += np.bincount(np.concatenate(met), minlength=s.buckets) if met else 0
                columns = [batch.column(0).cast(pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*rows))] if n else [pa.nulls(0, pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=arrow)
        if counts.any():
            none = pa.nulls(_SLICES, pa.int64())
            parts = [pa.compress(counts[i * each : (i + 1) * each], codec="zstd", asbytes=True) for i in range(_SLICES)]
            yield pa.RecordBatch.from_arrays([none] * 4 + [pa.array(range(_SLICES), pa.int32()), pa.array(parts)], schema=arrow)

    both = stage(documents.select(key, text).mapInArrow(run, schema), "set-sizes")

    def counters(packed: bytes) -> np.ndarray:
        return np.frombuffer(pa.decompress(packed, 8 * each, codec="zstd", asbytes=True), np.int64)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[i] = total.get(i, 0) + counters(packed)
        parts = [pa.compress(x, codec="zstd", asbytes=True) for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])

    # One number for each bucket, however many documents there are.
    slices = both.filter("slice IS NOT NULL").select("slice", "counts").repartition(_SLICES, "slice").mapInArrow(added, "slice int, counts binary")
    counts = np.zeros(s.buckets, np.uint32)
    for r in slices.collect():
        counts[r["slice"] * each : (r["slice"] + 1) * each] = np.minimum(counters(r["counts"]), 2**32 - 1)
    return both.filter("slice IS NULL").drop("slice", "counts"), counts


def boundary(sizes: dict[int, int], counts: np.ndarray, s: Settings) -> int:
    """The largest light size: keys emitted below it and list entries read above it cost the least."""
    total = max(int(counts.sum(dtype=np.int64)), 1)
    # A list entry meets as many others as its shingle is counted beyond what chance puts in a bucket.
    length = 1 + float((counts * np.maximum(counts.astype(float) - total / len(counts), 0.0)).sum() / total)

    def scanned(n: int) -> float:
        return (n - s.smallest(n) + 1) * length

    def cost(x: int) -> float:
        light = sum(k * s.keys(n, x) for n, k in sizes.items() if n <= x)
        return light + sum(k * scanned(n) for n, k in sizes.items() if n >= s.smallest(x + 1))

    return min(range(s.most_light + 1), key=lambda x: (cost(x), x))


@lru_cache(maxsize=4096)
def _left_out(n: int, r: int) -> np.ndarray:
    """All choices of r of n places."""
    return np.array(list(combinations(range(n), r)), np.int64)


def _subsets(own: np.ndarray, pairs: list[tuple[int, int]], s: Settings) -> tuple[list, list, list]:
    """Keys of all subsets: sizes as one number, and two hashes, which are sums over the subset."""
    sizes, one, two = [], [], []
    v1, v2 = mix(own), mix(own ^ np.uint64(0x5851F42D4C957F2D))
    for small, large in pairs:
        without = _left_out(len(own), len(own) - s.common(small, large))
        sizes += [small * 1000 + large] * len(without)
        for v, out in ((v1, one), (v2, two)):
            out.append(v.sum(dtype=np.uint64) - v[without].sum(axis=1, dtype=np.uint64))
    return sizes, one, two


def _classes(documents: DataFrame, text: str, s: Settings, counts: np.ndarray, light: int) -> DataFrame:
    """One row a class: its number, its sizes, its subset keys if light, its first shingles if it can
    have a heavy partner."""
    schema = f"{IDENTITY}, sizes array<long>, key1 array<long>, key2 array<long>, front array<long>"
    listed = pa.list_(pa.int64())
    arrow = pa.schema([("n", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()), *((c, listed) for c in ("sizes", "key1", "key2", "front"))])
    pairs = {n: s.size_pairs(n, light) for n in range(1, light + 1)}
    least = s.smallest(light + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for own in shingle_sets(batch.column(0).to_pylist(), s.shingle):
                    n = len(own)
                    if not n:
                        continue
                    keys: tuple = ([], [], [])
                    if n <= light and pairs[n]:
                        sizes, one, two = _subsets(own, pairs[n], s)
                        keys = (sizes, np.concatenate(one).view(np.int64), np.concatenate(two).view(np.int64))
                    front = own[:0]
                    if n >= least:
                        often = counts[(own % np.uint64(s.buckets)).astype(np.int64)]
                        front = own[np.lexsort((own, often))[: n - s.smallest(n) + 1]]
                    rows.append((*identity(own), *keys, front.view(np.int64)))
                columns = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    # Equal sets have equal keys and fronts, so any row of a class stands for it.
    one = documents.select(text).mapInArrow(run, schema).groupBy("n", "set1", "set2").agg(*(F.first(c).alias(c) for c in ("sizes", "key1", "key2", "front")))
    return stage(one.withColumn("class", F.monotonically_increasing_id()), "set-classes")


def _light_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) between light classes that share an enumerated subset of their sizes' overlap."""
    keyed = classes.filter(F.size("sizes") > 0).select("class", "n", F.explode(F.arrays_zip("sizes", "key1", "key2")).alias("k"))
    keyed = stage(keyed.select("class", "n", "k.sizes", "k.key1", "k.key2"), "set-subsets")
    small, large = F.floor(F.col("sizes") / 1000), F.col("sizes") % 1000
    hubs = (
        keyed.groupBy("sizes", "key1", "key2")
        .agg(F.min(F.when(F.col("n") == small, F.col("class"))).alias("low"), F.min(F.when(F.col("n") == large, F.col("class"))).alias("high"))
        .filter("low IS NOT NULL AND high IS NOT NULL")
    )
    # Both sides come from tables, so the adaptive plan can split a key that very many sets share.
    met = keyed.join(stage(hubs, "set-hubs"), ["sizes", "key1", "key2"])
    other = F.when(F.col("n") == small, F.col("high")).otherwise(F.col("low"))
    return ordered(met.select(F.col("class").alias("a"), other.alias("b")))


def _list_members(classes: DataFrame, s: Settings) -> DataFrame:
    """Entries (shingle, class, n, at, near, k) of the inverted lists of several sets.

    ``at`` is the shingle's place in the set's order, k the length of the list. Of two linked sets the
    smaller has a common shingle that is ``near``: among its first n - c(n, n) + 1.
    """
    first = F.col("n") - F.ceil(F.lit(2 * s.percent) * F.col("n") / (100 + s.percent)) + 1
    entries = classes.select("class", "n", first.alias("first"), F.posexplode("front").alias("at", "shingle"))
    entries = entries.select("shingle", "class", "n", "at", (F.col("at") < F.col("first")).alias("near"))
    lists = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    return stage(entries.join(stage(lists, "set-lists"), "shingle"), "set-members")


def _short_list_pairs(members: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b, shared) that meet in short lists and can be linked.

    Up to the last places i and j of a shingle they share there, two sets have the m shingles that
    they share there in common, and at most as many more as either has in long lists; behind those
    places at most what is left of either. A pair whose near shingle is in a long list meets a hub.
    """
    many = members.groupBy("class").agg(F.sum((F.col("k") > s.short).cast("long")).alias("long_lists"))
    entries = members.filter(F.col("k") <= s.short).join(many, "class")

    def side(name: str) -> list:
        return ["shingle", *(F.col(c).alias(f"{c}_{name}") for c in ("class", "n", "at", "near", "long_lists"))]

    both = entries.select(*side("a")).join(entries.select(*side("b")), "shingle")
    # The smaller set comes first; of equal sizes, the smaller number.
    both = both.filter("(n_a < n_b OR (n_a = n_b AND class_a < class_b))").filter(100 * F.col("n_a") >= s.percent * F.col("n_b"))
    met = both.groupBy("class_a", "class_b", "n_a", "n_b", "long_lists_a", "long_lists_b").agg(
        F.count(F.lit(1)).alias("shared"), F.max("at_a").alias("i"), F.max("at_b").alias("j"), F.max("near_a").alias("near")
    )
    most = F.col("shared") + F.least("long_lists_a", "long_lists_b") + F.least(F.col("n_a") - F.col("i"), F.col("n_b") - F.col("j")) - 1
    can = most * (100 + s.percent) >= s.percent * (F.col("n_a") + F.col("n_b"))
    return met.filter(can & F.col("near")).select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"), "shared")


def linked(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None, light: int | None = None) -> DataFrame:
    """Per row: its key (``id``), n_shingles, component_id (the smallest key it reaches).

    ``light`` sets the boundary instead of its cost.
    """
    s = settings or Settings()
    rows, counts = _sized(documents, key, text, s)
    if light is None:
        some = rows.filter(F.col("n").between(1, s.most_light + s.most_light // 2)).groupBy("n", "set1", "set2").agg(F.first("n").alias("k"))
        # At most one row for each size up to the largest that a boundary can concern.
        light = boundary({r["n"]: r["count"] for r in some.groupBy("n").count().collect()}, counts, s)
    classes = _classes(documents, text, s, counts, light)
    links = stage(_light_links(classes), "set-light")

    members = _list_members(classes, s)
    pairs = _short_list_pairs(members, s)
    long = members.filter(F.col("k") > s.short).select("shingle", "class", "n", "k")
    central = long.groupBy("class").agg(F.sum("k").alias("score"))
    scored = long.join(central, "class")
    hubs = scored.groupBy("shingle").agg(F.max_by("class", F.struct("score", -F.col("class"))).alias("hub"), F.max_by("n", F.struct("score", -F.col("class"))).alias("nh"))
    around = stage(long.join(stage(hubs, "set-list-hubs"), "shingle").filter("class != hub"), "set-around")
    near = 100 * F.least("n", "nh") >= s.percent * F.greatest("n", "nh")
    with_hub = (
        around.filter(near).select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    )
    stars = stage(pairs.unionByName(with_hub).groupBy("a", "b").agg(F.max("shared").alias("shared")), "set-stars")
    ends_of = stars.select(F.explode(F.array("a", "b")).alias("class")).unionByName(long.select("class"))
    texts = class_texts(documents, text, classes, ends_of.distinct(), s.shingle)
    links, found = confirmed_components(links, stars, texts, s.shingle, s.percent)
    around = around.select(F.col("shingle").alias("list"), "class", "n", "hub")
    _, found = confirm_across(links, found, around, texts, s.shingle, s.percent)
    named = named_components(rows, classes, found)
    return named.select("id", F.col("n").alias("n_shingles"), "component_id")
