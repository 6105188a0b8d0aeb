"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

A document is the set of hashes of its shingles (runs of words). Documents with equal sets are one
class, numbered once. Classes meet in bands of their MinHash signatures. Each
bucket of a band links its members to a leader, the member that meets most others over all bands:
in a large group of near copies that is the text they were made from, and the pairs of the group
need not be listed.

A pair is compared batch by batch over the signature: after each batch it goes as soon as the
posterior probability that its similarity reaches the threshold falls below ``miss``. The pairs
that survive are verified exactly on the full sets: first the most similar partner of each class,
then the other pairs that are still in different components. Two members of a bucket that the leader
does not connect can only be linked if they share some of what they do not share with it; such pairs
are found by those shingles (``sets``), so no link between components is left out because a leader
was not similar enough. The texts that verifications need are written once, one for each class.

Rows are documents, whatever their key: rows with one key and different texts are two documents, and
a NULL key is no smallest key. Texts without words, NULL and empty texts have no shingles and are
linked with nothing. Shorter texts than a shingle are one shingle; very long texts are read whole.
Equal texts and repeated rows are one class. An empty table gives an empty result. Only the key and
the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.frames import free_name
from stellate.llm.sets import (
    IDENTITY,
    class_texts,
    confirm_across,
    confirmed_components,
    identity,
    named_components,
    shingle_sets,
)
from stellate.sources.staging import stage


@dataclass(frozen=True)
class Settings:
    """shingle words, least similarity in hundredths, and the shape of the signature.

    bands x rows values are compared; a pair at the threshold shares no band with a probability of
    1e-7 for the defaults, and of 3e-7 for 0.85 with 32 bands of 6 rows. ``miss`` is the posterior
    probability at which a pair is given up.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    batch: int = 40
    miss: float = 1e-6
    seed: int = 7


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Smallest value under each of many hashes; shingles are mixed already."""
    out = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        values = (shingles[None, at : at + 512] ^ seeds[:, None]) * _ODD
        np.minimum(out, values.min(axis=1), out=out)
    return _mix(out)


def signatures(documents: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """Per row: id, text_hash, n shingles, two hashes of the whole set, band keys, short signature."""
    s = settings
    schema = f"id long, text_hash long, {IDENTITY}, bands array<long>, signature binary"
    names = ["id", "text_hash", "n", "set1", "set2", "bands", "signature"]
    kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            seeds = _mix(np.arange(1, s.bands * s.rows + 1, dtype=np.uint64) * _ODD + np.uint64(s.seed))
            for batch in batches:
                rows = []
                for own in shingle_sets(batch.column(2).to_pylist(), s.shingle):
                    if not len(own):
                        rows.append((0, 0, 0, None, None))
                        continue
                    values = _signature(own, seeds)
                    band = np.arange(s.bands, dtype=np.uint64)
                    for r in range(s.rows):
                        band = _mix(band * _ODD + values[r :: s.rows][: s.bands])
                    rows.append((*identity(own), band.view(np.int64), values.astype(np.uint8).tobytes()))
                columns = list(zip(*rows)) or [()] * 5
                arrays = [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, kinds))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = documents.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, schema)


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """For every number of compared values: the matches below which a pair is given up.

    With a flat prior, the similarity given m matches of n follows Beta(m + 1, n - m + 1).
    """
    t = settings.percent / 100
    total = settings.bands * settings.rows
    out = []
    for n in range(settings.batch, total + 1, settings.batch):
        m = 0
        while m < n and _tail(m + 1, n - m + 1, t) < settings.miss:
            m += 1
        out.append((n, m))
    return out


def _tail(a: int, b: int, t: float) -> float:
    """P(X >= t) for X ~ Beta(a, b) with whole a, b: a binomial sum."""
    n = a + b - 1
    return sum(
        2.718281828459045 ** (lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(t) + (n - k) * log(1 - t))
        for k in range(a)
    )


def _compared(pairs: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) that survive all batches, with the number of equal signature values."""
    limits = least_matches(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "matches"]
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in (2, 3)
            )
            alive, matches, before = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, least in limits:
                matches[alive] += (left[alive, before:n] == right[alive, before:n]).sum(axis=1)
                alive, before = alive[matches[alive] >= least], n
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept), pa.array(matches[alive])], names=names
            )

    # Sizes alone bound the similarity: the smaller set is at most the intersection.
    a = signed.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    b = signed.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    near = (100 * F.least("na", "nb")) >= (settings.percent * F.greatest("na", "nb"))
    return (
        pairs.join(a, "a").join(b, "b").filter(near).select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, matches long")
    )


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _grouped(documents: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """Every row: id, text_hash, n, set1, set2, component (a number; NULL without words), component_id."""
    signed = stage(signatures(documents, key, text, s), "signatures")
    one = signed.filter("n > 0").groupBy("n", "set1", "set2").agg(F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    classes = stage(one.withColumn("class", F.monotonically_increasing_id()), "signature-classes")
    bands = classes.select("class", "n", F.posexplode("bands").alias("band", "value"))
    shared = bands.groupBy("band", "value").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    met = stage(bands.join(stage(shared, "band-shared"), ["band", "value"]), "band-members")
    # The text that copies were made from shares more bands with them than they do with each other.
    central = met.groupBy("class").agg(F.sum("k").alias("score"))
    leaders = met.join(central, "class").groupBy("band", "value").agg(
        F.max_by("class", F.struct(F.col("score"), -F.col("class"))).alias("leader")
    )
    members = met.select("band", "value", "class", "n").join(stage(leaders, "band-leaders"), ["band", "value"])
    stars = members.filter("class != leader").select(*_pair(F.col("class"), F.col("leader"))).distinct()
    short = classes.select("class", "n", "signature")
    survivors = stage(_compared(stars, short, s).withColumnRenamed("matches", "shared"), "near-survivors")

    texts = class_texts(documents, text, classes, met.select("class").distinct(), s.shingle)
    links, found = confirmed_components(None, survivors, texts, s.shingle, s.percent)
    # What a leader did not connect: buckets that still hold several components.
    around = members.filter("class != leader").select(F.struct("band", "value").alias("list"), "class", "n", F.col("leader").alias("hub"))

    def sift(pairs: DataFrame) -> DataFrame:
        return stage(_compared(pairs.join(survivors, ["a", "b"], "left_anti"), short, s).select("a", "b"), "near-across")

    _, found = confirm_across(links, found, around, texts, s.shingle, s.percent, sift)
    return named_components(signed.drop("bands", "signature"), classes, found)


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id it reaches). ``key`` is an integer column."""
    found = _grouped(documents, key, text, settings or Settings())
    return found.select("id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row of every component, the one with the smallest key; rows without words all stay.

    A row without key is chosen only if all of its component are; of repeated rows one stays.
    """
    mine, mark = free_name(documents, "_kept"), free_name(documents, "_key")
    found = stage(_grouped(documents, key, text, settings or Settings()).select("id", "text_hash", "component"), "near-groups")
    grouped = found.filter("component IS NOT NULL")
    first = grouped.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("without"), "id", "text_hash")).alias("first"))
    chosen = first.select("component", F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"))
    alike = grouped.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("k"))
    named = F.struct("id", F.col("text_hash").alias("text")).alias(mine)
    same = (chosen["id"].eqNullSafe(alike["id"])) & (chosen["text_hash"] == alike["text_hash"])
    kept = stage(chosen.join(alike, same).select(F.struct(chosen["id"], chosen["text_hash"].alias("text")).alias(mine), "k"), "near-kept")
    empty = found.filter("component IS NULL").select(named).distinct()
    typed = F.struct(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text"))
    single = kept.filter("k = 1").select(mine).unionByName(empty)
    chosen_rows = documents.join(single, typed == F.col(mine), "left_semi")
    repeated = kept.filter("k > 1").select(mine)
    if repeated.isEmpty():
        return chosen_rows
    copies = documents.withColumn(mark, typed)
    return chosen_rows.unionByName(copies.join(repeated, F.col(mark) == F.col(mine), "left_semi").dropDuplicates([mark]).drop(mark))
