"""Repeated byte strings: every byte covered by a string of ``LENGTH`` bytes that starts twice.

Equal texts are folded first; all bytes of a repeated text of at least LENGTH bytes go. The other
texts are searched with a suffix order over sampled places:

* A place is sampled if the smallest hash of the grams in the next REACH places stands at either
  end of them. That depends on the next REACH + GRAM bytes only, so equal strings have equal sampled
  places, and every REACH places hold one. The bytes from one sampled place over the next one and
  its context are a phrase; a text is a string of phrases.
* Phrases that occur once cannot lie in a repeated string. The runs of the others, apart by
  separators, form one string that the difference-cover algorithm orders; suffixes next to each
  other are compared over all the bytes that the windows starting in the phrase need. If they
  agree, all those windows are repeated.
* Windows for which that does not decide, those that begin or end where a repeat begins or ends,
  are checked exactly, together with all windows before the same phrases: by 128-bit hashes of whole
  ranges of them first, and of smaller ranges down to single windows where that leaves some open.

A staged table is deleted when the next one stands; what stays until the end is the texts, once, and the
documents' digests.

Matches never cross texts. NULL counts as the empty text. Repeated rows are equal texts. Texts
shorter than LENGTH have nothing to remove.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.llm.suffix_order import suffix_order
from stellate.operators.keys import surrogate_key
from stellate.sources.staging import PACKED, delete_folder, shared_folder, shuffles_dropped, stage, unstage

LENGTH = 400
GRAM = 16
REACH = 128
#: 3 ** LEVELS phrases decide the order of suffixes; ties only send more windows to the exact check.
LEVELS = 5
#: Windows before a phrase are compared exactly in ranges of so many, then in smaller ones; the last are single
#: windows. A phrase starts at most REACH places behind the one before.
SIZES = (REACH, 32, 8, 1)
# Two polynomial hashes modulo 2 ** 64 with different steps and byte values.
_STEPS = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    _VALUES = tuple(_mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * i)) * _ODD) for i in range(2))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.concatenate([np.ones(1, np.uint64), np.full(size, base % 2**64, np.uint64)])
    return np.cumprod(steps, dtype=np.uint64)


class _Sums:
    """Hashes of any substrings of one text."""

    def __init__(self, data: np.ndarray, which: int = 0):
        size = 1 << max(12, len(data).bit_length())
        step = _STEPS[which]
        terms = _VALUES[which][data] * _powers(step, size)[: len(data)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.back = _powers(pow(step, -1, 2**64), size)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = np.asarray(ends - starts).astype(np.uint64)
        return _mix((self.sums[ends] - self.sums[starts]) * self.back[starts] ^ length * _ODD)


def sampled_places(sums: _Sums, n: int) -> np.ndarray:
    last = n - REACH - GRAM
    if last < 0:
        return np.zeros(0, np.int64)
    starts = np.arange(n - GRAM + 1)
    ids = sums.of(starts, starts + GRAM)
    lows, width = ids, 1
    while 2 * width <= REACH + 1:
        lows = np.minimum(lows[:-width], lows[width:])
        width *= 2
    rest = REACH + 1 - width
    lows = np.minimum(lows[: len(lows) - rest], lows[rest:])[: last + 1]
    return np.flatnonzero((lows == ids[: last + 1]) | (lows == ids[REACH : REACH + last + 1]))


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["text_id", "k", "place", "gap_before", "gap", "name", "prefix"]
    with np.errstate(over="ignore"):
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in names]
            for text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                n = len(data)
                if n < LENGTH:
                    continue
                sums = _Sums(data)
                place = sampled_places(sums, n)
                gap = np.diff(np.append(place, n))
                ends = np.minimum(place + gap + REACH + GRAM, n)
                name = sums.of(place, ends)
                if len(name):
                    name[-1] = _mix(name[-1:] ^ _ODD)[0]  # the phrase that ends its text
                # All windows that start in the phrase lie in so many bytes.
                needed = place + gap + LENGTH - 1
                fits = needed <= n
                prefix = np.where(fits, sums.of(place, np.minimum(needed, n)), np.uint64(0))
                values = (
                    np.full(len(place), text_id, np.int64), np.arange(len(place), dtype=np.int32), place.astype(np.int32),
                    np.diff(place, prepend=-1).astype(np.int32), gap.astype(np.int32), name.view(np.int64) >> 1, prefix.view(np.int64),
                )
                for column, own in zip(columns, values):
                    column.append(own)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)


def _ranges(size: int):
    """Per range of ``size`` windows before a phrase: its places in the text and two hashes each of two strings.

    A window that starts d bytes before the phrase is in the range of ``low`` if low <= d < low + size. The
    strings ``u1``, ``u2`` cover all windows of the range that are in the text and behind the phrase before;
    ``c1``, ``c2`` have the bytes that any window of the range has.
    """
    names = ["text_id", "place", "before", "low", "first", "end", "u1", "u2", "c1", "c2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                columns: list[list[np.ndarray]] = [[] for _ in names]
                ranges = batch.column(2)
                bounds, asked = ranges.offsets.to_numpy(), ranges.values
                places, befores, lows = (asked.field(x).to_numpy().astype(np.int64) for x in ("place", "before", "low"))
                for i, (text_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                    place, before, low = (x[bounds[i] : bounds[i + 1]] for x in (places, befores, lows))
                    least = np.maximum(low, place + LENGTH - len(data))
                    most = np.minimum(low + size, np.minimum(place + 1, before)) - 1
                    place, before, low, least, most = (x[least <= most] for x in (place, before, low, least, most))
                    first, end = place - most, place - least + LENGTH
                    hashes = []
                    for sums in (_Sums(data, 0), _Sums(data, 1)):
                        whole = _mix(sums.of(first, end) ^ (least * 256 + most).astype(np.uint64) * _ODD)
                        hashes += [whole, sums.of(place - low, place + LENGTH - low - size + 1)]
                    values = (
                        np.full(len(place), text_id, np.int64), *(x.astype(np.int32) for x in (place, before, low, first, end)),
                        *(hashes[j].view(np.int64) for j in (0, 2, 1, 3)),
                    )
                    for column, own in zip(columns, values):
                        column.append(own)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)

    return run


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges, ends exclusive."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((first, end))
    return out


def _texts(documents: DataFrame, text: str) -> tuple[DataFrame, int, str]:
    """Different texts with the number of rows that have them, bucketed by a 64-bit id.

    Later steps join ranges to texts by that id; the buckets keep the texts where they are. Should
    two texts share an id, another seed is tried.
    """
    spark = documents.sparkSession
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    seed = 0
    while True:
        name = f"texts_{uuid.uuid4().hex}"
        check = F.sha2(value, 256)
        with shuffles_dropped(spark):
            (
                documents.select(text_id(value, seed).alias("text_id"), value.alias("text"), check.alias("check"))
                .groupBy("text_id")
                .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.min("check").alias("low"), F.max("check").alias("high"))
                .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "text_id")
                .options(**PACKED, path=f"{shared_folder(spark)}/staged/{name}")
                .saveAsTable(name)
            )
        texts = spark.table(name)
        if texts.filter("low != high").isEmpty():
            return texts, seed, name
        _drop(spark, name)
        seed += 1


def _drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE {name}")
    delete_folder(spark, f"{shared_folder(spark)}/staged/{name}")


def text_id(value, seed: int):
    return F.xxhash64(F.lit(seed), value)


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """``text_id``, ``first``, ``end``: ranges of bytes to remove from different texts."""
    phrases = texts.select("text_id", "text").mapInArrow(
        _phrases, "text_id long, k int, place int, gap_before int, gap int, name long, prefix long"
    )
    again = phrases.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = stage(again.select("name", F.monotonically_increasing_id().alias("symbol")), "phrase-names", PACKED)
    kept = stage(phrases.join(again, "name").drop("name"), "phrases-repeated", PACKED)
    unstage(again)

    # One string of all runs: a separator, smaller than any name and never repeated, ends each run.
    by_text = Window.partitionBy("text_id").orderBy("k")
    run_ends = F.coalesce(F.lead("k").over(by_text) != F.col("k") + 1, F.lit(True))
    ends = F.explode(F.when(F.col("run_ends"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    string = kept.withColumn("run_ends", run_ends).select("*", ends.alias("end")).drop("run_ends").withColumns(
        {c: F.when(~F.col("end"), F.col(c)) for c in ("symbol", "prefix", "place", "gap_before", "gap")}
    )
    keyed = surrogate_key(string, "at", ["text_id", "k", "end"])
    numbered = stage(keyed.withColumn("at", F.col("at") - 1).drop("end"), "phrase-string", PACKED)
    unstage(kept, keyed)
    order = suffix_order(numbered.select("at", F.coalesce("symbol", -F.col("at") - 1).alias("symbol")), LEVELS)
    placed = stage(
        order.join(numbered.filter("prefix != 0").select("at", "prefix"), "at").select("rank", "at", "prefix"),
        "suffix-neighbours",
        PACKED,
    )
    unstage(order)
    after = placed.select((F.col("rank") - 1).alias("rank"), F.col("at").alias("at_b"), F.col("prefix").alias("prefix_b"))
    equal = placed.join(after, "rank").filter("prefix = prefix_b")
    yes = stage(equal.select(F.explode(F.array("at", "at_b")).alias("at")).distinct(), "phrases-decided", PACKED)
    unstage(placed)

    marked = stage(
        numbered.filter("symbol IS NOT NULL").drop("prefix")
        .join(yes.withColumn("yes", F.lit(True)), "at", "left").withColumn("yes", F.coalesce("yes", F.lit(False))),
        "phrases-marked",
        PACKED,
    )
    unstage(numbered, yes)
    # Windows from behind the previous sampled place up to this one are decided if both are.
    before = F.lag("yes").over(by_text) & (F.lag("k").over(by_text) == F.col("k") - 1)
    undecided = marked.withColumn("open", ~(F.col("yes") & F.coalesce(before, F.lit(False))))
    symbols = stage(undecided.filter("open").select("symbol").distinct(), "phrases-open", PACKED)
    asked = marked.join(symbols, "symbol", "left_semi").select("text_id", "place", F.col("gap_before").alias("before"), F.lit(0).alias("low"))
    found = _repeated_windows(texts.select("text_id", "text"), asked)
    inner = marked.filter("yes").select("text_id", F.col("place").alias("first"), (F.col("place") + F.col("gap") - 1 + LENGTH).alias("end"))
    ranges = stage(reduce(DataFrame.unionByName, [inner, *found]), "repeated-ranges", PACKED)
    unstage(marked, symbols, *found)
    return ranges


def _repeated_windows(texts: DataFrame, asked: DataFrame) -> list[DataFrame]:
    """Staged ranges of bytes of the repeated windows before the asked phrases, by exact comparison.

    A range of windows is settled if the bytes that cover all its windows occur twice. Of equal ones a
    single range goes on, and only if a range not yet settled has the bytes in common with another one
    that each of the windows has: it is cut into smaller ranges, in the end single windows.
    """
    found: list[DataFrame] = []
    given: list[DataFrame] = []
    for size, next_size in zip(SIZES, (*SIZES[1:], 0)):
        own = asked.groupBy("text_id").agg(F.collect_list(F.struct("place", "before", "low")).alias("ranges"))
        hashed = stage(
            texts.join(own, "text_id").mapInArrow(
                _ranges(size), "text_id long, place int, before int, low int, first int, end int, u1 long, u2 long, c1 long, c2 long"
            ),
            "window-ranges",
            PACKED,
        )
        unstage(*given)
        one = F.min(F.struct("text_id", "place", "before")).alias("one")
        alike = stage(
            hashed.groupBy("low", "u1", "u2", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), one), "window-ranges-alike", PACKED
        )
        twice = alike.filter("n > 1").select("low", "u1", "u2")
        found.append(stage(hashed.join(twice, ["low", "u1", "u2"], "left_semi").select("text_id", "first", "end"), "windows-found", PACKED))
        unstage(hashed)
        given = [alike]
        if next_size:
            # Written, so that the joins with hot phrases and strings can be split.
            open_ = alike.groupBy("low", "c1", "c2").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).filter("m > 1 AND least = 1")
            given.append(open_ := stage(open_.select("low", "c1", "c2"), "window-ranges-open", PACKED))
            lows = F.explode(F.sequence(F.col("low"), F.col("low") + size - 1, F.lit(next_size)))
            asked = alike.join(open_, ["low", "c1", "c2"], "left_semi").select("one.*", lows.alias("low"))
    unstage(*given)
    return found


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["text_id", "n_bytes", "n_removed", "spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for text_id, text, copies, ranges in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = text.encode("utf-8", "surrogatepass")
            spans = [(0, len(data))] if copies > 1 and len(data) >= LENGTH else merge([(r["first"], r["end"]) for r in ranges or ()])
            kept, at = hashlib.sha256(), 0
            for first, end in spans:
                kept.update(data[at:first])
                at = end
            kept.update(data[at:])
            told = [{"first": a, "end": b} for a, b in spans]
            rows.append((text_id, len(data), sum(b - a for a, b in spans), told, kept.hexdigest()))
        spans_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), spans_type, pa.string()]
        columns = zip(*rows) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def without_repeats(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with n_bytes, n_removed, spans and kept_sha256 in place of ``text``."""
    spark = documents.sparkSession
    texts, seed, table = _texts(documents, text)
    found = repeated_ranges(texts)
    ranges = found.groupBy("text_id").agg(F.collect_list(F.struct("first", "end")).alias("ranges"))
    schema = "text_id long, n_bytes long, n_removed long, spans array<struct<first:long,end:long>>, kept_sha256 string"
    digests = (
        texts.select("text_id", "text", "copies").join(ranges, "text_id", "left").mapInArrow(_digest, schema)
    )
    staged = stage(digests, "repeat-digests", PACKED).withColumnRenamed("text_id", "_text_id")
    unstage(found)
    _drop(spark, table)
    own = documents.withColumn("_of", text_id(F.coalesce(F.col(f"`{text}`"), F.lit("")), seed)).drop(text)
    return own.join(staged, F.col("_of") == F.col("_text_id")).drop("_of", "_text_id")
