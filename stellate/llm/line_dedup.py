"""Line dedup with a deletion neighbourhood: lines within one edit of an earlier line go.

Lines of at least ``min_chars`` characters are compared over the whole corpus, in the order of
(document key, line number). A line is dropped if an equal line stands earlier, or, if both have at
least ``min_edit_chars`` characters, a line within ``max_edits`` edits (inserted, removed or replaced
code points) of it. Earlier lines count whether they are kept or not, so the answer does not depend
on any processing order.

Equal lines are folded first; each different line is represented by its earliest occurrence. Two
lines within one edit agree on everything but one short segment, so lines first meet by halves and
then by all but one segment; both filters keep every pair within the bound. Lines that meet emit
their deletion variants inside that segment as hashed keys:

* two lines of equal length with the same variant at the same place differ at most there, so the
  earliest line of such a key is within the bound of all its lines;
* a variant that equals a whole line is one edit away from it.

So every line finds its earliest neighbour by minimums, without listing pairs. The edit distance of
the chosen pairs is then verified on the lines themselves.

NULL texts stay NULL, empty and blank lines stay. Repeated rows of one document count as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.frames import bind, free_name
from stellate.sources.staging import stage

#: Length of the segments of the second filter, in code points.
SEGMENT = 32
#: Shorter lines go as exact copies only: one edit makes another word or number of them.
EDIT_CHARS = 30
#: Roles of a variant key: a character replaced, the whole line, a character removed.
ROLES = ("replaced", "whole", "removed")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashed:
    """Prefix sums of a polynomial hash of one line; ``powers`` must be long enough."""

    def __init__(self, line: str, powers: np.ndarray, inverses: np.ndarray):
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = len(points)
        terms = _mix(points.astype(np.uint64) + _ODD) * powers[: self.n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.inverses = inverses

    def whole(self) -> np.uint64:
        return self.sums[-1]

    def without(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the line with one character left out."""
        return self.sums[at] + (self.sums[-1] - self.sums[at + 1]) * _INVERSE

    def ends(self, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Hashes of the first ``head`` and the last ``tail`` characters together."""
        rest = (self.sums[-1] - self.sums[self.n - tail]) * self.inverses[self.n - tail]
        return _mix(self.sums[head]) + _mix(rest ^ _ODD) * _ODD


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        ups = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _ODD)]), dtype=np.uint64)
        downs = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE)]), dtype=np.uint64)
    return ups, downs


def _segments(shorter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, head and tail lengths of each segment of a line of ``shorter`` characters."""
    j = np.arange(-(-max(shorter, 1) // SEGMENT))
    return j, j * SEGMENT, np.maximum(shorter - (j + 1) * SEGMENT, 0)


def _lengths(n: int) -> list[int]:
    """A line of n characters is compared with lines of n - 1, n and n + 1 characters."""
    return [n, n - 1] if n > 1 else [n]


def _each_batch(batches: Iterator[pa.RecordBatch], schema: pa.Schema, of_line) -> Iterator[pa.RecordBatch]:
    ups, downs = _powers(1024)
    for batch in batches:
        out = {name: [] for name in schema.names}
        for line_id, line, *rest in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if len(line) >= len(ups):
                ups, downs = _powers(2 * len(line))
            columns = of_line(_Hashed(line, ups, downs), *rest)
            out[schema.names[0]].append(np.full(len(columns[0]), line_id, np.int64))
            for name, values in zip(schema.names[1:], columns):
                out[name].append(values)
        if out[schema.names[0]]:
            arrays = [
                pa.array(np.concatenate(out[f.name]).view(np.int64) if f.type == pa.int64() else np.concatenate(out[f.name]), f.type)
                for f in schema
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _segment_keys(batches):
    schema = pa.schema([("line_id", pa.int64()), ("key", pa.int64()), ("shorter", pa.int32()), ("segment", pa.int32())])

    def of_line(h: _Hashed):
        keys, classes, numbers = [], [], []
        for c in _lengths(h.n):
            j, head, tail = _segments(c)
            salt = _mix(np.asarray(j, np.uint64) * _ODD + np.uint64(c))
            keys.append(_mix(h.ends(head, tail) ^ salt))
            classes.append(np.full(len(j), c, np.int32))
            numbers.append(j.astype(np.int32))
        return np.concatenate(keys), np.concatenate(classes), np.concatenate(numbers)

    with np.errstate(over="ignore"):
        yield from _each_batch(batches, schema, of_line)


def _variant_keys(batches):
    schema = pa.schema([("line_id", pa.int64()), ("key", pa.int64()), ("role", pa.int8())])

    def of_line(h: _Hashed, met: list):
        same, less = set(), set()
        for m in met:
            j, c = m["segment"], m["shorter"]
            first, last = j * SEGMENT, h.n - max(c - (j + 1) * SEGMENT, 0)
            (same if c == h.n else less).update(range(first, last))
        at = np.array(sorted(same), np.int64)
        replaced = _mix(h.without(at) ^ _mix(at.astype(np.uint64) * _ODD + np.uint64(h.n)))
        gone = np.array(sorted(less), np.int64)
        removed = np.unique(_mix(h.without(gone) + np.uint64(h.n - 1)))
        whole = _mix(np.array([h.whole()], np.uint64) + np.uint64(h.n))
        roles = np.repeat(np.array([0, 1, 2], np.int8), [len(at), 1, len(removed)])
        return np.concatenate([replaced, whole, removed]), roles

    with np.errstate(over="ignore"):
        yield from _each_batch(batches, schema, of_line)


def _half_keys(line: Column) -> Column:
    """Hashed halves: of two lines within one edit, one half is equal."""
    n = F.char_length(line)

    def of(p: Column) -> Column:
        head = F.xxhash64(F.lit(1), p, F.substr(line, F.lit(1), p))
        tail = F.xxhash64(F.lit(2), p, F.substr(line, n - p + 1, p))
        return F.array(head, tail)

    return F.array_distinct(F.concat(of(F.floor(n / 2).cast("int")), of(F.floor((n - 1) / 2).cast("int"))))


def dropped_lines(
    documents: DataFrame,
    key: str,
    text: str = "text",
    min_chars: int = 30,
    max_edits: int = 1,
    min_edit_chars: int | None = None,
) -> DataFrame:
    """One row per dropped line: document key, line number from 0, and the earlier line's place.

    ``min_chars=1`` drops copies of all lines that are not blank; ``min_edit_chars`` is ``min_chars``
    if not given. Columns: ``document``, ``line``, ``of_document``, ``of_line``.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits must be 0 or 1")
    lines = (
        documents.select(F.col(f"`{key}`").alias("document"), F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("line", "value"))
        .filter((F.char_length("value") >= min_chars) & F.col("value").rlike(r"[^\x20\x09-\x0D]"))
    )
    editable = F.char_length("value") >= (min_chars if min_edit_chars is None else min_edit_chars)
    place = F.struct("document", "line")
    marked = lines.select(
        place.alias("place"),
        F.xxhash64("value").alias("h1"),
        F.xxhash64(F.lit(1), "value").alias("h2"),
        *([F.when(editable, _half_keys(F.col("value"))).alias("halves")] if max_edits else []),
    )
    folded = [F.min("place").alias("first"), F.count(F.lit(1)).alias("n")]
    if max_edits:
        halves = F.first("halves").alias("halves")
        different = stage(marked.groupBy("h1", "h2").agg(*folded, halves), "lines-different")
        different = different.join(_nearest(lines.filter(editable), different), F.col("h1") == F.col("line_id"), "left")
    else:
        different = marked.groupBy("h1", "h2").agg(*folded).withColumn("near", F.lit(None))
        different = different.withColumn("near", F.col("near").cast(different.schema["first"].dataType))
    # Only lines with an equal or a near line matter; the rest never moves again.
    matter = different.filter((F.col("n") > 1) | (F.col("near") < F.col("first")))
    earlier = F.least("first", F.coalesce("near", "first"))
    return (
        marked.select("place", "h1", "h2")
        .join(matter, ["h1", "h2"])
        .filter(earlier < F.col("place"))
        .select(
            F.col("place.document").alias("document"),
            F.col("place.line").alias("line"),
            F.when(F.col("first") < F.col("place"), F.col("first")).otherwise(F.col("near")).alias("of"),
        )
        .select("document", "line", F.col("of.document").alias("of_document"), F.col("of.line").alias("of_line"))
    )


def _met(keys: DataFrame) -> DataFrame:
    """The rows whose key another row has too."""
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return keys.join(shared, "key", "left_semi")


def _nearest(lines: DataFrame, different: DataFrame) -> DataFrame:
    """Earliest line within one edit of each different line that has one: line_id, near.

    Lines are named by their first hash. Should two lines ever share it, one of them is compared
    with the other's text and stays.
    """
    halves = different.select(F.col("h1").alias("line_id"), F.explode("halves").alias("key"))
    partners = _met(halves).select("line_id").distinct()
    values = lines.select(F.xxhash64("value").alias("line_id"), "value").dropDuplicates(["line_id"])
    firsts = different.select(F.col("h1").alias("line_id"), "first")
    texts = stage(partners.join(values, "line_id").join(firsts, "line_id"), "lines-halves-met")
    rows = texts.select("line_id", "value")
    segments = _met(rows.mapInArrow(_segment_keys, "line_id long, key long, shorter int, segment int"))
    near_met = segments.groupBy("line_id").agg(F.collect_set(F.struct("shorter", "segment")).alias("met"))
    variants = (
        rows.join(near_met, "line_id")
        .select("line_id", "value", "met")
        .mapInArrow(_variant_keys, "line_id long, key long, role byte")
    )
    ordered = stage(_met(variants).join(texts.select("line_id", "first"), "line_id"), "line-variants")
    by_key = ordered.groupBy("key").agg(
        *(F.min(F.when(F.col("role") == i, F.col("first"))).alias(name) for i, name in enumerate(ROLES))
    )
    candidate = (
        F.when(F.col("role") == 0, F.col("replaced"))
        .when(F.col("role") == 1, F.col("removed"))
        .otherwise(F.col("whole"))
    )
    chosen = (
        ordered.join(by_key, "key")
        .select("line_id", "first", candidate.alias("near"))
        .filter(F.col("near") < F.col("first"))
        .groupBy("line_id")
        .agg(F.min("near").alias("near"))
    )
    own = texts.select("line_id", F.col("value").alias("own"))
    other = texts.select(F.col("first").alias("near"), F.col("value").alias("other"))
    return (
        chosen.join(own, "line_id")
        .join(other, "near")
        .filter(F.levenshtein("own", "other", 1) >= 0)
        .select("line_id", "near")
    )


def without_lines(
    documents: DataFrame, dropped: DataFrame, key: str, text: str = "text", into: tuple[str, str] = ("n_lines", "n_dropped")
) -> DataFrame:
    """The documents with ``text`` rebuilt from the lines that stay.

    ``into`` names two new columns: the lines before and the lines dropped. A document all of whose
    lines went has the text ''.
    """
    gone, of = free_name(documents, "_gone"), free_name(documents, "_of")
    by_document = dropped.groupBy(F.col("document").alias(of)).agg(F.collect_set("line").alias(gone))
    value = F.col(f"`{text}`")
    lines = F.split(F.coalesce(value, F.lit("")), "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rebuilt = F.array_join(bind(lines, lambda x: F.transform(stays, lambda i: F.get(x, i))), "\n")
    untouched = F.col(gone).isNull()
    return (
        documents.join(by_document, F.col(f"`{key}`") == F.col(of), "left")
        .withColumn(into[0], F.when(value.isNull(), 0).otherwise(F.size(lines)).cast("long"))
        .withColumn(into[1], F.when(untouched, 0).otherwise(F.size(gone)).cast("long"))
        .withColumn(text, F.when(untouched, value).otherwise(rebuilt))
        .drop(gone, of)
    )
