"""Shingle sets of documents, and what is linked around hubs: shared by the set operators.

Documents with equal sets are one class. The texts of the classes that a verification needs are
written once, compressed, one text for each class; sets are made from them again where two meet.

What hubs leave apart: if x is not linked with its hub B, let Dx be what x and B do not have in common.
With k = (100 - percent) / (100 + percent), x and y are linked if and only if
|Dx & Dy| >= (|Dx| + |Dy| - k(|x| + |y|)) / 2. As |Dy| >= | |B| - |y| |, this is at least
(|Dx| - k(|x| + |B|)) / 2 for any y: more than 0 if x is not linked with B (``far``). And for any y it
is more than (|Dy| + k(|B| - |y|)) / 2 if x is far. So a far x shares with y one of its first
|Dx| - (the first bound) + 1, which is at the same time one of the first |Dy| - (the second bound) + 1
of y, in one order for all members of the hub: what B lacks first. Of two members in different
components one is far, so the lists of these fronts hold every pair that can still be linked. Behind
the front that ends first, the two have at most what is left of that one in common, so a pair that
shares too little in the fronts goes before any text is read.

Members that have no more in common with the hub than a passage all lack the rest of it, so lists of what
they lack would hold them all. If x has more that B lacks than linked sets can differ by, (100 - percent)
hundredths of |x| (``strange``), y has some of that. What comes before the first shared one is not in the
other, so that one is among the first (100 - percent) |x| / 100 + 1 of x, and likewise of y: x then meets
partners by what B lacks only, and the lists of all differences hold the other members.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.components import components
from stellate.sources.staging import stage

IDENTITY = "n long, set1 long, set2 long"


def least_common(percent: int, n: int, m: int) -> int:
    """The least common members of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 2**64)
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
with np.errstate(over="ignore"):
    #: A random number for each byte, the same for both cases of a letter.
    _BYTE = mix(mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_STEP)))[_LOWER]
#: Texts of so many bytes are hashed at a time.
_TOGETHER = 1 << 19


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _sets_of(raws: list[bytes], span: int) -> Iterator[np.ndarray]:
    """Sets of some texts at once: hashes of words are sums over bytes, of shingles sums over words."""
    data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    gap = _GAP[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap])))
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(20, len(data).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_STEP, size)[: len(data)], dtype=np.uint64)])
    words = mix(mix((sums[ends] - sums[starts]) * _powers(_BACK, size)[starts] ^ (ends - starts).astype(np.uint64)))
    stops = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in raws]))
    weights = _powers(0x9E3779B97F4A7C15, 64)

    def combined(low: int, high: int, n: int) -> np.ndarray:
        """Runs of n words between two places."""
        total = np.full(high - low - n + 1, np.uint64(n), np.uint64)
        for k in range(n):
            total += words[low + k : high - n + 1 + k] * weights[k + 1]
        return mix(mix(total))

    every = combined(0, len(words), span) if len(words) >= span else words[:0]
    low = 0
    for high in stops.tolist():
        if high - low >= span:
            yield _distinct(every[low : high - span + 1])
        else:
            yield combined(low, high, high - low) if high > low else words[:0]
        low = high


def shingle_sets(texts: list[str | None], span: int) -> Iterator[np.ndarray]:
    """For each text: the sorted distinct hashes of its runs of ``span`` words, A-Z in lower case; one
    run of all its words if it has fewer; nothing without words."""
    raws: list[bytes] = []
    held = 0
    with np.errstate(over="ignore"):
        for text in texts:
            raws.append((text or "").encode("utf-8", "surrogatepass"))
            held += len(raws[-1])
            if held >= _TOGETHER:
                yield from _sets_of(raws, span)
                raws, held = [], 0
        if raws:
            yield from _sets_of(raws, span)


def identity(own: np.ndarray) -> tuple[int, int, int]:
    """Size and two hashes of a set."""
    one, two = own.sum(dtype=np.uint64), mix(own).sum(dtype=np.uint64)
    return len(own), int(one.view(np.int64)), int(two.view(np.int64))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def class_texts(documents: DataFrame, text: str, classes: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """Compressed text of one document of each wanted class: class, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n", "set1", "set2", "packed"]
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                texts = batch.column(0).to_pylist()
                for x, own in zip(texts, shingle_sets(texts, span)):
                    if len(own):
                        rows.append((*identity(own), _compressed(x)))
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()])], names=names)

    one = documents.select(text).mapInArrow(run, f"{IDENTITY}, packed binary").groupBy("n", "set1", "set2").agg(F.first("packed").alias("packed"))
    some = classes.select("n", "set1", "set2", "class").join(wanted, "class", "left_semi")
    return stage(one.join(some, ["n", "set1", "set2"]).select("class", "packed"), "set-texts")


def _compressed(text: str) -> bytes:
    data = text.encode("utf-8", "surrogatepass")
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _set_of(packed: bytes, span: int) -> np.ndarray:
    data = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    return next(shingle_sets([data.decode("utf-8", "surrogatepass")], span))


class _Sets:
    """Sets of a task, the last few kept: joined rows come with one side in runs."""

    def __init__(self, span: int, kept: int = 8):
        self.span, self.kept, self.known = span, kept, OrderedDict()

    def __call__(self, number: int, packed: bytes) -> np.ndarray:
        if number not in self.known:
            if len(self.known) >= self.kept:
                self.known.popitem(last=False)
            self.known[number] = _set_of(packed, self.span)
        return self.known[number]


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("class").alias("a"), F.col("packed").alias("pa"))
    b = texts.select(F.col("class").alias("b"), F.col("packed").alias("pb"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "pa", "pb")


def confirmed(pairs: DataFrame, texts: DataFrame, span: int, percent: int) -> DataFrame:
    """The pairs whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(span)
        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = _set_of(x, span), sets(b, y)
                keep.append(len(np.intersect1d(x, y, assume_unique=True)) >= least_common(percent, len(x), len(y)))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], names=["a", "b"])

    return stage(_with_texts(pairs, texts).mapInArrow(run, "a long, b long"), "set-links")


def _differences(around: DataFrame, texts: DataFrame, span: int, percent: int) -> DataFrame:
    """Per member and hub, what the two do not have in common: how much of it the member has (``new``) and
    lacks (``lost``), the front of ``new`` and, unless the member is ``strange``, that of all, of which
    ``far`` and ``own`` count."""
    p, q = 100 - percent, 100 + percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(span)
        names = ["class", "hub", "n", "new", "lost", "strange", "new_front", "front", "far", "own"]
        for batch in batches:
            rows = []
            for b, x, y in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                x, base = _set_of(x, span), sets(b, y)
                new, lost = np.setdiff1d(x, base, assume_unique=True), np.setdiff1d(base, x, assume_unique=True)
                size, without = len(new) + len(lost), p * len(x) // 100
                new_front = new[: without + 1].view(np.int64)
                if len(new) > without:
                    rows.append((len(x), len(new), len(lost), True, new_front, new_front[:0], 0, 0))
                    continue
                over = q * size - p * (len(x) + len(base))
                # In units of 1 / 2q: whole numbers, so no bound is rounded the wrong way.
                first = -(-over // (2 * q)) if over > 0 else 0
                second = (q * size + p * (len(base) - len(x))) // (2 * q) + 1
                far, own = size - first + 1 if over > 0 else 0, max(size - second + 1, 0)
                front = np.concatenate([new, lost]).view(np.int64)[: max(far, own)]
                rows.append((len(x), len(new), len(lost), False, new_front, front, far, own))
            columns = list(zip(*rows)) or [()] * 8
            listed = pa.list_(pa.int64())
            types = [pa.int64()] * 3 + [pa.bool_(), listed, listed, pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    pairs = around.select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct()
    schema = "class long, hub long, n long, new long, lost long, strange boolean, new_front array<long>, front array<long>, far int, own int"
    made = _with_texts(pairs, texts).mapInArrow(run, schema)
    return stage(made.join(around.select("class", "component").distinct(), "class"), "set-differences")


def _lists_of_fronts(apart: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of the lists by hub, kind and shingle: those that look for partners, and all."""
    size = F.col("new") + F.col("lost")

    def entries(kind: str, rows: DataFrame, front: Column, behind: Column, lost: Column, looks: Column) -> DataFrame:
        of = F.struct("n", "new", F.col("lost").alias("lacks"), behind.alias("behind"), lost.alias("lost"))
        return rows.withColumn("of", of).select("hub", F.lit(kind).alias("kind"), "class", "component", "of", looks.alias("looks"), F.explode(front).alias("shingle"))

    behind_new = size - F.col("lost") - F.size("new_front")
    by_new = entries("new", apart, F.col("new_front"), behind_new, F.col("lost"), F.col("strange"))
    known, none, is_far = apart.filter("NOT strange"), F.lit(0).cast("long"), F.col("far") > 0
    by_all = entries("all", known, F.slice("front", F.lit(1), "own"), size - F.col("own"), none, is_far)
    far = entries("all", known.filter(is_far), F.slice("front", F.lit(1), "far"), size - F.col("far"), none, is_far)
    return by_new.filter("looks").unionByName(far), by_new.unionByName(by_all)


def across(around: DataFrame, texts: DataFrame, span: int, percent: int) -> DataFrame:
    """Pairs (a, b) in different components around one hub that can still be linked."""
    looking, own = _lists_of_fronts(_differences(around, texts, span, percent))
    p, q = 100 - percent, 100 + percent
    place = ["hub", "kind", "shingle"]
    reached = own.groupBy(*place).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    probes = looking.join(stage(reached, "set-reached"), place).filter("component != low OR component != high")
    x = stage(probes, "set-probes").select(*place, F.col("class").alias("x"), F.col("of").alias("ofx"), F.col("component").alias("cx"))
    met = x.join(own, place).filter("cx != component AND (NOT looks OR x < class)")
    met = met.filter(100 * F.least("of.n", "ofx.n") >= percent * F.greatest("of.n", "ofx.n"))
    # They differ at least by as much as one has more, and one lacks more, than the other.
    differ = F.abs(F.col("of.new") - F.col("ofx.new")) + F.abs(F.col("of.lacks") - F.col("ofx.lacks"))
    met = met.filter(q * differ <= p * (F.col("of.n") + F.col("ofx.n")))
    pairs = met.groupBy("hub", "x", "class", "ofx", "of").agg(F.count(F.lit(1)).alias("shared"))
    most = F.col("shared") + F.greatest("ofx.behind", "of.behind") + F.least("ofx.lost", "of.lost")
    sizes = F.col("ofx.new") + F.col("ofx.lacks") + F.col("of.new") + F.col("of.lacks")
    can = 2 * q * most >= q * sizes - p * (F.col("ofx.n") + F.col("of.n"))
    return ordered(pairs.filter(can).select(F.col("x").alias("a"), F.col("class").alias("b")))


def with_partners_by_size(left: DataFrame, percent: int) -> DataFrame:
    """The members around a hub that have one of another component within the sizes of a link.

    Linked sizes fall into the same class of sizes or two that touch; a class spans a little more than
    the ratio of the threshold.
    """
    size = F.floor(F.log(F.col("n")) / (F.log(F.lit(100 / percent)) * 1.0001 + 1e-9)).cast("int")
    sized = left.withColumn("size", size)
    near = sized.select("hub", "component", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size"))
    met = near.groupBy("hub", "size").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return stage(sized.join(stage(met.select("hub", "size"), "set-sizes-met"), ["hub", "size"], "left_semi").select("class", "hub", "component"), "set-left")


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    a = found.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = found.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    joined = pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left")
    return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def confirmed_components(
    links: DataFrame | None, pairs: DataFrame, texts: DataFrame, span: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links and components after the pairs (a, b, shared) are confirmed, as far as that is needed.

    The pair in which a class shares most comes first: these settle most components, and pairs inside
    one component need no confirmation.
    """
    ends = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    best = pairs.select(ends.alias("e"), "shared").groupBy("e.x").agg(F.max_by("e.y", F.struct("shared", -F.col("e.y"))).alias("y"))
    best = stage(ordered(best.select(F.col("x").alias("a"), F.col("y").alias("b"))), "set-best")
    first = confirmed(best, texts, span, percent)
    links = first if links is None else links.unionByName(first)
    found = components(links)
    rest = stage(apart(pairs.join(best, ["a", "b"], "left_anti"), found), "set-rest")
    return confirm_more(links, found, rest, texts, span, percent)


def confirm_more(links: DataFrame, found: DataFrame, pairs: DataFrame, texts: DataFrame, span: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links and components with the confirmed ones of some more pairs."""
    if pairs.isEmpty():
        return links, found
    links = links.unionByName(confirmed(pairs, texts, span, percent))
    return links, components(links)


def confirm_across(
    links: DataFrame,
    found: DataFrame,
    around: DataFrame,
    texts: DataFrame,
    span: int,
    percent: int,
    sift: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
) -> tuple[DataFrame, DataFrame]:
    """Links and components after what hubs left apart; ``around`` has list, class, n and hub.

    ``sift`` may drop pairs before they are confirmed.
    """
    own = F.coalesce("component", "class").alias("component")
    placed = around.join(found.withColumnRenamed("id", "class"), "class", "left").select("list", "class", "n", "hub", own)
    mixed = placed.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("list")
    left = placed.join(stage(mixed, "set-mixed"), "list").select("class", "n", "hub", "component").distinct()
    left = with_partners_by_size(stage(left, "set-left"), percent)
    if left.isEmpty():
        return links, found
    pairs = sift(stage(across(left, texts, span, percent), "set-across"))
    return confirm_more(links, found, pairs, texts, span, percent)


def named_components(rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Every row of ``rows`` (id, n, set1, set2 and more) with its component and ``component_id``, the
    smallest id there; rows without shingles are their own."""
    least = rows.filter("n > 0").groupBy("n", "set1", "set2").agg(F.min("id").alias("low"))
    named = classes.select("n", "set1", "set2", "class").join(least, ["n", "set1", "set2"])
    named = named.join(found.withColumnRenamed("id", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = stage(named, "set-named")
    names = named.groupBy("component").agg(F.min("low").alias("component_id"))
    # Written, so that the join below has a shuffle of its own on both sides and splits a hot class.
    settled = stage(named.join(names, "component").select("n", "set1", "set2", "component", "component_id"), "set-settled")
    full = rows.filter("n > 0").join(settled, ["n", "set1", "set2"])
    empty = rows.filter("n = 0").withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("id")})
    return full.unionByName(empty)
