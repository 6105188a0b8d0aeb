"""Scans along one order that go on across partitions.

Rows are ranged by key and order, so a key of any length stands in as many tasks as its rows need.
Every task works along its own sorted rows and keeps nothing but the row before. The rows are written
once with their partition; what one partition has to tell the next is one row, and these rows, one
for each partition, are scanned in turn. Rows that were written cannot fall into other partitions
when a task is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, MapType, StructField, StructType, VariantType

from stellate.operators.cleanup import col
from stellate.operators.joins import _holds
from stellate.sources.staging import stage

PART, PLACE, EDGE = "__part", "__place", "__edge"


def _tie(df: DataFrame) -> list[Column]:
    """A hash of the row, so that equal places in the order do not depend on where a row came from."""
    hashed = [col(f.name) for f in df.schema if not _holds(f.dataType, (MapType, VariantType))]
    return [F.xxhash64(*hashed)] if hashed else []


def _ranged(df: DataFrame, order: Sequence[Column], work: Callable, extra: Sequence[StructField]) -> DataFrame:
    marks = [StructField(PART, IntegerType()), StructField(PLACE, LongType()), StructField(EDGE, BooleanType())]
    schema = StructType([*df.schema.fields, *extra, *marks])
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.mapInArrow(work, schema), "segments")


def _differs(before: pa.Array, after: pa.Array) -> np.ndarray:
    """Where two columns differ; NULL equals NULL and NaN equals NaN, as they do for grouping."""
    same = pc.or_(pc.fill_null(pc.equal(before, after), False), pc.and_(pc.is_null(before), pc.is_null(after)))
    if pa.types.is_floating(before.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(before), pc.is_nan(after)), False))
    return ~same.to_numpy(zero_copy_only=False)


def _new_key(columns: Sequence[pa.Array], n: int) -> np.ndarray:
    """For the rows after the first: whether any key column differs from the row before."""
    out = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        out |= _differs(c.slice(0, n - 1), c.slice(1))
    return out


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    tests = [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _row(names: Sequence[str]) -> Column:
    return F.struct(F.lit(0).alias("__any"), *(col(n) for n in names))


def fill_forward(df: DataFrame, keys: Sequence[str], order_by: str, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the last value before them, per key; without keys, along the whole table.

    NULL is a key of its own and comes first in the order. Of rows that share key and order, those
    with values come first.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, in_first = TaskContext.get().partitionId(), 0, True
        held_keys, held = None, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cols = dict(zip(batch.schema.names, batch.columns))
            own = [cols[k] for k in keys]
            new = np.concatenate([[held_keys is None], _new_key(own, n)])
            if held_keys is not None:
                new[0] = any(bool(_differs(a, b.slice(0, 1))[0]) for a, b in zip(held_keys, own))
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            for c in columns:
                last = np.maximum.accumulate(np.where(pc.is_valid(cols[c]).to_numpy(zero_copy_only=False), at, -1))
                # Place 0 of the pool is the value that the rows before this batch end with.
                source = np.where((last >= start) & (last >= 0), last + 1, np.where(start < 0, 0, -1))
                pool = pa.concat_arrays([held.get(c, pa.nulls(1, cols[c].type)), cols[c]])
                cols[c] = pool.take(pa.array(source, mask=source < 0))
                held[c] = cols[c].slice(n - 1, 1)
            held_keys = [c.slice(n - 1, 1) for c in own]
            first = np.cumsum(new[1:] if place == 0 else new)
            first = (np.concatenate([[0], first]) if place == 0 else first) == 0
            edge, in_first = first & in_first, in_first and bool(first[-1])
            marks = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), pa.array(edge)]
            place += n
            yield pa.RecordBatch.from_arrays([*cols.values(), *marks], names=[*cols, PART, PLACE, EDGE])

    order = [*(col(k) for k in keys), col(order_by), *(col(c).isNull() for c in columns), *_tie(df)]
    filled = _ranged(df, order, work, [])
    ends = filled.groupBy(PART).agg(
        F.max_by(_row([*keys, *columns]), PLACE).alias("last"), F.min_by(_row(keys), PLACE).alias("first")
    )
    # One row for each partition. What a partition ends with is what reached it, if it has nothing itself.
    reached = Window.partitionBy(*(F.col(f"last.`{k}`") for k in keys)).orderBy(PART).rowsBetween(Window.unboundedPreceding, 0)
    told = ends.select(
        PART, "first", "last", F.struct(F.lit(0).alias("__any"), *(F.last(F.col(f"last.`{c}`"), True).over(reached).alias(c) for c in columns)).alias("values")
    )
    before = Window.orderBy(PART)
    told = told.select(PART, "first", F.lag("last").over(before).alias("previous"), F.lag("values").over(before).alias("values"))
    carried = told.where(_same("previous", "first", keys) & F.col("previous").isNotNull()).select(
        PART, *(F.col(f"values.`{c}`").alias(f"__carried_{i}") for i, c in enumerate(columns))
    )
    joined = filled.join(F.broadcast(carried), PART, "left")
    value = {c: F.coalesce(col(c), F.when(F.col(EDGE), F.col(f"__carried_{i}"))) for i, c in enumerate(columns)}
    return joined.select(*(value[c].alias(c) if c in value else col(c) for c in df.columns))


def next_start(df: DataFrame, keys: Sequence[str], start: str, out: str) -> DataFrame:
    """Add the following ``start`` of the same key, NULL on its last row; NULL starts come first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, held = TaskContext.get().partitionId(), 0, None

        def made(table: pa.Table, following, edge: bool) -> pa.RecordBatch:
            n = len(table)
            marks = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n)), pa.array([edge] * n)]
            columns = [c.combine_chunks() for c in table.columns]
            return pa.RecordBatch.from_arrays([*columns, following, *marks], names=[*table.column_names, out, PART, PLACE, EDGE])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            n = len(rows)
            starts = rows.column(start).combine_chunks()
            new = _new_key([rows.column(k).combine_chunks() for k in keys], n)
            following = starts.take(pa.array(np.arange(1, n), mask=new))
            if n > 1:
                yield made(rows.slice(0, n - 1), following, False)
                place += n - 1
            held = rows.slice(n - 1)
        if held is not None:
            yield made(held, pa.nulls(1, held.schema.field(start).type), True)

    order = [*(col(k) for k in keys), col(start), *_tie(df)]
    led = _ranged(df, order, work, [StructField(out, df.schema[start].dataType)])
    ends = led.groupBy(PART).agg(F.max_by(_row(keys), PLACE).alias("last"), F.min_by(_row([*keys, start]), PLACE).alias("first"))
    # One row for each partition: its last row looks at the first one of the next partition.
    halo = ends.select(PART, "last", F.lead("first").over(Window.orderBy(PART)).alias("next"))
    halo = halo.where(F.col("next").isNotNull() & _same("last", "next", keys)).select(PART, F.col(f"next.`{start}`").alias("__next"))
    joined = led.join(F.broadcast(halo), PART, "left")
    return joined.select(*(col(c) for c in df.columns), F.when(F.col(EDGE), F.col("__next")).otherwise(col(out)).alias(out))
