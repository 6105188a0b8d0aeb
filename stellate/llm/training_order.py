"""Training order: every sequence has one slot of a keyed permutation, shards hold slots in order.

The token ids of all documents form one stream that is cut into sequences of equal length; only the
last one may be short. A keyed Feistel network over the next power of four, walked until it falls
into range, permutes sequence numbers; it needs the key and the number of sequences only, so any
worker finds any slot without a shuffle or a stored table. Pieces of documents then meet by ranges
of slots that never cross a shard, and every range is assembled in order. A shard is a fixed number
of slots and every sequence has the same size in bytes, so slot s is row ``s % per_shard`` of shard
``s // per_shard``.

NULL and empty texts are the end token alone. An empty table has no sequences. Repeated rows are
encoded as often as they occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.word_tokens import load
from stellate.sources.staging import stage

LENGTH = 2048
PER_SHARD = 8192
#: Slots that one task assembles and writes as one file, at most.
PER_FILE = 1024
END = 1
PAD = 0
#: Ids take a third less space so; the lowest level costs hardly more time than none.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
SCHEMA = "slot long, shard long, at_byte long, sequence long, n_tokens long, ids_crc32 long, ids binary"
_ROUNDS = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each sequence number: a permutation of 0 .. n - 1."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    out = np.asarray(numbers, np.uint64).copy()
    walking = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(walking):
            left, right = out[walking] >> half, out[walking] & low
            for r in range(_ROUNDS):
                seed = np.uint64((key * 1_000_003 + r) % 2**64)
                left, right = right, left ^ (_mix(right * _ODD + seed) & low)
            out[walking] = (left << half) | right
            walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def token_stream(documents: DataFrame, text: str, tokenizer: str) -> DataFrame:
    """Ids of every document with its place in the stream of its part: part, before, n, ids.

    Parts are the tasks that wrote the table; their numbers hold because the table is read back.
    """
    end = np.array([END], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = load(tokenizer), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                some = batch.slice(at, 2_000)
                ids = [
                    np.frombuffer(x, "<u4").astype("<u2").tobytes() + end
                    for x in encoder.encode(some.column(1))
                ]
                n = np.array([len(x) // 2 for x in ids], np.int64)
                places = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(places), pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "before", "n", "ids"],
                )

    numbered = documents.select(F.spark_partition_id().alias("part"), F.col(f"`{text}`").cast("string").alias("text"))
    return stage(numbered.mapInArrow(run, "part int, before long, n long, ids binary"), "token-stream", PACKED)


def training_order(
    documents: DataFrame, text: str, tokenizer: str, key: int, length: int = LENGTH, per_shard: int = PER_SHARD
) -> DataFrame:
    """One row per sequence, sorted by slot inside ranges of slots; shards are whole numbers of ranges.

    Columns: slot, shard, at_byte (place in the shard's ids laid end to end), sequence (number in the
    stream), n_tokens, ids_crc32 (of the padded ids) and ids (``length`` little-endian unsigned 16-bit numbers).
    """
    spark = documents.sparkSession
    stream = token_stream(documents, text, tokenizer)
    parts = sorted((r["part"], r["n"]) for r in stream.groupBy("part").agg(F.sum("n").alias("n")).collect())
    total, starts = 0, []
    for part, n in parts:  # one number per task of the table
        starts.append((part, total))
        total += n
    n_sequences = -(-total // length)
    begins = F.broadcast(spark.createDataFrame(starts, "part int, begin long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, at, pieces = [], [], []
            for start, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place, end = start, start + len(ids) // 2
                while place < end:
                    stop = min(end, (place // length + 1) * length)
                    sequence.append(place // length)
                    at.append(place % length)
                    pieces.append(ids[2 * (place - start) : 2 * (stop - start)])
                    place = stop
            slot = slots(np.array(sequence, np.int64), n_sequences, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(sequence, pa.int64()), pa.array(at, pa.int32()), pa.array(pieces, pa.binary())],
                names=["slot", "sequence", "at", "piece"],
            )

    names = ["slot", "shard", "at_byte", "sequence", "n_tokens", "ids_crc32", "ids"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces arrive by slot and place: join those of one slot, which may span two batches."""
        slot, sequence, pieces, done = None, None, [], []

        def close() -> None:
            ids = b"".join(pieces)
            whole = ids + np.full(length - len(ids) // 2, PAD, "<u2").tobytes()
            done.append(
                (slot, slot // per_shard, slot % per_shard * 2 * length, sequence, len(ids) // 2, zlib.crc32(whole), whole)
            )

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in list(zip(*done))[:-1]] + [pa.array([d[-1] for d in done], pa.binary())]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for s, q, piece in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if s != slot and slot is not None:
                    close()
                if s != slot:
                    slot, sequence, pieces = s, q, []
                pieces.append(piece)
                if len(done) >= 1000:
                    yield flush()
        if slot is not None:
            close()
        if done:
            yield flush()

    files = -(-per_shard // PER_FILE)
    per_file = -(-per_shard // files)
    in_shard = F.floor(F.col("slot") % per_shard / per_file)
    range_number = (F.floor(F.col("slot") / per_shard) * files + in_shard).cast("int")
    n_ranges = max(1, -(-n_sequences // per_shard) * files)
    pieces = stream.join(begins, "part").select((F.col("begin") + F.col("before")).alias("start"), "ids")
    return (
        pieces.mapInArrow(cut, "slot long, sequence long, at int, piece binary")
        .repartitionById(n_ranges, range_number)
        .sortWithinPartitions("slot", "at")
        .mapInArrow(assemble, SCHEMA)
    )


def write_shards(ordered: DataFrame, folder: str) -> None:
    """One folder per shard; its files hold one range of slots each, in the order of their slots."""
    rows = ordered.sortWithinPartitions("shard", "slot")  # the writer would sort by shard alone
    rows.write.partitionBy("shard").options(**PACKED).parquet(folder)


def shard_rows(spark, folder: str) -> DataFrame:
    """The rows of all shards as they lie in their files."""
    table = spark.read.schema(SCHEMA).parquet(folder)
    return table.select("slot", "shard", "at_byte", "sequence", "n_tokens", "ids_crc32", "ids")


def read_shards(spark, folder: str, first_slot: int = 0, per_shard: int = PER_SHARD) -> DataFrame:
    """The sequences from ``first_slot`` on; earlier shards are not opened."""
    table = shard_rows(spark, folder)
    return table.filter((F.col("shard") >= first_slot // per_shard) & (F.col("slot") >= first_slot)).orderBy("slot")
