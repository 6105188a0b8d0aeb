import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stellate.llm import token_attribution as ta
from stellate.llm import training_order as to
from stellate.llm.queries import op9_training_order
from stellate.llm.word_tokens import load

BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_boundary_rules():
    bounds, lengths = np.array([0, 4, 4, 5, 10]), np.array([3, 3, 1, 3])
    # Tokens cover 0-3, 3-6, 6-7, 7-10; the second crosses into sections 2 and 3.
    assert [x.tolist() for x in ta.attribute(bounds, lengths, "first")] == [[2, 0, 0, 2], [1, 0, 0, 0]]
    assert [x.tolist() for x in ta.attribute(bounds, lengths, "most")] == [[2, 0, 0, 2], [1, 0, 0, 0]]
    assert ta.attribute(np.array([0, 1, 4]), np.array([4]), "most")[0].tolist() == [0, 1]


@pytest.mark.parametrize("rule", ta.RULES)
def test_counts_equal_brute_force(spark, rule):
    docs = [(1, ["Hel", "lo wor", "ld", "", " é\n", "\n\nzz"]), (2, []), (3, None), (4, [""]), (5, [None, "a b"])]
    df = spark.createDataFrame(docs, "doc_id long, parts array<string>")
    found = {}
    for r in ta.section_tokens(df, "doc_id", F.col("parts"), *BYTES, rule=rule).collect():
        found.setdefault(r.doc_id, []).append(r.n_tokens)
    encoding, _ = ta._encoder(*BYTES)
    expected = {}
    for k, parts in docs:
        if not parts:
            continue
        owner = list(itertools.chain.from_iterable([i] * len((p or "").encode()) for i, p in enumerate(parts)))
        counts, at = [0] * len(parts), 0
        for token in encoding.encode_ordinary("".join(p or "" for p in parts)):
            own = owner[at : at + len(encoding.decode_single_token_bytes(token))]
            at += len(own)
            best = own[0] if rule == "first" else min(set(own), key=lambda i: (-own.count(i), i))
            counts[best] += 1
        expected[k] = counts
    assert found == expected


def test_lines_of_documents_sum_up(spark, sf_dir, awkward):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = ta.section_tokens(docs, "doc_id", ta.line_sections(F.col("text")), *BYTES)
    sums = {r.doc_id: r.n for r in counted.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    encoding, _ = ta._encoder(*BYTES)
    assert sums == {r.doc_id: len(encoding.encode_ordinary(r.text)) for r in docs.collect()}
    lines = ta.section_tokens(awkward, "doc_id", ta.line_sections(F.col("text")), *BYTES)
    assert lines.filter("doc_id = 1").count() == 0 and lines.filter("doc_id = 2").first().n_tokens == 0
    assert ta.section_tokens(awkward.limit(0), "doc_id", ta.line_sections(F.col("text")), *BYTES).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_slots_are_a_keyed_permutation(n):
    one, two = (to.slots(np.arange(n), n, key) for key in (1, 2))
    assert sorted(one) == sorted(two) == list(range(n))
    if n > 16:
        assert (one != two).any() and (one != np.arange(n)).mean() > 0.9


def test_training_order_round_trip(spark, sf_dir, awkward, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").unionByName(awkward.select("text"))
    rows = to.training_order(docs, "text", WORDS, key=5, length=256, per_shard=100)
    got = rows.orderBy("sequence").collect()
    assert [r.sequence for r in got] == list(range(len(got)))
    assert sorted(r.slot for r in got) == list(range(len(got)))
    for r in got:
        assert len(r.ids) == 512 and r.ids_crc32 == zlib.crc32(r.ids)
        assert (r.shard, r.at_byte) == (r.slot // 100, r.slot % 100 * 512)
    stream = np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u2")[: sum(r.n_tokens for r in got)]
    texts = [r.text or "" for r in docs.collect()]
    expected = sorted(np.append(np.frombuffer(i, "<u4"), 1).astype("<u2").tobytes() for i in load(WORDS).encode(texts))
    assert len(stream) == sum(len(x) // 2 for x in expected)
    # Parts of the table follow each other, so every document stands in one run of the stream.
    whole = stream.tobytes()
    assert all(x in whole for x in expected)
    to.write_shards(rows, f"{tmp_path}/shards")
    tail = to.read_shards(spark, f"{tmp_path}/shards", first_slot=150, per_shard=100).collect()
    assert [r.slot for r in tail] == list(range(150, len(got)))


def test_training_order_of_nothing(spark):
    assert to.training_order(spark.createDataFrame([], "text string"), "text", WORDS, key=1).count() == 0


def test_query_returns_rows_of_written_shards(spark, tmp_path, documents):
    docs = documents([(i, f"some words of document {i} " * 400) for i in range(60)] + [(60, None)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = op9_training_order(spark, str(tmp_path))
    files = out.inputFiles()
    assert files and all("/training-shards-" in f and "/shard=" in f for f in files)
    again = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = to.training_order(again, "text", WORDS, key=2024)
    assert out.columns == rows.columns and out.dtypes == rows.dtypes
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))


def test_files_hold_ordered_ranges_inside_a_shard(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(to, "PER_FILE", 40)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    to.write_shards(to.training_order(docs, "text", WORDS, key=5, length=256, per_shard=100), f"{tmp_path}/shards")
    n = to.shard_rows(spark, f"{tmp_path}/shards").count()
    found = []
    for shard in sorted(tmp_path.glob("shards/shard=*"), key=lambda p: int(p.name[6:])):
        for file in sorted(shard.glob("*.parquet")):
            found.append(pq.ParquetFile(file).read(["slot"]).column(0).to_pylist())
    assert n > 200 and sum(found, []) == list(range(n))
    assert all(f[0] % 100 % 34 == 0 and len(f) <= 34 for f in found)


def test_stream_and_shards_are_written_packed(spark, documents, tmp_path):
    """Together with the shuffle they have to stay below three times the input."""
    rng = random.Random(3)
    words = [rng.choice("abcdefgh") * rng.randrange(1, 5) + str(i) for i in range(300)]
    docs = documents([(i, " ".join(rng.choice(words) for _ in range(800))) for i in range(40)])
    stream = to.token_stream(docs, "text", WORDS)
    to.write_shards(to.training_order(docs, "text", WORDS, key=5), f"{tmp_path}/shards")
    ids = 2 * stream.agg(F.sum("n")).first()[0]
    for files in (stream.inputFiles(), to.shard_rows(spark, f"{tmp_path}/shards").inputFiles()):
        footers = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
        groups = [m.row_group(i) for m in footers for i in range(m.num_row_groups)]
        packed = [g.column(i) for g in groups for i in range(g.num_columns) if g.column(i).path_in_schema == "ids"]
        assert packed and {c.compression for c in packed} == {"ZSTD"}
        assert sum(c.total_compressed_size for c in packed) < 0.75 * ids
