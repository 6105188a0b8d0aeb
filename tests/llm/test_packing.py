import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stellate.llm import packing
from stellate.llm.word_tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("block", [50, 10_000])
def test_few_bins_and_every_piece(spark, block):
    r = random.Random(4)
    sizes = [r.choice((r.randint(1, 40), r.randint(30, 70), 100)) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, length long")
    out = packing.pack(df, capacity=100, block=block).collect()
    assert sorted((x.id, x.length) for x in out) == list(enumerate(sizes))
    assert check(out, 100) <= -(-sum(sizes) // 100) * 1.02 + 1


def test_evolution_beats_best_fit():
    r = random.Random(3)
    sizes, capacity = [], 1000
    for _ in range(30):  # bins that can be filled exactly
        a = r.randint(200, 480)
        b = r.randint(200, 480)
        sizes += [a, b, capacity - a - b]
    sizes.sort(reverse=True)
    first = packing.best_fit([], list(range(len(sizes))), sizes, capacity)
    population = [first] + [packing._mutate(first, sizes, capacity, r) for _ in range(5)]
    best = packing._evolve(population, sizes, capacity, r, 60)[0]
    assert len(best) <= len(first)
    assert packing._worth(best, sizes) > packing._worth(first, sizes)
    assert sorted(i for own in best for i in own) == list(range(len(sizes)))


def test_pieces_equal_the_tokenizer(spark, sf_dir, documents):
    odd = [(-1, None), (-2, ""), (-3, "İSTANBUL ΟΔΟΣ Οδός don't I'LL ½ 12 !!! a.b,c—d\x1cx ​　y é"), (-4, "word " * 9000)]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).collect()
    texts = dict([*odd, *((r.doc_id, r.text) for r in rows)])
    pieces = packing.token_pieces(documents(list(texts.items())), "doc_id", "text", PATH).collect()
    whole = Tokenizer.from_file(PATH)
    expected = set()
    for k, t in texts.items():
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for i, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a : a + 4096]
            expected.add((k, i, a, len(part), zlib.crc32(part.tobytes())))
    assert {tuple(p) for p in pieces} == expected


def test_random_texts_equal_the_tokenizer():
    """Special tokens, marks, digits, other scripts and every kind of white space, next to each other."""
    whole, r = Tokenizer.from_file(PATH), random.Random(3)
    letters = [
        "a", "B", "z", "É", "e\u0301", "\u0301", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "'s", "'LL", "don't", "½", "1", "!!!",
        ".,", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "İ", "ΟΔΟΣ", "中", "😀", "\u200b", "ﬁ", "|", "Ǆ", "\x00",
    ]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(4000)] + ["", None, "x" * 3000 + " " + "y" * 100]
    found = WordTokenizer(PATH).encode(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    assert sum(49407 in np.frombuffer(x, "<u4") for x in found) > 100


def test_a_full_table_starts_anew(monkeypatch):
    from stellate.llm import word_tokens

    monkeypatch.setattr(word_tokens, "KEPT_PIECES", 50)
    monkeypatch.setattr(word_tokens, "CHUNK_BYTES", 200)
    whole, encoder = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    texts = [f"word{i} other{i * 7}, {'long' * 30}{i}" for i in range(200)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 100


def test_evolution_saves_sequences_over_best_fit(spark):
    r = random.Random(3)
    sizes = []
    for _ in range(40):  # sequences that can be filled exactly
        a, b = r.randint(200, 480), r.randint(200, 480)
        sizes += [a, b, 1000 - a - b]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, length long")
    made = {}
    for epochs in (0, 4):
        out = packing.pack(df, capacity=1000, epochs=epochs, generations=80, population=10).collect()
        made[epochs] = check(out, 1000)
    assert made[4] < made[0]


def test_clashing_columns_stay(spark):
    names = ["block", "bin", "filled", "place", "row", "island", "sizes", "best"]
    df = spark.createDataFrame([(i, 10 + i, *range(8)) for i in range(30)], "id long, length long, " + ", ".join(f"{n} int" for n in names))
    out = packing.pack(df.withColumn("offset", df.id * 1000), capacity=100, block=10)
    assert out.columns == [*df.columns, "sequence_id", "offset"]
    assert {tuple(r[n] for n in names) for r in out.collect()} == {tuple(range(8))}
    assert check(out.collect(), 100) >= 8


def test_awkward_and_empty(awkward):
    pieces = packing.token_pieces(awkward, "doc_id", "text", PATH)
    out = packing.pack(pieces).collect()
    assert len(out) == pieces.count()
    check(out, 4096)
    assert packing.pack(packing.token_pieces(awkward.limit(0), "doc_id", "text", PATH)).count() == 0


def test_repeated_rows_are_dealt_over_blocks(spark):
    rows = [(None, 0, 0, 50, 7)] * 600
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start int, length int, ids_crc32 long")
    out = packing.pack(pieces, capacity=100, block=50).collect()
    assert len(out) == 600 and check(out, 100) <= 312
    assert max(Counter(r.sequence_id >> 20 for r in out).values()) <= 100
