import collections
import hashlib
import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from stellate.llm import token_alignment as t
from stellate.llm.queries import BYTE_LEVEL_TOKENIZER, PIECE_TOKENIZER

NAMES = t.Tokenizers(BYTE_LEVEL_TOKENIZER, P.PATTERN, PIECE_TOKENIZER)
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(BYTE_LEVEL_TOKENIZER)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)


def spelt(tokenizers, text):
    """(id, start, end) of every token of both sides; nothing where a side does not spell the text."""
    left, right = tokenizers
    if not text:
        return [], []
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        symbols[chr(256 + i)] = b
    made = left.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(symbols[c] for c in left.id_to_token(i))) for i in made.ids]
    b = []
    for i in right.encode(text):
        piece = right.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()))
    if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
        return [], []
    sides = []
    for side in (a, b):
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        sides.append(out)
    return sides


def brute(tokenizers, texts):
    found = []
    for text in texts:
        a, b = spelt(tokenizers, text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        said, low = [], 0
        for end in ends:
            said.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)))
            low = end
        found.append((len(a), len(b), len(ends), links, ";".join(said)))
    count = collections.Counter(x for f in found for x in f[3])
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (
            n_a, n_b, n_groups, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(said.encode()).hexdigest() if said else "",
        )
        for n_a, n_b, n_groups, links, said in found
    ]


def texts():
    random.seed(5)
    letters = "abZé ß\n\t  '!<|endoftext|></s><s>0９中😀▁​\r\x0b\x85\xa0ing tion the"
    odd = [None, "", " ", "  a", "a ", "\n", "<|endoftext|>", "<s>x</s>", "▁", "日本語のテキスト", "áé", "x\x00y", "ﬁn ﬀ", "a" * 700]
    return odd + ["".join(random.choice(letters) for _ in range(random.randint(1, 60))) for _ in range(300)]


def test_equals_brute_force(spark, sf_dir, documents, tokenizers):
    given = [r.text[:400] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    pairs = list(enumerate(texts() + given))
    expected = brute(tokenizers, [x for _, x in pairs])
    # Small blocks: the counts of a pair come together from many of them.
    for size in (2_000, t.BLOCK_BYTES):
        found = t.alignments(documents(pairs), "doc_id", "text", NAMES, block_bytes=size)
        rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
        assert [rows[k] for k, _ in pairs] == expected
    assert sum(x[0] > 0 for x in expected) > 150 and sum(x[0] == 0 for x in expected) > 5


def test_groups_are_the_hashed_text(documents):
    df = documents([(1, "Wordless unhappiness, tokenization"), (2, None)])
    said = {r.doc_id: r for r in t.groups(df, "doc_id", "text", NAMES).collect()}
    hashed = {r.doc_id: r for r in t.alignments(df, "doc_id", "text", NAMES).collect()}
    assert hashlib.sha256(said[1].groups.encode()).hexdigest() == hashed[1].groups_sha256
    assert said[1].groups.count(";") == said[1].n_groups - 1 == hashed[1].n_groups - 1
    assert (said[2].groups, hashed[2].groups_sha256, hashed[2].n_links) == ("", "", 0)


def test_words_one_by_one_are_the_pieces_of_the_text():
    random.seed(1)
    letters = ["a", "The", "é", " ", "  ", "\n", "\t", "▁", "\xa0", "\u3000", "日", "ﬁ", "12", "!!", "<s>", "<0x0A>", "\x00", "ing", " of the"]
    texts = ["".join(random.choice(letters) for _ in range(random.randint(1, 20))) for _ in range(5000)] + ["", " "]
    encoders = t.Encoders(NAMES)
    assert encoders.by_words and sum(map(t._one_space, filter(None, texts))) > 500
    assert list(encoders._pieces(texts)) == [encoders.right.encode(x) for x in texts]


def test_long_chains_of_overlaps_end_at_one_terminal():
    import numpy as np

    left = np.append(np.arange(2, 20_001, 2), 20_001)
    right = np.append(np.arange(1, 20_000, 2), 20_001)
    a, b = t.terminals(left, right)
    assert set(a) == set(b) == {len(left) - 1}


def test_awkward_rows_empty_tables_and_clashing_columns(awkward):
    clash = awkward.withColumn("_key", F.lit(1)).withColumn("block", F.lit("x")).withColumn("links", F.lit(2))
    rows = t.alignments(clash, "doc_id", "text", NAMES).collect()
    assert len(rows) == awkward.count()
    same = [tuple(r)[1:] for r in rows if r.doc_id == 5]
    assert same[0] == same[1]
    assert next(r for r in rows if r.doc_id is None).n_a > 0
    long = [r for r in rows if r.doc_id in (6, 7)]
    assert long[0].count_sum == long[1].count_sum and long[0].n_links > 20_000
    for df in (awkward.limit(0), awkward.filter("text IS NULL")):
        assert t.alignments(df, "doc_id", "text", NAMES).count() == df.count()
