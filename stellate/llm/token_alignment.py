"""Alignment of the tokens of two tokenizers over the same bytes, by pointer jumping.

Every token points to the token of the other tokenizer that reaches farthest to the right among those
it overlaps. Both tokens that end at a common offset point to one of the two, which is terminal. The
pointers of a whole block of documents are doubled (``succ = succ[succ]``) until they rest: each token
then names the terminal token of its group, after as many rounds as the logarithm of the longest chain.

Every offset where a token of either side ends closes one overlap of two tokens, so the links of a
document are the union of both sides' ends. How often two ids are linked in the whole corpus is
counted from blocks: documents are dealt to blocks of bounded size, a block holds each of its id
pairs once, and the pairs' counts travel back to blocks, not to documents or links. A frequent pair
therefore has one row a block, and no table of pairs is broadcast. The block of a document is a row
of a staged table, so a lost executor does not change it.

A document has no tokens if its text is NULL or empty, or if either side's tokens do not spell a space
and the text (a tokenizer that normalises, say); its numbers are zero and its groups the empty
string. Repeated rows, rows with equal or NULL keys and extra columns are of no account: every row is
aligned by itself. Texts are encoded whole; a text longer than ``BLOCK_BYTES`` is a block of its own.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.frames import free_name
from stellate.sources.staging import stage

#: A block of documents is closed when its texts have so many bytes.
BLOCK_BYTES = 4 << 20
#: Texts of so many bytes are aligned at a time; longer ones alone.
ALIGNED_BYTES = 1 << 18
#: Words whose pieces a worker keeps, and the characters of the longest one kept.
KEPT_WORDS, KEPT_CHARS = 200_000, 40
#: Pieces of the second tokenizer; an id pair is one number, ``a * PIECES + b``.
PIECES = 1 << 24


@dataclass(frozen=True)
class Tokenizers:
    """A byte-level BPE file (JSON), its split pattern, and a SentencePiece model."""

    byte_level: str
    pattern: str
    pieces: str


def _one_space(text: str) -> bool:
    return "  " not in text and "▁" not in text and " " not in (text[0], text[-1])


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoders:
    """Both tokenizers of one worker, with the bytes of every id."""

    def __init__(self, names: Tokenizers):
        import sentencepiece
        import tiktoken

        with open(names.byte_level, encoding="utf-8") as file:
            described = json.load(file)
        symbols = _byte_of_symbol()
        special = {t["content"] for t in described.get("added_tokens", ())}
        # Ids of such a vocabulary are in the order of the merges, which is what ranks are.
        ranks = {
            bytes(symbols[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special
        }
        self.left = tiktoken.Encoding("left", pat_str=names.pattern, mergeable_ranks=ranks, special_tokens={})
        self.right = sentencepiece.SentencePieceProcessor(model_file=names.pieces)
        self.left_sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.left_sizes[i] = len(token)
        self.right_bytes = [
            bytes([int(p[3:-1], 16)]) if self.right.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.right.id_to_piece(i)) for i in range(self.right.get_piece_size()))
        ]
        self.right_sizes = np.array([len(b) for b in self.right_bytes], np.int64)
        pieces = (self.right.id_to_piece(i) for i in range(self.right.get_piece_size()))
        self.by_words = not any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, list[int]] = {}
        size = max(len(self.left_sizes), len(self.right_sizes))
        #: Every id as text before a comma, a bar and a semicolon.
        self.said = [f"{i}{mark}" for i in range(size) for mark in ",|;"]

    def _pieces(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of the second side. No piece goes on behind a space, so the words of a text that has one
        space between any two are encoded one by one, each different word once."""
        words = [t.split(" ") if self.by_words and t and _one_space(t) else None for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        fresh = list(set(chain.from_iterable(w for w in words if w)).difference(self.known))
        own = dict(zip(fresh, self.right.encode(fresh, num_threads=1)))
        self.known.update(own)
        for text, split in zip(texts, words):
            if split is None:
                yield self.right.encode(text)
            else:
                yield list(chain.from_iterable(map(self.known.__getitem__, split)))
        for word in own:
            if len(word) > KEPT_CHARS:
                del self.known[word]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for every text; two empty lists where a side does not spell the text."""
        out = []
        for text, b in zip(texts, self._pieces(texts)):
            raw = (" " + text).encode()
            a = self.left.encode_ordinary(" " + text)
            spelt = text and b"".join(map(self.right_bytes.__getitem__, b)) == raw and self.left.decode_bytes(a) == raw
            out.append((a, b) if spelt else ([], []))
        return out


_LOADED: dict[Tokenizers, Encoders] = {}


def _encoders(names: Tokenizers) -> Encoders:
    if names not in _LOADED:
        _LOADED[names] = Encoders(names)
    return _LOADED[names]


def terminals(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token (an index into ``left``) of every token, from the ends of all tokens.

    Both arrays rise strictly and have the last end in common.
    """
    n = len(left)
    to_right, to_left = np.searchsorted(right, left), np.searchsorted(left, right)
    closed = right[to_right] == left
    succ = np.concatenate([np.where(closed, np.arange(n), n + to_right), to_left])
    while True:
        farther = succ[succ]
        if np.array_equal(farther, succ):
            return succ[:n], succ[n:]
        succ = farther


@dataclass
class Aligned:
    """One block of documents; arrays of tokens run over all its documents."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray  #: id pairs as numbers, in order
    said: list[str]  #: the groups of every document as text


def align_block(texts: list[str], encoders: Encoders) -> Aligned:
    pairs = encoders.encode(texts)
    n_a, n_b = (np.array([len(p[k]) for p in pairs], np.int64) for k in (0, 1))
    a, b = (np.fromiter(chain.from_iterable(p[k] for p in pairs), np.int64) for k in (0, 1))
    if not len(a):
        none = np.zeros(len(texts), np.int64)
        return Aligned(none, none, none, none, a, [""] * len(texts))
    # All documents on one line: a document ends with a common offset, so no group leaves it.
    ends_a, ends_b = np.cumsum(encoders.left_sizes[a]), np.cumsum(encoders.right_sizes[b])
    group_a, group_b = terminals(ends_a, ends_b)
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)

    first_a = np.concatenate([[0], np.cumsum(n_a)])
    document = np.repeat(np.arange(len(texts)), n_a)
    n_links = np.bincount(document[at_a], minlength=len(texts))
    n_groups = np.bincount(document[np.append(group_a[1:] != group_a[:-1], True)], minlength=len(texts))

    # Groups rise along both sides: a token stands behind its own side and the other side's earlier groups.
    words = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
    words[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 3 * a + last_a
    words[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = 3 * b + 2 * last_b
    bounds = first_a + np.concatenate([[0], np.cumsum(n_b)])
    said = [
        "".join(map(encoders.said.__getitem__, words[x:y].tolist()))[:-1] for x, y in zip(bounds.tolist(), bounds[1:].tolist())
    ]
    return Aligned(n_a, n_b, n_groups, n_links, a[at_a] * PIECES + b[at_b], said)


def _steps(codes: np.ndarray) -> bytes:
    """Rising numbers as the steps between them, in bytes; 255 stands for a step that goes on."""
    steps = np.diff(codes, prepend=0)
    size = steps // 255 + 1
    out = np.full(int(size.sum()), 255, np.uint8)
    out[np.cumsum(size) - 1] = steps % 255
    return out.tobytes()


def _blocks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of documents, in blocks."""
    keys, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text or ""
            keys.append(key)
            texts.append(text)
            held += len(text) + 64
            if held >= size:
                yield keys, texts
                keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


def groups(documents: DataFrame, key: str, text: str, names: Tokenizers) -> DataFrame:
    """Per document: its key, n_a, n_b, n_groups, n_links and its groups as ``a1,a2|b1;a3|b2,b3``."""
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, `groups` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(names)
        for keys, texts in _blocks_of(batches, ALIGNED_BYTES):
            x = align_block(texts, encoders)
            columns = [pa.array([k.as_py() for k in keys], keys[0].type), *map(pa.array, (x.n_a, x.n_b, x.n_groups, x.n_links, x.said))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_a", "n_b", "n_groups", "n_links", "groups"])

    return documents.select(key, text).mapInArrow(run, schema)


_DOCUMENT = "n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string"


def _blocks(documents: DataFrame, key: str, text: str, names: Tokenizers, size: int) -> DataFrame:
    """One row a block: its documents, their links as steps over its pairs, its pairs and their counts."""
    kind = documents.schema[key].dataType.simpleString()
    schema = f"block string, documents array<struct<key:{kind},{_DOCUMENT}>>, links binary, pairs binary, times binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(names)
        keys, parts, digests, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            n_links = np.concatenate([x.n_links for x in parts])
            pairs, place, times = np.unique(np.concatenate([x.links for x in parts]), return_inverse=True, return_counts=True)
            steps = [_steps(np.sort(own)) for own in np.split(place, np.cumsum(n_links)[:-1])]
            fields = {
                "key": pa.array([k.as_py() for k in keys], keys[0].type),
                **{c: pa.array(np.concatenate([getattr(x, c) for x in parts])) for c in ("n_a", "n_b", "n_groups")},
                "n_links": pa.array(n_links), "groups_sha256": pa.array(digests, pa.string()),
            }
            own = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
            columns = [
                pa.array([uuid.uuid4().hex]),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), own),
                *(pa.array([v], pa.binary()) for v in (b"".join(steps), pairs.tobytes(), times.astype(np.int64).tobytes())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "documents", "links", "pairs", "times"])

        for some, texts in _blocks_of(batches, min(size, ALIGNED_BYTES)):
            x = align_block(texts, encoders)
            digests += [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in x.said]
            x.said = []
            keys += some
            parts.append(x)
            held += sum(map(len, texts)) + 64 * len(texts)
            if held >= size:
                yield row()
                keys, parts, digests, held = [], [], [], 0
        if keys:
            yield row()

    return stage(documents.select(key, text).mapInArrow(run, schema), "alignment-blocks")


def _block_pairs(blocks: DataFrame) -> DataFrame:
    """Rows (block, a, b, n): every id pair of a block and its links there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, times in zip(*(batch.column(i).to_pylist() for i in range(3))):
                codes, n = np.frombuffer(pairs, np.int64), np.frombuffer(times, np.int64)
                columns = [pa.array([block] * len(codes), pa.string()), *map(pa.array, (codes // PIECES, codes % PIECES, n))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "a", "b", "n"])

    return blocks.select("block", "pairs", "times").mapInArrow(run, "block string, a long, b long, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Per id pair (a, b): its links in the corpus, and whether b has no pair with more."""
    counts = stage(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "alignment-pairs")
    # One row for each id of the second vocabulary at most.
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def alignments(documents: DataFrame, key: str, text: str, names: Tokenizers, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: its key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose id pair is as frequent in the corpus as any with the same second
    id; ``count_sum`` adds the corpus counts over the links.
    """
    blocks = _blocks(documents, key, text, names, block_bytes)
    pairs = _block_pairs(blocks)
    told = pairs.select("block", "a", "b").join(pair_counts(pairs), ["a", "b"])
    kind = documents.schema[key].dataType.simpleString()
    out = free_name(documents, "_key")
    schema = f"`{out}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def settle(block: pa.Table, known: pa.Table) -> pa.Table:
        own = block.column("documents").combine_chunks().flatten()
        fields = {f.name: own.field(f.name) for f in own.type}
        a, b, count, best = (known.column(c).to_numpy() for c in ("a", "b", "count", "best"))
        order = np.argsort(a * PIECES + b)
        count, best = count[order], best[order].astype(np.int64)
        # Every document has a run of steps of its own, with one byte below 255 for each link.
        sizes = fields["n_links"].to_numpy()
        data = np.frombuffer(block.column("links")[0].as_py(), np.uint8)
        ends = np.flatnonzero(data != 255)
        first = np.concatenate([[0], np.cumsum(sizes)])
        total = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
        starts = np.concatenate([[0], ends + 1])[first[:-1]]
        place = total[ends + 1] - np.repeat(total[starts], sizes)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        n_best, count_sum = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        np.add.at(n_best, rows, best[place])
        np.add.at(count_sum, rows, count[place])
        columns = [fields["key"], *(fields[c] for c in ("n_a", "n_b", "n_groups", "n_links"))]
        columns += [pa.array(n_best), pa.array(count_sum), fields["groups_sha256"]]
        names_ = [out, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return pa.Table.from_arrays(columns, names=names_)

    settled = (
        blocks.select("block", "documents", "links").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(settle, schema)
    )
    return settled.withColumnRenamed(out, key)
