"""Token ids of whole texts from a tokenizer that never looks across white space.

Texts are lowered and cut at ASCII white space by Arrow kernels, and the pieces of many texts become
one dictionary. Only pieces that a worker has not met are encoded, thousands of them as one text; the
ids of all texts are then gathered from the dictionary's ids by their places. This gives the ids of the
whole text for tokenizers that lower their input, drop white space and split at it; tests compare
both on given and on random texts. A text that holds a special token's string is encoded as a whole,
since the tokenizer cuts it there before anything else.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept per worker; the table starts anew beyond that.
KEPT_PIECES = 600_000
#: Longer pieces (bytes) are not kept.
KEPT_BYTES = 64
#: Texts of so many bytes are cut into pieces at a time.
CHUNK_BYTES = 4 << 20
#: New pieces that are encoded as one text.
TOGETHER = 2_000
#: ASCII letters are one word; before a run of ASCII marks the tokenizer always splits.
_LETTERS = re.compile(rb"[a-z]+")
_MARKED = re.compile(rb"(.*[a-z])([.,!?*%$&#|;:]+)", re.DOTALL)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[0], starts[0] + 1 ... for each run of the given size, one run after the other."""
    stops = np.cumsum(sizes)
    return np.repeat(starts - (stops - sizes), sizes) + np.arange(int(stops[-1]) if len(stops) else 0)


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # In the lowered pieces of a text without special tokens, their strings are ordinary text.
        self.plain.encode_special_tokens = True
        added = self.whole.get_added_tokens_decoder().values()
        self.special = "|".join(re.escape(t.content) for t in added if t.special)
        # Tokens that end a word; a piece of ASCII letters is one word.
        suffix = getattr(self.whole.model, "end_of_word_suffix", None) or ""
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab().items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self._forget()

    def _forget(self) -> None:
        #: Piece to its number; the ids of number i are ``pool[start[i] : start[i] + size[i]]``.
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(0, "<u4")
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.start)
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.pool = np.concatenate([self.pool, ids])
        self.known.update(zip(pieces, range(first, first + len(pieces))))

    def encode(self, texts: Iterable[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; none for NULL."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
        texts = pc.fill_null(texts, "")
        out: list[bytes] = []
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        low = 0
        while low < len(texts):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + CHUNK_BYTES)))
            out += self._chunk(texts.slice(low, high - low))
            low = high
        return out

    def _chunk(self, texts: pa.Array) -> list[bytes]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = split.flatten().dictionary_encode()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        numbers = self._numbers(words.dictionary.cast(pa.binary()).to_pylist())
        own = numbers[words.indices.to_numpy(zero_copy_only=False)]
        sizes = self.size[own]
        raw = self.pool[_runs(self.start[own], sizes)].tobytes()
        cuts = 4 * np.concatenate([[0], np.cumsum(sizes)])[bounds]
        out = [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        if self.special:
            marked = pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(marked).tolist():
                found = self.whole.encode(texts[i].as_py(), add_special_tokens=False)
                out[i] = np.array(found.ids, "<u4").tobytes()
        if len(self.known) > KEPT_PIECES or len(self.start) > 2 * KEPT_PIECES:
            self._forget()
        return out

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece; a long piece only has one for this call."""
        known = self.known
        fresh = [p for p in pieces if p not in known]
        marked = {p: m.groups() for p in fresh if (m := _MARKED.fullmatch(p))}
        parts = {p for p in fresh if p not in marked}.union(*marked.values())
        self._learn([p for p in parts if p not in known])
        if marked:
            both = np.array([known[x] for pair in marked.values() for x in pair], np.int64)
            sizes = self.size[both]
            self._add(list(marked), self.pool[_runs(self.start[both], sizes)], sizes.reshape(-1, 2).sum(axis=1))
        found = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        for p in {*fresh, *parts}:
            if len(p) > KEPT_BYTES:
                known.pop(p, None)
        return found

    def _learn(self, parts: list[bytes]) -> None:
        words = [p for p in parts if _LETTERS.fullmatch(p)] if self.ends.any() else []
        plain = set(words)
        for i in range(0, len(words), TOGETHER):
            some = words[i : i + TOGETHER]
            found = self.plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                self._add(some, ids, np.diff(stops, prepend=0))
            else:
                plain.difference_update(some)
        rest = sorted((p for p in parts if p not in plain), key=len)
        for i in range(0, len(rest), TOGETHER):
            some = [p.decode("utf-8", "replace") for p in rest[i : i + TOGETHER]]
            starts = np.cumsum([0, *(len(x) + 1 for x in some[:-1])])
            found = self.plain.encode(" ".join(some), add_special_tokens=False)
            owner = np.searchsorted(starts, np.array([a for a, _ in found.offsets], np.int64), side="right") - 1
            self._add(rest[i : i + TOGETHER], np.array(found.ids, "<u4"), np.bincount(owner, minlength=len(some)))


_LOADED: dict[str, WordTokenizer] = {}


def load(path: str) -> WordTokenizer:
    """The tokenizer of this worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
