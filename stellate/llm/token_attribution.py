"""Token counts per section of a document, from one encoding of the whole document.

A document is a list of sections whose texts, one after the other, are the document. The whole text
is encoded once; the byte spans of its tokens are joined to the spans of the sections. A token that
crosses a boundary goes to one section by a rule: ``first`` gives it to the section of its first
byte, ``most`` to the section with most of its bytes, the earlier one in a tie. So the counts of a
document's sections always sum up to its number of tokens.

A document without sections (NULL text or an empty list) has no rows. Empty sections have no tokens.
Repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("first", "most")

_LOADED: dict = {}


def _encoder(path: str, pattern: str):
    """The tokenizer of this worker and the byte length of each of its tokens."""
    if (path, pattern) not in _LOADED:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _LOADED[path, pattern] = own, lengths
    return _LOADED[path, pattern]


def line_sections(text: Column) -> Column:
    """The lines of a text, each with the line feed that ends it."""
    lines = F.split(text, "\n")
    return F.transform(lines, lambda x, i: F.when(i < F.size(lines) - 1, F.concat(x, F.lit("\n"))).otherwise(x))


def attribute(bounds: np.ndarray, lengths: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each section.

    ``bounds`` holds the first byte of every section and the end of the last one, ``lengths`` the
    bytes of every token.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    # Of sections that begin at one byte all but the last are empty; ``right`` finds that last one.
    first = np.searchsorted(bounds[:-1], starts, "right") - 1
    last = np.searchsorted(bounds[:-1], ends - 1, "right") - 1
    crossing = first != last
    owner = first.copy()
    if rule == "most":
        for k in np.flatnonzero(crossing):
            sections = np.arange(first[k], last[k] + 1)
            shares = np.minimum(bounds[sections + 1], ends[k]) - np.maximum(bounds[sections], starts[k])
            owner[k] = sections[np.argmax(shares)]
    n = len(bounds) - 1
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def section_tokens(
    documents: DataFrame, key: str, sections: Column, tokenizer: str, pattern: str, rule: str = "most"
) -> DataFrame:
    """One row per document and section: key, section, n_chars, n_tokens, n_crossing.

    ``sections`` is an array of strings; ``tokenizer`` the path of a rank file that every worker can
    open, ``pattern`` its splitting pattern.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = documents.select(key).schema[0].dataType.simpleString()
    names = [key, "section", "n_chars", "n_tokens", "n_crossing"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, token_bytes = _encoder(tokenizer, pattern)
        for batch in batches:
            rows, parts = [], []
            for i, own in enumerate(batch.column(1).to_pylist()):
                if not own:
                    continue
                texts = [x or "" for x in own]
                bounds = np.cumsum([0, *(len(x.encode()) for x in texts)])
                ids = np.array(encoding.encode_ordinary("".join(texts)), np.int64)
                counts, crossing = attribute(bounds, token_bytes[ids], rule)
                rows.append(np.full(len(texts), i))
                parts.append((np.arange(len(texts)), np.array([len(x) for x in texts]), counts, crossing))
            if rows:
                columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)]
                took = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(took), *map(pa.array, columns)], names=names)

    schema = f"`{key}` {kind}, section long, n_chars long, n_tokens long, n_crossing long"
    return documents.select(key, sections.alias("sections")).mapInArrow(run, schema)
