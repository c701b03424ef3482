"""Token counts of whole texts by overlap resynchronisation.

A text longer than one chunk is cut into overlapping chunks. Each chunk is encoded by itself into boundaries (offset in
characters, tokens before it); neighbours are spliced at a boundary that both have inside the overlap and that is proven
stable: no pre-token of the byte-level pattern reaches over it and none after it looks back, so the tokens on either side
are those of the whole text. Where an overlap holds no such boundary it is doubled, and once it spans the left chunk the
right one is merged into it. The count is therefore the library's count of the whole text, whatever the chunk size.

Stable is a change from a character that is no white space to an ASCII blank or newline: every alternative of the pattern
takes white space only at its start or is made of white space alone. A character of the added special tokens is never
white space, so these do not reach over it either.

A chunk's stretches between stable boundaries are encoded by the library once and remembered, since words recur.

Nulls count as empty, empty texts have 0 tokens, repeated rows are counted each, extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.llm.common import text_slices

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
#: Stretches remembered by a worker before it starts anew.
REMEMBERED = 900_000

#: White space before a blank or newline: there a stretch goes on over the blank.
_ODD = re.compile(r"\s[ \n]")
_STRETCH = re.compile(r"\s*\S+(?=[ \n])|.+\Z", re.DOTALL)


class _Known(dict):
    """stretch -> tokens, by the library on first use. A key without a newline at its start stands for itself after prefix."""

    def __init__(self, tokenizer, prefix: str):
        super().__init__()
        self.encode, self.prefix = tokenizer.encode, prefix

    def __missing__(self, key: str) -> int:
        text = key if key[:1] == "\n" else self.prefix + key
        value = self[key] = len(self.encode(text, add_special_tokens=False))
        return value


class ChunkEncoder:
    """Counts tokens with a tokenizers library object whose pre-tokenizer is the byte-level pattern."""

    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk_chars, overlap_chars
        self.whole, self.blank = _Known(self.tokenizer, ""), _Known(self.tokenizer, " ")

    def parts(self, text: str) -> tuple[list[str], _Known]:
        """text cut at its stable boundaries, as keys of the dict that has their tokens.

        In the keys of `blank` the blank between two stretches is left out; its first key is a whole stretch.
        """
        if len(self.blank) + len(self.whole) > REMEMBERED:
            self.blank.clear()
            self.whole.clear()
        if _ODD.search(text):
            return _STRETCH.findall(text), self.whole
        return text.replace("\n", " \n").split(" "), self.blank

    def tokens(self, text: str) -> int:
        """Tokens of a text of one chunk."""
        parts, known = self.parts(text)
        if known is self.blank:
            first = parts.pop(0)
            return (self.whole[first] if first else 0) + sum(map(known.__getitem__, parts))
        return sum(map(known.__getitem__, parts))

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Encode one chunk: offsets of its stretch ends, and the tokens up to each."""
        parts, known = self.parts(text)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        if known is self.whole:
            counts = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
        else:
            lengths[1:] += np.fromiter((p[:1] != "\n" for p in parts[1:]), np.int64, len(parts) - 1)
            counts = np.zeros(len(parts), np.int64)
            counts[0] = self.whole[parts[0]] if parts[0] else 0
            counts[1:] = np.fromiter(map(known.__getitem__, parts[1:]), np.int64, len(parts) - 1)
        return np.cumsum(lengths), np.cumsum(counts)

    def huge(self, text: str) -> int:
        """Tokens of a text of more than one chunk."""
        size, total = len(text), 0
        base, left_to = 0, min(self.chunk, len(text))  # the left chunk; all before base is counted
        ends, counts = self.boundaries(text[base:left_to])
        while left_to < size:
            overlap = self.overlap
            while True:
                right_from = max(base, left_to - overlap)
                right_to = min(size, left_to + self.chunk)
                r_ends, r_counts = self.boundaries(text[right_from:right_to])
                # The last end is the chunk's cut and not a boundary of the text.
                common = np.intersect1d(ends[:-1] + base, r_ends[:-1] + right_from)
                common = common[common > right_from]
                if len(common):
                    cut = int(common[-1])
                    at_left = int(np.searchsorted(ends, cut - base))
                    at_right = int(np.searchsorted(r_ends, cut - right_from))
                    total += int(counts[at_left])
                    ends, counts = r_ends[at_right + 1 :] + right_from - cut, r_counts[at_right + 1 :] - r_counts[at_right]
                    base, left_to = cut, right_to
                    break
                if right_from == base:  # no boundary in all of the left chunk: it grows by the right one
                    ends, counts, left_to = r_ends, r_counts, right_to
                    break
                overlap *= 2
        return total + (int(counts[-1]) if len(counts) else 0)

    def count(self, texts: list[str]) -> list[int]:
        return [self.huge(t) if len(t) > self.chunk else self.tokens(t) for t in texts]


_encoders: dict[tuple, ChunkEncoder] = {}


def _encoder(path: str | None, name: str, chunk: int, overlap: int) -> ChunkEncoder:
    """One for each worker process; without a path the file is looked up by name where the worker runs."""
    key = (path, name, chunk, overlap)
    if key not in _encoders:
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _encoders[key] = ChunkEncoder(path, chunk, overlap)
    return _encoders[key]


def count_tokens(docs: DataFrame, *, name: str = "byte_bpe_50k.json", path: str | None = None, limit: int = 512,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, name, chunk_chars, overlap_chars)
        for batch in batches:
            for at, texts in text_slices(batch):
                counts = encoder.count([(t or b"").decode() for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
