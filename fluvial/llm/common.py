"""What the text operators share: intermediate tables, Arrow batches of text, and word hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvial.checkpoint import materialize, settled, shared_root

__all__ = ["materialize", "settled", "shared_root"]

#: Bytes of text that a Python worker unpacks at once.
SLICE_BYTES = 2 << 20
#: Rows of a batch that goes to a Python worker.
BATCH_ROWS = 1_000
#: Entries at which a worker's word cache starts anew.
CACHE_WORDS = 400_000


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let this session hand Python workers at most so many rows at once: with texts, the default 10,000 fill an executor."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow; what its task has freed goes back to the system at its end. A worker waits for its next task beside others, and allocators would keep it."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns set; an input column of the same name, in any case, gives way."""
    taken = {c.lower() for c in columns}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken), *(v.alias(k) for k, v in columns.items()))


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """Consecutive slices of a batch, each of about `most` bytes: first row and the texts as UTF-8 bytes (None for null)."""
    col = batch.column(column).cast(pa.binary())
    if not len(col):
        return
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 64)
    start = 0
    while start < len(col):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, col.slice(start, stop - start).to_pylist()
        start = stop


class WordHashes(dict):
    """word -> 64-bit hash, computed on first use."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1 for all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, least: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """From batches sorted by key: pieces that hold whole groups, of so many rows at least but for the last, with the start and size of each group."""
    held: list[pa.RecordBatch] = []  # of whole groups and one that may go on
    last = None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and keys[0] != last and sum(map(len, held)) >= least:
            yield _grouped(held, key)
            held = []
        if cut:
            held.append(batch.slice(0, cut))
            if sum(map(len, held)) >= least:
                yield _grouped(held, key)
                held = []
        held.append(batch.slice(cut))
        last = keys[-1]
    if held:
        yield _grouped(held, key)


def _grouped(batches: list[pa.RecordBatch], key: str) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    batch = pa.concat_batches(batches) if len(batches) > 1 else batches[0]
    return _groups(batch, batch.column(key).to_numpy(zero_copy_only=False))


def _groups(batch: pa.RecordBatch, keys: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return batch, starts, np.diff(np.concatenate((starts, [len(keys)])))
