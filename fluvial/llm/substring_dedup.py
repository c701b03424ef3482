"""Substring deduplication by content-defined chunking.

A gear rolling hash runs over the bytes of each text: h = 2 h + G[byte], so its low bits depend on the last few bytes only. A
chunk ends where the low `MASK_BITS` bits are zero (32 bytes on average) or at `MOST_BYTES`. Where it ends depends on the content
nearby alone, so after an insertion the chunks fall into step again. Each chunk is known together with the one before it, by a 128-bit
digest of the bytes of both (of a text's first chunk alone); the first occurrence, by (doc_id, place), of each such link is the one
that is kept, and the others are repeats.

Single chunks are short enough to repeat by chance, and neighbours that repeat in different documents are no passage: a link repeats
only where two chunks stand together elsewhere too. A repeated passage is a run of consecutive repeated links that can have at
least `LEAST_WORDS` words: those of its chunks, at least `SURE_WORDS`, with those of the chunks on either side, in which the
passage begins and ends. Repeats inside one document count as well.

The digests are counted with map-side combining, and chunks meet their digest's count in a join that Spark can split, so a
chunk that a third of all documents have is no hot spot. What is grouped by document is its own chunks only.

Null and empty texts have no chunks. Null ids are smaller than any other and count as one document, as do rows that share an id; a row's
chunks are then repeats of the other's. Extra columns are ignored; empty tables give empty results. Texts are chunked whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fluvial.llm.common import materialize, text_slices

MASK_BITS = 5
MOST_BYTES = 512
LEAST_WORDS = 50
SURE_WORDS = 16
#: Bytes that the masked bits depend on is MASK_BITS; the rolling state is read above them, so that a cut sees this many.
SPAN = 16
#: A random number for each byte.
GEAR = np.random.default_rng(0x6EA5).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of data, ascending, the last its length.

    h after byte i is the sum of G[byte i - j] << j. Its top bits hold SPAN bytes and more; they are found for all i at
    once by doubling: the sum over 2 m bytes is that over m bytes plus that of the m bytes before, shifted by m.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    h = GEAR[np.frombuffer(data, np.uint8)]
    m = 1
    while m < SPAN:
        h[m:] = h[m:] + (h[:-m] << np.uint32(m))
        m *= 2
    # Bits SPAN - MASK_BITS to SPAN - 1: the sum's terms of up to SPAN bytes reach them.
    ends = np.flatnonzero((h >> np.uint32(SPAN - MASK_BITS)) & np.uint32((1 << MASK_BITS) - 1) == 0) + 1
    ends = np.unique(np.append(ends, n))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > MOST_BYTES:
        extra = [np.arange(e - g + MOST_BYTES, e, MOST_BYTES) for e, g in zip(ends[gaps > MOST_BYTES].tolist(), gaps[gaps > MOST_BYTES].tolist(), strict=True)]
        ends = np.unique(np.concatenate([ends, *extra]))
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, seq (from 0), digest (of the chunk with the one before it), first (offset in bytes of both), last (excluded), words (of the chunk), and of its neighbours: words_before, words_before_2, words_after."""
    names = ["doc_id", "seq", "digest", "first", "last", "words", "words_before", "words_before_2", "words_after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for at, texts in text_slices(batch):
                doc, parts, digests = [], [], []
                for i, text in enumerate(texts):
                    if not text:
                        continue
                    ends = cuts(text)
                    starts = np.concatenate(([0], ends[:-1]))
                    before = np.concatenate(([0], starts[:-1]))
                    digests.append(digest(text[: ends[0]], seed=1))
                    digests += [digest(text[a:b]) for a, b in zip(before[1:].tolist(), ends[1:].tolist(), strict=True)]
                    blank = np.frombuffer(text, np.uint8)
                    blank = (blank == 32) | ((blank >= 9) & (blank <= 13))
                    begins = ~blank
                    begins[1:] &= blank[:-1]
                    words = np.add.reduceat(begins.astype(np.int32), starts)
                    padded = np.concatenate(([0, 0], words, [0]))
                    doc.append(np.full(len(ends), at + i))
                    parts.append(np.stack([np.arange(len(ends)), before, ends, words, padded[1:-2], padded[:-3], padded[3:]]))
                if not doc:
                    continue
                seq, first, last, *counts = np.concatenate(parts, axis=1)
                ids = batch.column("doc_id").take(pa.array(np.concatenate(doc)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(seq.astype(np.int32)), pa.array(digests, pa.binary()), pa.array(first.astype(np.int64)), pa.array(last.astype(np.int64)), *(pa.array(x.astype(np.int32)) for x in counts)], names
                )

    schema = "doc_id long, seq int, digest binary, first long, last long, words int, words_before int, words_before_2 int, words_after int"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS, sure_words: int = SURE_WORDS) -> DataFrame:
    """doc_id, first, last (offsets in bytes of a repeated passage, last excluded), words, removed_words (of its chunks, without the kept occurrences)."""
    rows = chunks(docs)
    here = F.struct("doc_id", "seq")
    repeats = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(here).alias("kept")).where("n > 1")
    repeats = materialize(repeats.select("digest", "kept"), "repeated-chunks")
    marked = rows.join(repeats, "digest").withColumn("removed", (~here.eqNullSafe(F.col("kept"))).cast("int")).drop("digest", "kept")
    by_doc = W.partitionBy("doc_id").orderBy("seq")
    # Consecutive chunks differ from their rank by the same number; rows that share an id have equal numbers and rank alike.
    runs = marked.withColumn("run", F.col("seq") - F.dense_rank().over(by_doc))
    of_first = lambda c: F.min_by(c, "seq")
    spans = runs.groupBy("doc_id", "run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), (F.sum("words") + of_first("words_before")).alias("words"),
        (F.sum(F.col("words") * F.col("removed")) + of_first(F.col("words_before") * F.col("removed"))).alias("removed_words"), of_first("words_before_2").alias("before"), F.max_by("words_after", "seq").alias("after"),
    )
    # A word that goes over an end of the run begins in the chunk before.
    spans = spans.where((F.col("words") >= sure_words) & (F.col("words") + F.col("before") + F.col("after") >= least_words))
    return spans.select("doc_id", "first", "last", "words", "removed_words")


def repeated_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_spans, repeated_words, removed_words for every document that holds a repeated passage, the kept occurrence too."""
    return repeated_spans(docs).groupBy("doc_id").agg(F.count("*").alias("n_spans"), F.sum("words").alias("repeated_words"), F.sum("removed_words").alias("removed_words"))
