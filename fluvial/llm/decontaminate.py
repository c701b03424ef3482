"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items are partitioned by their number of distinct word shingles into classes (u / 2, u], u a power of two. For each class a
document is cut into windows of 1.25 u shingles at steps of u / 4, so that any passage as long as an item of the class lies
whole in some window, however long the document is. In a partition the sizes of item and window are thereby known within a factor
of 2.5, and containment t means a Jaccard similarity of at least t / (2.5 + 1 - t): 0.29 for 0.8. Signatures have `HASHES`
minima, each a band of one row; an item and a window that share any are a candidate. At 0.8 a passage is missed with
probability 0.71 ** 32, under 2e-5, and an item whose shingles are scattered over several windows hardly more often. Items of one
shingle are smaller than their class assumes; they are looked up by the shingle itself and never missed.

Each candidate is verified in the same task: the item's distinct shingles that the whole document has, compared as words,
divided by all of them. Documents are read once for each block of items and never shuffled. Items are taken in blocks of bounded
size, so what is broadcast doesn't grow with the benchmark.

Words are what lies between ASCII white space, lower-cased. A text of fewer words than a shingle has one shingle, its
whole sequence; one without words has none and matches nothing. Null ids are carried; rows that repeat are each searched and
give a row each; extra columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.llm.common import WordHashes, ragged, text_slices, trimmed

WIDTH = 5
THRESHOLD = 0.8
HASHES = 32
#: UTF-8 bytes of the items of one block.
BLOCK_BYTES = 8 << 20
SEED = 20_11
#: Windows move in steps of a quarter of the class bound and span five steps.
STEPS = 5


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").decode().lower().encode().split()


def shingle_hashes(hashes: np.ndarray, lengths: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """From the word hashes of texts one after the other: the shingle hashes, text by text, and how many each text has."""
    count = np.where(lengths >= width, lengths - width + 1, (lengths > 0).astype(np.int64))
    first = np.cumsum(lengths) - lengths
    at = ragged(first, count)
    span = np.repeat(np.minimum(lengths, width), count)
    h, base = np.zeros(len(at), np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for k in range(width):
        inside = k < span
        if inside.all():
            h = h * base + hashes[at + k]
        else:
            h[inside] = h[inside] * base + hashes[at[inside] + k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29)), count


@dataclass
class ItemIndex:
    """The items of a block: shingles of each, and for each size class and hash the sorted minima with their items."""

    ids: list
    shingles: list[dict[tuple, int]]  # words -> hash
    classes: dict[int, tuple[list[np.ndarray], list[np.ndarray]]]
    filters: dict[int, np.ndarray]  # by hash: the low bits that any minimum has
    single: tuple[np.ndarray, np.ndarray]  # the sorted shingles of items that have one, with their items
    width: int
    threshold: float

    @classmethod
    def build(cls, items: list[tuple], width: int, threshold: float) -> ItemIndex:
        hasher, ids, shingles = WordHashes(), [], []
        for item_id, text in items:
            words = words_of(text.encode() if text is not None else None)
            if not words:
                continue
            h, _ = shingle_hashes(hasher.of(words), np.array([len(words)]), width)
            ids.append(item_id)
            shingles.append({tuple(words[i : i + width]): int(x) for i, x in enumerate(h.tolist())})
        alone = sorted((h, i) for i, s in enumerate(shingles) if len(s) == 1 for h in s.values())
        single = np.array([h for h, _ in alone], np.uint64), np.array([i for _, i in alone], np.int64)
        bounds = [max(4, 1 << (len(s) - 1).bit_length()) if len(s) > 1 else 0 for s in shingles]
        multiply, classes, filters = _multipliers(HASHES), {}, {}
        bits = max(16, (16 * max(len(ids), 1)).bit_length())
        for u in sorted(set(bounds) - {0}):
            members = np.array([i for i, b in enumerate(bounds) if b == u])
            minima = np.array([[int((np.array(list(shingles[i].values()), np.uint64) * a >> np.uint64(32)).min()) for a in multiply] for i in members], np.uint32)
            order = np.argsort(minima, axis=0, kind="stable")
            classes[u] = ([minima[order[:, j], j] for j in range(HASHES)], [members[order[:, j]] for j in range(HASHES)])
            table = np.zeros((HASHES, 1 << bits), bool)
            for j in range(HASHES):
                table[j, minima[:, j] & ((1 << bits) - 1)] = True
            filters[u] = table
        return cls(ids, shingles, classes, filters, single, width, threshold)

    def candidates(self, h: np.ndarray, count: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs of which a window shares a minimum, or the item's one shingle; h are the texts' shingle hashes, count of them each."""
        found: set[tuple[int, int]] = set()
        use = np.flatnonzero(count)
        values, members = self.single
        if len(values) and len(h):
            hit = np.flatnonzero(np.isin(h, values))
            text = np.searchsorted(np.cumsum(count), hit, "right")
            lo, hi = np.searchsorted(values, h[hit], "left"), np.searchsorted(values, h[hit], "right")
            found.update(zip(np.repeat(text, hi - lo).tolist(), members[ragged(lo, hi - lo)].tolist(), strict=True))
        if not len(use) or not self.classes:
            return found
        n = count[use]
        first = np.cumsum(n) - n
        least = min(self.classes) // 4
        layouts = {}
        for u in self.classes:  # steps of each class, text by text, as runs of the least steps
            blocks = -(-n // (u // 4))
            layouts[u] = (blocks, np.cumsum(blocks) - blocks)
        fine_n = -(-n // least)
        fine_first = np.cumsum(fine_n) - fine_n
        fine_at = np.repeat(first, fine_n) + (np.arange(int(fine_n.sum())) - np.repeat(fine_first, fine_n)) * least
        steps = {}
        for u, (blocks, start) in layouts.items():
            steps[u] = np.repeat(fine_first, blocks) + (np.arange(int(blocks.sum())) - np.repeat(start, blocks)) * (u // 4 // least)
        for j, a in enumerate(_multipliers(HASHES)):
            fine = np.minimum.reduceat((h * a >> np.uint64(32)).astype(np.uint32), fine_at)
            for u, (blocks, start) in layouts.items():
                step = fine if u // 4 == least else np.minimum.reduceat(fine, steps[u])
                window = step.copy()
                last = np.repeat(start + blocks, blocks)
                here = np.arange(len(step))
                for k in range(1, STEPS):
                    window = np.minimum(window, step[np.minimum(here + k, last - 1)])
                table = self.filters[u][j]
                hit = np.flatnonzero(table[window & np.uint32(table.shape[0] - 1)])
                if len(hit):
                    values, members = self.classes[u][0][j], self.classes[u][1][j]
                    lo, hi = np.searchsorted(values, window[hit], "left"), np.searchsorted(values, window[hit], "right")
                    text = use[np.searchsorted(start, hit, "right") - 1]
                    some = hi > lo
                    pairs = np.repeat(text[some], (hi - lo)[some]), members[ragged(lo[some], (hi - lo)[some])]
                    found.update(zip(pairs[0].tolist(), pairs[1].tolist(), strict=True))
        return found

    def matched(self, item: int, words: list[bytes], h: np.ndarray) -> int:
        """How many of the item's distinct shingles the text has; a hash only says where to compare words."""
        own = self.shingles[item]
        at = np.flatnonzero(np.isin(h, np.fromiter(own.values(), np.uint64, len(own))))
        return len({s for s in (tuple(words[i : i + self.width]) for i in at.tolist()) if s in own})

    def search(self, texts: list[bytes | None], hasher: WordHashes) -> list[tuple[int, int, int]]:
        """(text, item, shingles matched) of all pairs at or over the threshold."""
        words = [words_of(t) for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        hashes = hasher.of([w for ws in words for w in ws])
        h, count = shingle_hashes(hashes, lengths, self.width)
        first = np.cumsum(count) - count
        out = []
        for text, item in sorted(self.candidates(h, count)):
            matched = self.matched(item, words[text], h[first[text] : first[text] + count[text]])
            if matched >= self.threshold * len(self.shingles[item]) - 1e-9:
                out.append((text, item, matched))
        return out


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """The items in blocks of up to `most` bytes (one item at least), streamed through the driver."""
    held, size = [], 0
    for row in items.toLocalIterator():
        bytes_here = len((row[1] or "").encode()) + 16
        if held and size + bytes_here > most:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += bytes_here
    if held:
        yield held


OUT = "doc_id long, item_id long, n_shingles long, n_matched long, containment double"


def contaminated(docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_shingles (distinct, of the item), n_matched, containment for every document that holds an item of benchmark(item_id, text)."""
    spark, out = docs.sparkSession, None
    for items in _blocks(benchmark.select(F.col("item_id").cast("long"), "text"), block_bytes):
        shared = spark.sparkContext.broadcast(ItemIndex.build(items, width, threshold))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hasher = shared.value, WordHashes()
            for batch in batches:
                for at, texts in text_slices(batch):
                    hits = index.search(texts, hasher)
                    if hits:
                        docs_at = batch.column("doc_id").take(pa.array([at + t for t, _, _ in hits]))
                        sizes = [len(index.shingles[i]) for _, i, _ in hits]
                        yield pa.RecordBatch.from_arrays(
                            [docs_at, pa.array([index.ids[i] for _, i, _ in hits], pa.int64()), pa.array(sizes, pa.int64()), pa.array([m for _, _, m in hits], pa.int64()), pa.array([m / n for (_, _, m), n in zip(hits, sizes, strict=True)])],
                            ["doc_id", "item_id", "n_shingles", "n_matched", "containment"],
                        )

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(run), OUT)
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], OUT) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that hold no item, with their columns; searched and filtered in place, without a join."""
    spark = docs.sparkSession
    for items in _blocks(benchmark.select(F.col("item_id").cast("long"), "text"), block_bytes):
        shared = spark.sparkContext.broadcast(ItemIndex.build(items, width, threshold))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hasher = shared.value, WordHashes()
            for batch in batches:
                good = np.ones(len(batch), bool)
                for at, texts in text_slices(batch):
                    good[[at + t for t, _, _ in index.search(texts, hasher)]] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(trimmed(run), docs.schema)
    return docs


#: The same in DuckDB's SQL.
ORACLE = r"""
WITH w AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id AS id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') FROM benchmark),
s AS (SELECT kind, row, id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
b AS (SELECT DISTINCT row, id, s FROM s WHERE kind = 'b'),
n AS (SELECT row, count(*) AS n FROM b GROUP BY row),
m AS (SELECT d.row, d.id AS doc_id, b.row AS item, b.id AS item_id, count(*) AS m
      FROM (SELECT DISTINCT row, id, s FROM s WHERE kind = 'd') d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n.n AS n_shingles, m.m AS n_matched, m.m / n.n::DOUBLE AS containment
FROM m JOIN n ON n.row = m.item WHERE m.m >= 0.8 * n.n - 1e-9
"""
