"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is the set of its hashed words and marks, with its shares of distinct and of capital words. P(grade > k) = 1 / (1 + exp(t_k - w.x)) with one weight for each bucket, shared by all
grades, and thresholds t_0 < t_1 < ... kept in order by the logs of their gaps. The fitted model gives each text its expected grade and the
probability of reaching a grade, by which texts are selected.

It is fitted by stochastic gradient on a bounded sample: the `sample` rated documents of the least hashed ids, of texts up to `SAMPLE_CHARS`;
only buckets that `LEAST_DOCS` of them have get a weight. Scoring reads every text whole.

Null and empty texts have no features: their score is that of the thresholds alone. Null ratings are left out; ratings of
unknown documents too; with several ratings of a document each counts. With no rating, or one grade only, every text gets that grade (0 if
none). Rows that repeat are scored each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvial.llm.common import CACHE_WORDS, text_slices

SAMPLE, SAMPLE_CHARS, LEAST_DOCS = 20_000, 1 << 20, 4
BUCKETS = 1 << 18
EPOCHS, BATCH, RATE, DECAY = 15, 64, 0.3, 1e-5


class Buckets(dict):
    """token -> buckets of its letters and digits in lower case, and of its other characters together."""

    def __missing__(self, token: str) -> tuple[int, ...]:
        word = "".join(filter(str.isalnum, token)).lower()
        rest = "".join(c for c in token if not c.isalnum())
        value = self[token] = (*([_bucket("w" + word)] if word else []), *([_bucket("s" + rest)] if rest else []))
        return value

    def of(self, text: str) -> np.ndarray:
        """The sorted distinct buckets of a text: its tokens', and those of its shares of distinct and of capital tokens in tenths."""
        if len(self) > CACHE_WORDS:
            self.clear()
        tokens = text.split()
        distinct = set(tokens)
        found = set().union(*map(self.__getitem__, distinct))
        if tokens:
            found.add(_bucket(f"d{10 * len(distinct) // len(tokens)}"))
            found.add(_bucket(f"c{10 * sum(map(str.isupper, distinct)) // len(distinct)}"))
        return np.unique(np.fromiter(found, np.int32, len(found)))


def _bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) & (BUCKETS - 1)


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def above(self, margin: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - margin[:, None], -500, 500)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_grades: int) -> OrdinalModel:
    """Fit on rows of buckets and grades 0 to n_grades - 1."""
    weights = np.zeros(BUCKETS)
    share = np.clip(np.array([(grades > k).mean() for k in range(n_grades - 1)]), 1e-3, 1 - 1e-3) if len(grades) else np.full(n_grades - 1, 0.5)
    start = np.log((1 - share) / share)  # ascending, as P(grade > k) falls
    low, gaps = start[0] if len(start) else 0.0, np.log(np.maximum(np.diff(start), 1e-2))
    if n_grades < 2 or not len(rows):
        return OrdinalModel(weights, np.sort(start))
    common = np.bincount(np.concatenate(rows), minlength=BUCKETS) >= LEAST_DOCS
    rows = [r[common[r]] for r in rows]
    deal = np.random.default_rng(7)
    for epoch in range(EPOCHS):
        rate = RATE / (1 + 0.3 * epoch)
        order = deal.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            sizes = np.fromiter((len(rows[i]) for i in part), np.int64, len(part))
            flat, y = np.concatenate([rows[i] for i in part]), grades[part]
            owner = np.repeat(np.arange(len(part)), sizes)
            margin = np.bincount(owner, weights[flat], len(part))
            t = np.concatenate(([low], low + np.cumsum(np.exp(gaps)))) if len(gaps) else np.array([low])
            up = 1 / (1 + np.exp(np.clip(t - margin[:, None], -500, 500)))  # P(grade > k)
            edge = np.concatenate([np.ones((len(part), 1)), up, np.zeros((len(part), 1))], axis=1)
            row = np.arange(len(part))
            p = np.maximum(edge[row, y] - edge[row, y + 1], 1e-12)
            slope = edge * (1 - edge)
            d_margin = (slope[row, y] - slope[row, y + 1]) / p
            d_t = np.zeros((len(part), n_grades + 1))
            d_t[row, y] -= slope[row, y] / p
            d_t[row, y + 1] += slope[row, y + 1] / p
            d_t = d_t[:, 1:-1].mean(axis=0)
            # A text's own step doesn't grow with its number of words.
            step = np.bincount(flat, (d_margin / np.sqrt(np.maximum(sizes, 1)))[owner], BUCKETS)
            weights *= 1 - rate * DECAY * BATCH
            weights += rate * step / 4
            low += rate * d_t.sum()
            if len(gaps):
                gaps += rate * np.exp(gaps) * d_t[::-1].cumsum()[::-1][1:]
    return OrdinalModel(weights, np.concatenate(([low], low + np.cumsum(np.exp(gaps)))) if len(gaps) else np.array([low]))


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade of labels(doc_id, quality, toxic): 0 toxic, 1 poor, 2 good; rows with a null in either are left out."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, sample: int = SAMPLE) -> OrdinalModel:
    """The model of docs(doc_id, text) and ratings(doc_id, grade)."""
    chosen = ratings.where("grade IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    rated = docs.where(F.length("text") <= SAMPLE_CHARS).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            for at, texts in text_slices(batch):
                rows = [buckets.of((t or b"").decode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), batch.column("grade").slice(at, len(texts)), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "grade", "buckets"]
                )

    found = rated.select("doc_id", "text", "grade").mapInArrow(run, "doc_id long, grade int, buckets array<int>").toArrow()
    ids, grades = found.column("doc_id").to_numpy(), found.column("grade").to_numpy()
    order = np.lexsort((grades, ids))
    lists = found.column("buckets").combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    rows = np.split(flat, ends[:-1]) if len(ends) else []
    return fit_ordinal([rows[i] for i in order], grades[order].astype(int), n_grades)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, expected_grade, tails (P(grade >= k) for k from 1) of every row of docs(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, buckets = shared.value, Buckets()
        for batch in batches:
            for at, texts in text_slices(batch):
                above = model.above(np.array([model.weights[buckets.of((t or b"").decode())].sum() for t in texts]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(above.sum(axis=1)), pa.array(list(above), pa.list_(pa.float64()))], ["doc_id", "expected_grade", "tails"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, expected_grade double, tails array<double>")


def selected(least: float = 0.5, grade: int = 2) -> Column:
    """Whether a scored text is likely enough to reach the grade."""
    return F.element_at("tails", grade) >= least
