"""Language identification: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

Fitting counts hashed character n-grams (1 to 4, with word ends) and letters by script for each language on a bounded
sample of labelled rows: up to `per_language` documents of each language, those of the least hashed ids. A word's score for a
language is the mean log-probability of its n-grams, relative to the best language; languages that don't write in the word's script are no
candidates, and a word in a script that no language has is neutral. Viterbi takes the labelling of a text's words with the greatest
sum of scores less a penalty for each switch. The text's language is the one with most letters in its words; its share of
all letters is the score.

Null texts and texts without a letter get `und` with score 0, as does every text when there is nothing to learn from. A text
whose words are all neutral gets the first language and score 1 / languages. Equal sums go to the language first in code-point order.
Rows that repeat are labelled each; extra columns are ignored. Whole texts are read, whatever their length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvial.llm.common import CACHE_WORDS, text_slices, trimmed

UND = "und"
#: Documents of each language in the fitted sample, and buckets of hashed n-grams. All languages are learned; each takes 256 kB.
PER_LANGUAGE, BUCKETS = 3_000, 1 << 15
ORDERS = (1, 2, 3, 4)
#: Cost of a switch, in mean log-probability of a word.
SWITCH = 6.0
#: A language writes in a script that has this share of its letters.
SCRIPT_SHARE = 0.02
#: Text that a worker labels at once.
SLICE = 6 << 20

#: First code point of each script range, and the script (0: none in particular).
SCRIPT_RANGES = (
    (0x0000, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0750, 6),
    (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 11), (0x0B80, 12), (0x0C00, 13), (0x0C80, 14),
    (0x0D00, 15), (0x0D80, 16), (0x0E00, 17), (0x0E80, 18), (0x0F00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22),
    (0x1200, 23), (0x13A0, 0), (0x1780, 24), (0x1800, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 25), (0x30A0, 26),
    (0x3100, 0), (0x3400, 27), (0xA000, 0), (0xAC00, 22), (0xD7B0, 0), (0xF900, 27), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6),
    (0xFE00, 0), (0xFF66, 26), (0xFFA0, 0), (0x20000, 27), (0x30000, 0),
)
SCRIPTS = 28
_FROM = np.array([a for a, _ in SCRIPT_RANGES], np.uint32)
_SCRIPT = np.array([s for _, s in SCRIPT_RANGES], np.int64)


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letters of the words with a blank around each word; starts and lengths of the words with their blanks."""
    flat = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return flat, np.cumsum(lengths - 1) - (lengths - 1), lengths


def _grams(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of the n-grams of every word, and how many each word has."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(len(flat), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(flat) - n + 1] * np.uint64(0x100000001B3) + flat[n - 1 :].astype(np.uint64) + np.uint64(1)
        if n not in ORDERS:
            continue
        count = np.maximum(lengths - n + 1, 0)
        ends = np.cumsum(count)
        at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(starts, count)
        g = (h[at] + np.uint64(n)) * mix
        yield ((g ^ (g >> np.uint64(29))) * mix >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), count


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log-probabilities, buckets x languages
    writes: np.ndarray  # scripts x languages

    def scores(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word of letters: 0 for the best candidate, less for others; all 0 if there is no candidate."""
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        flat, starts, lengths = _code_points(words)
        total, n = np.zeros((len(words), len(self.languages))), np.zeros(len(words))
        for buckets, count in _grams(flat, starts, lengths):
            some = count > 0
            first = (np.cumsum(count) - count)[some]
            if len(first):
                total[some] += np.add.reduceat(self.table[buckets], first, axis=0)
            n += count
        candidates = self.writes[script_of(flat[starts + 1])]
        mean = np.where(candidates, total / n[:, None], -np.inf)
        best = mean.max(axis=1, keepdims=True)
        none = ~candidates.any(axis=1)
        out = np.maximum(mean - np.where(none[:, None], 0, best), -50.0)
        out[none] = 0
        return out.astype(np.float32)


def script_of(code_points: np.ndarray) -> np.ndarray:
    return _SCRIPT[np.searchsorted(_FROM, code_points, "right") - 1]


def is_training(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0)) != 2


def fit(train: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """The model of train(doc_id, text, lang): only text and lang are learned from; doc_id deals the sample."""
    train = train.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = [(r["lang"], min(1.0, per_language / r["count"])) for r in train.groupBy("lang").count().collect()]
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((SCRIPTS, 0), bool))
    shares = train.sparkSession.createDataFrame(sizes, "id_lang string, share double")
    train = train.join(F.broadcast(shares), F.col("lang") == F.col("id_lang")).drop("id_lang")
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            for at, texts in text_slices(batch):
                words: dict[str, Counter] = {}
                for lang, text in zip(languages[at:], texts, strict=False):
                    words.setdefault(lang, Counter()).update(map(_letters, text.decode().lower().split()))
                for lang, counter in words.items():
                    counter.pop("", None)
                    if counter:
                        flat, starts, lengths = _code_points(list(counter))
                        often = np.fromiter(counter.values(), np.float64, len(counter))
                        held = sums.setdefault(lang, np.zeros(BUCKETS + SCRIPTS))
                        for buckets, n in _grams(flat, starts, lengths):
                            held[:BUCKETS] += np.bincount(buckets, np.repeat(often, n), BUCKETS)
                        held[BUCKETS:] += np.bincount(script_of(flat[starts + 1]), often * (lengths - 2), SCRIPTS)
        for lang, held in sums.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(held[at].astype(np.int64))], ["lang", "bucket", "n"])

    counted = train.where(dealt < F.col("share")).drop("share").mapInArrow(trimmed(count), "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").to_pylist()), key=lambda s: s.encode())
    held = np.zeros((BUCKETS + SCRIPTS, len(languages)))
    column = {lang: i for i, lang in enumerate(languages)}
    held[found.column("bucket").to_numpy(), [column[x] for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    grams, letters = held[:BUCKETS] + 0.5, held[BUCKETS:]
    return Model(languages, np.log(grams / grams.sum(axis=0)), letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The best labels of the rows of scores, the words of texts of the given lengths one after the other; all texts go step by step together."""
    n_texts, n_labels = len(lengths), scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    length = lengths[order]
    start = (np.cumsum(lengths) - lengths)[order]
    longest = int(length[0]) if n_texts else 0
    active = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than t words
    stay, before = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int16)
    value = np.zeros((n_texts, n_labels), np.float64)
    for t in range(longest):
        a = active[t]
        at = start[:a] + t
        v = value[:a]
        if t:
            top = v.argmax(axis=1)
            before[at] = top
            least = v[np.arange(a), top] - penalty
            stay[at] = v >= least[:, None]
            v = np.maximum(v, least[:, None])
            v -= least[:, None]
        value[:a] = v + scores[at]
    label = np.zeros(len(scores), np.int16)
    state = value.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at = start[:a] + t
        s = state[:a]
        label[at] = s
        state[:a] = np.where(stay[at, s], s, before[at])
    return label


class Labeller:
    """Labels texts with a model; a worker keeps the scores of the words it has met."""

    def __init__(self, model: Model, penalty: float = SWITCH):
        self.model, self.penalty = model, penalty
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def words(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray]:
        """The words of the texts and their ids."""
        words = [t.lower().split() for t in texts]
        if len(self.ids) > CACHE_WORDS:
            self.forget()
        ids, new = self.ids, []
        for w in set().union(*words):
            if w not in ids:
                ids[w] = len(ids)
                new.append(_letters(w))
        if new:
            rows = np.zeros((len(new), len(self.model.languages)), np.float32)
            lettered = [i for i, w in enumerate(new) if w]
            rows[lettered] = self.model.scores([new[i] for i in lettered])
            self.rows = np.concatenate([self.rows, rows])
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, new), np.int64, len(new))])
        get = ids.__getitem__
        return words, np.fromiter((get(w) for ws in words for w in ws), np.int64, sum(map(len, words)))

    def label(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Words of each text; label and number of letters of each word, all texts in one array."""
        words, ids = self.words(texts)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return words, viterbi(self.rows[ids], lengths, self.penalty), self.letters[ids]

    def languages(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        names = self.model.languages
        if not names:
            return [UND] * len(texts), np.zeros(len(texts))
        words, label, letters = self.label(texts)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.repeat(np.arange(len(texts)), lengths)
        sums = np.bincount(text * len(names) + label, letters, len(texts) * len(names)).reshape(len(texts), len(names))
        known = np.bincount(text, letters * self.model_knows(texts, words), len(texts)) > 0
        top, total = sums.argmax(axis=1), sums.sum(axis=1)
        score = np.where(known, sums.max(axis=1) / np.maximum(total, 1), 1 / len(names))
        return [names[i] if n else UND for i, n in zip(top, total, strict=True)], np.where(total > 0, score, 0.0)

    def model_knows(self, texts: list[str], words: list[list[str]]) -> np.ndarray:
        """Of each word: whether some language is better than another."""
        get = self.ids.__getitem__
        told = (self.rows.min(axis=1) < 0) | (len(self.model.languages) == 1)
        return told[np.fromiter((get(w) for ws in words for w in ws), np.int64, sum(map(len, words)))]

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(first word, word after the last, language) of each run of one label."""
        words, label, _ = self.label([text])
        if not self.model.languages or not len(label):
            return []
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(label)) + 1, [len(label)]))
        return [(int(a), int(b), self.model.languages[label[a]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH, keep: list[str] | None = None) -> DataFrame:
    """The columns keep of docs (doc_id unless given) with lang_pred and score; text is all that is looked at."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in docs.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value, penalty)
        for batch in batches:
            for at, texts in text_slices(batch.select(["id_text"]), "id_text", SLICE):
                names, score = labeller.languages([(t or b"").decode() for t in texts])
                kept = [batch.column(f.name).slice(at, len(texts)) for f in fields]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(score)], [*(f.name for f in fields), "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*(F.col(f"`{f.name}`") for f in fields), F.col("text").alias("id_text")).mapInArrow(trimmed(run), schema)


def spans(docs: DataFrame, model: Model, penalty: float = SWITCH) -> DataFrame:
    """doc_id, first_word, last_word (excluded), lang of each run of words of one label, for every text of docs(doc_id, text); texts without a word have none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value, penalty)
        for batch in batches:
            for at, texts in text_slices(batch):
                found = [(at + i, *span) for i, t in enumerate(texts) for span in labeller.spans((t or b"").decode())]
                row, first, last, lang = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(lang, pa.string())], ["doc_id", "first_word", "last_word", "lang"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(run), "doc_id long, first_word int, last_word int, lang string")
