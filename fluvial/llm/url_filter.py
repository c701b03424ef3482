"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for what no rule decides.

The trees learn from labelled URLs: any table with url and label, or else those that a rule decides. Features are lengths, depth,
digit ratio, character entropy, counts of labels, hyphens and parameters, and the share of blocked URLs among the labelled ones of
the host's suffix (its last label), smoothed. The suffix statistics are counted over all labelled rows by Spark and are cross-fitted: a
labelled row gets the share of the other folds, dealt by host, so it never sees its own label or its host's. A suffix
whose labels are all alike gets the share of all suffixes: it could repeat the label but not be tested, so it decides nothing by itself.
The trees are fitted on a bounded sample, the `sample` labelled URLs of the least hashes, of up to `SAMPLE_CHARS` characters.

A null URL, or one without "://", has an empty host and path; no rule fits it and the trees judge it by its features. An
empty table gives an empty result. With no labelled URL, or only one kind, the verdict is allow, or that kind. Rows that
repeat are judged each; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule): the rule is a host and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BLOCK, ALLOW = "block", "allow"
SAMPLE, SAMPLE_CHARS = 20_000, 8_192
#: Folds of the suffix statistics, dealt by host.
FOLDS = 5
#: Suffixes up to which their statistics are broadcast, so that URLs are scored where they are read.
FEW_SUFFIXES = 100_000
#: Labelled URLs that the prior share of a suffix counts as.
PRIOR = 10.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def rule_and_verdict(rules: tuple[tuple[str, str], ...] = RULES, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The longest rule that fits and what it says; both null where none does."""
    rule = said = None
    for verdict, text in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((F.col(host) == name) | F.col(host).endswith(f".{name}")) & F.col(path).startswith(f"/{rest}")
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        said = F.when(fits, verdict) if said is None else said.when(fits, verdict)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, said)


FEATURES = ("length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "host_entropy", "host_labels", "hyphens", "parameters", "query_length", "fragment", "secure", "dots_in_path", "longest_run", "suffix_share")


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def features(url: str | None, host: str, path: str, share: float) -> list[float]:
    url = url or ""
    query = url.partition("?")[2].partition("#")[0]
    digits = sum(map(str.isdigit, url))
    return [
        len(url), len(host), len(path), path.count("/"), digits / max(len(url), 1), _entropy(url), _entropy(host), host.count(".") + bool(host), host.count("-"),
        query.count("=") + query.count("&"), len(query), float("#" in url), float(url[:6].lower() == "https:"), path.count("."), max(map(len, path.split("/"))), share,
    ]


@dataclass
class BoostedTrees:
    """Gradient-boosted trees for a yes-or-no label: logistic loss, splits by histograms over quantile bins."""

    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    least: int = 20
    penalty: float = 1.0
    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # by node: feature (-1: leaf), bin, value

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if len(y) else 0.5
        self.start = float(np.log(share / (1 - share)))
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned, margin = self._binned(x), np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, p - y, np.maximum(p * (1 - p), 1e-9))
            self.grown.append(tree)
            margin += self._walk(tree, binned)
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        node = np.zeros(len(g), int)
        for level in range(self.depth + 1):
            first, n = 2**level - 1, 2**level
            inside = node >= first
            local = node[inside] - first
            g_all, h_all = np.bincount(local, g[inside], n), np.bincount(local, h[inside], n)
            value[first : first + n] = -self.rate * g_all / (h_all + self.penalty)
            if level == self.depth:
                break
            best = np.full(n, 1e-6)
            for j in range(binned.shape[1]):
                at = local * self.bins + binned[inside, j]
                gl, hl, nl = (np.bincount(at, w, n * self.bins).reshape(n, self.bins).cumsum(axis=1) for w in (g[inside], h[inside], np.ones(len(at))))
                gain = gl**2 / (hl + self.penalty) + (g_all[:, None] - gl) ** 2 / (h_all[:, None] - hl + self.penalty) - (g_all**2 / (h_all + self.penalty))[:, None]
                gain[(nl < self.least) | (nl[:, -1:] - nl < self.least)] = -np.inf
                top = gain.argmax(axis=1)
                better = gain[np.arange(n), top] > best
                best[better] = gain[np.arange(n), top][better]
                feature[first : first + n][better], cut[first : first + n][better] = j, top[better]
            split = (feature[node] >= 0) & (node >= first)
            right = binned[np.arange(len(node)), np.maximum(feature[node], 0)] > cut[node]
            node = np.where(split, 2 * node + 1 + right, node)
            node[~split & (node >= first)] = -1  # a leaf above the last level is done
        return feature, cut, value

    def _walk(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, row = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(self.depth):
            split = feature[node] >= 0
            node = np.where(split, 2 * node + 1 + (binned[row, np.maximum(feature[node], 0)] > cut[node]), node)
        return value[node]

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        margin = np.full(len(x), self.start)
        for tree in self.grown:
            margin += self._walk(tree, binned)
        return 1 / (1 + np.exp(-margin))


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """suffix, overall, n and blocked (arrays by fold, the last for all) of labelled(host, label); one row of a null suffix has the overall share alone."""
    rows = labelled.select(F.substring_index("host", ".", -1).alias("suffix"), fold_of().alias("fold"), (F.col("label") == BLOCK).cast("long").alias("b"))
    of = lambda x: [F.sum(F.when(F.col("fold") == k, x).otherwise(0)) for k in range(FOLDS)]
    counted = rows.rollup("suffix").agg(F.array(*of(F.lit(1)), F.count("*")).alias("n"), F.array(*of(F.col("b")), F.sum("b")).alias("blocked"), F.grouping("suffix").alias("whole"))
    return counted.select(F.when(F.col("whole") == 0, F.col("suffix")).alias("suffix"), "whole", "n", "blocked")


def fold_of(host: str = "host") -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS)).cast("int")


def with_suffix_share(urls: DataFrame, labelled: DataFrame, fold: Column | None = None) -> DataFrame:
    """urls(host, ...) with share: how many of the labelled(host, label) rows of the host's suffix are blocked, without those of `fold`, smoothed towards all."""
    counted = suffix_counts(labelled)
    whole = counted.where("whole = 1").select(F.get("n", F.lit(FOLDS)).alias("n"), F.get("blocked", F.lit(FOLDS)).alias("b")).first()
    overall = F.lit(whole.b / whole.n if whole and whole.n else 0.5)
    last = F.lit(FOLDS)
    mixed = counted.where("whole = 0").where((F.get("blocked", last) > 0) & (F.get("blocked", last) < F.get("n", last))).select(F.col("suffix").alias("uf_suffix"), F.col("n").alias("uf_n"), F.col("blocked").alias("uf_blocked"))
    if mixed.limit(FEW_SUFFIXES + 1).count() <= FEW_SUFFIXES:
        mixed = F.broadcast(mixed)
    joined = urls.join(mixed, F.substring_index(urls["host"], ".", -1) == F.col("uf_suffix"), "left")
    without = lambda c: F.get(c, last) - (F.lit(0) if fold is None else F.get(c, fold))
    share = (F.coalesce(without("uf_blocked"), F.lit(0)) + PRIOR * overall) / (F.coalesce(without("uf_n"), F.lit(0)) + PRIOR)
    return joined.withColumn("share", share).drop("uf_suffix", "uf_n", "uf_blocked")


def fit(labelled: DataFrame, sample: int = SAMPLE) -> BoostedTrees | str:
    """Trees fitted on labelled(url, host, path, share, label); with one label only, that label."""
    rows = labelled.where(F.coalesce(F.length("url"), F.lit(0)) <= SAMPLE_CHARS).select("url", "host", "path", "share", "label").orderBy(F.xxhash64("url"), "url").limit(sample).collect()
    kinds = {r.label for r in rows}
    if len(kinds) < 2:
        return kinds.pop() if kinds else ALLOW
    x = np.array([features(r.url, r.host, r.path, r.share) for r in rows])
    return BoostedTrees().fit(x, np.array([r.label == BLOCK for r in rows], float))


def learn(labelled: DataFrame, sample: int = SAMPLE) -> BoostedTrees | str:
    """Trees fitted on labelled(url, label), with cross-fitted suffix statistics."""
    host, path = host_and_path()
    rows = labelled.where("label IS NOT NULL").select("url", "label", host.alias("host"), path.alias("path"))
    return fit(with_suffix_share(rows, rows, fold_of()), sample)


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, sample: int = SAMPLE, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block; null where a rule decides) of every row of pages(page_id, url).

    The trees learn from labelled(url, label), label block or allow; by default from the pages that a rule decides.
    """
    host, path = host_and_path()
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, said = rule_and_verdict(rules)
    rows = rows.withColumns({"rule": rule, "label": said})
    if labelled is None:
        labelled = rows.select("url", "label")
    known = labelled.where("label IS NOT NULL").select(host.alias("host"), "label")
    model = learn(labelled, sample)
    rows = with_suffix_share(rows, known)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n = len(batch)
            rule, label = batch.column("rule"), batch.column("label").to_pylist()
            score = np.zeros(n)
            if isinstance(model, str):
                score[:] = float(model == BLOCK)
            elif n:
                score = model.probability(np.array([features(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("url", "host", "path", "share")), strict=True)]))
            verdict = [v if v is not None else BLOCK if p >= 0.5 else ALLOW for v, p in zip(label, score.tolist(), strict=True)]
            columns = [batch.column("page_id"), batch.column("host"), batch.column("path"), rule, pa.array(verdict, pa.string()), pa.array(score, mask=np.array([v is not None for v in label], bool))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([pages.schema["page_id"], *(StructField(c, StringType()) for c in ("host", "path", "rule", "verdict")), StructField("score", DoubleType())])
    return rows.select("page_id", "url", "host", "path", "share", "rule", "label").mapInArrow(run, schema)
