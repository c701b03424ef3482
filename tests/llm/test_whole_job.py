"""Similar lines and copies that earlier rounds left apart."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from fluvial.llm import line_dedup, simhash

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti") for b in ("ba", "co", "di", "fe", "gu", "ha")]


def test_lines_with_changed_words_are_linked_by_edit_similarity_alone(spark):
    rnd, rows = random.Random(5), []
    for i in range(120):
        w = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range((10, 20, 30, 50)[i % 4])]
        other = list(w)
        for k in rnd.sample(range(len(w)), 2 if i % 3 else 1):
            other[k] = rnd.choice(WORDS) + rnd.choice(WORDS)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
        assert line_dedup.similar(rows[-2][1], rows[-1][1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(d, d - d % 2) for d, _ in rows}
    assert {(r.doc_id, r.group_doc_id) for r in line_dedup.repeated_lines(df).collect()} == want


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_similar_sets_have_a_signature_in_common():
    rnd, signatures, found = np.random.default_rng(3), simhash.Signatures(0.8), 0
    for _ in range(3000):
        n = int(rnd.integers(1, 60)) if rnd.random() < 0.7 else int(rnd.integers(60, 900))
        a = rnd.integers(0, 1 << 48, n, dtype=np.uint64)
        gone = int(rnd.integers(0, n // 5 + 1))
        b = np.concatenate([a[gone:], rnd.integers(0, 1 << 48, int(rnd.integers(0, max(1, n // 4 - gone) + 1)), dtype=np.uint64)])
        if len(b) and jaccard(set(a.tolist()), set(b.tolist())) >= 0.8:
            found += 1
            row, keys = signatures.of(np.concatenate([a, b]), np.array([len(a), len(b)]))
            assert set(keys[row == 0].tolist()) & set(keys[row == 1].tolist()), (len(a), len(b))
    assert found > 1500


def test_similar_sets_have_as_many_signatures_in_common_as_needed():
    rnd, signatures, found = np.random.default_rng(13), simhash.Signatures(0.8), 0
    for _ in range(2000):
        n = int(rnd.integers(1, 1500))
        a = rnd.integers(0, 1 << 48, n, dtype=np.uint64)
        gone = int(rnd.integers(0, n // 5 + 1))
        b = np.concatenate([a[gone:], rnd.integers(0, 1 << 48, int(rnd.integers(0, max(1, n // 4 - gone) + 1)), dtype=np.uint64)])
        if len(b) and jaccard(set(a.tolist()), set(b.tolist())) >= 0.8:
            found += 1
            row, keys = signatures.of(np.concatenate([a, b]), np.array([len(a), len(b)]))
            both = np.array(sorted(set(keys[row == 0].tolist()) & set(keys[row == 1].tolist())), np.uint64)
            levels, often = np.unique((both & np.uint64(127)).astype(np.int64), return_counts=True)
            assert (often >= signatures.needed(levels)).any(), (len(a), len(b))
    assert found > 1000


def test_texts_that_share_a_passage_are_no_candidates(spark, monkeypatch):
    """Candidates would grow with the square of the number of texts; one pair of copies among them is found."""
    rnd = random.Random(21)
    word = lambda: rnd.choice(WORDS) + rnd.choice(WORDS)
    passage = " ".join(word() for _ in range(20))
    texts = [" ".join(word() for _ in range(75)) + f" {passage} " + " ".join(word() for _ in range(75)) for _ in range(600)]
    texts.append(texts[0] + " indeed")
    tables = {}

    def kept(df, label, plain=simhash.materialize):
        tables[label] = plain(df, label)
        return tables[label]

    monkeypatch.setattr(simhash, "materialize", kept)
    found = simhash.copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i % 600 for i in range(601)}
    laid_out = sum(r["count"] ** 2 for r in tables["copy-crowds"].groupBy("key").count().collect()) if "copy-crowds" in tables else 0
    assert tables["copy-pairs"].count() + laid_out < 600


@pytest.mark.parametrize("crowd", [16, 2])
def test_copies_in_a_crowd_are_exact(spark, monkeypatch, crowd):
    """Families that lean on one text without being similar to it, in chains: links that a text's nearest or a crowd's first do not show."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rnd, texts = random.Random(9), []
    for n in (12, 40, 150):
        base = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]
        for _ in range(4):
            here = list(base)
            for _ in range(12):
                for k in range(max(1, n // 60)):
                    here[rnd.randrange(n)] = rnd.choice(WORDS) + rnd.choice(WORDS)
                texts.append(" ".join(here))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8 - 1e-9:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = {r.doc_id: r.component_id for r in simhash.copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = {i: find(i) for i in range(len(texts))}
    assert len(set(want.values())) > 20
    assert got == want


def test_pair_counts_never_part_similar_lines():
    rnd = random.Random(8)
    lines = []
    for _ in range(400):
        a = "".join(rnd.choice("ab cdé") for _ in range(rnd.randrange(1, 90)))
        b = list(a)
        for _ in range(int(0.2 * len(a))):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randrange(2)] = rnd.choice(["", "x", "a"])
        lines += [a, "".join(b)]
    counts, size = line_dedup.pair_counts(lines), np.array(list(map(len, lines)))
    allowed = line_dedup.counts_allow(counts[::2], counts[1::2], size[::2], size[1::2], 0.8)
    similar = [line_dedup.similar(a, b) for a, b in zip(lines[::2], lines[1::2], strict=True)]
    assert sum(similar) > 200 and all(allowed[np.flatnonzero(similar)])


def test_long_lines_with_few_word_pairs_in_common_are_compared():
    """Each second word changed in one letter: a similarity of 0.9, though hardly a pair of words stays; met lines are judged by their texts alone."""
    rnd = random.Random(11)
    words = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(60)]
    texts = [" ".join(words), " ".join(w if k % 2 else "x" + w[1:] for k, w in enumerate(words))]
    comparison = line_dedup.Comparison(line_dedup.Kinds(line_dedup.Plan.of(2), line_dedup.Plan.of(2), 1), 0.8)
    comparison.lines, comparison.of, comparison.left, comparison.right, comparison.pairs = pa.array(texts), np.arange(2), [], [], {}
    assert line_dedup.similar(*texts) and comparison.compare(0, 1)


def test_run_counts_never_part_similar_lines():
    rnd = random.Random(18)
    lines = []
    for _ in range(600):
        a = "".join(rnd.choice("ab cdé") for _ in range(rnd.randrange(1, 250)))
        b = list(a)
        for _ in range(int(0.2 * len(a))):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randrange(2)] = rnd.choice(["", "x", "a"])
        lines += [a, "".join(b)]
    runs, size = line_dedup.run_counts(lines), np.array(list(map(len, lines)))
    assert all(runs.sum(axis=1) == size)
    assert line_dedup.run_counts([]).shape == (0, line_dedup.RUN_COUNTERS)
    bits = np.packbits(runs > 0, axis=1).view(np.uint64)
    similar = np.flatnonzero([line_dedup.similar(a, b) for a, b in zip(lines[::2], lines[1::2], strict=True)])
    assert len(similar) > 200
    assert all(line_dedup.counts_allow(runs[::2], runs[1::2], size[::2], size[1::2], 0.8, 3)[similar])
    assert all(line_dedup.runs_allow(bits[::2], bits[1::2], size[::2], size[1::2], 0.8)[similar])


def test_lines_that_cannot_be_similar_are_not_compared_as_texts(monkeypatch):
    """Short and long lines of one meeting: lengths and runs of characters tell most of them apart."""
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)) for n in (9, 9, 10, 14, 20, 40)]
    texts.append(texts[0][:-1] + "x")
    plan = line_dedup.Plan.of(2)
    sims = pa.array([b"\0" * 8 * plan.words] * len(texts), pa.binary())
    columns = {"id": list(range(7)), "of": list(range(7)), "meeting": [0] * 7, "by_words": sims, "by_chars": pa.array([len(t.split()) < 12 and b"\0" * 8 * plan.words or None for t in texts], pa.binary()), "line": texts}
    met = []
    monkeypatch.setattr(line_dedup, "similar", lambda a, b, least, plain=line_dedup.similar: met.append((a, b)) or plain(a, b, least))
    comparison = line_dedup.Comparison(line_dedup.Kinds(plan, plan, 1), 0.8)
    left, right = comparison.run(pa.RecordBatch.from_pydict(columns), np.array([0]), np.array([7]))
    assert (left, right) == ([0], [6])
    assert met == [(texts[0], texts[6])]


def changed_lines(rnd, n, longest):
    lines = []
    for _ in range(n):
        letters = rnd.choice(["ab ", "abcdefgh ijk", "abcé日本x\x01\x02"])
        a = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, longest)))
        b = list(a)
        for _ in range(int(rnd.choice([0.1, 0.2, 0.25, 0.3]) * len(a))):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randrange(2)] = rnd.choice(["", "x", "a"])
        lines.append((a, "".join(b)))
    return lines


def test_pairs_are_judged_by_arrays_as_one_by_one(monkeypatch):
    lines = changed_lines(random.Random(21), 3_000, 220)
    want = [line_dedup.similar(a, b) for a, b in lines]
    plain, alone = line_dedup.similar, []
    monkeypatch.setattr(line_dedup, "similar", lambda a, b, least: alone.append((a, b)) or plain(a, b, least))
    assert 500 < sum(want) < 2_900
    assert line_dedup.all_similar(*zip(*lines, strict=True)).tolist() == want
    assert all(max(map(len, x)) < 5 or max(map(len, x)) * 0.2 >= 32 or not all(c in "abcdefghijkx " for c in "".join(x)) for x in alone)


def test_a_large_meeting_of_unlike_lines_compares_few_texts(monkeypatch):
    """A meeting of 900 short lines, some with a near copy: all links are found, and hardly another pair's texts are compared."""
    rnd = random.Random(22)
    texts = [" ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(rnd.randrange(5, 9))) for _ in range(600)]
    texts += [t[:-1] + "q" for t in texts[:300]]
    want, n = set(), len(texts)
    for i in range(n):
        for j in range(i + 1, n):
            if abs(len(texts[i]) - len(texts[j])) <= 12 and len(set(texts[i].split()) & set(texts[j].split())) > 1 and line_dedup.similar(texts[i], texts[j]):
                want.add((i, j))
    plan = line_dedup.Plan.of(n)
    sims = pa.array([b"\0" * 8 * plan.words] * n, pa.binary())
    batch = pa.RecordBatch.from_pydict({"id": list(range(n)), "of": list(range(n)), "meeting": [plan.blocks << 48] * n, "by_words": sims, "by_chars": sims, "line": texts})
    compared = []
    monkeypatch.setattr(line_dedup, "all_similar", lambda a, b, least, plain=line_dedup.all_similar: compared.append(len(a)) or plain(a, b, least))
    left, right = line_dedup.Comparison(line_dedup.Kinds(plan, plan, 1), 0.8).run(batch, np.array([0]), np.array([n]))
    joined = line_dedup.Joined()
    for a, b in want:
        joined[joined.head(b)] = joined.head(a)
    found = line_dedup.Joined()
    for a, b in zip(left, right, strict=True):
        found[found.head(b)] = found.head(a)
    assert len(want) >= 300 and all(found.head(a) == found.head(b) for a, b in want)
    assert all(joined.head(a) == joined.head(b) for a, b in zip(left, right, strict=True))
    assert sum(compared) < n * n // 100
