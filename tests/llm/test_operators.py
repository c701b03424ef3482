"""Text operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fluvial.llm import decontaminate, language_id, line_dedup, mixing, quality, queries, simhash, substring_dedup, token_counts, top_k, url_filter
from fluvial.llm.components import connected_components

ODD = "doc_id long, text string, lang string, source string, size string, Target int, mx_row int"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti") for b in ("ba", "co", "di", "fe", "gu", "ha")]


def words(rnd, n):
    return [rnd.choice(WORDS) for _ in range(n)]


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns named like results."""
    long_text = " ".join(words(random.Random(1), 30_000))
    rows = [
        (1, "Mi kaba lodi.", "xx", "b", "s", 1, 2), (1, "Mi kaba lodi.", "xx", "b", "s", 1, 2), (2, None, None, None, None, None, None), (3, "", "yy", "a", None, 1, 1), (None, "no id here at all", "xx", "a", "t", 0, 0),
        (4, "  \n\t ", "xx", None, "t", 0, 0), (5, long_text, "xx", "b", "t", 0, 0), (6, "123 !!! 456", "yy", "c", "t", 0, 0), (7, "MI KABA LODI.", "xx", "b", "t", 0, 0),
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], ODD)


# Mixing


def water_fill(sizes, weights, cap=3):
    target, full, total = dict.fromkeys(sizes, 0.0), set(), sum(sizes.values())
    while True:
        left, share = total - sum(cap * sizes[s] for s in full), sum(weights[s] for s in sizes if s not in full)
        for s in sizes:
            target[s] = cap * sizes[s] if s in full else left * weights[s] / share
        over = {s for s in sizes if s not in full and target[s] > cap * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def test_mix_hits_targets_and_is_the_same_again(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", "d", None]), rnd.choice([1, 3, 10, rnd.randrange(1, 200)])) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    got = mixing.mix_sources(df, size=F.col("n")).collect()
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = water_fill(dict(sizes), {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    taken = Counter()
    for r in got:
        assert 0 <= r.copies <= 3
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.copies * r.size
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 2 * 200 for s in sizes)
    again = mixing.mix_sources(df.repartition(7), size=F.col("n")).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)
    assert mixing.emitted(mixing.mix_sources(df, size=F.col("n"))).count() == sum(r.copies for r in got)


@pytest.mark.parametrize("sizes", [[0, 0], [1, 0, 5], [100, 1, 1, 1], [7]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(False, f"s{i}", n) for i, n in enumerate(sizes)], "src_null boolean, src string, source_size long")
    want = water_fill({f"s{i}": n for i, n in enumerate(sizes)}, {f"s{i}": mixing.WEIGHTS[i % 3] for i in range(len(sizes))}) if sum(sizes) else dict.fromkeys([f"s{i}" for i in range(len(sizes))], 0.0)
    assert {r.src: pytest.approx(r.target) for r in mixing.targets(df).collect()} == want


def test_mix_of_odd_rows(odd, nothing):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == odd.count()
    assert {r["size"] for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mix_sources(nothing).count() == 0


# Decontamination


def shingles(text, width=5):
    w = decontaminate.words_of(None if text is None else text.encode())
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def test_items_are_found_in_long_documents(spark):
    rnd = random.Random(8)
    items = [(i, " ".join(words(rnd, rnd.choice([3, 5, 9, 20, 60])))) for i in range(40)] + [(90, None), (91, ""), (92, "the Same ITEM twice in here"), (93, "the Same ITEM twice in here")]
    docs = []
    for d in range(120):
        w = words(rnd, rnd.choice([2, 30, 400, 5000]))
        if d % 2 and items[d % 40][1]:
            part = items[d % 40][1].split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                part[rnd.randrange(len(part))] = "zz"
            at = rnd.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((d, " ".join(w).upper() if d % 5 == 0 else " ".join(w)))
    docs += [(500, None), (501, ""), (None, "the same item twice in here"), (502, items[0][1]), (502, items[0][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, text in docs:
        for j, item in items:
            s = shingles(item)
            if s and len(s & shingles(text)) >= 0.8 * len(s) - 1e-9:
                want[i, j] += 1
    assert len(want) > 30
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()) == want
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b, block_bytes=500).collect()) == want
    kept = {r.doc_id for r in decontaminate.clean(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}
    assert decontaminate.contaminated(d, b.limit(0)).count() == 0
    assert decontaminate.contaminated(d.limit(0), b).count() == 0


def test_items_of_one_shingle_are_never_missed(spark):
    rnd = random.Random(18)
    items = [(i, " ".join(rnd.sample(WORDS, 5))) for i in range(300)]
    docs = [(i, f"{' '.join(words(rnd, 300))} {item} {' '.join(words(rnd, 300))}") for i, item in items]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(i, j) for i, text in docs for j, item in items if shingles(item) <= shingles(text)}
    assert len(want) >= 300
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()} == want


# Substrings


def test_repeated_passages(spark, odd, nothing):
    rnd = random.Random(9)
    passage = " ".join(str(rnd.randrange(10**6)) for _ in range(80))
    unique = lambda n: " ".join(str(rnd.randrange(10**9)) for _ in range(n))
    docs = [(i, f"{unique(rnd.randrange(5, 300))} {passage} {unique(50)}") for i in range(6)] + [(i, unique(200)) for i in range(10, 20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.repeated_documents(df).collect()}
    assert set(got) == set(range(6))
    assert got[0].removed_words == 0
    assert all(50 <= r.repeated_words <= 80 and r.removed_words == r.repeated_words for i, r in got.items() if i)
    for r in substring_dedup.repeated_spans(df).collect():
        text = docs[r.doc_id][1].encode()
        assert text[r.first : r.last].decode() in passage
    data = unique(4000).encode()
    ends = substring_dedup.cuts(data)
    assert ends[-1] == len(data)
    assert np.diff(ends, prepend=0).max() <= substring_dedup.MOST_BYTES
    shifted = substring_dedup.cuts(b"inserted " + data)
    assert len(set((ends + 9).tolist()) & set(shifted.tolist())) > 0.9 * len(ends)
    assert {r.doc_id for r in substring_dedup.repeated_documents(odd).collect()} == set()
    assert substring_dedup.repeated_documents(nothing).count() == 0


def test_repeated_passages_against_brute_force(spark):
    """Documents with a run of over 50 words that stands twice, among others that share many shorter phrases."""
    rnd = random.Random(19)
    name = lambda: rnd.choice(WORDS) + rnd.choice(WORDS) + str(rnd.randrange(50))
    phrases = [[name() for _ in range(rnd.randrange(8, 16))] for _ in range(30)]
    passages = [[name() for _ in range(rnd.randrange(55, 90))] for _ in range(12)]
    docs = []
    for i in range(240):
        w = []
        for _ in range(rnd.randrange(4, 12)):
            w += rnd.choice(phrases) + [name() for _ in range(rnd.randrange(3, 25))]
        if i % 4 == 0:
            at = rnd.randrange(len(w))
            w[at:at] = rnd.choice(passages)
        docs.append((i, " ".join(w)))
    where = defaultdict(set)
    for i, text in docs:
        w = text.split()
        for k in range(len(w) - 50):
            where[tuple(w[k : k + 51])].add((i, k))
    want = {i for found in where.values() if len(found) > 1 for i, _ in found}
    got = {r.doc_id for r in substring_dedup.repeated_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(want) > 40
    assert len(got & want) >= 0.99 * len(want)
    assert len(got & want) >= 0.95 * len(got)


# URLs


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in raw), re.match(r"[^?#]*", rest[len(raw) :])[0]


def test_rules_and_trees(spark):
    rnd = random.Random(11)
    urls = [None, "", "no scheme", "http://", "http://NET", "http://net/", "x://a.net/en/", "https://EXAMPLE.net/en/1?q#f", "http://a.example.net/en", "http://example.com/de/", "http://example.comm/de/", "http://w.org/fr/x", "http://aorg/fr/", "a://b?c://d/e", "http://É.net/É", "h://x.net/a\nb"]
    for _ in range(400):
        urls.append(f"http://{rnd.choice(['www.', '', 'm.'])}{rnd.choice(['alpha', 'beta'])}.{rnd.choice(['example.net', 'example.com', 'site.org', 'other.com'])}/{rnd.choice(['en', 'de', 'fr'])}/{rnd.randrange(999)}")
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, u in enumerate(urls):
        host, path = host_path(u)
        assert (got[i].host, got[i].path) == (host, path), u
        fits = [(len(r), v, r) for v, r in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        best = max(fits, default=(0, None, None))
        assert got[i].rule == best[2], u
        assert got[i].verdict == best[1] if best[1] else got[i].verdict in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).count() == 0
    alone = url_filter.judge(spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")).collect()
    assert [(r.rule, r.verdict) for r in alone] == [(None, "allow")]


def spam_urls(n, seed=3, suffixes=("net", "com", "org")):
    """(host, url, label): what is blocked has digits, hyphens or many parameters more often, under every suffix."""
    rnd, out = random.Random(seed), []
    for _ in range(n):
        bad, suffix = rnd.random() < 0.4, rnd.choice(suffixes)
        name = "-".join(words(rnd, rnd.choice([3, 4]))) + str(rnd.randrange(1000)) if bad else rnd.choice(["www.", ""]) + "".join(words(rnd, 2))
        query = "&".join(f"p{k}={rnd.randrange(10**6)}" for k in range(rnd.randrange(2, 6))) if bad else rnd.choice(["", "page=2"])
        host = f"{name}.{suffix}"
        out.append((host, f"http://{host}/{'/'.join(words(rnd, rnd.randrange(1, 4)))}?{query}", "block" if bad else "allow"))
    return out


def test_trees_judge_urls_of_hosts_that_they_have_not_seen(spark):
    rows = spam_urls(1500)
    train = [(u, v) for h, u, v in rows if hash_of(h) % 4]
    test = [(i, u) for i, (h, u, v) in enumerate(rows) if not hash_of(h) % 4]
    labelled = spark.createDataFrame(train, "url string, label string")
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(test, "page_id long, url string"), rules=(), labelled=labelled).collect()}
    assert len(got) == len(test) > 300
    assert sum(got[i] == rows[i][2] for i in got) >= 0.95 * len(got)


def hash_of(text):
    return xxhash.xxh3_64_intdigest(text)


def test_a_suffix_does_not_decide_alone(spark):
    """Under xx all labels are block, for no other reason: good-looking URLs there are judged by their looks."""
    rows = spam_urls(1200) + [(h, u, v) for h, u, v in spam_urls(600, 5, ("xx",)) if v == "block"]
    looks = [(i, u) for i, (h, u, v) in enumerate(spam_urls(600, 6, ("xx",))) if v == "allow"]
    labelled = spark.createDataFrame([(u, v) for _, u, v in rows], "url string, label string")
    got = [r.verdict for r in url_filter.judge(spark.createDataFrame(looks, "page_id long, url string"), rules=(), labelled=labelled).collect()]
    assert got.count("allow") >= 0.9 * len(got)


def test_suffix_shares_leave_out_the_row_s_own_fold(spark):
    rows = [(f"h{i}.net", "block" if i % 3 else "allow") for i in range(40)] + [(f"h{i}.org", "allow") for i in range(9)]
    df = spark.createDataFrame(rows, "host string, label string")
    fold = {r.host: r.f for r in df.select("host", url_filter.fold_of().alias("f")).collect()}
    overall = sum(v == "block" for _, v in rows) / len(rows)
    for r in url_filter.with_suffix_share(df, df, url_filter.fold_of()).collect():
        others = [v for h, v in rows if h.endswith(".net") and fold[h] != fold[r.host]] if r.host.endswith("net") else []
        assert r.share == pytest.approx((others.count("block") + 10 * overall) / (len(others) + 10))


def test_trees_learn_held_out_labels():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = url_filter.BoostedTrees(trees=30).fit(x[:2000], y[:2000])
    assert ((trees.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


# Language


def test_viterbi_is_the_best_labelling():
    rnd = np.random.default_rng(4)
    for _ in range(30):
        lengths = rnd.integers(0, 7, 5)
        scores = -rnd.random((int(lengths.sum()), 3)) * 3
        got, at = language_id.viterbi(scores, lengths, 0.8), 0
        for n in lengths:
            s = scores[at : at + n]
            value = lambda lab, s=s: sum(s[i, x] for i, x in enumerate(lab)) - 0.8 * sum(a != b for a, b in zip(lab, lab[1:], strict=False))
            best = max((value(lab) for lab in np.ndindex(*(3,) * int(n))), default=0)
            assert value(tuple(got[at : at + n])) == pytest.approx(best)
            at += n


def test_languages_are_told_apart(spark, odd, nothing):
    rnd = random.Random(6)
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "xe", "qy"], "ru": ["да", "не", "по"]}
    make = lambda lang, n: " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n))
    docs = [(i, make(lang, 30), lang) for i, lang in enumerate(list(parts) * 40)]
    model = language_id.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "ru"]
    label = language_id.Labeller(model)
    mixed = make("aa", 20) + " " + make("ru", 20) + " " + make("bb", 20)
    assert [s[2] for s in label.spans(mixed)] == ["aa", "ru", "bb"]
    assert label.languages(["", "12 !", make("bb", 5), "日本"])[0][:3] == ["und", "und", "bb"]
    mixes = spark.createDataFrame([(1, mixed), (2, None), (3, "")], "doc_id int, text string")
    assert [(r.doc_id, r.first_word, r.last_word, r.lang) for r in language_id.spans(mixes, model).orderBy("doc_id", "first_word").collect()] == [(1, 0, 20, "aa"), (1, 20, 40, "ru"), (1, 40, 60, "bb")]
    got = language_id.identify(odd, model).collect()
    assert len(got) == odd.count()
    assert {r.lang_pred for r in got if r.doc_id in (2, 3, 4, 6)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.identify(nothing, model).count() == 0
    empty = language_id.fit(nothing)
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}


# Lines


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(1)
    for _ in range(500):
        a = "".join(rnd.choice("abé ") for _ in range(rnd.randrange(30)))
        b = "".join(c for c in a if rnd.random() < 0.9) + rnd.choice(["", "x", "ab"])
        assert line_dedup.edit_distance(a, b) == edit(a, b)


def test_similar_is_the_edit_similarity():
    rnd = random.Random(4)
    for _ in range(400):
        w = words(rnd, rnd.randrange(1, 9))
        v = [x for x in w if rnd.random() < 0.9] + (["x"] if rnd.random() < 0.2 else [])
        a, b = " ".join(w), " ".join(x if rnd.random() < 0.8 else x[::-1] for x in v)
        assert line_dedup.similar(a, b) == (max(len(a), len(b)) == 0 or 1 - edit(a, b) / max(len(a), len(b)) >= 0.8 - 1e-9)


def test_similar_tiny_lines_share_a_piece():
    rnd, found = random.Random(7), 0
    for _ in range(4000):
        a = "".join(rnd.choice("ab cé") for _ in range(rnd.randrange(1, 31)))
        b = list(a)
        for _ in range(rnd.randrange(1, 6)):
            k = rnd.randrange(len(b) + 1)
            b[k : k + rnd.randrange(2)] = rnd.choice(["", "x", "a"])
        b = "".join(b)[:30]
        if b and 1 - edit(a, b) / max(len(a), len(b)) >= 0.8 - 1e-9:
            found += 1
            assert line_dedup.pieces_of(a) & line_dedup.pieces_of(b), (a, b)
    assert found > 500


def plain_groups(lines):
    """Root of each line by plain edit similarity of all pairs, and the similar pairs."""
    parent, pairs = list(range(len(lines))), []
    for i, a in enumerate(lines):
        for j in range(i):
            b = lines[j]
            longer = max(len(a), len(b))
            if min(len(a), len(b)) >= 0.8 * longer - 1e-9 and sum((Counter(a) - Counter(b)).values()) <= 0.2 * longer + 1e-9 and 1 - edit(a, b) / longer >= 0.8 - 1e-9:
                parent[find(parent, i)] = find(parent, j)
                pairs.append((i, j))
    return [find(parent, i) for i in range(len(lines))], pairs


@pytest.mark.parametrize("most", [None, 3])
def test_repeated_lines_against_plain_edit_similarity(spark, monkeypatch, most):
    if most:  # so that blocks are dealt out
        monkeypatch.setattr(line_dedup, "MOST", most)
        monkeypatch.setattr(line_dedup, "FEW", most)
    rnd = random.Random(2)
    base = [" ".join(words(rnd, n)) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 15, 20, 30, 40) for _ in range(2)]

    def line():
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, max(1, len(w) // 8)])):
            k = rnd.randrange(len(w))
            w[k] = rnd.choice([rnd.choice(WORDS), w[k][1:], w[k] + "e", ""])
        return rnd.choice([" ", "  "]).join(w) + rnd.choice(["", ".", "!"])

    docs = [(i, "\n".join(line() if rnd.random() < 0.7 else " ".join(words(rnd, rnd.randrange(1, 20))) for _ in range(rnd.randrange(1, 5)))) for i in range(110)]
    docs += [(500, None), (501, ""), (502, "\n\n"), (503, "!!!"), (None, base[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    where = defaultdict(list)
    for i, text in docs:
        for k, w in enumerate(line_dedup.normal_words(None if text is None else text.encode())):
            if w:
                where[b" ".join(w).decode()].append((i, k))
    lines = list(where)
    roots, pairs = plain_groups(lines)
    got = {(r.doc_id, r.line_no): (r.group_doc_id, r.group_line_no, r.kept) for r in line_dedup.repeated_lines(df).collect()}
    root_of = {o: roots[i] for i, x in enumerate(lines) for o in where[x]}
    for o, (a, k, kept) in got.items():
        assert root_of[o] == root_of[a, k]  # no group goes beyond the plain one
        assert kept == (o == (a, k))
    for i, x in enumerate(lines):  # equal lines are one, whatever their ids
        if len(where[x]) > 1 or where[x][0] in got:
            assert len({got[o][:2] for o in where[x]}) == 1
    for short in (True, False):
        some = [(i, j) for i, j in pairs if (min(len(lines[i].split()), len(lines[j].split())) < line_dedup.LONG_WORDS) == short]
        assert len(some) > 30
        together = [where[lines[i]][0] in got and got[where[lines[i]][0]][:2] == got.get(where[lines[j]][0], (0, 0))[:2] for i, j in some]
        assert sum(together) >= 0.95 * len(some), short
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, drop_emptied=False).collect()}
    for i, text in docs:
        drop = {k for (a, k), v in got.items() if a == i and not v[2] and i is not None}
        assert out[i] == (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop))


def test_lines_of_odd_rows(odd, nothing):
    assert line_dedup.repeated_lines(nothing).count() == 0
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns
    assert {2, 3, 4, 5, 6} <= {r.doc_id for r in out.collect()}
    assert 7 not in {r.doc_id for r in out.collect()}  # its only line stands in document 1


# Quality


def test_quality_grades_held_out_texts(spark, odd, nothing):
    rnd = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        grade = rnd.choice([0, 1, 2, 2])
        w = words(rnd, 60) + {0: ["awful"] * 3, 1: ["junk%%%"] * 3, 2: []}[grade]
        rnd.shuffle(w)
        docs.append((i, " ".join(w)))
        labels.append((i, int(grade == 2), int(grade == 0)))
    d, r = spark.createDataFrame(docs, "doc_id long, text string"), quality.graded(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = quality.fit(d, r.where("doc_id < 700"))
    assert (np.diff(model.thresholds) > 0).all()
    keep = {x.doc_id: x.keep for x in quality.score(d.where("doc_id >= 700"), model).withColumn("keep", quality.selected()).collect()}
    assert sum(keep[i] == bool(q) for i, q, _ in labels[700:]) >= 190
    assert quality.score(odd, model).count() == odd.count()
    assert quality.score(nothing, model).count() == 0
    none = quality.fit(d, r.limit(0))
    assert quality.score(odd, none).count() == odd.count()
    loose = quality.graded(spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, 1)], "doc_id long, quality int, toxic int"))
    assert [tuple(x) for x in loose.collect()] == [(2, 0)]


# Top-k


def test_top_k_is_exact(spark):
    rnd = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rnd.normal(size=6).round(1)], 0) for i in range(400)]
    rows += [(1000, None, 0), (1050, [None] * 6, 0), (1100, [float("nan")] * 6, 0), (1150, [float("inf")] * 6, 0), (None, [1.0] * 6, 0), (1200, [], 0), (1250, [9.0], 0), (450, [0.1] * 6, 0), (451, [0.1] * 6, 0), (451, [0.1] * 6, 0), (500, [3.0] * 6, 0), (500, [-3.0] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for n, (q, v) in enumerate(good):
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for m, (i, w) in enumerate(good) if m != n)[:5]
            want.update((q, k + 1, i, -x) for k, (x, i) in enumerate(s))
    for kw in ({}, {"block": 3, "shard": 64, "sample": 7}):
        assert Counter(tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 50 == 0, **kw).collect()) == want
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_ball_tree_bounds_hold():
    rnd = np.random.default_rng(3)
    x = np.floor(rnd.normal(size=(700, 8)) * 100) + 50
    tree = top_k.BallTree(x, leaf=20)
    q = np.floor(rnd.normal(size=(9, 8)) * 100)
    bounds = tree.leaf_bounds(q, np.full(9, -np.inf))
    for j, (s, e) in enumerate(tree.levels[-1]):
        assert (bounds[:, j] >= (q @ x[tree.order[s:e]].T).max(axis=1)).all()
    assert sorted(tree.order.tolist()) == list(range(700))


# Tokens


def test_token_counts_are_the_library_s(spark, odd, nothing):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    small, big = token_counts.ChunkEncoder(path, 60, 4), token_counts.ChunkEncoder(path)
    rnd = random.Random(1)
    parts = ["a", "the", "b", " ", "  ", "\n", "\n\n", " \n", "\t", " ", "é", "中文", "，", "12", "s", "'s", "'", "...", "<|endoftext|>", "　", "x" * 30, "🙂", "\x1c", "\r\n", "<|end"]
    for i in range(400):
        text = "".join(rnd.choice(parts[:4] if i % 2 else parts) for _ in range(rnd.randrange(200)))
        n = len(small.tokenizer.encode(text, add_special_tokens=False).ids)
        assert small.count([text]) == big.count([text]) == [n], text
    text = "x" * 5000 + "中" * 3000
    assert small.count([text]) == [len(small.tokenizer.encode(text, add_special_tokens=False).ids)]
    got = token_counts.count_tokens(odd).collect()
    assert len(got) == odd.count()
    assert all((r.n_bytes, r.n_tokens, r.over_limit) == (0, 0, False) for r in got if r.doc_id in (2, 3))
    assert next(r for r in got if r.doc_id == 5).over_limit
    assert token_counts.count_tokens(nothing).count() == 0


# SimHash


def plain_fingerprint(text):
    w = (text or b"").lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, b"", b" \t", b"a", b"a b", b"A  b\tc", b"A b c d \n e f g" * 300, " É x ".encode(), b"x y z " * 30_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_links_connect_what_brute_force_connects(spark):
    rnd = random.Random(3)
    fps = {0, 1, 3, 7, 15, 2**64 - 1}
    for _ in range(40):
        base = here = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 40)):
            here = rnd.choice([base, here])
            for _ in range(rnd.randrange(5)):
                here ^= 1 << rnd.randrange(64)
            fps.add(here)
    fps = sorted(fps)
    signed = lambda x: x - (x >> 63 << 64)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    root = {r.node: r.root for r in connected_components(simhash.links(df), "a", "b").collect()}
    parent = list(range(len(fps)))
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                parent[find(parent, i)] = find(parent, j)
    want = defaultdict(set)
    for i, x in enumerate(fps):
        want[find(parent, i)].add(x)
    got = defaultdict(set)
    for x in fps:
        got[root.get(signed(x), signed(x))].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates_of_odd_rows(odd, nothing):
    got = {r.doc_id: r for r in simhash.near_duplicates(odd).collect()}
    assert {got[i].component_id for i in (2, 3, 4)} == {2}
    assert got[7].component_id == got[1].component_id == 1
    assert got[None].component_id is None
    kept = [r.doc_id for r in simhash.keep_one(odd).collect()]
    assert sorted(kept, key=repr) == sorted([1, 1, 2, None, 5, 6], key=repr)
    assert simhash.keep_one(odd).columns == odd.columns
    assert simhash.near_duplicates(nothing).count() == 0


def test_copies_by_plain_jaccard_similarity(spark):
    rnd, texts = random.Random(12), []
    for _ in range(60):
        w = words(rnd, rnd.randrange(30, 300))
        texts.append(" ".join(w))
        for _ in range(rnd.randrange(4)):
            v = list(w)
            for k in rnd.sample(range(len(v)), rnd.choice([1, 1, 2, 3])):
                v[k] = "zz"
            texts.append(rnd.choice([" ", "  "]).join(v).upper())
    sets = [shingles(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    parent = list(range(len(texts)))
    for i, j in near:
        parent[find(parent, i)] = find(parent, j)
    df = spark.createDataFrame([*enumerate(texts), (900, None), (901, " ")], "doc_id int, text string")
    got = {r.doc_id: r.component_id for r in simhash.copies(df).collect()}
    assert got[900] == got[901] == 900
    assert all(find(parent, i) == find(parent, got[i]) for i in range(len(texts)))
    assert len(near) > 50
    assert sum(got[i] == got[j] for i, j in near) >= 0.98 * len(near)


def test_ids_of_any_whole_type(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id int, text string")
    assert [r.component_id for r in simhash.near_duplicates(df).collect()] == [1, 1]
    assert [r.n_bytes for r in token_counts.count_tokens(df).collect()] == [5, 5]


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, j) for j in range(1001, 1040)] + [(5000, 5000), (None, 3)]
    root = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert len({root[i] for i in range(61)}) == 1
    assert len({root[i] for i in range(1000, 1040)}) == 1
    assert root[0] != root[1000]
    assert 5000 not in root


# Queries


def test_queries_are_registered():
    assert sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES) == list(range(1, 11))
