"""Simplification of small basins."""

from __future__ import annotations

import random
from collections import defaultdict

from fluvial.operators import simplify

COLUMNS = "outlet_id long, id long, down long, stream_order int, area double, length double, has_divide boolean"


def run(spark, rows, **kw):
    out = defaultdict(set)
    for r in simplify.classify(spark.createDataFrame(rows, COLUMNS), **kw).collect():
        out[r["class"]].add((r.id, r.target) if r.target else r.id)
    return out


def test_small_basins(spark):
    big = [(1, 1, None, 2, 9.0, 2.0, True), (1, 2, 1, 1, 5.0, 2.0, True), (1, 3, 1, 1, 4.0, 2.0, True)]
    out = run(spark, big)
    assert (out["connector"], out["independent"], out["merged"]) == ({"1"}, {"2", "3"}, set())
    small = [(1, 1, None, 2, 0.5, 2.0, True), (1, 2, 1, 1, 5.0, 2.0, True), (1, 3, 1, 1, 4.0, 2.0, True)]
    out = run(spark, small)
    assert out["merged"] == {("1", "2"), ("3", "1")}
    assert out["virtual"] == {("3", "1")}
    chain = [(1, 1, None, 1, 1.0, 2.0, True), (1, 2, 1, 1, 1.0, 2.0, True), (1, 3, 2, 1, 1.5, 2.0, True), (1, 4, 3, 1, 1.0, 2.0, True)]
    out = run(spark, chain)
    assert out["merged"] == {("1", "2"), ("2", "3")}
    assert out["independent"] == {"4"}
    assert run(spark, [(1, 1, None, 1, 1.0, 2.0, False)])["visited"] == set()
    short = [(1, 1, None, 1, 5.0, 2.0, True), (1, 2, 1, 1, 5.0, 0.1, True)]
    assert run(spark, short)["virtual"] == {("2", "1")}
    assert run(spark, short, overrides={"2": (("turn_over", "self", "down"),)})["merged"] == {("2", "1")}


def test_basins_stay_apart_below_their_outlets(spark):
    basin = lambda o: [(o, o, None, 2, 0.001, 2.0, True), *((o, o + k, o, 2, 5.0, 2.0, True) for k in (1, 2, 3))]
    classes = simplify.classify(spark.createDataFrame(basin(10) + basin(20), COLUMNS))
    assert {r.outlet_id for r in classes.where("class = 'merged' AND target = '0'").collect()} == {"10", "20"}
    units = simplify.units(classes).collect()
    assert all(u.unit != "0" and u.ref_id != "0" for u in units)
    outlets = {}
    for u in units:
        outlets.setdefault(u.unit, set()).add(u.outlet_id)
    assert all(len(x) == 1 for x in outlets.values())
    assert {u.ref_id for u in units} >= {"10", "20"}


def test_every_reach_is_classified_once_walked(spark):
    rnd = random.Random(6)
    rows, order = [], {}
    down = {i: None if i == 0 else rnd.randrange(max(0, i - 5), i) for i in range(150)}
    for i in sorted(down, reverse=True):
        o = [order[j] for j in down if down[j] == i]
        order[i] = (max(o) + (o.count(max(o)) > 1)) if o else 1
    for i, d in down.items():
        rows.append((0, i, d, order[i], rnd.choice([0.001, 0.5, 2.0, 8.0]), rnd.choice([0.1, 1.0]), rnd.random() < 0.7))
    out = run(spark, rows)
    said = {x[0] if isinstance(x, tuple) else x for c in ("independent", "connector", "merged", "virtual", "dropped") for x in out[c]} | {t for _, t in out["merged"]}
    assert out["visited"] <= said | {"0"}
    assert out["visited"] == {str(i) for i in down}
    again = run(spark, rows[::-1])
    assert again == out
    units = simplify.units(simplify.classify(spark.createDataFrame(rows, COLUMNS))).collect()
    assert len({(u.outlet_id, u.ref_id) for u in units}) == len(units)
