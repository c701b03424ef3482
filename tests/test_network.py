"""Networks: small inline basins, and random forests against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fluvial.operators import graph

REACH = "id long, hydroseq double, dnhydroseq double"


def forest(spark, rows):
    return spark.createDataFrame(rows, "id long, down long, w double")


@pytest.mark.parametrize(
    ("rows", "links", "ends"),
    [
        ([(1, 100.0, 200.0), (2, 200.0, 300.0), (3, 300.0, 0.0)], {(1, 2), (2, 3)}, {3}),
        ([(1, 100.0, 300.0), (2, 200.0, 300.0), (3, 300.0, 0.0)], {(1, 3), (2, 3)}, {3}),
        ([(1, 100.0, 200.0), (2, 200.0, 0.0), (3, 300.0, 400.0), (4, 400.0, 0.0)], {(1, 2), (3, 4)}, {2, 4}),
        ([(1, 100.0, 200.0), (2, 200.0, None), (3, 300.0, 999.0)], {(1, 2)}, {3}),
        ([], set(), set()),
    ],
)
def test_edges_and_outlets(spark, rows, links, ends):
    reaches = spark.createDataFrame(rows, REACH)
    assert {(r.up_id, r.dn_id) for r in graph.edges(reaches).collect()} == links
    assert {r.id for r in graph.outlets(reaches).collect()} == ends


def test_walks_sums_orders_and_stems_of_a_random_forest(spark):
    rnd = random.Random(3)
    down = {i: None if i < 3 else rnd.randrange(max(0, i - 6), i) for i in range(120)}
    weight = {i: float(rnd.randrange(1, 9)) for i in down}
    f = forest(spark, [(i, d, weight[i]) for i, d in down.items()])
    got = {r.id: (r.outlet_id, r.depth, r.path) for r in graph.to_outlet(f, F.col("w")).collect()}

    def walk(i):
        depth, path = 0, 0.0
        while down[i] is not None:
            i = down[i]
            depth, path = depth + 1, path + weight[i]
        return i, depth, path

    assert got == {i: walk(i) for i in down}
    ups = {i: [j for j in down if down[j] == i] for i in down}
    total = {i: weight[i] for i in down}
    order = {}
    for i in sorted(down, reverse=True):
        total[i] += sum(total[j] for j in ups[i])
        o = [order[j] for j in ups[i]]
        order[i] = (max(o) + (o.count(max(o)) > 1)) if o else 1
    tables = graph.jump_tables(f)
    assert {r.id: r.w for r in graph.upstream_sums(f, ["w"], tables).collect()} == total
    for by_level in (None, True, False):
        assert {r.id: r.stream_order for r in graph.stream_order(f, tables, by_level).collect()} == order
    reaches = spark.createDataFrame([(i, down[i], order[i], total[i]) for i in down], "id long, down long, stream_order int, total_area double")
    head = {}
    for i in sorted(down):
        best = down[i] is not None and min(ups[down[i]], key=lambda j: (-order[j], -total[j], j)) == i
        head[i] = head[down[i]] if best else i
    assert {r.id: r.mainstem_head for r in graph.mainstems(reaches).collect()} == head
    seq = {r.id: (r.hydroseq, r.dn_hydroseq) for r in graph.hydroseq(graph.to_outlet(f), f).collect()}
    assert sorted(s for s, _ in seq.values()) == list(range(len(down)))
    assert all(seq[i][1] == (seq[d][0] if d is not None else 0) and (d is None or seq[d][0] < seq[i][0]) for i, d in down.items())


def test_cycles_are_found(spark):
    f = forest(spark, [(1, 2, 0.0), (2, 3, 0.0), (3, 1, 0.0), (4, 1, 0.0), (5, None, 0.0), (6, 5, 0.0)])
    assert {r.id for r in graph.cyclic(f).collect()} == {1, 2, 3, 4}
    with pytest.raises(ValueError, match="cycle"):
        graph.jump_tables(f)


def test_components_and_divergence(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (20, 20), (None, 5)]
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {(r.node, r.component) for r in graph.components(df, "a", "b").collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (10, 10), (11, 10), (12, 10), (20, 20)}
    links = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "up_id long, dn_id long")
    assert [tuple(r) for r in graph.divergent(links).collect()] == [(1, 2)]
