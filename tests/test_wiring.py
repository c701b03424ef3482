"""References, tributaries and divides on small hand-made networks; polygons on lines."""

import math

from fluvial.operators import overlays, wiring


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_segment_is_covered_before_references_choose(spark):
    segments = spark.createDataFrame([(1, 11, 0.0, 10.0), (1, 12, 10.0, 10.0), (1, 13, 10.0, 30.0), (2, 21, 5.0, 5.0)], "unit long, seg_id long, a double, b double")
    refs = spark.createDataFrame(
        [(1, "x", 0, 0.0, 9.0), (1, "y", 1, 2.0, 8.0), (1, "z", 2, 1.0, 2.0), (2, "w", 0, 0.0, 1.0), (3, "v", 0, 0.0, 1.0)], "unit long, ref_id string, rank int, a double, b double"
    )
    # x overlaps the first segment most; of the others y's middle is nearer to the second, which nothing overlaps.
    assert rows(wiring.assign_references(segments, refs)) == [(1, "x", 11), (1, "y", 13), (1, "z", 11)]
    assert wiring.assign_references(segments, refs.limit(0)).count() == 0
    assert wiring.assign_references(segments.limit(0), refs).count() == 0


def test_ties_of_references_go_to_the_lower_rank_and_the_earlier_segment(spark):
    segments = spark.createDataFrame([(1, 1, 0.0, 10.0), (1, 2, 10.0, 20.0)], "unit long, seg_id long, a double, b double")
    refs = spark.createDataFrame([(1, 7, 1, 5.0, 15.0), (1, 8, 0, 5.0, 15.0), (1, 9, 2, 5.0, 15.0)], "unit long, ref_id long, rank int, a double, b double")
    assert rows(wiring.assign_references(segments, refs)) == [(1, 7, 2), (1, 8, 1), (1, 9, 1)]


def test_places_beyond_the_segments_take_the_nearest_end(spark):
    segments = spark.createDataFrame([(1, 1, 2.0, 10.0), (1, 2, 14.0, 20.0)], "unit long, seg_id long, a double, b double")
    places = spark.createDataFrame([(1, 1, 0.0), (1, 2, 10.0), (1, 3, 12.0), (1, 4, 13.0), (1, 5, 99.0), (2, 6, 1.0)], "unit long, ref_id long, at double")
    assert rows(wiring.segment_at(segments, places)) == [(1, 1, 1), (1, 2, 1), (1, 3, 1), (1, 4, 2), (1, 5, 2)]


def test_tributaries_reuse_the_nexus_below(spark):
    chains = spark.createDataFrame([(5, [5, 6], 20, 1.5, 0.0), (7, [7], 10, 2.0, 0.0), (9, [9], 5, 1.0, 0.0)], "dn_ref long, refs array<long>, hydroseq long, length_km double, area_sqkm double")
    reaches = spark.createDataFrame([(5, 1), (6, 5), (7, 2), (9, 3)], "id long, down long")
    units = spark.createDataFrame([(100, 1), (100, 2)], "unit long, ref_id long")
    shares = spark.createDataFrame([(5, 0.25), (6, 0.5)], "ref_id long, share double")
    nexuses = spark.createDataFrame([(1, 77)], "ref_id long, nex_id long")
    virtual, taken = wiring.tributaries(chains, reaches, units, shares, nexuses, 50)
    # Reach 9 flows into no unit; ids run by hydroseq all the same.
    assert rows(virtual) == [(51, 51, 100, 2.0, 0.0, 0.0, True), (52, 77, 100, 1.5, 0.0, 0.75, False)]
    assert rows(taken) == [(5, 52, 100), (6, 52, 100), (7, 51, 100)]


def test_open_ends_move_to_the_head_below(spark):
    paths = spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, 5), (5, None)], "fp_id long, fp_to_id long")
    virtual = spark.createDataFrame(
        [(10, 1, None, 900), (11, 1, 200, 900), (12, 1, None, 901), (20, 2, 200, 902), (30, 3, None, 903), (40, 4, None, 904), (50, 5, None, 905)],
        "virtual_fp_id long, div_id long, up_virtual_nex_id long, dn_virtual_nex_id long",
    )
    fed = spark.createDataFrame([(901, 11)], "nex_id long, virtual_fp_id long")
    heads = spark.createDataFrame([(2, 200), (3, 300)], "fp_id long, nex_id long")
    fallbacks = spark.createDataFrame([(5, 50), (3, 30)], "fp_id long, virtual_fp_id long")
    out, removed, more = wiring.wire(paths, virtual, fed, heads, fallbacks)
    ends = {r.virtual_fp_id: r.dn_virtual_nex_id for r in out.collect()}
    # 11 begins at the head below, so it keeps its end; 12 flows on inside its divide; 40's neighbour has a fallback alone.
    assert ends == {10: 200, 11: 900, 12: 901, 20: 300, 30: 903, 40: 904, 50: 905}
    assert rows(removed) == [(900,), (902,)]
    assert rows(more) == [(901, 11), (904, 50)]


def test_main_ends_are_the_farthest_free_ends(spark):
    lines = spark.createDataFrame(
        [(1, 0, [(0.0, 0.0), (1.0, 0.0)]), (1, 1, [(1.0, 0.0), (4.0, 0.0)]), (1, 2, [(1.0, 0.0), (1.0, 1.0)]), (2, 0, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]), (3, 0, [(5.0, 5.0)]), (4, 0, None)],
        "id long, part int, line array<struct<x:double,y:double>>",
    )
    assert rows(wiring.main_ends(lines)) == [(1, 0.0, 0.0, 4.0, 0.0, 4.0), (2, 0.0, 0.0, 0.0, 0.0, None)]


def test_polygons_take_the_path_of_most_ancestors(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0), (0.0, 0.0)]  # an L
    polygons = spark.createDataFrame([(1, ring), (2, [(x + 50, y) for x, y in ring])], "id long, ring array<struct<x:double,y:double>>")
    lines = spark.createDataFrame(
        [(1, [(-1.0, 0.5), (5.0, 0.5)]), (2, [(0.5, 5.0), (0.5, 2.0)]), (3, [(2.0, 2.0), (2.0, 0.9)]), (4, [(0.2, 3.9), (0.8, 3.9)]), (5, [(2.0, 3.0), (3.0, 2.0)])],
        "id long, line array<struct<x:double,y:double>>",
    )
    ancestors = spark.createDataFrame([(1, 3), (2, 9), (3, 50), (4, 9), (5, 99)], "id long, n long")
    got = {r.id: r for r in overlays.polygon_paths(polygons, lines, ancestors, 0.5, 3.0).collect()}
    assert got[1].line_id == 4  # of two with nine ancestors the greater id; 3 is in by 0.1 alone, 5 lies in the notch
    assert math.isclose(got[1].x, (4 * 2 + 3 * 0.5) / 7) and math.isclose(got[1].y, (4 * 0.5 + 3 * 2.5) / 7)
    assert got[2].line_id is None
    lakes = polygons.selectExpr("id", "ring", "id * 100 AS line_id")
    assert rows(overlays.lake_paths(lakes, lines, 3.0)) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 200)]
