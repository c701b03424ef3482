"""Which reference belongs to which segment of a main stem, the flowpaths of tributaries, and how the divides' virtual networks join.

Segments and references of a unit (one divide) meet as two arrays, so nothing is laid out pair by pair and the rules, of which one depends
on order, are expressions on them. The rest are joins by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvial.operators.keyed import arg_max, arg_min, running_ids


def _segments(segments: DataFrame) -> DataFrame:
    """unit, segs: the segments that have a length, in order."""
    some = segments.where(F.col("b") > F.col("a"))
    return some.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("a", "b", "seg_id"))).alias("segs"))


def _score(seg: Column, ref: Column) -> Column:
    """Length in common; without any, the distance between the middles with a minus."""
    common = F.least(seg["b"], ref["b"]) - F.greatest(seg["a"], ref["a"])
    return F.when(common > 0, common).otherwise(-F.abs((ref["a"] + ref["b"]) / 2 - (seg["a"] + seg["b"]) / 2))


def assign_references(segments: DataFrame, refs: DataFrame) -> DataFrame:
    """unit, ref_id, seg_id: the segment of every one of refs(unit, ref_id, rank, a, b) by segments(unit, seg_id, a, b), both as places along the main stem.

    First each segment, from the stem's start, takes the best reference that no other has taken, so all are covered while references last; then
    each reference left takes its best segment. Ties go to the lower rank, or to the earlier segment. Segments without length take
    none; units without segments give no rows.
    """
    listed = refs.groupBy("unit").agg(F.collect_list(F.struct("rank", "ref_id", "a", "b")).alias("refs"))
    both = listed.join(_segments(segments), "unit")
    seg_type, ref_type = dict(segments.dtypes)["seg_id"], dict(refs.dtypes)["ref_id"]
    none = F.array().cast(f"array<struct<score:double,worse:long,ref_id:{ref_type},seg_id:{seg_type}>>")

    def take(taken: Column, seg: Column) -> Column:
        free = F.filter("refs", lambda r: ~F.exists(taken, lambda t: t["ref_id"] == r["ref_id"]))
        row = lambda r: F.struct(_score(seg, r).cast("double").alias("score"), (-r["rank"]).cast("long").alias("worse"), r["ref_id"].alias("ref_id"), seg["seg_id"].alias("seg_id"))
        best = F.array_max(F.transform(free, row))
        return F.when(best.isNull(), taken).otherwise(F.concat(taken, F.array(best)))

    rows = both.withColumn("taken", F.aggregate("segs", none, take)).select("unit", "segs", "taken", F.explode("refs").alias("ref"))
    own = F.get(F.filter("taken", lambda t: t["ref_id"] == F.col("ref.ref_id")), F.lit(0))["seg_id"]
    best = F.array_max(F.transform("segs", lambda s, i: F.struct(_score(s, F.col("ref")).alias("score"), (-i).alias("worse"), s["seg_id"].alias("seg_id"))))["seg_id"]
    return rows.select("unit", F.col("ref.ref_id").alias("ref_id"), F.coalesce(own, best).alias("seg_id"))


def segment_at(segments: DataFrame, places: DataFrame) -> DataFrame:
    """unit, ref_id, seg_id: the first of segments(unit, seg_id, a, b) that holds the place of places(unit, ref_id, at), else the one of the nearest end, the
    earlier on ties."""
    both = places.join(_segments(segments), "unit")
    at = F.col("at")

    def far(s: Column, i: Column) -> Column:
        inside = at.between(s["a"], s["b"])
        return F.struct(F.when(inside, 0.0).otherwise(F.least(F.abs(at - s["a"]), F.abs(at - s["b"]))).alias("far"), (~inside).alias("outside"), i.alias("i"), s["seg_id"].alias("seg_id"))

    return both.select("unit", "ref_id", F.array_min(F.transform("segs", far))["seg_id"].alias("seg_id"))


def tributaries(chains: DataFrame, reaches: DataFrame, units: DataFrame, shares: DataFrame, nexuses: DataFrame, first_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """Virtual flowpaths of chains(dn_ref, refs, hydroseq, length_km, area_sqkm) outside the main stems, and the references that they take.

    Ids run from first_id by (hydroseq, dn_ref). The divide is that of units(unit, ref_id) below the lowest reference by reaches(id, down); a chain
    that flows into none gives no row. Its share is the sum of its members' shares(ref_id, share), 0 where unknown. It ends in the nexus of
    nexuses(ref_id, nex_id) of the reference below, else in one of its own with its own id (new_nexus). The second table has
    ref_id, virtual_fp_id, div_id; of several chains the last takes a reference.
    """
    below = reaches.select(F.col("id").alias("dn_ref"), F.col("down").alias("below"))
    divide = units.select(F.col("ref_id").alias("below"), F.col("unit").alias("div_id"))
    named = running_ids([chains], ["hydroseq", "dn_ref"], "virtual_fp_id", first_id)
    placed = named.join(below, "dn_ref").join(divide, "below")
    members = placed.select("virtual_fp_id", "div_id", F.explode("refs").alias("ref_id"))
    share = members.join(shares, "ref_id").groupBy("virtual_fp_id").agg(F.sum("share").alias("share"))
    at = placed.join(nexuses.select(F.col("ref_id").alias("below"), "nex_id"), "below", "left").join(share, "virtual_fp_id", "left")
    virtual = at.select(
        "virtual_fp_id", F.coalesce("nex_id", "virtual_fp_id").alias("dn_virtual_nex_id"), "div_id", "length_km", "area_sqkm", F.coalesce("share", F.lit(0.0)).alias("share"), F.col("nex_id").isNull().alias("new_nexus")
    )
    own = placed.select("virtual_fp_id", "div_id", F.col("dn_ref").alias("ref_id"))
    taken = arg_max(members.unionByName(own), ["ref_id"], F.col("virtual_fp_id")).select("ref_id", "virtual_fp_id", "div_id")
    return virtual, taken


def wire(paths: DataFrame, virtual: DataFrame, fed: DataFrame, heads: DataFrame, fallbacks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Join the virtual networks of neighbouring divides: (virtual, removed, fed).

    An open end is a dn_virtual_nex_id of virtual(virtual_fp_id, div_id, up_virtual_nex_id, dn_virtual_nex_id) from which nothing flows on by
    fed(nex_id, virtual_fp_id). In a divide whose lower neighbour, by paths(fp_id, fp_to_id), has a head nexus in heads(fp_id, nex_id), open
    ends move to the head, but for flowpaths that begin there; the nexuses left are in removed(nex_id). Where the neighbour has only a
    flowpath of fallbacks(fp_id, virtual_fp_id), the open end feeds that. A nexus on several divides goes by the least of them.
    """
    head = heads.select(F.col("fp_id").alias("fp_to_id"), F.col("nex_id").alias("head"))
    fallback = fallbacks.select(F.col("fp_id").alias("fp_to_id"), F.col("virtual_fp_id").alias("feeds"))
    lower = paths.where("fp_to_id IS NOT NULL").join(head, "fp_to_id", "left").join(fallback, "fp_to_id", "left")
    lower = lower.select(F.col("fp_id").alias("div_id"), "head", F.when(F.col("head").isNull(), F.col("feeds")).alias("feeds"))
    rows = virtual.join(lower, "div_id", "left")
    movable = F.col("head").isNotNull() & ~F.col("head").eqNullSafe(F.col("up_virtual_nex_id"))
    open_ends = rows.join(fed.select(F.col("nex_id").alias("dn_virtual_nex_id")), "dn_virtual_nex_id", "left_anti").where(movable | F.col("feeds").isNotNull())
    events = open_ends.select(F.col("dn_virtual_nex_id").alias("nex_id"), "div_id", "feeds")
    decided = arg_min(events, ["nex_id"], F.col("div_id"))
    removed = decided.where("feeds IS NULL").select("nex_id")
    gone = removed.select(F.col("nex_id").alias("gone"))
    moved = rows.join(gone, F.col("dn_virtual_nex_id") == F.col("gone"), "left")
    out = moved.withColumn("dn_virtual_nex_id", F.when(F.col("gone").isNotNull() & movable, F.col("head")).otherwise(F.col("dn_virtual_nex_id"))).select(*virtual.columns)
    more = decided.where("feeds IS NOT NULL").select("nex_id", F.col("feeds").alias("virtual_fp_id"))
    return out, removed, fed.select("nex_id", "virtual_fp_id").unionByName(more)


def main_ends(lines: DataFrame) -> DataFrame:
    """id, ax, ay, bx, by, dist of lines(id, part, line), parts by number: the two farthest of the ends that only one part has, or of all where there is none such.

    Of equal distances the ends that come first count. A line with one end in all has it twice, and no distance.
    """
    end = lambda k, i: F.struct((F.col("part") * 2 + k).alias("no"), F.element_at("line", i).alias("p"))
    ends = lines.where("size(line) > 1").select("id", F.explode(F.array(end(0, 1), end(1, -1))).alias("e"))
    points = ends.groupBy("id", F.col("e.p.x").alias("x"), F.col("e.p.y").alias("y")).agg(F.count("*").alias("n"), F.min("e.no").alias("no"))
    listed = points.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("no", "x", "y", "n"))).alias("all"))
    single = F.filter("all", lambda p: p["n"] == 1)
    listed = listed.select("id", F.when(F.size(single) > 0, single).otherwise(F.col("all")).alias("c"))
    to_later = lambda p, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda q: F.struct(F.sqrt((p["x"] - q["x"]) ** 2 + (p["y"] - q["y"]) ** 2).alias("dist"), (-p["no"]).alias("i"), (-q["no"]).alias("j"), p.alias("p"), q.alias("q")))
    best = F.array_max(F.flatten(F.transform("c", to_later)))
    first = F.element_at("c", 1)
    row = listed.select("id", best.alias("best"), first.alias("first"))
    pick = lambda side, c: F.coalesce(F.col(f"best.{side}.{c}"), F.col(f"first.{c}"))
    return row.select("id", pick("p", "x").alias("ax"), pick("p", "y").alias("ay"), pick("q", "x").alias("bx"), pick("q", "y").alias("by"), F.col("best.dist").alias("dist"))
