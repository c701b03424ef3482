"""Network simplification: which reaches become routing units of their own, which are merged, which stay as virtual lines.

The rules depend on the order in which reaches are met, from the outlet upstream, so a basin is one unit of work: its rows are grouped by outlet and
a small machine walks them. It is written as rules that return effects and one place that carries them out. Everything is taken in sorted order, so the
result doesn't depend on partitions. Basins are bounded by the largest river; all else about the network is set-based (see graph).
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the rules: square kilometres, square kilometres, kilometres.
UNIT_AREA, SLIVER_AREA, SHORT_HEADWATER = 3.0, 0.005, 0.3
NOWHERE = "0"


@dataclass
class Basin:
    """The reaches of one outlet: downstream id, order, area, length, and which have a divide."""

    down: dict[str, str]
    order: dict[str, int]
    area: dict[str, float]
    length: dict[str, float]
    divides: set[str]
    ups: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.ups = {i: [] for i in self.down}
        for i in sorted(self.down):
            if self.down[i] in self.ups:
                self.ups[self.down[i]].append(i)

    def above(self, start: str) -> list[str]:
        """start and everything upstream of it, nearest first."""
        out, queue = [], deque([start])
        while queue:
            out.append(queue.popleft())
            queue.extend(self.ups[out[-1]])
        return out

    def bare_above(self, start: str) -> bool:
        """Whether nothing strictly upstream has a divide."""
        return self.divides.isdisjoint(self.above(start)[1:])

    def bare_two_layers(self, ups: list[str]) -> bool:
        return self.divides.isdisjoint(ups) and all(self.divides.isdisjoint(self.ups[u]) for u in ups)

    def stem(self, start: str) -> set[str]:
        """The reaches of the longest chain that ends in start; the least ids on ties."""
        best: dict[str, tuple[int, str | None]] = {}
        for i in reversed(self.above(start)):
            tops = [(-best[u][0], u) for u in self.ups[i]]
            best[i] = (1 - min(tops)[0], min(tops)[1]) if tops else (1, None)
        out, here = set(), start
        while here is not None:
            out.add(here)
            here = best[here][1]
        return out

    def greatest(self, ids: list[str]) -> str:
        """Of greatest order, then area, then id as text."""
        return max(ids, key=lambda i: (self.order[i], self.area[i], i))


@dataclass
class Classes:
    independent: set[str] = field(default_factory=set)
    connectors: set[str] = field(default_factory=set)
    minor: dict[str, str] = field(default_factory=dict)  # virtual line -> what it was turned over to, the first that did
    dropped: set[str] = field(default_factory=set)  # not routing reaches
    merged: set[tuple[str, str]] = field(default_factory=set)
    in_merge: set[str] = field(default_factory=set)
    forced: set[str] = field(default_factory=set)
    done: set[str] = field(default_factory=set)


class Simplifier:
    """Classes of one basin's reaches."""

    def __init__(self, basin: Basin, overrides: dict[str, tuple[str, ...]] | None = None, unit_area: float = UNIT_AREA, short_headwater: float = SHORT_HEADWATER):
        self.b, self.c, self.carried = basin, Classes(), {}
        self.queue: deque[str] = deque()
        self.overrides, self.unit_area, self.short = overrides or {}, unit_area, short_headwater

    def run(self, outlet: str) -> Classes:
        if self.b.divides:
            self.queue.append(outlet)
            while self.queue:
                here = self.queue.popleft()
                if here in self.c.done:
                    continue
                self.c.done.add(here)
                for effect, *args in self._override(here) or self._rule(here):
                    getattr(self, f"_do_{effect}")(*args)
        return self.c

    def _override(self, i: str) -> list[tuple]:
        """Effects set down for one reach: (effect, ...), a word self or down standing for the ids."""
        names = {"self": i, "down": self.b.down[i]}
        return [tuple(names.get(x, x) if isinstance(x, str) else x for x in effect) for effect in self.overrides.get(i, ())]

    # Effects

    def _do_merge(self, i: str, into: str) -> None:
        self.c.merged.add((i, into))
        self.c.in_merge |= {i, into}

    def _do_minor(self, i: str, to: str) -> None:
        self.c.dropped.add(i)
        self.c.minor.setdefault(i, to)

    def _do_turn_over(self, start: str, to: str) -> None:
        """All from start upstream becomes virtual and part of `to`."""
        for i in self.b.above(start):
            self._do_minor(i, to)
            self._do_merge(i, to)
            self.c.done.add(i)

    def _do_gather(self, start: str) -> None:
        """All from start upstream becomes part of start; off the longest chain, or everywhere without divides, it is virtual."""
        everything = self.b.above(start)
        bare = self.b.divides.isdisjoint(everything)
        stem = self.b.stem(start)
        if bare:
            self.c.dropped.add(start)
        for i in everything:
            self.c.done.add(i)
            if bare or i not in stem:
                self._do_minor(i, self.b.down[i])
            self._do_merge(i, start)

    def _do_independent(self, i: str) -> None:
        if i not in self.c.in_merge:
            self.c.independent.add(i)

    def _do_connector(self, i: str) -> None:
        if i not in self.c.in_merge:
            self.c.connectors.add(i)

    def _do_release(self, i: str) -> None:
        self.c.connectors.discard(i)

    def _do_demote(self, i: str) -> None:
        self.c.independent.discard(i)

    def _do_carry(self, i: str, area: float) -> None:
        self.carried[i] = area

    def _do_force(self, i: str) -> None:
        self.c.forced.add(i)

    def _do_visit(self, *ids: str) -> None:
        self.queue.extend(i for i in ids if i not in self.c.done)

    # Rules

    def _rule(self, i: str) -> list[tuple]:
        ups = self.b.ups[i]
        if not ups:
            return self._headwater(i)
        if len(ups) == 1:
            return self._single(i, ups[0])
        return self._confluence(i, ups) if i in self.b.divides else self._bare_confluence(i, ups)

    def _headwater(self, i: str) -> list[tuple]:
        b = self.b
        short = b.order[i] == 1 and b.down[i] != NOWHERE and b.length[i] < self.short
        return [("minor", i, b.down[i])] if i not in b.divides or short else [("independent", i)]

    def _hand_down(self, i: str) -> list[tuple]:
        """A bare branch: gathered where it joins a connector, else turned over to what is downstream."""
        to = self.b.down[i]
        return [("gather", i)] if to in self.c.connectors else [("turn_over", i, to), ("demote", to)]

    def _single(self, i: str, up: str) -> list[tuple]:
        b, to = self.b, self.b.down[i]
        if i not in b.divides:
            if b.order[i] <= 2:
                return [("gather", i)]
            if b.bare_two_layers([up]) and b.bare_above(i):
                return self._hand_down(i)
        total = self.carried.get(i, 0.0) + b.area[i]
        if b.area[i] < SLIVER_AREA:  # the sum goes on from the area downstream, as the rules have it
            return [("merge", i, up), *([("carry", up, b.area[to] + b.area[i])] if to in b.area else []), ("visit", up)]
        if total < self.unit_area:
            return [("merge", i, up), ("carry", up, total), ("visit", up)]
        alone = i in b.divides and up in b.divides
        return [("independent", i) if alone else ("merge", i, up), ("visit", up)]

    def _sink_sliver(self, i: str, ups: list[str]) -> list[tuple]:
        to = self.b.down[i]
        return [("release", to), ("merge", i, to), ("demote", to), ("visit", *ups)]

    def _confluence(self, i: str, ups: list[str]) -> list[tuple]:
        b, to = self.b, self.b.down[i]
        fresh = [u for u in ups if u not in self.c.done]
        low, high = [u for u in fresh if b.order[u] == 1], [u for u in fresh if b.order[u] > 1]
        total, sliver = self.carried.get(i, 0.0) + b.area[i], b.area[i] < SLIVER_AREA
        as_connector = [("connector", i), ("visit", *ups)]
        if not fresh:
            return as_connector
        if high and len(ups) > 2:
            return self._sink_sliver(i, ups) if sliver else as_connector
        if len(high) > 1 or (high and not low):
            return as_connector
        main = high[0] if high else b.greatest(low)
        others = [u for u in low if u != main]
        if sliver and to != NOWHERE:
            return self._sink_sliver(i, ups)
        if sliver and not high:
            return [("merge", i, main), ("demote", main), ("visit", *ups)]
        absorbed = [("merge", i, main), *(("turn_over", u, i) for u in others), ("visit", main)]
        if sliver:
            return [("demote", main), *absorbed]
        return [("carry", main, total), *absorbed] if total < self.unit_area else as_connector

    def _keep_one(self, i: str, main: str, others: list[str], *, force: bool) -> list[tuple]:
        turned = [e for u in others for e in ([("force", u)] if force else []) + [("turn_over", u, i)]]
        return [("merge", i, main), *turned, ("visit", main)]

    def _bare_confluence(self, i: str, ups: list[str]) -> list[tuple]:
        b, to = self.b, self.b.down[i]
        fresh = [u for u in ups if u not in self.c.done]
        if b.order[i] == 1:
            return self._hand_down(i)
        if not fresh:
            return []
        main = b.greatest(fresh)
        if to == NOWHERE:
            return self._keep_one(i, main, [u for u in fresh if u != main], force=False)
        if b.ups.get(to, []) in ([i], []):
            joined = [("release", to), ("merge", i, to), ("demote", to)]
            bare = [u for u in ups if u not in b.divides]
            if len(bare) == len(ups) and b.bare_above(i):
                return [*joined, ("gather", i)]
            if bare and (len(bare) == len(ups) or main not in b.divides):
                return [*joined, *self._keep_one(i, main, [u for u in ups if u != main], force=True)]
            if bare:
                return [*joined, ("connector", i), ("visit", *ups)]
            small = [u for u in fresh if b.order[u] == 1]
            return [*joined, ("connector", i), *(("turn_over", u, i) for u in small), ("visit", *(u for u in fresh if b.order[u] > 1))]
        if b.bare_two_layers(ups):
            return self._hand_down(i)
        small, large = [u for u in fresh if b.order[u] <= 2], [u for u in fresh if b.order[u] > 2]
        if not small:
            return self._sink_sliver(i, ups)
        if not large:
            return self._keep_one(i, main, [u for u in small if u != main], force=True)
        turned = [e for u in small for e in (("force", u), ("turn_over", u, i))]
        return [("merge", i, main), *turned, ("visit", *large)]


OUT = "outlet_id string, id string, class string, target string"


def classify(reaches: DataFrame, overrides: dict[str, tuple] | None = None, unit_area: float = UNIT_AREA, short_headwater: float = SHORT_HEADWATER) -> DataFrame:
    """outlet_id, id, class, target of reaches(outlet_id, id, down, stream_order, area, length, has_divide): a row for each thing said of a reach.

    Classes are independent, connector, dropped, forced and visited, and with a target merged and virtual. Ids are text; a null or absent downstream
    reach is 0, a null length is endless. A basin without any divide has no rows.
    """

    def basin(pdf: pd.DataFrame) -> pd.DataFrame:
        outlet = pdf["outlet_id"].iloc[0]
        col = lambda c: dict(zip(pdf["id"], pdf[c], strict=True))
        b = Basin(col("down"), col("stream_order"), col("area"), col("length"), set(pdf.loc[pdf["has_divide"], "id"]))
        c = Simplifier(b, overrides, unit_area, short_headwater).run(outlet)
        rows = [(i, name, None) for name, ids in (("independent", c.independent), ("connector", c.connectors), ("dropped", c.dropped), ("forced", c.forced), ("visited", c.done)) for i in sorted(ids)]
        rows += [(i, "merged", t) for i, t in sorted(c.merged)] + [(i, "virtual", t) for i, t in sorted(c.minor.items())]
        return pd.DataFrame(rows, columns=["id", "class", "target"]).assign(outlet_id=outlet)[["outlet_id", "id", "class", "target"]]

    text = lambda c: F.col(c).cast("string")
    rows = reaches.where("id IS NOT NULL AND outlet_id IS NOT NULL").select(
        text("outlet_id").alias("outlet_id"), text("id").alias("id"), F.coalesce(text("down"), F.lit(NOWHERE)).alias("down"), F.coalesce(F.col("stream_order").cast("int"), F.lit(1)).alias("stream_order"),
        F.coalesce(F.col("area").cast("double"), F.lit(0.0)).alias("area"), F.coalesce(F.col("length").cast("double"), F.lit(float("inf"))).alias("length"), F.coalesce("has_divide", F.lit(False)).alias("has_divide"),
    )
    return rows.groupBy("outlet_id").applyInPandas(basin, OUT)


def units(classes: DataFrame) -> DataFrame:
    """outlet_id, unit, ref_id, type of classify's rows: merged reaches by the least id of their group, connectors and independents alone.

    Where a reach has several, aggregate gives way to independent and that to connector.
    """
    from fluvial.operators.graph import components
    from fluvial.operators.keyed import arg_max

    # A merge into what lies below an outlet joins nothing: that id stands for no reach, and all basins share it.
    node = lambda c: F.struct("outlet_id", F.col(c).alias("id"))
    merged = classes.where((F.col("class") == "merged") & (F.col("target") != NOWHERE)).select(node("id").alias("a"), node("target").alias("b"))
    groups = components(merged, "a", "b").select("node.outlet_id", F.col("node.id").alias("ref_id"), F.col("component.id").alias("unit"))
    lone = classes.where((F.col("class") == "merged") & (F.col("target") == NOWHERE)).select("outlet_id", F.col("id").alias("ref_id"), F.col("id").alias("unit"))
    lone = lone.distinct().join(groups.select("outlet_id", "ref_id"), ["outlet_id", "ref_id"], "left_anti")
    aggregates = groups.unionByName(lone).withColumns({"type": F.lit("aggregate"), "rank": F.lit(0)})
    single = lambda c, rank: classes.where(F.col("class") == c).select("outlet_id", F.col("id").alias("unit"), F.col("id").alias("ref_id"), F.lit(c).alias("type"), F.lit(rank).alias("rank"))
    every = aggregates.unionByName(single("independent", 1)).unionByName(single("connector", 2))
    return arg_max(every, ["outlet_id", "ref_id"], F.col("rank"), F.col("unit")).select("outlet_id", "unit", "ref_id", "type")
