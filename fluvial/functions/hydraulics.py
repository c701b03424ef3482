"""Reservoir hydraulics and channel attributes as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluvial.functions.scalars import ACRE_FOOT_M3, zero_to_null

# Defaults and fractions of the hydraulics rules.
WEIR_C, WEIR_L, ORIFICE_C, ORIFICE_A, IFD = 0.4, 10.0, 0.1, 1.0, 0.899
CREST, INVERT, MAX, MAX_ABOVE_POOL = 0.90, 0.15, 1.00, 0.10
ORIFICE_SMALL, ORIFICE_MEDIUM, ORIFICE_LARGE, ORIFICE_CONCRETE = 0.5, 0.9, 1.5, 1.2
#: Word cues of spillways and dams.
OUTLET_WORDS = ("orfice", "sluice", "pipe", "outlet")
GATE_WORDS = ("gate", "gated", "radial", "tunnel", "culvert", "conduit", "valve")
CONCRETE_WORDS = ("concrete", "gravity", "arch")

NUMBERS = (
    "structural_height", "dam_height", "hydraulic_height", "nid_height", "ref_elev", "dam_elev", "LkArea", "wb_areasqkm", "ref_area_sqkm", "surface_area", "nid_storage",
    "normal_storage", "max_storage", "WeirL", "spillway_width", "dam_length", "Dam_Length", "WeirC", "OrificeC", "OrificeA", "WeirE", "LkMxE", "OrificeE", "ifd",
)
TEXTS = ("spillway_type", "dam_type", "purposes", "hazard")


def _any_word(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def reservoir_hydraulics(dams: DataFrame, *, strict_parity: bool = True, use_hazard: bool = False) -> DataFrame:
    """dams with H_m, LkArea, LkMxE, WeirC, WeirL, WeirE, OrificeC, OrificeA, OrificeE, Dam_Length and ifd, from what inputs they have.

    Inputs that are absent count as null, numbers that don't parse too. With strict_parity off, mean depth is storage over the area in
    square metres, and the word orifice is an outlet cue; on, the area counts in square kilometres and the cue is not known.
    """
    exact = set(dams.columns)
    num = {c: (F.col(f"`{c}`").try_cast("double") if c in exact else F.lit(None).cast("double")) for c in NUMBERS}
    num = {c: F.when(~F.isnan(v), v) for c, v in num.items()}
    text = {c: (F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in exact else F.lit("")) for c in TEXTS}
    nz = lambda c: zero_to_null(num[c])
    spill, dam = text["spillway_type"], text["dam_type"]
    has = lambda t, w: F.contains(t, F.lit(w))
    height = F.coalesce(nz("structural_height"), nz("dam_height"), nz("hydraulic_height"), nz("nid_height"))
    pool, base = num["ref_elev"], num["dam_elev"]
    area = F.coalesce(num["LkArea"], num["wb_areasqkm"], num["ref_area_sqkm"], num["surface_area"] / 1e6)
    area = F.when(area != 0, area)
    storage = F.coalesce(*(num[c] * ACRE_FOOT_M3 for c in ("nid_storage", "normal_storage", "max_storage")))
    depth = F.when(area > 0, storage / (area if strict_parity else area * 1e6))
    weir_l = F.coalesce(nz("WeirL"), nz("spillway_width"), nz("dam_length"), F.lit(WEIR_L))
    dam_l = F.coalesce(num["Dam_Length"], num["dam_length"])
    weir_c = F.coalesce(num["WeirC"], F.when(has(spill, "broad"), 1.6).when(has(spill, "ogee"), 1.7).when(has(spill, "sharp"), 1.84).when(has(dam, "earth"), 1.6).otherwise(WEIR_C))
    outlet = _any_word(spill, OUTLET_WORDS if strict_parity else (*OUTLET_WORDS, "orifice"))
    orifice_c = F.coalesce(num["OrificeC"], F.when(outlet, 0.62).when(_any_word(spill, GATE_WORDS) | has(text["purposes"], "hydro") | has(text["purposes"], "power"), 0.80).otherwise(ORIFICE_C))
    by_height = F.when(height < 10, ORIFICE_SMALL).when(height < 30, ORIFICE_MEDIUM).when(height >= 30, ORIFICE_LARGE)
    orifice_a = F.coalesce(num["OrificeA"], by_height)
    dam_l = F.when(dam_l != 0, dam_l).otherwise(weir_l)
    if use_hazard:
        hazard = text["hazard"]
        high, significant = F.startswith(hazard, F.lit("h")), F.startswith(hazard, F.lit("s"))
        weir_l = F.when(high, weir_l * 1.10).when(significant, weir_l * 1.05).otherwise(weir_l)
        orifice_a = F.when(high, orifice_a * 1.20).when(significant, orifice_a * 1.10).otherwise(orifice_a)
        unknown = spill == ""
        orifice_c = F.when(high & unknown, F.greatest(orifice_c, F.lit(0.80))).when(significant & unknown, F.greatest(orifice_c, F.lit(0.70))).otherwise(orifice_c)
    orifice_a = F.coalesce(orifice_a, F.when(_any_word(dam, CONCRETE_WORDS) | has(spill, "ogee"), ORIFICE_CONCRETE).otherwise(ORIFICE_A))
    weir_e = F.coalesce(num["WeirE"], pool, base + CREST * height, base + depth)
    max_e = F.coalesce(num["LkMxE"], pool + MAX_ABOVE_POOL * height, pool, base + MAX * height, base + depth)
    orifice_e = F.coalesce(num["OrificeE"], base + INVERT * height, pool - (CREST - INVERT) * height)
    weir_e = F.when(weir_e < orifice_e, orifice_e).otherwise(weir_e)
    max_e = F.when(max_e < weir_e, weir_e).otherwise(max_e)
    orifice_e = F.coalesce(orifice_e, weir_e)
    out = {
        "H_m": height, "LkArea": area, "LkMxE": max_e, "WeirC": weir_c, "WeirL": weir_l, "WeirE": weir_e, "OrificeC": orifice_c, "OrificeA": orifice_a,
        "OrificeE": orifice_e, "Dam_Length": dam_l, "ifd": F.coalesce(num["ifd"], F.lit(IFD)),
    }
    taken = {k.lower() for k in out}  # names differ by more than case: dam_length gives way to Dam_Length
    return dams.select(*(F.col(f"`{c}`") for c in dams.columns if c.lower() not in taken), *(v.alias(k) for k, v in out.items()))


#: Fixed values by Strahler order, 1 to 10: Manning's n, channel side slope, bottom width.
MANNING_N = {1: 0.096, 2: 0.076, 3: 0.060, 4: 0.047, 5: 0.037, 6: 0.030, 7: 0.025, 8: 0.021, 9: 0.018, 10: 0.022}
SIDE_SLOPE = {1: 0.03, 2: 0.03, 3: 0.03, 4: 0.04, 5: 0.04, 6: 0.04, 7: 0.04, 8: 0.04, 9: 0.05, 10: 0.10}
BOTTOM_WIDTH = {1: 1.6, 2: 2.4, 3: 3.5, 4: 5.3, 5: 7.4, 6: 11.0, 7: 14.0, 8: 16.0, 9: 26.0, 10: 110.0}
#: Fixed values where the order is outside.
DEFAULT_N, DEFAULT_SLOPE, DEFAULT_WIDTH, MUSX, MUSK = 0.035, 0.05, 5.0, 0.2, 3600


def _lookup(order: Column, table: dict[int, float], default: float) -> Column:
    values = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(values[order.cast("int")], F.lit(default))


def channel_attributes(reaches: DataFrame) -> DataFrame:
    """reaches(stream_order, total_da_sqkm, and topwdth_ml if there is one) with n, ncc, btmwdth, chslp, musx, musk, topwdth, topwdthcc, topwdthcc_ml."""
    order, area = F.col("stream_order"), F.col("total_da_sqkm")
    n, top = _lookup(order, MANNING_N, DEFAULT_N), 2.44 * F.pow(area, F.lit(0.34))
    ml = F.col("topwdth_ml") if "topwdth_ml" in reaches.columns else F.lit(None).cast("double")
    out = {
        "n": n, "ncc": 2 * n, "btmwdth": _lookup(order, BOTTOM_WIDTH, DEFAULT_WIDTH), "chslp": _lookup(order, SIDE_SLOPE, DEFAULT_SLOPE), "musx": F.lit(MUSX), "musk": F.lit(MUSK),
        "topwdth": top, "topwdthcc": F.when(top != 0, 3 * top), "topwdthcc_ml": F.when(ml != 0, 3 * ml),
    }
    return reaches.withColumns(out)


def snow_melt_factors(cells: DataFrame) -> DataFrame:
    """cells(f, rdb, wind, r) with the greatest and least seasonal melt factor."""
    most = (1.03 * (1 - F.col("f")) * F.col("rdb") + 2.04 + 0.42 * F.col("wind")) / (2 * (F.col("r") + 1))
    return cells.withColumns({"mfmax": most, "mfmin": most * F.col("r")})


def wind_adjustment(wind: Column, forest: Column) -> Column:
    return wind * F.pow(F.lit(0.1), 0.1 + 0.15 * forest) * 3.6 * 6 * 0.002
