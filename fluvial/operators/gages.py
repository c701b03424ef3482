"""Gages: sources merged into one master by site number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluvial.functions import scalars
from fluvial.operators.keyed import append_sources, fill_missing, override, upsert

#: Status labels of the partner sources.
LABELS = {"rfc": "RFC", "nid": "USACE", "adhoc": "adhoc_lakes", "great_lakes": "canada_great_lakes", "usbr": "USBR", "usace": "USACE"}


def append_unknown(master: DataFrame, more: DataFrame, status: str = "routelink") -> DataFrame:
    """master with the rows of more whose trimmed, non-empty site_no it doesn't have."""
    rows = more.withColumn("site_no", F.trim("site_no")).where("site_no <> ''")
    fresh = rows.join(master.select(F.col("site_no").alias("known")), F.col("site_no") == F.col("known"), "left_anti")
    return append_sources(master, fresh.withColumn("status", F.lit(status)))


def partner_rows(rows: DataFrame, kind: str) -> DataFrame:
    """A partner's rows as gages: adhoc ids lose a trailing OT, usbr ids are numbers with a prefix, the status is the partner's."""
    site = {"adhoc": scalars.without_suffix(F.col("site_no").cast("string")), "usbr": F.concat(F.lit("usbr-"), F.col("site_no").cast("long").cast("string"))}
    return rows.withColumns({"site_no": site.get(kind, F.col("site_no").cast("string")), "status": F.lit(LABELS[kind])})


def forecast_points(rows: DataFrame, index: DataFrame, phrase: str) -> DataFrame:
    """Rows(site_no, forecast_status) with the phrase as status, or in the reservoir index(site_no)."""
    known = index.select(F.col("site_no").alias("known")).distinct().withColumn("indexed", F.lit(True))
    joined = rows.join(known, F.col("site_no") == F.col("known"), "left")
    return joined.where((F.col("forecast_status") == phrase) | F.col("indexed")).select(*rows.columns)


def build(base: DataFrame, shapes: list[DataFrame], tables: list[DataFrame], partners: dict[str, DataFrame], route_link: DataFrame, areas: DataFrame, overrides: DataFrame) -> DataFrame:
    """The master of gages: upserts of the agency's own sources first, then partners as they are, unknown route-link gages, missing areas, overrides."""
    out = base
    for s in shapes:
        out = upsert(out, s, "site_no", update=[c for c in s.columns if c != "site_no"])
    for t in tables:
        out = upsert(out, t, "site_no", update=[c for c in t.columns if c != "site_no"], update_existing=False)
    out = append_sources(out, *(partner_rows(rows, kind) for kind, rows in partners.items()))
    out = append_unknown(out, route_link)
    out = fill_missing(out, areas, "site_no", "area_sqkm", "csv", "area_source")
    return override(out, overrides, "site_no", [c for c in overrides.columns if c != "site_no"])
