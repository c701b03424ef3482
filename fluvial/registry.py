"""All queries of the library with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fluvial.plans import keyed, network, outlets, scalars, spatial, streams, wiring, zonal

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _module in (network, keyed, zonal, scalars, spatial, outlets, wiring, streams):
    QUERIES |= _module.register.queries
    ORACLES |= _module.register.oracles
