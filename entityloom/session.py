"""Spark session with the settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates become midnight instants, so the zone has to be pinned.  Left-side skew
# of a shuffled lookup (hot codes, null codes) is split by AQE, also where that
# costs one more exchange further up.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no stack walk per column
}


def build_session(
    app_name: str = "entityloom",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
