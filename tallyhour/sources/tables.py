"""Scans of raw inputs, dimensions and the fact table (S-01..S-06)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tallyhour.schemas import SSOT_SCHEMA, TABLE_SCHEMAS

INPUT_TABLES = ["events_stream", "fact_gam_data_transfer", "fact_demand_partner_reports",
                "fact_ssp_report", "fact_syndication_revenue", "dim_country_mapping",
                "dim_line_items_mapping", "dim_ad_unit_mapping"]


def read_table(spark: SparkSession, base: str, name: str, *, schema=None) -> DataFrame:
    """Read one parquet table ``{base}/{name}`` (a directory, optionally partitioned).

    A declared schema avoids footer-based inference on wide directories; filters
    and projections applied afterwards are pushed into the scan by Catalyst.
    """
    path = os.path.join(base, name)
    if not os.path.exists(path) and os.path.exists(path + ".parquet"):
        path = path + ".parquet"
    schema = schema if schema is not None else TABLE_SCHEMAS.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_inputs(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All raw inputs and dimensions stored under ``base`` as parquet tables."""
    return {name: read_table(spark, base, name) for name in INPUT_TABLES}


def empty_ssot(spark: SparkSession) -> DataFrame:
    """An empty fact table with the declared schema (first run)."""
    return spark.createDataFrame([], SSOT_SCHEMA)
