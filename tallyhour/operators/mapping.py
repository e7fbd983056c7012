"""Dimension lookups (D-01..D-06) with a checked-size broadcast.

One small action proves that the join key is unique (a duplicate would fan facts
out, H10). It runs every time the join is planned, on the data as it is then: a
dimension rewritten between runs of one session is checked anew. A second small
aggregate measures the dimension's bytes; up to ``BROADCAST_BYTES`` it is broadcast,
beyond that the join is a shuffle join, which AQE may still turn into a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhour.functions.exprs import normalise_country_code
from tallyhour.schemas import GAM_PARTNER

BROADCAST_BYTES = 64 << 20


class DimensionKeyError(ValueError):
    """A dimension has duplicate join keys."""


def checked_dim(dim: DataFrame, key_exprs: Sequence[Column]) -> DataFrame:
    """Return ``dim`` after checking that its key is unique, with a broadcast hint if it is small.

    Rows with a null key can never match an equality join and are ignored by
    the uniqueness test.
    """
    keyed = dim.select([e.alias(f"_k{i}") for i, e in enumerate(key_exprs)])
    kcols = [f"_k{i}" for i in range(len(key_exprs))]
    nonnull = F.lit(True)
    for k in kcols:
        nonnull = nonnull & F.col(k).isNotNull()
    per_key = keyed.where(nonnull).groupBy(*kcols).agg(F.count(F.lit(1)).alias("_n"))
    bad = [tuple(r[k] for k in kcols) for r in per_key.where("_n > 1").limit(10).collect()]
    if bad:
        raise DimensionKeyError(f"dimension key not unique; duplicated keys (up to 10): {bad}")
    width = F.lit(16)
    for f in dim.schema.fields:
        width = width + F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 8
    size = dim.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(dim) if size <= BROADCAST_BYTES else dim


def map_advertiser(df: DataFrame, dim: DataFrame, *, line_item_col: str = "line_item") -> DataFrame:
    """D-01 line item -> advertiser (left join, plain equality: null stays unmatched)."""
    d = checked_dim(dim, [F.col("line_item_id")]).select(
        F.col("line_item_id").alias("_li_id"), F.col("advertiser_name").alias("advertiser"))
    return df.join(d, df[line_item_col] == d["_li_id"], "left").drop("_li_id")


def map_country_name(df: DataFrame, dim: DataFrame, *, name_col: str = "country_name",
                     out_col: str = "country") -> DataFrame:
    """D-02 country name -> alpha-2 code, falling back to the original name."""
    d = checked_dim(dim, [F.col("country_name")]).select(
        F.col("country_name").alias("_cn"), F.col("country_code").alias("_cc"))
    j = df.join(d, df[name_col] == d["_cn"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("_cc"), F.col(name_col))).drop("_cn", "_cc")


def normalise_country(df: DataFrame, dim: DataFrame, *, code_col: str = "country_code",
                      out_col: str = "country") -> DataFrame:
    """D-03 two-letter codes kept (upper-cased); three-letter codes looked up; unknown -> null."""
    d = checked_dim(dim, [F.col("country_code_alpha3")]).select(
        F.col("country_code_alpha3").alias("_a3"), F.col("country_code").alias("_a2"))
    j = df.join(d, F.upper(df[code_col]) == d["_a3"], "left")
    return j.withColumn(out_col, normalise_country_code(F.col(code_col), F.col("_a2"))).drop("_a3", "_a2")


def gam_ad_unit_dim(dim: DataFrame, partner: str = GAM_PARTNER) -> DataFrame:
    """D-04 GAM rows of the ad-unit map: adunit path -> numeric ad unit id."""
    g = dim.where(F.lower(F.col("partner_name")) == F.lit(partner))
    g = checked_dim(g, [F.col("adunit_path")])
    return g.select(F.col("adunit_path").alias("_gam_path"), F.col("ad_unit_id").cast("bigint").alias("_gam_unit_id"))


def map_gam_ad_unit(df: DataFrame, dim: DataFrame, *, adunit_col: str = "adunit",
                    out_col: str = "map_ad_unit_id") -> DataFrame:
    """D-04 left join of rows to their GAM numeric ad unit id (null when unmapped)."""
    d = gam_ad_unit_dim(dim)
    return (df.join(d, df[adunit_col] == d["_gam_path"], "left")
              .withColumnRenamed("_gam_unit_id", out_col).drop("_gam_path"))


def map_partner_ad_unit(df: DataFrame, dim: DataFrame, *, network_col: str = "network",
                        org_col: str = "organization_id", adunit_col: str = "adunit",
                        out_col: str = "mapped_adunit_path") -> DataFrame:
    """D-06 partner alias -> DWH ad unit path, case-insensitive on three keys."""
    d = checked_dim(dim, [F.lower("partner_name"), F.lower("property_code"), F.lower("partner_ad_unit")])
    d = d.select(F.lower("partner_name").alias("_pn"), F.lower("property_code").alias("_pc"),
                 F.lower("partner_ad_unit").alias("_pu"), F.col("adunit_path").alias(out_col))
    cond = ((F.lower(df[network_col]) == d["_pn"]) & (F.lower(df[org_col]) == d["_pc"])
            & (F.lower(df[adunit_col]) == d["_pu"]))
    return df.join(d, cond, "left").drop("_pn", "_pc", "_pu")
