"""Headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mandiscope.functions.lookups import TIERS
from mandiscope.functions.scalars import with_row
from mandiscope.operators.dedup import signature
from mandiscope.operators.relational import average_price, supplier_tier

# Fixed value: first day of the volume chart, 2024-05-28.
VOLUME_START = 1716854400


def dashboard_kpis(df: DataFrame) -> DataFrame:
    """Totals, supplier count, rating, verified share, measured duplicates and average price.

    Rolled up from signatures to suppliers to one row, so no distinct count expands the listings.
    """
    both = F.col("price_min").isNotNull() & F.col("price_max").isNotNull()
    name, supplier = signature()
    by_signature = df.groupBy("supplier_name", supplier.alias("_s"), name.alias("_n")).agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("supplier_rating", F.lit(0.0))).alias("rating"),
        F.count_if("verified_supplier").alias("verified"),
        F.sum(F.when(both, average_price())).alias("price"),
        F.count_if(both).alias("n_both"),
    )
    # Spellings of one supplier share a signature, so duplicates are counted per signature.
    kept = by_signature.groupBy("_s", "_n").agg(F.count("*").alias("_c")).agg(F.count("*").alias("unique_signatures"))
    by_supplier = by_signature.groupBy("supplier_name").agg(
        *(F.sum(c).alias(c) for c in ("n", "rating", "verified", "price", "n_both"))
    )
    total = by_supplier.agg(
        F.sum("n").alias("total"),
        F.count("supplier_name").alias("unique_suppliers"),
        F.try_divide(F.sum("rating"), F.sum("n")).alias("avg_rating"),
        (F.try_divide(F.sum("verified"), F.sum("n")) * 100).alias("verified_pct"),
        F.coalesce(F.try_divide(F.sum("price"), F.sum("n_both")), F.lit(0.0)).alias("avg_price"),
    )
    return with_row(total, kept).select(
        "total",
        "unique_suppliers",
        "avg_rating",
        "verified_pct",
        (F.col("total") - F.col("unique_signatures")).alias("duplicates"),
        (F.try_divide(F.col("total") - F.col("unique_signatures"), F.col("total")) * 100).alias("duplicate_pct"),
        "avg_price",
    )


def tier_breakdown(df: DataFrame) -> DataFrame:
    """The three tiers with counts and shares; empty tiers stay."""
    tier = F.col("supplier_tier") if "supplier_tier" in df.columns else supplier_tier()
    counts = df.groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    dimension = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, TIERS))).alias("tier"))
    return with_row(dimension.join(counts, "tier", "left"), total).select(
        "tier",
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) / F.col("total") * 100).alias("share_pct"),
    )


def daily_volume(df: DataFrame, start: int = VOLUME_START, days: int = 30, column: str = "scraped_at") -> DataFrame:
    """Listings per UTC day over a fixed span, days without listings included."""
    first = start // 86400
    day = F.floor(F.col(column) / 86400)
    counts = (
        df.where(day.between(first, first + days - 1))
        .groupBy(F.date_from_unix_date(day.cast("int")).alias("day"))
        .agg(F.count("*").alias("n"))
    )
    calendar = df.sparkSession.range(first, first + days).select(
        F.date_from_unix_date(F.col("id").cast("int")).alias("day")
    )
    return calendar.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


def category_list(df: DataFrame) -> DataFrame:
    return df.select("category").where(F.col("category").isNotNull()).distinct().orderBy("category")
