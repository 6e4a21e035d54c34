"""Counts and averages by place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.functions.lookups import CATEGORIES, REGIONS
from mandiscope.functions.scalars import with_row
from mandiscope.operators.relational import average_price, supplier_tier, top_group_rows
from mandiscope.plans.summary import boxplot_stats


def geo_counts(df: DataFrame, column: str, k: int | None = 10) -> DataFrame:
    """Listings and distinct suppliers per place, most listings first."""
    per_supplier = (
        df.where(F.col(column).isNotNull()).groupBy(column, "supplier_name").agg(F.count("*").alias("n"))
    )
    counts = per_supplier.groupBy(F.col(column).alias("place")).agg(
        F.sum("n").alias("listings"), F.count("supplier_name").alias("suppliers")
    )
    ordered = counts.orderBy(F.desc("listings"), "place")
    return ordered if k is None else ordered.limit(k)


def top_cities(df: DataFrame, k: int = 10) -> DataFrame:
    return (
        df.groupBy(F.coalesce("supplier_city", F.lit("Unknown")).alias("city"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "city")
        .limit(k)
    )


def region_share(df: DataFrame) -> DataFrame:
    """Share of all listings per region."""
    counts = df.groupBy(F.coalesce("supplier_region", F.lit("Unknown")).alias("region")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return with_row(counts, total).select(
        "region", "n", (F.col("n") / F.col("total") * 100).alias("share_pct")
    )


def state_heatmap(df: DataFrame) -> DataFrame:
    """Count, average price and rating, top category and density level per state."""
    by_category = df.groupBy(F.coalesce("supplier_state", F.lit("Unknown")).alias("state"), "category").agg(
        F.count("*").alias("n"),
        F.sum(average_price(nulls_as_zero=True)).alias("price"),
        F.sum(F.coalesce("supplier_rating", F.lit(0.0))).alias("rating"),
    )
    # A state has at most as many rows here as there are categories.
    by_state = by_category.groupBy("state").agg(
        F.sum("n").alias("listings"),
        (F.sum("price") / F.sum("n")).alias("avg_price"),
        (F.sum("rating") / F.sum("n")).alias("avg_rating"),
        F.min(F.struct((-F.col("n")).alias("n"), "category"))["category"].alias("top_category"),
    )
    most = by_state.agg(F.max("listings").alias("most"))
    density = F.col("listings") / F.col("most")
    level = F.when(density > 0.6, "high").when(density > 0.3, "medium").otherwise("low")
    return with_row(by_state, most).select(
        "state",
        "listings",
        "avg_price",
        "avg_rating",
        "top_category",
        density.alias("density"),
        level.alias("level"),
    )


def region_category_pivot(
    df: DataFrame, regions: Sequence[str] = REGIONS, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """Fixed regions by fixed categories, zeros kept, everything else dropped."""
    kept = df.where(F.col("supplier_region").isin(list(regions)) & F.col("category").isin(list(categories)))
    counts = kept.groupBy("supplier_region").agg(
        *(F.count_if(F.col("category") == c).alias(c) for c in categories)
    )
    dimension = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, regions))).alias("supplier_region"))
    return dimension.join(counts, "supplier_region", "left").na.fill(0)


def state_ranking(df: DataFrame, k: int = 15, tier: str | None = "supplier_tier") -> DataFrame:
    """States with most listings and their rank."""
    gold = (F.col(tier) if tier in df.columns else supplier_tier()) == "Gold"
    top = (
        df.groupBy(F.coalesce("supplier_state", F.lit("Unknown")).alias("state"))
        .agg(
            F.count("*").alias("listings"),
            F.avg(average_price(nulls_as_zero=True)).alias("avg_price"),
            F.avg(F.coalesce("supplier_rating", F.lit(0.0))).alias("avg_rating"),
            F.count_if(gold).alias("gold"),
        )
        .orderBy(F.desc("listings"), "state")
        .limit(k)
    )
    # The window runs over the k rows left.
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("listings"), "state"))
    return top.withColumn("rank", rank)


def price_by_top_country(df: DataFrame, column: str = "supplier_country", k: int = 8) -> DataFrame:
    """Box-plot figures of the lower price for the places with most priced listings."""
    priced = df.na.drop(subset=["price_min", column])
    return boxplot_stats(top_group_rows(priced, column, k), "price_min", [column])
