"""Keyed picks, filters, paging and small projections over listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The greatest row per key by ``order``, then by all columns.

    A maximum over structs is combined on the map side, so a key that holds most rows ships one row
    per task; a ranking window would gather them all.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    picked = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return picked.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns))


def distinct_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first seen row per key by ``order``, then by all columns."""
    rest = [c for c in df.columns if c != key and c not in order]
    picked = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return picked.select(*(F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in df.columns))


def upsert_rows(current: DataFrame, batch: DataFrame, key: str = "product_id") -> DataFrame:
    """Rows after inserting or replacing by key; the batch wins, inside it the newest."""
    stacked = current.withColumn("_batch", F.lit(0)).unionByName(
        batch.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return latest_by_key(stacked, key, ["_batch", "scraped_at"]).drop("_batch")


def filter_products(
    df: DataFrame,
    category: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """Warehouse predicates; an empty category means any."""
    if category:
        df = df.where(F.col("category") == category)
    if min_price is not None:
        df = df.where(F.col("price_min") >= min_price)
    if max_price is not None:
        df = df.where(F.col("price_max") <= max_price)
    return df


def newest(df: DataFrame, limit: int | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Newest first; a limit of zero or none means all."""
    ordered = df.orderBy(F.desc_nulls_last("scraped_at"), *tie)
    return ordered.limit(limit) if limit else ordered


def average_price(nulls_as_zero: bool = False) -> Column:
    """Mean of both prices; with ``nulls_as_zero`` a missing price counts as zero."""
    low, high = F.col("price_min"), F.col("price_max")
    if nulls_as_zero:
        low, high = F.coalesce(low, F.lit(0.0)), F.coalesce(high, F.lit(0.0))
    return (low + high) / 2


def explorer_filter(
    df: DataFrame,
    category: str | None = None,
    tier: str | None = None,
    city: str | None = None,
    price_from: float | None = None,
    price_to: float | None = None,
    verified_only: bool = False,
) -> DataFrame:
    """Conjunction of the explorer's controls, each optional."""
    if category:
        df = df.where(F.col("category") == category)
    if tier:
        df = df.where(F.col("supplier_tier") == tier)
    if city and city.strip():
        df = df.where(F.lower(F.coalesce("supplier_city", F.lit(""))).contains(city.strip().lower()))
    if price_from is not None:
        df = df.where(average_price(True) >= price_from)
    if price_to is not None:
        df = df.where(average_price(True) <= price_to)
    if verified_only:
        df = df.where(F.coalesce("verified_supplier", F.lit(False)))
    return df


def page_products(df: DataFrame, page: int = 1, size: int = 25, tie: Sequence[str] = ("product_id",)) -> DataFrame:
    """One page of listings by name."""
    return df.orderBy("name", *tie).offset((page - 1) * size).limit(size)


def price_spread() -> tuple[Column, Column]:
    """Spread and spread in percent of the lower price; no percentage of a zero price."""
    spread = F.col("price_max") - F.col("price_min")
    return spread, F.try_divide(spread, F.col("price_min")) * 100


def supplier_tier(gold: float = 4.0, silver: float = 3.0) -> Column:
    rating = F.coalesce(F.col("supplier_rating"), F.lit(0.0))
    verified = F.coalesce(F.col("verified_supplier"), F.lit(False))
    return (
        F.when(verified & (rating >= gold), "Gold").when(verified & (rating >= silver), "Silver").otherwise("Unverified")
    )


def rating_stars(rating: Column) -> Column:
    """Five stars, as many of them full as the rating rounded half up."""
    full = F.floor(F.coalesce(rating, F.lit(0.0)) + 0.5).cast("int")
    return F.concat(F.repeat(F.lit("★"), full), F.repeat(F.lit("☆"), F.lit(5) - full))


def format_price(price: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(price, 2), F.lit(" USD"))


def scatter_points(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Order quantity against price for the listed categories."""
    return df.where(F.col("category").isin(list(categories))).select(
        "category",
        F.col("moq").alias("x"),
        average_price(True).alias("y"),
        "name",
        F.coalesce("supplier_city", F.lit("N/A")).alias("city"),
    )


def top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values of ``group``, ties by value."""
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), group).limit(k)


def top_group_rows(df: DataFrame, group: str, k: int) -> DataFrame:
    """Rows of the most frequent groups. The broadcast side has ``k`` rows."""
    return df.join(F.broadcast(top_groups(df, group, k).select(group)), group, "left_semi")


def merge_keywords(*lists: Column, limit: int = 10) -> Column:
    """Lists joined without repeats, in first-seen order, cut to ``limit``."""
    return F.slice(F.array_distinct(F.concat(*lists)), 1, limit)
