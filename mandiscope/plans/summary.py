"""Warehouse statistics and dataset overview."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.functions.scalars import with_row
from mandiscope.operators.quantiles import column_quantiles, exact_quantiles
from mandiscope.session import written


def product_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_products"))


def count_by_category(df: DataFrame) -> DataFrame:
    return df.where(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("n"))


def price_statistics(df: DataFrame) -> DataFrame:
    """Over rows with both prices."""
    return df.where(F.col("price_min").isNotNull() & F.col("price_max").isNotNull()).agg(
        F.avg("price_min").alias("avg_min_price"),
        F.avg("price_max").alias("avg_max_price"),
        F.min("price_min").alias("min_price"),
        F.max("price_max").alias("max_price"),
    )


def supplier_statistics(df: DataFrame) -> DataFrame:
    """Over rows with a rating."""
    return df.where(F.col("supplier_rating").isNotNull()).agg(
        F.avg("supplier_rating").alias("avg_rating"),
        F.avg("response_rate").alias("avg_response_rate"),
        F.count_if("verified_supplier").alias("verified_suppliers"),
    )


def warehouse_statistics(df: DataFrame) -> DataFrame:
    """All warehouse statistics as (section, key, value) rows from a single pass.

    Everything is kept as mergeable partial sums per category and rolled up, so the listings are read
    once.
    """
    both = F.col("price_min").isNotNull() & F.col("price_max").isNotNull()
    rated = F.col("supplier_rating").isNotNull()

    def total(c: str, condition) -> Column:
        return F.sum(F.when(condition, F.col(c)))

    parts = df.groupBy("category").agg(
        F.count("*").alias("n"),
        F.count_if(both).alias("n_both"),
        total("price_min", both).alias("s_min"),
        total("price_max", both).alias("s_max"),
        F.min(F.when(both, F.col("price_min"))).alias("min_price"),
        F.max(F.when(both, F.col("price_max"))).alias("max_price"),
        F.count_if(rated).alias("n_rated"),
        total("supplier_rating", rated).alias("s_rating"),
        F.count(F.when(rated, F.col("response_rate"))).alias("n_rate"),
        total("response_rate", rated).alias("s_rate"),
        F.count_if(rated & F.col("verified_supplier")).alias("verified"),
    )

    def row(section: str, key: Column, value: Column):
        return F.struct(F.lit(section).alias("section"), key.alias("key"), value.cast("double").alias("value"))

    whole = parts.agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum("s_min"), F.sum("n_both")).alias("avg_min_price"),
        F.try_divide(F.sum("s_max"), F.sum("n_both")).alias("avg_max_price"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.try_divide(F.sum("s_rating"), F.sum("n_rated")).alias("avg_rating"),
        F.try_divide(F.sum("s_rate"), F.sum("n_rate")).alias("avg_response_rate"),
        F.sum("verified").alias("verified_suppliers"),
    )
    totals = [row("total", F.lit("products"), F.col("n"))]
    totals += [row("price", F.lit(c), F.col(c)) for c in ("avg_min_price", "avg_max_price", "min_price", "max_price")]
    totals += [
        row("supplier", F.lit(c), F.col(c)) for c in ("avg_rating", "avg_response_rate", "verified_suppliers")
    ]
    lines = whole.select(F.explode(F.array(*totals)).alias("r"))
    named = parts.where(F.col("category").isNotNull())
    return lines.unionAll(named.select(row("category", F.col("category"), F.col("n")).alias("r"))).select("r.*")


def category_summary(df: DataFrame) -> DataFrame:
    """Listings per category, most first; a missing category counts as Other."""
    return (
        df.groupBy(F.coalesce("category", F.lit("Other")).alias("category"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "category")
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column that has nulls."""
    counted = df.agg(
        F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns))
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(df.columns)]
    return (
        counted.select("_n", F.explode(F.array(*rows)).alias("r"))
        .where(F.col("r.missing") > 0)
        .select("r.column", "r.missing", (F.col("r.missing") / F.col("_n") * 100).alias("missing_pct"))
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Columns in order with their types and the number of rows."""
    rows = [
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(t).alias("type"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count("*").alias("n")).select(F.explode(F.array(*rows)).alias("r"), "n").select("r.*", "n")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def long_values(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    """(column, value) rows of several columns."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def numeric_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column, in two scans of the rows."""

    def moments(v: Column) -> dict[str, Column]:
        return {"mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}

    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = column_quantiles(df, columns or numeric_columns(df), shares, also=moments)
    return found.withColumnRenamed("n", "count").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """Most frequent values of the first text columns. Ranks are cut inside each task before the shuffle."""
    long = long_values(df, columns or text_columns(df)[:5], "string").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins per column over rows where all are present; the last bin is closed."""
    long = long_values(df.na.drop(subset=list(columns)), columns, "double")
    ranges = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    # One row per asked column.
    ranges = F.broadcast(
        ranges.select(
            "column",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    position = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counted = (
        long.join(ranges, "column")
        .groupBy("column", F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    grid = ranges.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot_stats(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the extreme points within 1.5 interquartile ranges, outlier count."""
    groups = list(groups)
    data = df.select(*groups, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    quartiles = written(exact_quantiles(data, groups, "_x", {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    if groups:
        # The written table has a known size, so the planner moves it and not the rows.
        side = quartiles.withColumnsRenamed({g: f"_{g}" for g in groups})
        fenced = data.join(side, reduce(and_, (F.col(g) == F.col(f"_{g}") for g in groups)))
    else:
        fenced = with_row(data, quartiles)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_x").between(F.col("q1") - reach, F.col("q3") + reach)
    return fenced.groupBy(*groups).agg(
        F.max("n").alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
