"""Price level, spread, correlation and elasticity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.functions.lookups import CATEGORIES, PRICE_BAND_EDGES, PRICE_BAND_LABELS, lookup_frame
from mandiscope.functions.scalars import with_row
from mandiscope.operators.quantiles import exact_quantiles
from mandiscope.operators.relational import average_price, price_spread

COMPLETE = ["price_min", "price_max", "category", "supplier_rating", "moq"]
# Fixed value: analyses need more rows than this.
MIN_ROWS = 10


def priced(df: DataFrame) -> DataFrame:
    """Complete rows with their average price."""
    return df.na.drop(subset=COMPLETE).withColumn("avg_price", average_price())


def category_price_stats(df: DataFrame) -> DataFrame:
    data = priced(df).select("category", "avg_price")
    moments = {"mean": F.avg("avg_price"), "std": F.stddev_samp("avg_price")}
    found = exact_quantiles(data, ["category"], "avg_price", {"median": 0.5}, also=moments)
    return found.select("category", "mean", "median", "std", "n")


def _moq_trimmed(df: DataFrame) -> DataFrame:
    data = priced(df).select("avg_price", F.col("moq").cast("double").alias("moq"))
    limits = exact_quantiles(data, [], "moq", {"q01": 0.01, "q99": 0.99}).select("q01", "q99")
    return with_row(data, limits).where(F.col("moq").between(F.col("q01"), F.col("q99")))


def _fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Pearson correlation and least squares line, null for too few rows."""
    enough = F.col("n") > MIN_ROWS
    stats = df.agg(
        F.count("*").alias("n"),
        F.corr(x, y).alias("correlation"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )
    return stats.select("n", *(F.when(enough, F.col(c)).alias(c) for c in ("correlation", "slope", "intercept")))


def price_moq_fit(df: DataFrame) -> DataFrame:
    """Average price against order quantity inside the 1 % and 99 % quantiles of the quantity."""
    return _fit(_moq_trimmed(df), "avg_price", "moq")


def price_moq_corr(df: DataFrame) -> DataFrame:
    return price_moq_fit(df).select("n", "correlation")


def price_moq_trend(df: DataFrame) -> DataFrame:
    return price_moq_fit(df).select("slope", "intercept")


def price_rating_corr(df: DataFrame) -> DataFrame:
    return _fit(priced(df), "avg_price", "supplier_rating")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def student_p_value(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    from math import exp, lgamma, log, log1p

    if np.isnan(t) or df <= 0:
        return float("nan")
    if np.isinf(t):
        return 0.0
    a, b = df / 2.0, 0.5
    x = df / (df + t * t)
    if x >= 1.0:
        return 1.0
    scale = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return scale * _beta_fraction(a, b, x) / a
    return 1.0 - scale * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def _p_values(r2: pd.Series, n: pd.Series) -> pd.Series:
    out = []
    for fit, rows in zip(r2, n):
        if pd.isna(fit):
            out.append(None)
            continue
        free = rows - 2
        t = np.inf if fit >= 1 else np.sqrt(fit * free / (1 - fit))
        out.append(student_p_value(float(t), float(free)))
    return pd.Series(out, dtype="float64")


def price_elasticity(df: DataFrame, p_value: bool = True) -> DataFrame:
    """Log-log slope of order quantity on price per category, with more than ten rows each.

    Needs at least two categories. Rows whose price or quantity has no logarithm are left out.
    """
    per_category = (
        priced(df)
        .groupBy("category")
        .agg(
            F.regr_slope(_ln("moq"), _ln("avg_price")).alias("elasticity"),
            F.regr_r2(_ln("moq"), _ln("avg_price")).alias("r_squared"),
            F.count_if((F.col("avg_price") > 0) & (F.col("moq") > 0)).alias("sample_size"),
        )
    )
    categories = per_category.agg(F.count("*").alias("_categories"))
    result = (
        with_row(per_category, categories)
        .where((F.col("_categories") > 1) & (F.col("sample_size") > MIN_ROWS))
        .drop("_categories")
        .withColumn("expected_sign", F.col("elasticity") < 0)
    )
    return result.withColumn("p_value", _p_values("r_squared", "sample_size")) if p_value else result


def _ln(name: str) -> Column:
    """Logarithm where both price and quantity have one."""
    usable = (F.col("avg_price") > 0) & (F.col("moq") > 0)
    return F.when(usable, F.ln(F.col(name).cast("double")))


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows with their spread, up to the 95 % quantile of the spread in percent."""
    spread, pct = price_spread()
    data = df.select("category", spread.alias("price_spread"), pct.alias("price_spread_pct")).na.drop()
    limit = exact_quantiles(data, [], "price_spread_pct", {"q95": 0.95}).select("q95")
    return with_row(data, limit).where(F.col("price_spread_pct") <= F.col("q95")).drop("q95")


def spread_summary(df: DataFrame) -> DataFrame:
    return spread_rows(df).agg(
        F.count("*").alias("n"),
        F.avg("price_spread").alias("avg_spread"),
        F.avg("price_spread_pct").alias("avg_spread_pct"),
    )


def price_band(price: Column) -> Column:
    """Band number by lower edges; the last band is open."""
    band = F.when(price < PRICE_BAND_EDGES[1], 0)
    for i, edge in enumerate(PRICE_BAND_EDGES[2:], start=1):
        band = band.when(price < edge, i)
    return F.when(price >= PRICE_BAND_EDGES[0], band.otherwise(len(PRICE_BAND_EDGES) - 1))


def price_bands(df: DataFrame, categories: list[str] = CATEGORIES) -> DataFrame:
    """Listings per category and price band, zeros kept; a missing price counts as zero."""
    counted = (
        df.where(F.col("category").isin(categories))
        .groupBy("category", price_band(average_price(nulls_as_zero=True)).alias("band"))
        .agg(F.count("*").alias("n"))
    )
    grid = [(c, b) for c in categories for b in range(len(PRICE_BAND_LABELS))]
    labels = F.array(*map(F.lit, PRICE_BAND_LABELS))
    return (
        lookup_frame(df.sparkSession, grid, "category", "band")
        .withColumn("band", F.col("band").cast("int"))
        .join(counted, ["category", "band"], "left")
        .select("category", "band", F.get(labels, "band").alias("label"), F.coalesce("n", F.lit(0)).alias("n"))
    )


def iqr_outliers(df: DataFrame) -> DataFrame:
    """Rows whose average price lies beyond 1.5 interquartile ranges; quartiles are sorted values, not interpolated."""
    data = df.withColumn("avg_price", average_price(nulls_as_zero=True))
    quartiles = exact_quantiles(data, [], "avg_price", {"q1": 0.25, "q3": 0.75}, method="floor").select("q1", "q3")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    price = F.col("avg_price")
    return (
        with_row(data, quartiles)
        .where((price < F.col("q1") - reach) | (price > F.col("q3") + reach))
        .drop("q1", "q3")
    )


def price_bounds(df: DataFrame, floor_bound: int = 50_000) -> DataFrame:
    """Upper end and step of a price slider."""
    top = F.coalesce(F.max(average_price(nulls_as_zero=True)), F.lit(float(floor_bound)))
    bound = F.greatest(F.lit(floor_bound).cast("bigint"), ((F.floor(top / 1000) + 1) * 1000).cast("bigint"))
    return df.agg(bound.alias("max_price")).withColumn(
        "step", F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("max_price") / 500).cast("bigint"))
    )
