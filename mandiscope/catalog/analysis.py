"""Summary, geography, price and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mandiscope.catalog.registry import TIER, query, r, rounded, sql_list, with_listings
from mandiscope.functions.lookups import PRICE_BAND_LABELS
from mandiscope.operators.relational import (
    average_price,
    explorer_filter,
    format_price,
    page_products,
    price_spread,
    rating_stars,
    scatter_points,
    supplier_tier,
    top_group_rows,
)
from mandiscope.plans import dashboard, geography, pricing, summary
from mandiscope.sources.tables import listings, table
from mandiscope.sources.warehouse import load_products

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PLACES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
AVG = "((price_min + price_max) / 2)"


@query("product_count", with_listings("SELECT count(*) AS total_products FROM listings"))
def product_count(spark, folder):
    return summary.product_count(listings(spark, folder, "product_id"))


@query("count_by_category", with_listings("SELECT category, count(*) AS n FROM listings GROUP BY category"))
def count_by_category(spark, folder):
    return summary.count_by_category(listings(spark, folder, "category"))


@query(
    "price_statistics",
    with_listings(
        f"""SELECT {r('avg(price_min)', 4)} AS avg_min_price, {r('avg(price_max)', 4)} AS avg_max_price,
        {r('min(price_min)', 4)} AS min_price, {r('max(price_max)', 4)} AS max_price
        FROM listings WHERE price_min IS NOT NULL AND price_max IS NOT NULL"""
    ),
)
def price_statistics(spark, folder):
    out = summary.price_statistics(listings(spark, folder, "price_min", "price_max"))
    return rounded(out, 4, *out.columns)


@query(
    "supplier_statistics",
    with_listings(
        f"""SELECT {r('avg(supplier_rating)')} AS avg_rating, {r('avg(response_rate)')} AS avg_response_rate,
        CAST(sum(CASE WHEN verified_supplier THEN 1 ELSE 0 END) AS BIGINT) AS verified_suppliers
        FROM listings WHERE supplier_rating IS NOT NULL"""
    ),
)
def supplier_statistics(spark, folder):
    out = summary.supplier_statistics(
        listings(spark, folder, "supplier_rating", "response_rate", "verified_supplier")
    )
    return rounded(out, 6, "avg_rating", "avg_response_rate")


@query(
    "warehouse_statistics",
    with_listings(
        f"""SELECT section, key, {r('value', 6)} AS value FROM (
        SELECT 'total' AS section, 'products' AS key, CAST(count(*) AS DOUBLE) AS value FROM listings
        UNION ALL SELECT 'category', category, count(*) FROM listings GROUP BY category
        UNION ALL SELECT 'price', 'avg_min_price', avg(price_min) FROM listings
        UNION ALL SELECT 'price', 'avg_max_price', avg(price_max) FROM listings
        UNION ALL SELECT 'price', 'min_price', min(price_min) FROM listings
        UNION ALL SELECT 'price', 'max_price', max(price_max) FROM listings
        UNION ALL SELECT 'supplier', 'avg_rating', avg(supplier_rating) FROM listings
        UNION ALL SELECT 'supplier', 'avg_response_rate', avg(response_rate) FROM listings
        UNION ALL SELECT 'supplier', 'verified_suppliers', count(*) FILTER (verified_supplier) FROM listings)"""
    ),
)
def warehouse_statistics(spark, folder):
    columns = "category price_min price_max supplier_rating response_rate verified_supplier".split()
    return rounded(summary.warehouse_statistics(listings(spark, folder, *columns)), 6, "value")


@query(
    "category_summary",
    with_listings("SELECT coalesce(category, 'Other') AS category, count(*) AS n FROM listings GROUP BY 1"),
)
def category_summary(spark, folder):
    return summary.category_summary(listings(spark, folder, "category"))


@query(
    "missing_values",
    f"""WITH j AS (SELECT d.doc_id, text, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT * FROM (
      SELECT 'quality' AS "column", count(*) - count(quality) AS missing,
        {r('(count(*) - count(quality)) / count(*) * 100')} AS missing_pct FROM j
      UNION ALL SELECT 'toxic', count(*) - count(toxic), {r('(count(*) - count(toxic)) / count(*) * 100')} FROM j
      UNION ALL SELECT 'text', count(*) - count(text), {r('(count(*) - count(text)) / count(*) * 100')} FROM j)
    WHERE missing > 0""",
)
def missing_values(spark, folder):
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return rounded(summary.missing_values(joined.select("doc_id", "text", "lang", "quality", "toxic")), 6, "missing_pct")


@query(
    "schema_profile",
    """SELECT CAST(v.i AS INTEGER) AS ordinal, v.c AS "column", v.t AS type, (SELECT count(*) FROM part) AS n
    FROM (VALUES (0, 'p_partkey', 'bigint'), (1, 'p_name', 'string'), (2, 'p_brand', 'string'),
      (3, 'p_type', 'string'), (4, 'p_size', 'int'), (5, 'p_retailprice', 'double')) AS v(i, c, t)""",
)
def schema_profile(spark, folder):
    return summary.schema_profile(table(spark, folder, "part"))


DESCRIBED = ["price_min", "price_max", "moq", "supplier_rating", "response_rate"]


@query(
    "numeric_describe",
    with_listings(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS "count", {r(f'avg({c})', 4)} AS mean,
            {r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS min, {r(f'quantile_cont({c}, 0.25)', 4)} AS p25,
            {r(f'quantile_cont({c}, 0.5)', 4)} AS p50, {r(f'quantile_cont({c}, 0.75)', 4)} AS p75,
            {r(f'max({c})', 4)} AS max FROM listings"""
            for c in DESCRIBED
        )
    ),
)
def numeric_describe(spark, folder):
    out = summary.numeric_describe(listings(spark, folder, *DESCRIBED))
    return rounded(out, 4, "mean", "std", "min", "p25", "p50", "p75", "max")


COUNTED = ["product_id", "name", "currency", "unit", "supplier_name"]


@query(
    "value_counts",
    with_listings(
        """SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM long) WHERE rank <= 5""",
        "long AS ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM listings GROUP BY {c}""" for c in COUNTED
        )
        + ")",
    ),
)
def value_counts(spark, folder):
    return summary.value_counts(listings(spark, folder, *COUNTED))


def _histogram(column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(b.i AS INTEGER) AS bin, {r('lo + (hi - lo) * b.i / 30', 4)} AS bin_start,
      coalesce(c.n, 0) AS n
    FROM (SELECT unnest(range(30)) AS i) b
    CROSS JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM listings) m
    LEFT JOIN (SELECT least(floor(({column} - lo) / (hi - lo) * 30), 29) AS bin, count(*) AS n
      FROM listings, (SELECT min({column}) AS lo, max({column}) AS hi FROM listings) GROUP BY 1) c ON c.bin = b.i"""


@query("price_histogram", with_listings(f"{_histogram('price_min')} UNION ALL {_histogram('price_max')}"))
def price_histogram(spark, folder):
    out = summary.histogram(listings(spark, folder, "price_min", "price_max"), ["price_min", "price_max"])
    return rounded(out, 4, "bin_start")


def boxplot_sql(source: str, value: str, group: str) -> str:
    return f"""SELECT f.{group}, any_value(n) AS n, {r('any_value(q1)', 4)} AS q1, {r('any_value(median)', 4)} AS median,
      {r('any_value(q3)', 4)} AS q3,
      {r(f'min(CASE WHEN {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {value} END)', 4)} AS whisker_low,
      {r(f'max(CASE WHEN {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {value} END)', 4)} AS whisker_high,
      count(*) FILTER (NOT {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM {source} f JOIN (SELECT {group}, count(*) AS n, quantile_cont({value}, 0.25) AS q1,
      quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY {group}) q
      ON f.{group} = q.{group}
    GROUP BY f.{group}"""


BOX = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query(
    "boxplot_stats",
    with_listings(
        boxplot_sql("boxed", "avg_price", "category"), f"boxed AS (SELECT category, {AVG} AS avg_price FROM listings)"
    ),
)
def boxplot_stats(spark, folder):
    data = listings(spark, folder, "category", "price_min", "price_max").withColumn("avg_price", average_price())
    return rounded(summary.boxplot_stats(data, "avg_price", ["category"]), 4, *BOX)


@query(
    "price_by_top_state",
    with_listings(
        boxplot_sql("kept", "price_min", "supplier_state"),
        """kept AS (SELECT supplier_state, price_min FROM listings WHERE supplier_state IN (
        SELECT supplier_state FROM listings GROUP BY supplier_state ORDER BY count(*) DESC, supplier_state LIMIT 8))""",
    ),
)
def price_by_top_state(spark, folder):
    data = listings(spark, folder, "supplier_state", "price_min")
    return rounded(geography.price_by_top_country(data, "supplier_state", 8), 4, *BOX)


@query(
    "spread_boxplot",
    with_listings(
        boxplot_sql("kept", "pct", "category"),
        "spread AS (SELECT category, (price_max - price_min) / nullif(price_min, 0) * 100 AS pct FROM listings)",
        "kept AS (SELECT * FROM spread WHERE pct <= (SELECT quantile_cont(pct, 0.95) FROM spread))",
    ),
)
def spread_boxplot(spark, folder):
    data = pricing.spread_rows(listings(spark, folder, "category", "price_min", "price_max"))
    return rounded(summary.boxplot_stats(data, "price_spread_pct", ["category"]), 4, *BOX)


@query(
    "geo_counts",
    with_listings(
        """SELECT supplier_state AS place, count(*) AS listings, count(DISTINCT supplier_name) AS suppliers
        FROM listings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""
    ),
)
def geo_counts(spark, folder):
    return geography.geo_counts(listings(spark, folder, "supplier_state", "supplier_name"), "supplier_state", 15)


@query(
    "category_price_stats",
    with_listings(
        f"""SELECT category, {r(f'avg({AVG})', 4)} AS mean, {r(f'median({AVG})', 4)} AS median,
        {r(f'stddev_samp({AVG})', 4)} AS std, count(*) AS n FROM listings GROUP BY category"""
    ),
)
def category_price_stats(spark, folder):
    out = pricing.category_price_stats(listings(spark, folder, *pricing.COMPLETE))
    return rounded(out, 4, "mean", "median", "std")


TRIMMED = f"""trimmed AS (SELECT {AVG} AS p, CAST(moq AS DOUBLE) AS m FROM listings
  WHERE moq BETWEEN (SELECT quantile_cont(moq, 0.01) FROM listings) AND (SELECT quantile_cont(moq, 0.99) FROM listings))"""


@query(
    "price_moq_corr",
    with_listings(f"SELECT count(*) AS n, {r('corr(p, m)')} AS correlation FROM trimmed", TRIMMED),
)
def price_moq_corr(spark, folder):
    return rounded(pricing.price_moq_corr(listings(spark, folder, *pricing.COMPLETE)), 6, "correlation")


@query(
    "price_moq_trend",
    with_listings(
        f"SELECT {r('regr_slope(p, m)', 4)} AS slope, {r('regr_intercept(p, m)', 4)} AS intercept FROM trimmed", TRIMMED
    ),
)
def price_moq_trend(spark, folder):
    return rounded(pricing.price_moq_trend(listings(spark, folder, *pricing.COMPLETE)), 4, "slope", "intercept")


@query(
    "price_rating_corr",
    with_listings(
        f"""SELECT count(*) AS n, {r(f'corr({AVG}, supplier_rating)')} AS correlation,
        {r(f'regr_slope({AVG}, supplier_rating)', 4)} AS slope,
        {r(f'regr_intercept({AVG}, supplier_rating)', 4)} AS intercept FROM listings"""
    ),
)
def price_rating_corr(spark, folder):
    out = pricing.price_rating_corr(listings(spark, folder, *pricing.COMPLETE))
    return rounded(rounded(out, 6, "correlation"), 4, "slope", "intercept")


@query(
    "price_elasticity",
    with_listings(
        f"""SELECT category, {r('regr_slope(ln(moq), ln(p))')} AS elasticity, {r('regr_r2(ln(moq), ln(p))')} AS r_squared,
        count(*) AS sample_size, regr_slope(ln(moq), ln(p)) < 0 AS expected_sign
        FROM (SELECT category, moq, {AVG} AS p FROM listings WHERE moq > 0) WHERE p > 0
        GROUP BY category HAVING count(*) > 10"""
    ),
)
def price_elasticity(spark, folder):
    out = pricing.price_elasticity(listings(spark, folder, *pricing.COMPLETE), p_value=False)
    return rounded(out, 6, "elasticity", "r_squared")


# The two-sided p-value of a slope is the tail beyond asin(sqrt(r2)) of the density cos(x)^(n - 3), here by Simpson's rule.
STEPS = 4000
TAIL = f"""1 - 2 * sum(CASE WHEN i IN (0, {STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(cos(asin(sqrt(r2)) * i / {STEPS}), n - 3))
  * asin(sqrt(r2)) / {STEPS} / 3 / exp(lgamma(0.5) + lgamma((n - 2) / 2.0) - lgamma((n - 1) / 2.0))"""


@query(
    "price_elasticity_significance",
    with_listings(
        f"""SELECT category, {r('slope')} AS elasticity, {r('r2')} AS r_squared, n AS sample_size, slope < 0 AS expected_sign,
        {r(f"greatest({TAIL}, 0.0)")} AS p_value FROM fits, range({STEPS + 1}) AS steps(i) GROUP BY category, slope, r2, n""",
        f"""fits AS (SELECT category, regr_slope(ln(moq), ln(p)) AS slope, regr_r2(ln(moq), ln(p)) AS r2, count(*) AS n
        FROM (SELECT category, moq, {AVG} AS p FROM listings WHERE moq > 0) WHERE p > 0 GROUP BY category HAVING count(*) > 10)""",
    ),
)
def price_elasticity_significance(spark, folder):
    out = pricing.price_elasticity(listings(spark, folder, *pricing.COMPLETE))
    return rounded(out, 6, "elasticity", "r_squared", "p_value")


@query(
    "spread_summary",
    with_listings(
        f"""SELECT count(*) AS n, {r('avg(s)', 4)} AS avg_spread, {r('avg(pct)', 4)} AS avg_spread_pct FROM spread
        WHERE pct <= (SELECT quantile_cont(pct, 0.95) FROM spread)""",
        """spread AS (SELECT price_max - price_min AS s, (price_max - price_min) / nullif(price_min, 0) * 100 AS pct
        FROM listings)""",
    ),
)
def spread_summary(spark, folder):
    out = pricing.spread_summary(listings(spark, folder, "category", "price_min", "price_max"))
    return rounded(out, 4, "avg_spread", "avg_spread_pct")


@query(
    "region_share",
    with_listings(
        f"""SELECT coalesce(supplier_region, 'Unknown') AS region, count(*) AS n,
        {r('count(*) * 100.0 / (SELECT count(*) FROM listings)')} AS share_pct FROM listings GROUP BY 1"""
    ),
)
def region_share(spark, folder):
    return rounded(geography.region_share(listings(spark, folder, "supplier_region")), 6, "share_pct")


@query(
    "tier_breakdown",
    with_listings(
        f"""SELECT t.tier, count(c.tier) AS n, {r('count(c.tier) * 100.0 / (SELECT count(*) FROM listings)')} AS share_pct
        FROM (VALUES ('Gold'), ('Silver'), ('Unverified')) AS t(tier)
        LEFT JOIN (SELECT {TIER} AS tier FROM listings) c ON t.tier = c.tier GROUP BY t.tier"""
    ),
)
def tier_breakdown(spark, folder):
    out = dashboard.tier_breakdown(listings(spark, folder, "supplier_rating", "verified_supplier"))
    return rounded(out, 6, "share_pct")


@query(
    "supplier_tier",
    with_listings(
        f"SELECT product_id, supplier_name, supplier_rating, verified_supplier, {TIER} AS tier FROM listings"
    ),
)
def supplier_tiers(spark, folder):
    columns = ["product_id", "supplier_name", "supplier_rating", "verified_supplier"]
    return listings(spark, folder, *columns).withColumn("tier", supplier_tier())


@query(
    "daily_volume",
    with_listings(
        """SELECT d.day, count(l.day) AS n
        FROM (SELECT CAST(DATE '2000-01-01' + CAST(i AS INTEGER) AS DATE) AS day FROM range(30) t(i)) d
        LEFT JOIN (SELECT CAST(to_timestamp(scraped_at) AT TIME ZONE 'UTC' AS DATE) AS day FROM listings) l ON d.day = l.day
        GROUP BY d.day"""
    ),
)
def daily_volume(spark, folder):
    return dashboard.daily_volume(listings(spark, folder, "scraped_at"), start=946684800)


@query(
    "dashboard_kpis",
    with_listings(
        f"""SELECT count(*) AS total, count(DISTINCT supplier_name) AS unique_suppliers,
        {r('avg(coalesce(supplier_rating, 0))')} AS avg_rating,
        {r('count(*) FILTER (verified_supplier) * 100.0 / count(*)')} AS verified_pct,
        count(*) - count(DISTINCT (lower(name), lower(supplier_name))) AS duplicates,
        {r('(count(*) - count(DISTINCT (lower(name), lower(supplier_name)))) * 100.0 / count(*)')} AS duplicate_pct,
        {r(f'avg({AVG})', 4)} AS avg_price FROM listings"""
    ),
)
def dashboard_kpis(spark, folder):
    columns = "name supplier_name supplier_rating verified_supplier price_min price_max".split()
    out = dashboard.dashboard_kpis(listings(spark, folder, *columns))
    return rounded(rounded(out, 6, "avg_rating", "verified_pct", "duplicate_pct"), 4, "avg_price")


CITY_OF_LOCATION = "split_part(supplier_location, ',', 1)"


def _with_city(df):
    return df.withColumn("supplier_city", F.split_part("supplier_location", F.lit(","), F.lit(1)))


@query(
    "top_cities",
    with_listings(f"SELECT {CITY_OF_LOCATION} AS city, count(*) AS n FROM listings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def top_cities(spark, folder):
    return geography.top_cities(_with_city(listings(spark, folder, "supplier_location")))


HEATMAP = f"""
SELECT s.state, s.listings, {r('s.avg_price', 4)} AS avg_price, {r('s.avg_rating')} AS avg_rating, t.category AS top_category,
  {r('s.listings / m.most')} AS density,
  CASE WHEN s.listings / m.most > 0.6 THEN 'high' WHEN s.listings / m.most > 0.3 THEN 'medium' ELSE 'low' END AS level
FROM (SELECT coalesce(supplier_state, 'Unknown') AS state, count(*) AS listings,
    avg((coalesce(price_min, 0) + coalesce(price_max, 0)) / 2) AS avg_price, avg(coalesce(supplier_rating, 0)) AS avg_rating
  FROM SOURCE GROUP BY 1) s
JOIN (SELECT coalesce(supplier_state, 'Unknown') AS state, category,
    row_number() OVER (PARTITION BY coalesce(supplier_state, 'Unknown') ORDER BY count(*) DESC, category) AS rn
  FROM SOURCE GROUP BY 1, 2) t ON s.state = t.state AND t.rn = 1
CROSS JOIN (SELECT max(n) AS most FROM (SELECT count(*) AS n FROM SOURCE GROUP BY supplier_state)) m
"""


@query("state_heatmap", with_listings(HEATMAP.replace("SOURCE", "listings")))
def state_heatmap(spark, folder):
    columns = "supplier_state category price_min price_max supplier_rating".split()
    out = geography.state_heatmap(listings(spark, folder, *columns))
    return rounded(rounded(out, 6, "avg_rating", "density"), 4, "avg_price")


@query(
    "region_category_pivot",
    with_listings(
        "SELECT g.supplier_region, "
        + ", ".join(f"count(*) FILTER (l.category = '{t}') AS {t}" for t in TYPES[:5])
        + f""" FROM (SELECT unnest([{sql_list(PLACES + ['Nowhere'])}]) AS supplier_region) g
        LEFT JOIN listings l ON g.supplier_region = l.supplier_region GROUP BY g.supplier_region"""
    ),
)
def region_category_pivot(spark, folder):
    data = listings(spark, folder, "supplier_region", "category")
    return geography.region_category_pivot(data, PLACES + ["Nowhere"], TYPES[:5])


@query(
    "state_ranking",
    with_listings(
        f"""SELECT CAST(row_number() OVER (ORDER BY listings DESC, state) AS INTEGER) AS rank, state, listings, avg_price,
        avg_rating, gold FROM (
        SELECT coalesce(supplier_state, 'Unknown') AS state, count(*) AS listings, {r(f'avg({AVG})', 4)} AS avg_price,
        {r('avg(supplier_rating)')} AS avg_rating, count(*) FILTER ({TIER} = 'Gold') AS gold
        FROM listings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)"""
    ),
)
def state_ranking(spark, folder):
    columns = "supplier_state price_min price_max supplier_rating verified_supplier".split()
    out = geography.state_ranking(listings(spark, folder, *columns))
    return rounded(rounded(out, 6, "avg_rating"), 4, "avg_price")


@query(
    "price_bands",
    with_listings(
        f"""SELECT g.category, CAST(g.band AS INTEGER) AS band, ([{sql_list(PRICE_BAND_LABELS)}])[g.band + 1] AS label,
        count(l.category) AS n
        FROM (SELECT c.category, b.band FROM (SELECT unnest([{sql_list(TYPES[:5])}]) AS category) c,
          (SELECT unnest(range(6)) AS band) b) g
        LEFT JOIN (SELECT category, CASE WHEN {AVG} < 100 THEN 0 WHEN {AVG} < 500 THEN 1 WHEN {AVG} < 1000 THEN 2
          WHEN {AVG} < 5000 THEN 3 WHEN {AVG} < 10000 THEN 4 ELSE 5 END AS band FROM listings) l
        ON l.category = g.category AND l.band = g.band GROUP BY g.category, g.band"""
    ),
)
def price_bands(spark, folder):
    return pricing.price_bands(listings(spark, folder, "category", "price_min", "price_max"), TYPES[:5])


@query(
    "iqr_outliers",
    """WITH priced AS (SELECT o_orderkey AS product_id, o_totalprice * (1 + o_custkey % 7) AS price FROM orders),
    ranked AS (SELECT price, row_number() OVER (ORDER BY price) - 1 AS i, count(*) OVER () AS n FROM priced),
    q AS (SELECT max(price) FILTER (i = floor(n * 0.25)) AS q1, max(price) FILTER (i = floor(n * 0.75)) AS q3 FROM ranked)
    SELECT product_id, """
    + r("price", 4)
    + """ AS avg_price FROM priced, q WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)""",
)
def iqr_outliers(spark, folder):
    price = F.col("o_totalprice") * (1 + F.col("o_custkey") % 7)
    data = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("product_id"), price.alias("price_min"), price.alias("price_max")
    )
    return rounded(pricing.iqr_outliers(data).select("product_id", "avg_price"), 4, "avg_price")


@query("category_list", with_listings("SELECT DISTINCT category FROM listings"))
def category_list(spark, folder):
    return dashboard.category_list(listings(spark, folder, "category"))


@query(
    "price_bounds",
    with_listings(
        """SELECT max_price, greatest(1, max_price // 500) AS step FROM (
        SELECT greatest(50000, CAST((floor(max((price_min + price_max) / 2) / 1000) + 1) * 1000 AS BIGINT)) AS max_price
        FROM listings)"""
    ),
)
def price_bounds(spark, folder):
    return pricing.price_bounds(listings(spark, folder, "price_min", "price_max"))


@query(
    "price_spread",
    with_listings(
        f"""SELECT product_id, moq, {r('price_max - price_min', 4)} AS spread,
        {r('(price_max - price_min) / nullif(price_min, 0) * 100', 4)} AS spread_pct FROM listings"""
    ),
)
def price_spreads(spark, folder):
    spread, pct = price_spread()
    data = listings(spark, folder, "product_id", "moq", "price_min", "price_max")
    return data.select("product_id", "moq", F.round(spread, 4).alias("spread"), F.round(pct, 4).alias("spread_pct"))


@query(
    "scatter_points",
    with_listings(
        f"""SELECT category, moq AS x, {r(AVG, 4)} AS y, name, {CITY_OF_LOCATION} AS city FROM listings
        WHERE category IN ({sql_list(TYPES[:5])})"""
    ),
)
def scatter(spark, folder):
    data = _with_city(listings(spark, folder, "category", "moq", "price_min", "price_max", "name", "supplier_location"))
    return rounded(scatter_points(data, TYPES[:5]), 4, "y")


@query(
    "rating_stars",
    """SELECT s_suppkey, repeat('★', k) || repeat('☆', 5 - k) AS stars FROM (
    SELECT s_suppkey, CAST(floor(greatest(0.0, least(5.0, s_acctbal / 2000.0)) + 0.5) AS INTEGER) AS k FROM supplier)""",
)
def stars(spark, folder):
    rating = F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.col("s_acctbal") / 2000.0))
    return table(spark, folder, "supplier").select("s_suppkey", rating_stars(rating).alias("stars"))


@query(
    "format_price",
    "SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) || ' USD' AS price FROM orders",
)
def format_prices(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", format_price(F.col("o_totalprice")).alias("price"))


@query(
    "dropna_subset",
    """SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def dropna_subset(spark, folder):
    joined = table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels"), "doc_id", "left")
    return joined.na.drop(subset=["quality", "toxic"])


@query(
    "explorer_filter",
    with_listings(
        f"""SELECT product_id, name, category, {r(AVG, 4)} AS avg_price, {CITY_OF_LOCATION} AS supplier_city FROM listings
        WHERE category = 'PROMO' AND {TIER} = 'Gold' AND contains(lower({CITY_OF_LOCATION}), 'mum')
        AND {AVG} BETWEEN 1000 AND 5000 AND verified_supplier"""
    ),
)
def explorer(spark, folder):
    columns = "product_id name category price_min price_max supplier_location supplier_rating verified_supplier".split()
    data = _with_city(listings(spark, folder, *columns)).withColumn("supplier_tier", supplier_tier())
    kept = explorer_filter(data, "PROMO", "Gold", " Mum ", 1000, 5000, True)
    out = kept.select("product_id", "name", "category", average_price(True).alias("avg_price"), "supplier_city")
    return rounded(out, 4, "avg_price")


@query(
    "load_products",
    with_listings(
        """SELECT product_id, category, price_min, price_max, scraped_at FROM listings
        WHERE category = 'SMALL' AND price_min >= 1500 AND price_max <= 3000
        ORDER BY scraped_at DESC, product_id, price_min, price_max LIMIT 1000"""
    ),
)
def newest_products(spark, folder):
    data = listings(spark, folder, "product_id", "category", "price_min", "price_max", "scraped_at")
    return load_products(data, 1000, "SMALL", 1500, 3000, ("product_id", "price_min", "price_max"))


@query(
    "page_products",
    with_listings(
        """SELECT product_id, name, price_max FROM listings ORDER BY name, product_id, price_max LIMIT 25 OFFSET 50"""
    ),
)
def third_page(spark, folder):
    data = listings(spark, folder, "product_id", "name", "price_max")
    return page_products(data, 3, 25, ("product_id", "price_max"))


@query(
    "top_group_rows",
    with_listings(
        """SELECT product_id, supplier_state, moq FROM listings WHERE supplier_state IN (
        SELECT supplier_state FROM listings GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)"""
    ),
)
def rows_of_top_states(spark, folder):
    return top_group_rows(listings(spark, folder, "product_id", "supplier_state", "moq"), "supplier_state", 8)
