"""The star schema seen as marketplace listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mandiscope.functions.text import round_half_up
from mandiscope.session import spread

# Order in which the listing's currency is picked by the supplier's nation.
LISTING_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CNY", "INR"]
LISTING_UNITS = {"A": "Pcs.", "N": "KGS", "R": "sqm"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session's zone."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return (F.unix_date(ts.cast("date")).cast("double") * 86400.0 + clock).cast("double")


def _columns() -> dict[str, tuple[Column, set[str]]]:
    """Listing column -> (expression, dimension tables it needs)."""
    unit_price = F.col("l_extendedprice") / F.col("l_quantity")
    currency = F.lit(None).cast("string")
    for code, name in reversed(list(enumerate(LISTING_CURRENCIES))):
        currency = F.when(F.col("s_nationkey") % 6 == code, name).otherwise(currency)
    unit = F.lit(None).cast("string")
    for flag, text in LISTING_UNITS.items():
        unit = F.when(F.col("l_returnflag") == flag, text).otherwise(unit)
    place = F.col("s_suppkey") % 4
    location = (
        F.when(place == 0, "Mumbai, Maharashtra, India")
        .when(place == 1, "Pune, Maharashtra")
        .when(place == 2, "Navi Mumbai")
        .otherwise(F.concat("n_name", F.lit(", "), "r_name"))
    )
    description = F.concat(
        F.col("p_name"), F.lit(" of "), F.lower("p_type"), F.lit(" grade, "),
        F.col("p_size").cast("string"), F.lit(" mm wide, "),
        F.when(F.col("p_size") % 3 == 0, "steel").when(F.col("p_size") % 3 == 1, "Brass").otherwise("nylon"),
        F.lit(" body, "), (F.col("p_size") * 5).cast("string"), F.lit(" V AC"),
    )
    return {
        "product_id": (F.concat(F.lit("P-"), "l_orderkey", F.lit("-"), "l_linenumber"), set()),
        "name": (F.col("p_name"), {"part"}),
        "price_min": (unit_price * (1 - F.col("l_discount")) + 0.0, set()),
        "price_max": (unit_price + 0.0, set()),
        "currency": (currency, {"supplier"}),
        "moq": (F.col("l_quantity").cast("int"), set()),
        "unit": (unit, set()),
        "supplier_name": (F.col("s_name"), {"supplier"}),
        "supplier_rating": (round_half_up(F.least(F.lit(5.0), F.col("s_acctbal") / 2000.0), 1), {"supplier"}),
        "supplier_location": (location, {"supplier", "nation", "region"}),
        "verified_supplier": (F.col("l_linestatus") == "F", set()),
        "response_rate": (100.0 * (1 - F.col("l_tax") * 10.0), set()),
        "category": (F.col("p_type"), {"part"}),
        "subcategory": (F.col("p_brand"), {"part"}),
        "description": (description, {"part"}),
        "scraped_at": (epoch_seconds(F.col("l_shipdate")), set()),
        "supplier_country": (F.lit("India"), set()),
        "supplier_state": (F.col("n_name"), {"supplier", "nation"}),
        "supplier_region": (F.col("r_name"), {"supplier", "nation", "region"}),
    }


LISTING_COLUMNS = list(
    "product_id name price_min price_max currency moq unit supplier_name supplier_rating "
    "supplier_location verified_supplier response_rate category subcategory description scraped_at "
    "supplier_country supplier_state supplier_region".split()
)


def listings(spark: SparkSession, folder: str, *columns: str, lines: DataFrame | None = None) -> DataFrame:
    """Line items, or other ``lines`` like them, as listings, joined to just the dimensions the columns need."""
    expressions = _columns()
    wanted = columns or tuple(LISTING_COLUMNS)
    needed = set().union(*(expressions[c][1] for c in wanted))
    df = table(spark, folder, "lineitem") if lines is None else lines
    if "part" in needed:
        df = df.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "supplier" in needed:
        df = df.join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    if "nation" in needed:
        df = df.join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    if "region" in needed:
        df = df.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.select(*(expressions[c][0].alias(c) for c in wanted))


def spread_listings(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Listings whose lines are dealt out to all cores before the joins, for costly work per row."""
    return listings(spark, folder, *columns, lines=spread(table(spark, folder, "lineitem")))
