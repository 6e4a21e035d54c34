"""Named queries over the test tables, each with the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query. Without SQL only its rows are checked, and a test covers its rule."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def r(expression: str, digits: int = 6) -> str:
    """SQL for a double rounded half up on its decimal text, as Spark rounds, without a negative zero."""
    decimal = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 17))"
    return f"(CAST(round({decimal}, {digits}) AS DOUBLE) + 0.0)"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_values(pairs: Iterable[tuple], columns: str) -> str:
    """A lookup table as SQL; ``columns`` is its alias and column list."""
    rows = ", ".join(
        "(" + ", ".join(sql_text(v) if isinstance(v, str) else repr(v) for v in row) + ")" for row in pairs
    )
    return f"(VALUES {rows}) AS {columns}"


def sql_list(values: Iterable[str]) -> str:
    return ", ".join(sql_text(v) for v in values)


LISTINGS = """
listings AS (
  SELECT
    'P-' || l_orderkey || '-' || l_linenumber AS product_id,
    p_name AS name,
    l_extendedprice / l_quantity * (1 - l_discount) + 0.0 AS price_min,
    l_extendedprice / l_quantity + 0.0 AS price_max,
    CASE s_nationkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
      WHEN 3 THEN 'JPY' WHEN 4 THEN 'CNY' ELSE 'INR' END AS currency,
    CAST(l_quantity AS INTEGER) AS moq,
    CASE l_returnflag WHEN 'A' THEN 'Pcs.' WHEN 'N' THEN 'KGS' WHEN 'R' THEN 'sqm' END AS unit,
    s_name AS supplier_name,
    floor(least(5.0, s_acctbal / 2000.0) * 10.0 + 0.5) / 10.0 + 0.0 AS supplier_rating,
    CASE s_suppkey % 4 WHEN 0 THEN 'Mumbai, Maharashtra, India' WHEN 1 THEN 'Pune, Maharashtra'
      WHEN 2 THEN 'Navi Mumbai' ELSE n_name || ', ' || r_name END AS supplier_location,
    l_linestatus = 'F' AS verified_supplier,
    100.0 * (1 - l_tax * 10.0) AS response_rate,
    p_type AS category,
    p_brand AS subcategory,
    p_name || ' of ' || lower(p_type) || ' grade, ' || p_size || ' mm wide, '
      || CASE p_size % 3 WHEN 0 THEN 'steel' WHEN 1 THEN 'Brass' ELSE 'nylon' END
      || ' body, ' || (p_size * 5) || ' V AC' AS description,
    epoch(l_shipdate) AS scraped_at,
    'India' AS supplier_country,
    n_name AS supplier_state,
    r_name AS supplier_region
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)
"""

TIER = """CASE WHEN verified_supplier AND coalesce(supplier_rating, 0) >= 4.0 THEN 'Gold'
  WHEN verified_supplier AND coalesce(supplier_rating, 0) >= 3.0 THEN 'Silver' ELSE 'Unverified' END"""


def with_listings(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([LISTINGS, *ctes]) + body
