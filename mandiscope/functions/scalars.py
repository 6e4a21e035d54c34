"""One-row results beside every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame.

    The row is a scalar subquery: it is computed once and used as a constant, without any join.
    """
    constant = row.select(F.struct(*row.columns).alias("_row")).scalar()
    return df.withColumn("_row", constant).select(*df.columns, *(F.col(f"_row.{c}").alias(c) for c in row.columns))
