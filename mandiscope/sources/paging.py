"""Pages of an ordered snapshot by seeking a key, in place of a full sort with an offset.

A snapshot is written in ranges of its order, one folder each, with a small table of every range's first and last key and
its number of rows. A page then reads the one or two ranges it lies in, whether it is asked for by its number or by the
last key of the page before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a range, about.
RANGE = 50_000
#: Ranges at most, each a folder; of larger tables every range holds more rows.
RANGES = 1_000


def write_ordered(df: DataFrame, path: str, order: Sequence[str], rows: int = RANGE) -> None:
    """Write ``df`` as ranges by ``order``, null first, at most ``RANGES``. Rows that repeat a whole key stay in one range."""
    number = df.count()
    ranges = min(RANGES, max(1, -(-number // rows)))
    dealt = df.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    # Without rows there is no folder, so one empty file keeps the schema.
    dealt.sortWithinPartitions(*order).write.mode("overwrite").partitionBy(*(["range"] if number else [])).parquet(f"{path}/rows")
    held = df.sparkSession.read.schema(dealt.schema).parquet(f"{path}/rows")
    bounds = held.groupBy("range").agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"), F.count("*").alias("n"))
    # One row per range.
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    bounds.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")


def _rows(spark: SparkSession, path: str, ranges: Sequence[int]) -> DataFrame:
    whole = spark.read.parquet(f"{path}/rows")
    return whole.where(F.col("range").isin(list(ranges))).drop("range")


def _key(spark: SparkSession, path: str, after: Sequence) -> Column:
    """``after`` as a struct of the order's types; structs compare field by field with null first."""
    fields = spark.read.parquet(f"{path}/ranges").schema["low"].dataType.fields
    return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(after, fields)))


def page_after(spark: SparkSession, path: str, after: Sequence | None = None, size: int = 25) -> DataFrame:
    """The ``size`` rows that follow the key ``after``, or the first ones, in order."""
    ranges = spark.read.parquet(f"{path}/ranges")
    order = ranges.schema["low"].dataType.fieldNames()
    ahead = ranges if after is None else ranges.where(F.col("high") > _key(spark, path, after))
    # As many ranges as hold the page besides the first, of which a part may lie before the key.
    found, held = [], 0
    for row in ahead.orderBy("range").select("range", "n").limit(size + 1).collect():
        found.append(row.range)
        held += row.n if len(found) > 1 or after is None else 0
        if held >= size:
            break
    rows = _rows(spark, path, found)
    if after is not None:
        rows = rows.where(F.struct(*order) > _key(spark, path, after))
    return rows.orderBy(*order).limit(size)


def page_number(spark: SparkSession, path: str, page: int = 1, size: int = 25) -> DataFrame:
    """Page ``page`` from 1, in order; no rows beyond the last."""
    ranges = spark.read.parquet(f"{path}/ranges")
    order = ranges.schema["low"].dataType.fieldNames()
    first = (max(page, 1) - 1) * size
    found = ranges.where((F.col("before") < first + size) & (F.col("before") + F.col("n") > first)).orderBy("range").collect()
    skipped = first - found[0].before if found else 0
    return _rows(spark, path, [r.range for r in found]).orderBy(*order).offset(skipped).limit(size)
