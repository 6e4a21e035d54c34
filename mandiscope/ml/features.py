"""Imputation, scaling and encoding with exact statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.operators.quantiles import medians, modes
from mandiscope.session import durable


class _Columns(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Parameters of the steps below; learnt values are parameters as well, so that saving a model keeps them."""

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    text = Param(Params._dummy(), "text", "text columns", TypeConverters.toListString)
    unknown = Param(Params._dummy(), "unknown", "text of a column without values", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the scaled columns", TypeConverters.toString)
    medians = Param(Params._dummy(), "medians", "median per numeric column, NaN if it has no value", TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "most frequent value per text column", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "mean per numeric column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviation per numeric column", TypeConverters.toListFloat)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(numeric=[], text=[], unknown="unknown", prefix="z_")
        self._set(**values)


class FillGapsModel(Model, _Columns):
    """Fills missing numbers by the learnt median and missing texts by the learnt value. A column without values stays null."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(None if math.isnan(m) else m).cast("double")) for c, m in zip(get("numeric"), get("medians"))}
        fills |= {c: F.coalesce(F.col(c), F.lit(m)) for c, m in zip(get("text"), get("modes"))}
        return dataset.withColumns(fills) if fills else dataset


class FillGaps(Estimator, _Columns):
    """Learns the exact median of numeric columns and the most frequent value of text columns (ties: the smallest)."""

    def _fit(self, dataset: DataFrame) -> FillGapsModel:
        numeric, text = self.getOrDefault("numeric"), self.getOrDefault("text")
        # One value per column comes to the driver.
        middle = {r.column: r.median for r in medians(dataset, numeric).collect()} if numeric else {}
        common = {r.column: r.mode for r in modes(dataset, text).collect()} if text else {}
        unknown = self.getOrDefault("unknown")
        return FillGapsModel(
            numeric=numeric, text=text, medians=[middle.get(c, math.nan) for c in numeric], modes=[common.get(c, unknown) for c in text]
        )


class StandardizeModel(Model, _Columns):
    """Adds z-scores by the learnt means and deviations; a constant column scores zero."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        scores = {}
        for c, mean, deviation in zip(get("numeric"), get("means"), get("deviations")):
            score = F.lit(0.0) if deviation == 0 else (F.col(c) - F.lit(mean)) / F.lit(deviation)
            scores[f"{get('prefix')}{c}"] = F.when(F.col(c).isNotNull(), score)
        return dataset.withColumns(scores)


class Standardize(Estimator, _Columns):
    """Learns mean and population deviation of the numeric columns."""

    def _fit(self, dataset: DataFrame) -> StandardizeModel:
        numeric = self.getOrDefault("numeric")
        row = dataset.agg(*(F.avg(c) for c in numeric), *(F.stddev_pop(c) for c in numeric)).first()
        told = [math.nan if v is None else v for v in row]
        return StandardizeModel(numeric=numeric, prefix=self.getOrDefault("prefix"), means=told[: len(numeric)], deviations=told[len(numeric) :])


def impute(df: DataFrame, numeric: Sequence[str], text: Sequence[str], unknown: str = "unknown") -> DataFrame:
    """Missing numbers become the exact median, missing texts the most frequent value, else ``unknown``."""
    return FillGaps(numeric=list(numeric), text=list(text), unknown=unknown).fit(df).transform(df).select(*df.columns)


def standardize(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Add z-scores by population deviation; a constant column scores zero."""
    return Standardize(numeric=list(columns), prefix=prefix).fit(df).transform(df)


def prepare(numeric: Sequence[str], text: Sequence[str], scaled: Sequence[str], averaged: bool = False) -> Pipeline:
    """Imputation, the average price if asked for, and scaling as one pipeline to fit, save and use on new rows."""
    stages = [FillGaps(numeric=list(numeric), text=list(text))]
    if averaged:
        stages.append(SQLTransformer(statement="SELECT *, (price_min + price_max) / 2 AS avg_price FROM __THIS__"))
    return Pipeline(stages=[*stages, *([Standardize(numeric=list(scaled))] if scaled else [])])


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with codes 0.. in sorted order.

    Positions are counted per range partition and offset by the partitions before, so no task sees
    all values.
    """
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    ordered = values.sort("value").select("value", F.monotonically_increasing_id().alias("_id"))
    # The generated id holds the partition above bit 33 and the position inside it below.
    split = ordered.select(
        "value", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(2**33 - 1).alias("_pos")
    )
    split = durable(split)
    # One row per partition of the sort, here and in the broadcast below.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        split.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    return split.join(F.broadcast(before), "_part").select("value", (F.col("_offset") + F.col("_pos")).alias("code"))


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the code of a column's value; null stays without one.

    The planner broadcasts the codes only if they are small. Otherwise rows meet them by value and a salt, so that neither a
    frequent value nor the nulls gather in one task.
    """
    spread_over = 16
    codes = label_codes(df, column).select(F.col("value").alias("_value"), F.col("code").alias(out))
    codes = codes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread_over - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(spread_over)).cast("int"))
    # A null never meets a code, but it may go to any task.
    own = F.coalesce(F.col(column), F.concat(F.lit("\0"), F.xxhash64(*df.columns).cast("string")))
    found = salted.withColumn("_own", own).join(codes, (F.col("_own") == F.col("_value")) & salted["_salt"].eqNullSafe(codes["_salt"]), "left")
    return found.select(*df.columns, out)
