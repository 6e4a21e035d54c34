"""Price anomalies by an isolation forest (Liu, Ting and Zhou, 2008).

Spark ML has no such model. The trees need only a bounded sample, so they are grown in parallel tasks
from it; the forest, a few thousand nodes, is broadcast and every row is scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mandiscope.functions.scalars import with_row
from mandiscope.ml.features import prepare
from mandiscope.operators.quantiles import exact_quantiles
from mandiscope.session import durable, spread

# Features, seed, forest size, sample per tree, flagged share and row minimum.
FEATURES = ["price_min", "price_max", "moq"]
SEED = 42
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.1
MIN_ROWS = 10

NODE = "tree int, node int, feature int, split double, size int"


def path_length(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(points: np.ndarray, rng: np.random.Generator) -> list[tuple[int, int, float, int]]:
    """Nodes of one tree as (heap position, feature or -1, split, size)."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes, stack = [], [(1, points, 0)]
    while stack:
        at, data, depth = stack.pop()
        spread = data.max(axis=0) - data.min(axis=0)
        usable = np.flatnonzero(spread > 0)
        if depth >= limit or len(data) <= 1 or not len(usable):
            nodes.append((at, -1, 0.0, len(data)))
            continue
        feature = int(rng.choice(usable))
        low = data[:, feature].min()
        split = float(rng.uniform(low, low + spread[feature]))
        left = data[:, feature] <= split
        nodes.append((at, feature, split, len(data)))
        stack += [(2 * at, data[left], depth + 1), (2 * at + 1, data[~left], depth + 1)]
    return nodes


def price_anomalies(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    key: str = "product_id",
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    sample_rows: int = SAMPLE,
) -> DataFrame | None:
    """Rows with gaps filled, ``anomaly_score`` (low is odd) and ``is_anomaly``; ``None`` for too few rows.

    Each tree grows from ``sample_rows`` rows, as published; all rows are scored.
    """
    features = list(features)
    spark = df.sparkSession
    dealt = spread(df)
    scaled = prepare(features, [], features).fit(dealt).transform(dealt).na.drop(subset=features)
    z = [f"z_{f}" for f in features]
    # The rows of least hash, so that the choice does not depend on partitioning.
    hashed = scaled.select(F.xxhash64(F.col(key), *z, F.lit(SEED)).alias("_h"), *z)
    wanted = trees * sample_rows
    # A threshold thins the rows before they are ordered; without it every task would send its own least rows.
    share = min(1.0, 1.5 * wanted / max(scaled.count(), 1))
    picked = hashed.where(F.col("_h") <= min(int((2 * share - 1) * 2.0**63), 2**63 - 1)).orderBy("_h", *z).limit(wanted).toPandas()
    if len(picked) < wanted and share < 1:
        picked = hashed.orderBy("_h", *z).limit(wanted).toPandas()
    if len(picked) <= MIN_ROWS:
        return None
    sample = spark.sparkContext.broadcast(picked[z].to_numpy())

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tree in batch["id"]:
                rng = np.random.default_rng([SEED, int(tree)])
                size = min(sample_rows, len(sample.value))
                chosen = sample.value[rng.choice(len(sample.value), size, replace=False)]
                rows += [(tree, *node) for node in grow(chosen, rng)]
            yield pd.DataFrame(rows, columns=["tree", "node", "feature", "split", "size"])

    # At most trees * (2 * sample_rows - 1) nodes.
    forest = spark.range(trees).repartition(spark.sparkContext.defaultParallelism).mapInPandas(build, NODE).toPandas()
    width = int(forest["node"].max()) + 1
    feature = np.full((trees, width), -1, dtype=np.int16)
    split = np.zeros((trees, width))
    size = np.zeros((trees, width))
    at = (forest["tree"].to_numpy(), forest["node"].to_numpy())
    feature[at], split[at], size[at] = forest["feature"], forest["split"], forest["size"]
    leaf_depth = np.floor(np.log2(np.maximum(np.arange(width), 1))) + path_length(size)
    shared = spark.sparkContext.broadcast((feature, split, leaf_depth, float(path_length(min(sample_rows, len(picked))))))

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, split, leaf_depth, normal = shared.value
        depth = int(np.log2(feature.shape[1])) + 1
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for tree in range(len(feature)):
                at = np.ones(len(x), dtype=np.int64)
                for _ in range(depth):
                    f = feature[tree, at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go = 2 * at + (x[rows, np.maximum(f, 0)] > split[tree, at])
                    at = np.where(inner, go, at)
                total += leaf_depth[tree, at]
            yield pd.Series(-np.exp2(-total / len(feature) / normal))

    scored = durable(scaled.withColumn("anomaly_score", score(*z)).drop(*z))
    limit = exact_quantiles(scored, [], "anomaly_score", {"limit": contamination}).select("limit")
    return (
        with_row(scored, limit)
        .withColumn("is_anomaly", F.col("anomaly_score") < F.col("limit"))
        .drop("limit")
    )


def anomaly_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("n"),
        F.count_if("is_anomaly").alias("anomalies"),
        (F.count_if("is_anomaly") / F.count("*") * 100).alias("anomaly_pct"),
    )


def threshold_check(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """One row: ``n``, whether all flagged rows score below all others, and whether they are the asked share.

    Rows that tie at the threshold are not flagged, so with ties the flagged are fewer; with the ties they are no fewer.
    """
    low = scored.agg(
        F.count("*").alias("n"),
        F.count_if("is_anomaly").alias("flagged"),
        F.max(F.when(F.col("is_anomaly"), F.col("anomaly_score"))).alias("low"),
        F.min(F.when(~F.col("is_anomaly"), F.col("anomaly_score"))).alias("high"),
    )
    ties = with_row(scored.select("anomaly_score"), low.select("high")).agg(F.count_if(F.col("anomaly_score") == F.col("high")).alias("ties"))
    place = (F.col("n") - 1) * F.lit(contamination)
    return with_row(low, ties).select(
        "n",
        (F.col("low") < F.col("high")).alias("separated"),
        ((F.col("flagged") <= F.ceil(place)) & (F.col("flagged") + F.col("ties") > F.floor(place))).alias("share_met"),
    )
