import numpy as np
import pytest
from pyspark.sql import functions as F

from mandiscope.operators import quantiles
from mandiscope.operators.quantiles import exact_quantiles, medians, modes
from mandiscope.session import written

SHARES = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q95": 0.95}


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", 7.0)] * 900 + [(g, float(v)) for g, n in (("one", 1), ("two", 2), ("many", 700), (None, 50)) for v in rng.integers(0, 40, n)]
    return rows, spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("accuracy", [20_000, 50])
def test_linear_and_floor(values, accuracy):
    rows, df = values
    linear = {r.g: r for r in exact_quantiles(df, ["g"], "v", SHARES, accuracy=accuracy).collect()}
    floor = {r.g: r for r in exact_quantiles(df, ["g"], "v", SHARES, "floor", accuracy).collect()}
    for group in {g for g, _ in rows}:
        own = np.sort([v for g, v in rows if g == group])
        assert [linear[group][k] for k in SHARES] == pytest.approx(np.quantile(own, list(SHARES.values())))
        assert [floor[group][k] for k in SHARES] == [own[int(len(own) * p)] for p in SHARES.values()]


def test_ungrouped(values):
    rows, df = values
    got = exact_quantiles(df, [], "v", SHARES).first()
    assert [got[k] for k in SHARES] == pytest.approx(np.quantile([v for _, v in rows], list(SHARES.values())))


def test_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (4.0, "a"), (None, "a"), (2.0, "b")], "x double, t string")
    assert [tuple(r) for r in medians(df, ["x"]).collect()] == [("x", 2.0)]
    assert [tuple(r) for r in modes(df, ["t"]).collect()] == [("t", "a")]


def test_columns_in_one_pass_with_their_moments(spark):
    rng = np.random.default_rng(4)
    rows = [(float(a), int(b), None if k % 3 else float(a), float("nan") if k % 5 else 1.0) for k, (a, b) in enumerate(zip(rng.normal(size=400), rng.integers(0, 5, 400)))]
    df = spark.createDataFrame(rows, "x double, n int, gaps double, odd double").withColumn("none", F.lit(None).cast("double"))
    found = quantiles.column_quantiles(df, ["x", "n", "gaps", "odd", "none"], SHARES, also=lambda v: {"mean": F.avg(v), "top": F.max(v)}, accuracy=50)
    got = {r.column: r for r in found.collect()}
    assert set(got) == {"x", "n", "gaps", "odd"}
    for at, name in enumerate(("x", "n", "gaps", "odd")):
        own = [r[at] for r in rows if r[at] is not None and r[at] == r[at]]
        assert [got[name][k] for k in SHARES] == pytest.approx(np.quantile(own, list(SHARES.values())))
        assert (got[name].n, got[name].top) == (len(own), max(own)) and got[name].mean == pytest.approx(np.mean(own))


def test_raw_rows_stay_where_they_are(spark, monkeypatch):
    """Only partial aggregates are exchanged, whatever the broadcast setting of the rows' own joins."""
    plans = []
    monkeypatch.setattr(quantiles, "written", lambda df: plans.append(df) or written(df))
    rows = spark.range(50_000).select((F.col("id") % 7).alias("g"), F.rand(3).alias("v"))
    assert exact_quantiles(rows, ["g"], "v", SHARES).count() == 7
    told = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    assert len(told) == 2 and "BroadcastHashJoin" in told[1] and not any("SortMergeJoin" in t for t in told)
    for text in told:
        lines = text.splitlines()
        at = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert at and all("partial_" in lines[k + 1] for k in at)
