"""Exact quantiles that never hold a group's values in one task and never move raw rows to their group.

Spark's exact ``percentile`` keeps every distinct value of a group in one hash map. Here the rank is refined in two
scans. The first brackets each quantile between two values by a bounded sketch, one aggregate row per group, and
writes these brackets as a table. The second reads the rows beside that table, which the planner broadcasts by its
known size, and counts what lies below and above each bracket by conditional aggregates; only values inside a
bracket, about ``4 / accuracy`` of a group, become keys of the aggregate. Both scans combine on the map side, so one
value or one group may hold most rows, and several columns are done in the same two scans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mandiscope.functions.scalars import with_row
from mandiscope.session import written

ACCURACY = 20_000


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    method: str = "linear",
    accuracy: int = ACCURACY,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group: group columns, ``n``, one column per named probability, and the aggregates ``also``.

    ``linear`` interpolates between neighbours at position ``(n - 1) p``; ``floor`` takes the sorted
    value at index ``floor(n p)``. Null and NaN values are ignored; groups without values are absent.
    ``also`` are aggregates over the rows with a value, taken in the first scan.
    """
    present = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    found = _quantiles(present, list(groups), [value], probabilities, method, accuracy, lambda _: also or {})
    return found.select(*groups, "n", *probabilities, *(also or {}))


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    method: str = "linear",
    accuracy: int = ACCURACY,
    also: Callable[[Column], dict[str, Column]] = lambda _: {},
) -> DataFrame:
    """One row per column that has values: ``column``, ``n``, the named probabilities and the aggregates ``also`` of it."""
    found = _quantiles(df, [], list(columns), probabilities, method, accuracy, also)
    return found.select("column", "n", *probabilities, *(also(F.lit(0.0)) if columns else {}))


def _quantiles(
    df: DataFrame,
    groups: list[str],
    columns: list[str],
    probabilities: dict[str, float],
    method: str,
    accuracy: int,
    also: Callable[[Column], dict[str, Column]],
) -> DataFrame:
    if method not in ("linear", "floor"):
        raise ValueError(f"unknown method {method!r}")
    shares, margin = list(probabilities.values()), 2.0 / accuracy
    bounds = [b for p in shares for b in (max(p - margin, 0.0), min(p + margin, 1.0))]
    keys = [f"_g{i}" for i in range(len(groups))]
    cast = [F.col(c).cast("double") for c in columns]
    values = df.select(
        *(F.col(g).alias(k) for g, k in zip(groups, keys)),
        *(F.when(~F.isnan(v), v).alias(f"_v{c}") for c, v in enumerate(cast)),
        *(df[name] for name in df.columns),
    )
    own = [F.col(f"_v{c}") for c in range(len(columns))]
    sketch = values.groupBy(*keys).agg(
        *(F.count(v).alias(f"_n{c}") for c, v in enumerate(own)),
        *(F.percentile_approx(v, bounds, accuracy).alias(f"_b{c}") for c, v in enumerate(own)),
        *(a.alias(f"_a{c}_{name}") for c, v in enumerate(own) for name, a in also(v).items()),
    )
    sketch = written(sketch)
    narrow = values.select(*keys, *own)
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    side = sketch.select(*(F.col(k).alias(f"{k}_") for k in keys), *(f"_b{c}" for c in range(len(columns))))
    # The planner chooses by the size of the written table; without groups that is one row.
    located = narrow.join(side, reduce(and_, same)) if keys else with_row(narrow, side)

    def limits(c: int, q: int) -> tuple[Column, Column]:
        return F.get(f"_b{c}", F.lit(2 * q)), F.get(f"_b{c}", F.lit(2 * q + 1))

    pairs = [(c, q, *limits(c, q)) for c in range(len(columns)) for q in range(len(shares))]
    held = [reduce(or_, (own[c].between(lo, hi) for d, _, lo, hi in pairs if d == c)) for c in range(len(columns))]
    inside = [F.when(h, v).alias(f"_v{c}") for c, (h, v) in enumerate(zip(held, own))]
    counted = located.groupBy(*keys, *inside).agg(
        F.count("*").alias("c"),
        *(a for c, q, lo, hi in pairs for a in (
            F.count_if(own[c] < lo).alias(f"below_{c}_{q}"),
            F.count_if(own[c] > hi).alias(f"above_{c}_{q}"),
            F.max(F.when(own[c] < lo, own[c])).alias(f"last_{c}_{q}"),
            F.min(F.when(own[c] > hi, own[c])).alias(f"next_{c}_{q}"),
        )),
    )
    return _picked(written(counted), sketch, keys, groups, columns, probabilities, method, also)


def _picked(
    counted: DataFrame,
    sketch: DataFrame,
    keys: list[str],
    groups: list[str],
    columns: list[str],
    probabilities: dict[str, float],
    method: str,
    also: Callable[[Column], dict[str, Column]],
) -> DataFrame:
    """The values at the wanted ranks, from counts below, inside and above each bracket; all tables here are small."""
    pairs = [(c, q) for c in range(len(columns)) for q in range(len(probabilities))]
    totals = counted.groupBy(*keys).agg(
        *(F.sum(f"{side}_{c}_{q}").alias(f"{side}_{c}_{q}") for c, q in pairs for side in ("below", "above")),
        *(F.max(f"last_{c}_{q}").alias(f"last_{c}_{q}") for c, q in pairs),
        *(F.min(f"next_{c}_{q}").alias(f"next_{c}_{q}") for c, q in pairs),
    )

    def outside(c: int, q: int, zone: int) -> Column:
        value, count = ("last", "below") if zone < 0 else ("next", "above")
        return F.struct(F.lit(c).alias("column"), F.lit(q).alias("q"), F.lit(zone).alias("zone"), F.col(f"{value}_{c}_{q}").alias("v"), F.col(f"{count}_{c}_{q}").alias("c"))

    border = totals.select(*keys, F.explode(F.array(*(outside(c, q, z) for c, q in pairs for z in (-1, 1)))).alias("_o")).select(*keys, "_o.*")
    slots = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_v{c}").alias("v")) for c in range(len(columns))))
    inside = counted.select(*keys, "c", F.explode(F.filter(slots, lambda s: s["v"].isNotNull())).alias("_s"))
    inside = inside.groupBy(*keys, F.col("_s.column").alias("column"), F.col("_s.v").alias("v")).agg(F.sum("c").alias("c"))

    def ranks(n: Column, p: float) -> tuple[Column, Column, Column]:
        if method == "floor":
            low = F.least(F.floor(n * p), n - 1)
            return low, low, F.lit(0.0)
        position = (n - 1) * F.lit(float(p))
        low = F.floor(position)
        return low, F.ceil(position), position - low

    wanted = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(q).alias("q"),
                F.col(f"_n{c}").alias("n"),
                F.get(f"_b{c}", F.lit(2 * q)).alias("lo"),
                F.get(f"_b{c}", F.lit(2 * q + 1)).alias("hi"),
                *(r.alias(a) for r, a in zip(ranks(F.col(f"_n{c}"), p), ("k0", "k1", "frac"))),
            )
            for c in range(len(columns))
            for q, p in enumerate(probabilities.values())
        )
    )
    asked = sketch.select(*keys, F.explode(wanted).alias("_w")).select(*keys, "_w.*").where("n > 0")
    other = asked.select(*(F.col(k).alias(f"{k}_") for k in keys), F.col("column").alias("column_"), F.col("q").alias("q_"), "n", "lo", "hi", "k0", "k1", "frac")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], F.col("column") == F.col("column_"))
    fixed = [*keys, "column", "q", "n", "k0", "k1", "frac"]
    counts = (
        border.join(other, same & (F.col("q") == F.col("q_"))).select(*fixed, "zone", "v", "c").where("c > 0").unionByName(
            inside.join(other, same & F.col("v").between(F.col("lo"), F.col("hi")))
            .withColumnRenamed("q_", "q")
            .select(*fixed, F.lit(0).alias("zone"), "v", "c")
        )
    )
    running = Window.partitionBy(*keys, "column", "q").orderBy("zone", "v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("c").over(running))
    checked = ranked.withColumn(
        "v",
        # Outside the bracket only its direct neighbour is known: the largest below, the smallest above.
        F.when(
            (F.col("zone") == -1) & (F.col("k0") < F.col("upto") - 1),
            F.raise_error(F.lit("quantile below its bracket: raise accuracy")).cast("double"),
        )
        .when(
            (F.col("zone") == 1) & (F.col("k1") > F.col("upto") - F.col("c")),
            F.raise_error(F.lit("quantile above its bracket: raise accuracy")).cast("double"),
        )
        .otherwise(F.col("v")),
    )
    picked = checked.groupBy(*fixed).agg(
        F.min(F.when(F.col("upto") > F.col("k0"), F.col("v"))).alias("v0"),
        F.min(F.when(F.col("upto") > F.col("k1"), F.col("v"))).alias("v1"),
    )
    answer = F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac")
    result = picked.groupBy(*keys, "column").agg(
        F.max("n").alias("n"), *(F.max(F.when(F.col("q") == q, answer)).alias(name) for q, name in enumerate(probabilities))
    )
    more = list(also(F.lit(0.0)))
    if more:
        told = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"_a{c}_{m}").alias(m) for m in more)) for c in range(len(columns))))
        extra = sketch.select(*(F.col(k).alias(f"{k}_") for k in keys), F.explode(told).alias("_t"))
        extra = extra.select(*(f"{k}_" for k in keys), F.col("_t.column").alias("column_"), *(f"_t.{m}" for m in more))
        result = result.join(extra, same)
    return result.select(
        *(F.col(k).alias(g) for k, g in zip(keys, groups)),
        F.element_at(F.array(*map(F.lit, columns)), F.col("column") + 1).alias("column"),
        "n",
        *probabilities,
        *more,
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of several numeric columns as (column, median) rows."""
    return column_quantiles(df, columns, {"median": 0.5}).select("column", "median")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent text of several columns, the smallest on ties, as (column, mode) rows."""
    long = df.select(
        F.explode(
            F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
        ).alias("_c")
    ).select("_c.*")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").count()
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("count")).alias("c"), "value")).alias("best"))
    return best.select("column", F.col("best.value").alias("mode"))
