"""A15, A16 and exact quantiles that never gather a group into one task.

``exact_percentiles`` brackets each wanted rank before it sorts anything: a quantile sketch
per group (bounded, combined map-side) yields two values that enclose the rank. One pass then
counts, also map-side, the values below, between and above the brackets; only those inside a
bracket are counted value by value. Running counts over these few rows find the exact order
statistics. No value is shuffled as a row: what moves is a sketch per task and group, and the
distinct values of brackets that hold a few ten-thousandths of a group each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def geometric_mean(x: Column) -> Column:
    """``exp(mean(log(x + 1))) - 1``, NULLs skipped (an aggregate expression)."""
    return F.exp(F.avg(F.log(x + F.lit(1.0)))) - F.lit(1.0)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    *,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact linear-interpolated percentiles of an integer column per group.

    Matches ``percentile`` / pandas / ``quantile_cont``: for n values and
    probability p, the result interpolates between the values at 0-based ranks
    floor((n-1)p) and ceil((n-1)p). NULL values are ignored; groups without values
    are absent from the result. Returns ``keys`` + one double column per probability.

    ``accuracy`` sets the sketch: its rank error is n / accuracy, a bracket reaches four
    times that far to either side. Up to 4 * accuracy values a group is one bracket. Should
    a rank lie outside its bracket after all, the query fails; it never yields another value.

    One lazy plan whatever the data: nothing runs while it is built.
    """
    keys = list(keys)
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in probs]
    k, reach = len(probs), 4.0 / accuracy
    vals = df.select(*keys, F.col(value).cast("long").alias("_v")).filter("_v IS NOT NULL")
    edges = [max(0.0, p - reach) for p in probs] + [min(1.0, p + reach) for p in probs]
    bracket = vals.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_e"))
    bracket = bracket.select(*keys, "_n", F.expr(f"CASE WHEN _n > {4 * accuracy} THEN _e END").alias("_e"))

    # a zone lies below, in or above each bracket; zones ascend with the values, and those in
    # a bracket keep the values apart
    above = [f"(_v > _e[{k + i}])" for i in range(k)]
    inside = [f"(_v BETWEEN _e[{i}] AND _e[{k + i}])" for i in range(k)]
    zone = " + ".join(f"2 * int({a}) + int({b})" for a, b in zip(above, inside))
    counted = (
        vals.join(bracket, keys)
        .selectExpr(*keys, "_n", f"coalesce({zone}, 0) AS _zone", f"CASE WHEN _e IS NULL OR {' OR '.join(inside)} THEN _v END AS _v")
        .groupBy(*keys, "_n", "_zone", "_v").agg(F.count(F.lit(1)).alias("_c"))
    )
    up_to = Window.partitionBy(*keys, "_n").orderBy("_zone", "_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_c").over(up_to))

    aggs, out = [], []
    for i, p in enumerate(probs):
        pos = f"((_n - 1) * {float(p)!r}D)"
        for side in ("floor", "ceil"):
            hit = f"{side}({pos}) >= _upto - _c AND {side}({pos}) < _upto"
            found = "coalesce(_v, raise_error('a rank lies outside its bracket'))"
            aggs.append(F.expr(f"max(CASE WHEN {hit} THEN {found} END)").cast("double").alias(f"_{side}{i}"))
        # the interpolation arithmetic of Spark's percentile, bit for bit
        out.append(F.expr(f"CASE WHEN floor({pos}) = ceil({pos}) THEN _floor{i} "
                          f"ELSE (ceil({pos}) - {pos}) * _floor{i} + ({pos} - floor({pos})) * _ceil{i} END").alias(names[i]))
    return ranked.groupBy(*keys, "_n").agg(*aggs).select(*keys, *out)
