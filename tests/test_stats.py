import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crashlens.functions.stats import exact_percentiles, geometric_mean


@pytest.mark.parametrize("accuracy", [10_000, 100, 10])
def test_exact_percentiles_paths(spark, accuracy):
    rng = random.Random(11)
    rows = [("hot", rng.randrange(0, 10)) for _ in range(3000)]               # one group with a third+ of rows
    rows += [("wide", rng.randrange(0, 2 ** 40)) for _ in range(500)]
    rows += [("skew", min(2 ** 40, int(rng.paretovariate(0.3)))) for _ in range(4000)] + [("below", -k * k) for k in range(700)]
    rows += [("one", 42)]
    rows += [("none", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs, accuracy=accuracy).collect()}
    assert "none" not in got
    for g in ("hot", "wide", "skew", "below", "one"):
        vals = np.array([v for k, v in rows if k == g], dtype=float)
        want = np.percentile(vals, [p * 100 for p in probs])
        assert [got[g][f"p{int(p * 100)}"] for p in probs] == pytest.approx(list(want), rel=1e-12)


def test_values_are_not_shuffled(spark):
    """Beyond a bracket's worth of values, a few rows of each group reach the ranking step."""
    df = spark.range(0, 200_000, 1, 4).selectExpr("id % 2 AS g", "(id * 7919) % 200003 AS v")
    out = exact_percentiles(df, ["g"], "v", [0.5], accuracy=1000)
    rows = out.collect()

    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert {r.g: r.p50 for r in rows} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_percentile_approx" in plan


def test_geometric_mean(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    assert df.select(geometric_mean(df.x)).first()[0] == pytest.approx(np.exp(np.log([2.0, 4.0]).mean()) - 1)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    groups=st.dictionaries(
        st.sampled_from(["a", "b", "c"]),
        st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**45)), min_size=1, max_size=60),
        min_size=1,
    ),
)
def test_exact_percentiles_property(spark, groups):
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v bigint")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        want = np.percentile(np.array(vs, dtype=float), [p * 100 for p in probs])
        assert [got[g][f"p{int(p * 100)}"] for p in probs] == pytest.approx(list(want), rel=1e-12, abs=1e-9)
