"""Quantiles by selection against numpy's linear interpolation, with sketches so coarse that ranges, ties and small groups all occur."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotewell.operators.quantiles import with_quantiles
from quotewell.plans.queries import trial

QS = (0.0, 0.25, 0.5, 0.95, 0.999, 1.0)


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_against_numpy(spark, accuracy):
    rng = random.Random(1)
    rows = [("spread", rng.gauss(0, 1)) for _ in range(3001)] + [("ties", float(rng.choice((0, 0, 0, 1, 2)))) for _ in range(2500)] + [("one", 7.0)] + [("two", 1.0), ("two", 2.0)]
    rows += [("steps", float(rng.randrange(40))) for _ in range(1111)] + [("none", None)] * 3 + [(None, float(k)) for k in range(900)] + [("spread", None)] * 50 + [("same", 3.0)] * 1000
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in with_quantiles(df, {"g": F.col("g")}, {f"q{k}": (F.col("v"), q) for k, q in enumerate(QS)}, F.count("*").alias("n"), F.max("v").alias("top")).collect()}
    assert len(got) == 8
    for g, r in got.items():
        own = [v for k, v in rows if k == g]
        held = [v for v in own if v is not None]
        assert r.n == len(own) and r.top == max(held, default=None)
        for k, q in enumerate(QS):
            assert (r[f"q{k}"] is None) == (not held)
            if held:
                assert r[f"q{k}"] == pytest.approx(float(np.quantile(held, q)), abs=1e-12), (g, q)


def test_several_values_keys_and_odd_numbers(spark):
    rows = [(k % 2, k % 3, float(k), -float(k) if k % 4 else None) for k in range(600)] + [(0, 0, math.nan, math.inf), (1, 2, -math.inf, 0.0)]
    df = spark.createDataFrame(rows, "a int, b int, v double, w double")
    got = with_quantiles(df, {"a": F.col("a"), "c": F.col("b") + 1}, {"mv": (F.col("v"), 0.5), "mw": (F.col("w"), 0.25), "hi": (F.col("v"), 1.0)}, accuracy=10).collect()
    assert len(got) == 6
    for r in got:
        v, w = ([x[k] for x in rows if (x[0], x[1] + 1) == (r.a, r.c) and x[k] is not None] for k in (2, 3))
        order = sorted(v, key=lambda x: (math.isnan(x), x))
        h = (len(v) - 1) / 2
        assert r.mv == pytest.approx((order[math.floor(h)] + order[math.ceil(h)]) / 2)
        assert r.mw == pytest.approx(float(np.quantile(w, 0.25)))
        assert math.isnan(r.hi) if any(map(math.isnan, v)) else r.hi == max(v)


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert with_quantiles(df, {"g": F.col("g")}, {"m": (F.col("v"), 0.5)}).count() == 0


def test_comparisons_keep_no_group_in_one_buffer(spark, sf_dir):
    """No exact percentile in the plans, and one scan a pass."""
    from quotewell.operators import compare, explore

    w = trial(spark, sf_dir)
    for f in (compare.cmp_level_by_year, compare.cmp_disagreement_causes, compare.cmp_volume_mismatch_shape, explore.level_metrics):
        plan = f(w)._jdf.queryExecution().toString()
        assert "percentile(" not in plan and "median(" not in plan and "percentile_approx(" in plan
