"""Exact quantiles by distributed selection against numpy."""

import math
import random

import numpy as np
import pytest

from cellspark.operators import aggregates as AG
from cellspark.operators.quantiles import quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def _values(kind, rng, n):
    if kind == "counts":
        return [float(rng.randint(0, 5)) for _ in range(n)]
    if kind == "wide":  # many magnitudes: equal bins narrow it slowly
        return [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-200, 300) for _ in range(n)]
    return [rng.gauss(0, 1) for _ in range(n)]


@pytest.mark.parametrize("kind", ["counts", "normal", "wide"])
def test_groups_equal_numpy(spark, kind):
    rng = random.Random(kind)
    data = {g: _values(kind, rng, n) for g, n in (("a", 1), ("b", 2), ("hot", 3000), (None, 100))}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), ("b", float("nan")), ("empty", None)]
    got = {r.g: (r.n, r.q) for r in quantiles(spark.createDataFrame(rows, "g string, v double").repartition(4), "v", PROBS, ["g"]).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        assert got[g][0] == len(vs)
        assert got[g][1] == pytest.approx(np.quantile(np.array(vs), PROBS).tolist(), rel=1e-12, abs=1e-300)


def test_without_groups_and_infinite_values(spark):
    vs = [math.inf, -math.inf, math.inf, 0.0, 1.5, -2.0, 1.7e308, -1.7e308]
    row = quantiles(spark.createDataFrame([(v,) for v in vs], "v double"), "v", [0.0, 0.5, 1.0]).collect()
    assert [(r.n, r.q) for r in row] == [(8, [-math.inf, 0.75, math.inf])]
    assert quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).collect() == []


def test_plans_hold_no_percentile(spark, capsys):
    df = spark.createDataFrame([("x", float(i)) for i in range(20)] + [("y", None)], "g string, v double")
    box = AG.box_stats(df, "v", "g")
    described = AG.describe_metrics(df, ["v"])
    for out in (box, described):
        out.explain("formatted")
        plan = capsys.readouterr().out.lower()
        assert "percentile" not in plan and "median(" not in plan
    assert {r.g: (r.n, r.min, r.q1, r.median, r.q3, r.max) for r in box.collect()} == {"x": (20, 0.0, 4.75, 9.5, 14.25, 19.0), "y": (0, None, None, None, None, None)}
    assert described.first()["median"] == 9.5
