"""Percentiles by refinement equal Spark's own, with groups far above the size that is held."""

import math
import random

import pytest
from pyspark.sql import functions as F

from capturelake.operators import quantiles


@pytest.mark.parametrize("most", [60, 50_000])
def test_same_as_percentile(spark, monkeypatch, most):
    monkeypatch.setattr(quantiles, "MOST", most)
    monkeypatch.setattr(quantiles, "BINS", 16)
    rng = random.Random(8)
    rows = []
    for key, make in {
        "even": lambda: rng.uniform(-1, 1), "steps": lambda: float(rng.randint(0, 3)), "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300), "one": lambda: 0.1, "close": lambda: 1 + rng.randint(0, 400) * 2.0**-52, "odd": lambda: rng.choice([math.nan, math.inf, -math.inf, 0.0, -0.0, 1.5, None]),
        None: lambda: rng.gauss(0, 1),
    }.items():
        rows += [(key, make(), rng.random()) for _ in range(700)]
    rows += [("few", float(i), None) for i in range(7)] + [("none", None, None)] * 3
    d = spark.createDataFrame(rows, "k string, v double, u double").repartition(5)
    measures = {"q0": (F.col("v"), 0.0), "q10": (F.col("v"), 0.1), "q50": (F.col("v"), 0.5), "q995": (F.col("v"), 0.995), "top": (F.col("v"), 1.0), "u50": (F.col("u") * 2, 0.5)}
    got = {r.k: r for r in quantiles.exact_percentiles(d, ["k"], measures).collect()}
    want = {r.k: r for r in d.groupBy("k").agg(*[F.percentile(c, F.lit(q)).alias(n) for n, (c, q) in measures.items()]).collect()}
    assert got.keys() == want.keys() and len(want) == 9
    for k, w in want.items():
        for n in measures:
            a, b = getattr(got[k], n), getattr(w, n)
            assert a == b or (a != a and b != b), (k, n, a, b)
    assert quantiles.exact_percentiles(d.limit(0), ["k"], measures).count() == 0
