"""The crop's closed form against a search over all lengths; wide images cost no more than narrow ones."""

import math

from pyspark.sql import functions as F

from capturelake.functions import expressions as X


def searched(length, center, share, tolerance):
    for n in range(length, math.ceil(length * share) - 1, -1):
        origin = max(math.ceil(center - n / 2 - tolerance), 0)
        if abs(center - origin - n / 2) <= tolerance and origin + n <= length:
            return n, origin
    return None


def test_closed_form_equals_search(spark):
    rows = [(n, c / 8) for n in (1, 2, 3, 7, 8, 64, 65, 101) for c in range(-8, 8 * n + 9)] + [(n, n * f) for n in (99, 100, 1001) for f in (0.41, 1 / 3, 0.5, 0.55, 0.623)]
    d = spark.createDataFrame(rows, "n int, c double")
    for share in (0.0, 0.5, 0.75):
        for tolerance in (0.0, 0.1, 0.3, 0.5, 0.8, 1.5):
            got = [(r.p.length, r.p.origin) if r.p else None for r in d.select(X.centered_crop(F.col("n"), F.col("c"), share, tolerance).alias("p")).collect()]
            assert got == [searched(n, c, share, tolerance) for n, c in rows], (share, tolerance)


def test_wide_images(spark):
    """A billion pixels: a list of all lengths would not fit; null, NaN and infinite middles give none."""
    d = spark.createDataFrame([(10**9, 5e8), (10**9, None), (10**9, float("nan")), (10**9, float("inf")), (10**9, float("-inf")), (10**9, 1e300)], "n int, c double")
    assert [tuple(r.p) if r.p else None for r in d.select(X.centered_crop(F.col("n"), F.col("c")).alias("p")).collect()] == [(10**9, 0), None, None, None, None, None]
