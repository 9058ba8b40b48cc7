"""Calibration of one scale to another: moments, quantile maps, stretches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import percentiles


def line(x: Column, y: Column) -> list[Column]:
    """Aggregates slope and intercept of y on x by least squares."""
    return [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")]


def origin_slope(x: Column, y: Column, ridge: float = 1e-6) -> Column:
    """Aggregate: the slope through the origin, rows with x = 0 left out."""
    return F.sum(F.when(x != 0, x * y)) / (F.sum(F.when(x != 0, x * x)) + ridge)


def parabola(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Per key: b0, b1, b2 of y = b0 + b1 (x - m) + b2 (x - m)^2 and x_mean m, from centred moments in two aggregates.

    Keys are those of fitted curves, so few; their means are broadcast, as a key may hold most of the rows."""
    means = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(F.avg(x).alias("x_mean"))
    d = F.col(x) - F.col("x_mean")
    sums = df.join(F.broadcast(means), list(by)).groupBy(*by).agg(
        F.first("x_mean").alias("x_mean"), F.count(d * F.col(y)).alias("n"), *[F.sum(F.when(F.col(y).isNotNull(), d**k)).alias(f"s{k}") for k in (1, 2, 3, 4)],
        F.sum(F.col(y)).alias("t0"), F.sum(d * F.col(y)).alias("t1"), F.sum(d**2 * F.col(y)).alias("t2"),
    )
    n, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("n", "s2", "s3", "s4", "t0", "t1", "t2"))  # s1 is zero about the mean
    determinant = F.nullif(s2 * s4 - s3 * s3 - s2 * s2 * s2 / n, F.lit(0.0))
    b2 = (s2 * t2 - s3 * t1 - s2 * s2 * t0 / n) / determinant
    b1 = (t1 - s3 * b2) / F.nullif(s2, F.lit(0.0))
    return sums.select(*by, "n", "x_mean", ((t0 - s2 * b2) / n).alias("b0"), b1.alias("b1"), b2.alias("b2"))


def rescaled(df: DataFrame, by: Sequence[str], x: str, y: str, name: str) -> DataFrame:
    """(x - mean x) * slope + mean y by key, slope that of y on x. The fits of the keys are broadcast."""
    fit = df.groupBy(*by).agg(F.regr_slope(y, x).alias("_s"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
    return df.join(F.broadcast(fit), list(by)).withColumn(name, (F.col(x) - F.col("_mx")) * F.col("_s") + F.col("_my")).drop("_s", "_mx", "_my")


def robust_scale(x: Column, median: Column, q1: Column, q3: Column, centre: float, spread: float, low: float = 0.3, high: float = 2.0) -> Column:
    """Median to centre and interquartile range / 1.349 to spread, the factor kept within bounds."""
    factor = F.least(F.greatest(F.lit(spread) / F.nullif((q3 - q1) / 1.349, F.lit(0.0)), F.lit(low)), F.lit(high))
    return centre + (x - median) * factor


def knots(df: DataFrame, x: str, y: str, shares: Sequence[float], apart: float = 1e-3) -> list[tuple[float, float]]:
    """Matching exact percentiles of two columns, those of x at least `apart`; one row for each column reaches the driver."""
    xs, ys = (row["percentiles"] if (row := percentiles(df, [], c, shares).first()) else [] for c in (x, y))
    out: list[tuple[float, float]] = []
    for a, b in zip(xs, ys, strict=False):  # a column without values gives no knots
        if not out or a - out[-1][0] > apart:
            out.append((a, b))
    return out


def monotone_cubic(points: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Pieces (start, c0, c1, c2, c3) of the shape-preserving cubic through points: harmonic slopes inside, one-sided ones at the ends."""
    if len(points) < 2:
        return [(float("-inf"), points[0][1] if points else 0.0, 0.0, 0.0, 0.0)]
    h = [b[0] - a[0] for a, b in zip(points, points[1:], strict=False)]
    d = [(b[1] - a[1]) / step for a, b, step in zip(points, points[1:], h, strict=False)]

    def end(h0: float, h1: float, d0: float, d1: float) -> float:
        slope = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
        if slope * d0 <= 0:
            return 0.0
        return 3 * d0 if d0 * d1 < 0 and abs(slope) > 3 * abs(d0) else slope

    if len(h) == 1:
        slopes = [d[0], d[0]]
    else:
        inner = []
        for i in range(1, len(h)):
            a, b = 2 * h[i] + h[i - 1], h[i] + 2 * h[i - 1]
            inner.append(0.0 if d[i - 1] * d[i] <= 0 else (a + b) / (a / d[i - 1] + b / d[i]))
        slopes = [end(h[0], h[1], d[0], d[1]), *inner, end(h[-1], h[-2], d[-1], d[-2])]
    return [
        (p[0], p[1], slopes[i], (3 * d[i] - 2 * slopes[i] - slopes[i + 1]) / h[i], (slopes[i] + slopes[i + 1] - 2 * d[i]) / h[i] ** 2)
        for i, p in enumerate(points[:-1])
    ]


def piecewise(x: Column, pieces: Sequence[tuple[float, float, float, float, float]]) -> Column:
    """The pieces at x; the first and last ones reach beyond the ends."""
    out, following = None, None
    for start, c0, c1, c2, c3 in reversed(pieces):
        d = x if start == float("-inf") else x - start
        value = ((F.lit(c3) * d + c2) * d + c1) * d + c0
        out = value if out is None else F.when(x < following, value).otherwise(out)
        following = start
    return F.when(x.isNotNull(), out)


def stretched(x: Column, threshold: Column | float, share: Column | float) -> Column:
    """x, with what lies above a threshold enlarged by a share."""
    threshold, share = (v if isinstance(v, Column) else F.lit(v) for v in (threshold, share))
    return F.when(x > threshold, threshold + (1 + share) * (x - threshold)).otherwise(x)
