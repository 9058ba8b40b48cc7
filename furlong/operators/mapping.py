"""Maps of one scale onto another, fitted on bounded summaries, and how they compare on rows held out.

A fit reads the training rows a fixed number of times, whatever their number: exact percentiles, sums by bin, counts by grid cell. What
reaches the driver is some hundred numbers for each group; from them each method makes a curve of cubic pieces, and all curves are applied
to the rows in one pass. Groups (surfaces) are fitted apart; groups with fewer than `least` training rows keep their values.

Rows without x stay unmapped; rows without y are not trained or tested on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import written
from .calibrate import monotone_cubic
from .ranks import percentiles


@dataclass(frozen=True)
class Curve:
    """Cubic pieces from ascending starts; clip: the ends hold beyond the ends, else the end pieces go on."""

    starts: np.ndarray
    parts: np.ndarray  # a row for each piece: constant, linear, square, cube
    end: float
    clip: bool = False

    def __call__(self, x: np.ndarray) -> np.ndarray:
        held = np.clip(x, self.starts[0], self.end) if self.clip and np.isfinite(self.starts[0]) else x
        at = np.maximum(np.searchsorted(self.starts, held, "right") - 1, 0)
        d = held - np.where(np.isfinite(self.starts[at]), self.starts[at], 0.0)
        c = self.parts[at]
        return ((c[:, 3] * d + c[:, 2]) * d + c[:, 1]) * d + c[:, 0]


def through(points: Sequence[tuple[float, float]], clip: bool = False, linear: bool = False) -> Curve:
    """The curve through points with ascending x: shape-preserving cubics, or straight lines."""
    points = [(float(a), float(b)) for a, b in points]
    if linear and len(points) > 1:
        pieces = [(a, y, (z - y) / (b - a), 0.0, 0.0) for (a, y), (b, z) in zip(points, points[1:], strict=False)]
    else:
        pieces = monotone_cubic(points)
    table = np.array(pieces)
    return Curve(table[:, 0], table[:, 1:], points[-1][0] if points else 0.0, clip)


def apart(xs: Sequence[float], ys: Sequence[float], least: float = 1e-3) -> list[tuple[float, float]]:
    """Points whose x is at least some distance from the point before."""
    out: list[tuple[float, float]] = []
    for a, b in zip(xs, ys, strict=True):
        if not out or a - out[-1][0] > least:
            out.append((a, b))
    return out


def isotonic(means: Sequence[float], weights: Sequence[float]) -> list[float]:
    """The ascending sequence nearest to means in weighted squares: neighbours that descend are pooled, over and over."""
    pools: list[list[float]] = []
    for mean, weight in zip(means, weights, strict=True):
        pools.append([mean, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            weight = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / weight, weight, a[2] + b[2]])
    return [mean for mean, _, n in pools for _ in range(int(n))]


def smoothing_spline(xs: Sequence[float], ys: Sequence[float], allowed: float) -> Curve:
    """The natural cubic spline of least curvature whose squared distances from the points sum to `allowed` at most; straight lines go on beyond the ends."""
    x, y = np.asarray(xs, float), np.asarray(ys, float)
    if len(x) < 3:
        return through(list(zip(x, y, strict=True)), linear=True)
    h = np.diff(x)
    n = len(x) - 2
    q, r = np.zeros((len(x), n)), np.zeros((n, n))
    for j in range(n):
        q[j : j + 3, j] = 1 / h[j], -1 / h[j] - 1 / h[j + 1], 1 / h[j + 1]
        r[j, j] = (h[j] + h[j + 1]) / 3
        if j:
            r[j, j - 1] = r[j - 1, j] = h[j] / 6
    target, cross = q.T @ y, q.T @ q

    def fit(penalty: float) -> tuple[np.ndarray, np.ndarray]:
        curvature = np.linalg.solve(r + penalty * cross, target)
        return y - penalty * (q @ curvature), curvature

    low, high = -30.0, 40.0  # of the penalty's natural logarithm; distances grow with it
    if ((fit(math.exp(high))[0] - y) ** 2).sum() <= allowed:
        low = high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if ((fit(math.exp(middle))[0] - y) ** 2).sum() <= allowed else (low, middle)
    at, curvature = fit(math.exp(low))
    g = np.concatenate([[0], curvature, [0]])
    slope = np.diff(at) / h - h * (2 * g[:-1] + g[1:]) / 6
    parts = np.stack([at[:-1], slope, g[:-1] / 2, np.diff(g) / (6 * h)], 1)
    last = slope[-1] + h[-1] * (g[-2] + g[-1]) / 2
    ends = np.array([[at[0], slope[0], 0, 0], [at[-1], last, 0, 0]])
    first = np.array([[at[0] - slope[0] * 1e6, slope[0], 0, 0]])
    return Curve(np.concatenate([[x[0] - 1e6], x[:-1], x[-1:]]), np.concatenate([first, parts, ends[1:]]), float("inf"))


def smoothed_cdf(counts: np.ndarray, step: float, spread: float) -> np.ndarray:
    """The running share of counts on a grid after each count is spread by a normal kernel of that deviation."""
    reach = max(1, min(len(counts), int(5 * spread / step) + 1))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) * step / spread) ** 2) if spread > 0 else np.ones(1)
    total = np.cumsum(np.convolve(counts, kernel, "full")[len(kernel) // 2 :][: len(counts)])
    return total / total[-1]


# Quantile grids, as shares.


def even_grid(n: int) -> list[float]:
    return [i / n for i in range(n + 1)]


def banded_grid(*bands: tuple[float, float, float]) -> list[float]:
    """Shares by (from, to, step) in per cent, the last band with its end."""
    out = [low + i * step for low, high, step in bands for i in range(round((high - low) / step))]
    return [v / 100 for v in [*out, bands[-1][1]]]


def beta_share(x: float, a: float) -> float:
    """The distribution function of the symmetric beta law, by its power series on the lower half."""
    if x > 0.5:
        return 1 - beta_share(1 - x, a)
    term, total = 1.0, 1.0 / a
    for n in range(1, 200):
        term *= (n - a) / n * x
        total += term / (a + n)
    return x**a * total * math.gamma(2 * a) / math.gamma(a) ** 2


def beta_grid(n: int, a: float) -> list[float]:
    """n shares and both ends, denser toward the ends the smaller a is."""
    return [0.0, *[beta_share(i / (n + 1), a) for i in range(1, n + 1)], 1.0]


# The banded grids that are compared, in per cent.
TAILS = ((0, 5, 0.25), (5, 95, 2), (95, 100, 0.25))
FAR_TAILS = ((0, 2, 0.1), (2, 10, 0.5), (10, 90, 2), (90, 98, 0.5), (98, 100, 0.1))
CELLS, BINS, BIAS_BINS, BIAS_LEAST = 2000, 100, 20, 50


@dataclass
class Summary:
    """What the training rows of a group come to."""

    n: int
    mean: tuple[float, float]  # of x, of y
    spread: tuple[float, float]  # population deviations
    x_at: dict[float, float]  # share -> percentile
    y_at: dict[float, float]
    bins: dict[int, np.ndarray]  # number of bins -> rows of n, mean x, mean y
    grid: np.ndarray  # middles of the cells
    cells: tuple[np.ndarray, np.ndarray]  # counts of x, of y

    def knots(self, shares: Sequence[float]) -> list[tuple[float, float]]:
        return apart([self.x_at[s] for s in shares], [self.y_at[s] for s in shares])


Mapper = Callable[[np.ndarray], np.ndarray]


def tanh_stretch(s: Summary, k: float = 1.5) -> Mapper:
    """Means and deviations matched, the more so the farther from the mean."""

    def mapped(x: np.ndarray) -> np.ndarray:
        d = x - s.mean[0]
        ratio = s.spread[1] / s.spread[0] if s.spread[0] else 1.0
        return s.mean[1] + d * (1 + (ratio - 1) * np.tanh(np.abs(d) / (s.spread[0] or 1.0) * k))

    return mapped


def pooled(s: Summary) -> list[tuple[float, float]]:
    n, x, y = s.bins[BINS].T
    return apart(x, isotonic(y, n), 0.0)


def isotonic_smoothed(s: Summary, share: float = 0.01, points: int = 200) -> Mapper:
    curve = through(pooled(s), clip=True, linear=True)
    xs = np.linspace(s.x_at[0.0] - 10, s.x_at[1.0] + 10, points)
    return smoothing_spline(xs, curve(xs), share * points)


def quantile_spline(s: Summary, share: float = 0.005) -> Mapper:
    points = s.knots(even_grid(100))
    return smoothing_spline(*zip(*points, strict=True), share * len(points))


def bias_corrected(s: Summary) -> Mapper:
    """x less the curve of its mean error by bin."""
    rows = s.bins[BIAS_BINS]
    rows = rows[rows[:, 0] >= BIAS_LEAST]
    curve = through(apart(rows[:, 1], rows[:, 1] - rows[:, 2], 0.0)) if len(rows) else (lambda x: 0.0 * x)
    return lambda x: x - curve(x)


def cdf_transfer(s: Summary, width: float) -> Mapper:
    """The value of y at the smoothed share of x, both on one grid."""
    step = s.grid[1] - s.grid[0]
    px, py = (smoothed_cdf(c, step, width * d) for c, d in zip(s.cells, s.spread, strict=True))
    rising = np.flatnonzero(np.diff(py, prepend=-1.0) > 1e-12)
    share, back = through(list(zip(s.grid, px, strict=True)), linear=True, clip=True), through(list(zip(py[rising], s.grid[rising], strict=True)), linear=True, clip=True)
    return lambda x: back(np.clip(share(x), 0.0001, 0.9999))


def quantile_curve(shares: Sequence[float]) -> Callable[[Summary], Mapper]:
    return lambda s: through(s.knots(shares))


#: The methods by name.
METHODS: dict[str, Callable[[Summary], Mapper]] = {
    "none": lambda s: lambda x: x,
    "tanh_stretch": tanh_stretch,
    **{f"pchip_{n}": quantile_curve(even_grid(n)) for n in (20, 50, 100)},
    "pchip_tails": quantile_curve(banded_grid(*TAILS)),
    "pchip_far_tails": quantile_curve(banded_grid(*FAR_TAILS)),
    **{f"pchip_beta_{a}": quantile_curve(beta_grid(100, a)) for a in (0.3, 0.5, 0.7)},
    "isotonic": lambda s: through(pooled(s), clip=True, linear=True),
    "isotonic_smoothed": isotonic_smoothed,
    "quantile_spline": quantile_spline,
    "bias_corrected": bias_corrected,
    **{f"cdf_transfer_{w}": (lambda s, w=w: cdf_transfer(s, w)) for w in (0.2, 0.3, 0.5)},
}
SHARES = sorted({*even_grid(20), *even_grid(50), *even_grid(100), *banded_grid(*TAILS), *banded_grid(*FAR_TAILS), *[s for a in (0.3, 0.5, 0.7) for s in beta_grid(100, a)]})
#: Methods whose tails are corrected as well: (base, lower and upper share from where, the outermost shares, factor).
CORRECTED = {"cdf_transfer_0.3_tails": ("cdf_transfer_0.3", 0.05, 0.01, 1.0), "pchip_50_tails": ("pchip_50", 0.1, 0.01, 0.5)}


def summaries(train: DataFrame, by: str, x: str, y: str, least: int) -> dict[object, Summary]:
    """A summary for each group with enough rows. Four passes; groups must be few, as each has some hundred numbers here."""
    moments = {r[by]: r for r in train.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{name}{i}") for i, c in enumerate((x, y)) for name, f in (("mean", F.avg), ("spread", F.stddev_pop))]).collect()}
    at = [{r[by]: dict(zip(SHARES, r["percentiles"], strict=True)) for r in percentiles(train, [by], c, SHARES).collect()} for c in (x, y)]
    kept = [g for g, r in moments.items() if r["n"] >= least]
    edges = {(g, n): np.unique([at[0][g][s] for s in even_grid(n)])[1:-1] for g in kept for n in (BINS, BIAS_BINS)}
    grids = {g: (min(at[0][g][0.0], at[1][g][0.0]) - 20, max(at[0][g][1.0], at[1][g][1.0]) + 20) for g in kept}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            frame.columns = ["g", "x", "y"]
            rows = []
            for g, part in frame.groupby("g", dropna=False):
                g = None if pd.isna(g) else g
                if g not in grids:
                    continue
                a, b = part["x"].to_numpy(), part["y"].to_numpy()
                low, high = grids[g]
                for kind, v in (("x", a), ("y", b)):
                    cell, n = np.unique(np.clip(np.rint((v - low) / (high - low) * (CELLS - 1)), 0, CELLS - 1).astype(int), return_counts=True)
                    rows += [(g, kind, int(c), int(k), 0.0, 0.0) for c, k in zip(cell, n, strict=True)]
                for n_bins in (BINS, BIAS_BINS):
                    at_bin = np.searchsorted(edges[g, n_bins], a, "right")
                    for c in np.unique(at_bin):
                        some = at_bin == c
                        rows.append((g, str(n_bins), int(c), int(some.sum()), float(a[some].sum()), float(b[some].sum())))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (batch.schema.field(0).type, pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["g", "kind", "cell", "n", "sx", "sy"])

    kind_of = train.schema[by].dataType.simpleString()
    found = train.select(by, F.col(x).cast("double"), F.col(y).cast("double")).mapInArrow(sums, f"g {kind_of}, kind string, cell int, n bigint, sx double, sy double")
    cells: dict[tuple, list] = {}
    for r in found.groupBy("g", "kind", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy")]).orderBy("cell").collect():
        cells.setdefault((r["g"], r["kind"]), []).append((r["cell"], r["n"], r["sx"], r["sy"]))

    def counted(g: object, kind: str) -> np.ndarray:
        out = np.zeros(CELLS)
        for c, n, *_ in cells[g, kind]:
            out[c] = n
        return out

    binned = lambda g, n: np.array([(k, sx / k, sy / k) for _, k, sx, sy in cells[g, str(n)]])
    return {
        g: Summary(moments[g]["n"], (moments[g]["mean0"], moments[g]["mean1"]), (moments[g]["spread0"], moments[g]["spread1"]), at[0][g], at[1][g], {n: binned(g, n) for n in (BINS, BIAS_BINS)}, np.linspace(*grids[g], CELLS), (counted(g, "x"), counted(g, "y")))
        for g in kept
    }


def mapped(df: DataFrame, by: str, x: str, maps: dict[object, dict[str, Mapper]], names: Sequence[str]) -> DataFrame:
    """df with a column for each map, in one pass; rows of groups without maps keep x. The maps, some hundred numbers each, go with the function."""

    @F.pandas_udf(", ".join(f"`{n}` double" for n in names))
    def all_maps(group: pd.Series, value: pd.Series) -> pd.DataFrame:
        v = value.to_numpy(float)
        out = {n: v.copy() for n in names}
        for g, curves in maps.items():
            at = (group.isna() if g is None else group == g).fillna(False).to_numpy(bool) & ~np.isnan(v)
            for n in names:
                out[n][at] = curves[n](v[at])
        return pd.DataFrame(out)

    return df.withColumn("_maps", all_maps(F.col(by), F.col(x).cast("double"))).select(*df.columns, *[F.nanvl(F.col("_maps").getField(n), F.lit(None).cast("double")).alias(n) for n in names])


def tail_corrected(base: Mapper, s: Summary, biases: tuple[float | None, float | None], start: float, outer: float, factor: float) -> Mapper:
    """A map less the mean error of each tail, which sets in at a share and is whole at the outermost one."""
    near = [at_share(s.x_at, q) for q in (start, 1 - start)]
    far = [at_share(s.x_at, q) for q in (outer, 1 - outer)]

    def out(x: np.ndarray) -> np.ndarray:
        y = base(x)
        for side, bias, a, b in zip((-1, 1), biases, near, far, strict=True):
            if bias is not None:
                y = y - bias * factor * np.clip(side * (x - a) / max(side * (b - a), 1), 0, 1)
        return y

    return out


def at_share(at: dict[float, float], q: float) -> float:
    return at[min(at, key=lambda s: abs(s - q))]


def fitted(train: DataFrame, by: str, x: str, y: str, least: int = 1000) -> dict[object, dict[str, Mapper]]:
    """Each method's map for each group; the tails of the corrected ones take one more pass over the training rows."""
    train = written(train.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(by, x, y), "mapping")
    known = summaries(train, by, x, y, least)
    maps = {g: {name: make(s) for name, make in METHODS.items()} for g, s in known.items()}
    bases = sorted({base for base, *_ in CORRECTED.values()})
    if known:
        border = {g: [at_share(s.x_at, q) for _, start, *_ in CORRECTED.values() for q in (start, 1 - start)] for g, s in known.items()}
        rows = mapped(train, by, x, maps, bases)
        pick = lambda i: F.coalesce(*[F.when(F.col(by).eqNullSafe(F.lit(g)), F.lit(float(b[i]))) for g, b in border.items()])  # noqa: E731  a literal for each group
        wants = []
        for k, (base, *_) in enumerate(CORRECTED.values()):
            error = F.col(f"`{base}`") - F.col(y)
            wants += [F.avg(F.when(F.col(x) <= pick(2 * k), error)).alias(f"low{k}"), F.avg(F.when(F.col(x) >= pick(2 * k + 1), error)).alias(f"high{k}")]
        for r in rows.groupBy(by).agg(*wants).collect():
            for k, (name, (base, start, outer, factor)) in enumerate(CORRECTED.items()):
                if r[by] in maps:
                    maps[r[by]][name] = tail_corrected(maps[r[by]][base], known[r[by]], (r[f"low{k}"], r[f"high{k}"]), start, outer, factor)
    return maps


def bake_off(df: DataFrame, by: str, x: str, y: str, train: Column, least: int = 1000) -> DataFrame:
    """method, n, mae, bias, rmse and corr of every map on the rows that were not trained on, best first by mean absolute error."""
    names = [*METHODS, *CORRECTED]
    maps = fitted(df.where(train), by, x, y, least)
    held = mapped(df.where(~F.coalesce(train, F.lit(False)) & F.col(x).isNotNull() & F.col(y).isNotNull()).select(by, x, y), by, x, maps, names)
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("method"), F.col(f"`{n}`").alias("v")) for n in names])).alias("m")
    error = F.col("m.v") - F.col(y)
    scores = held.select(each, F.col(y).cast("double").alias(y)).groupBy(F.col("m.method").alias("method"))
    return scores.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(error)).alias("mae"), F.avg(error).alias("bias"), F.sqrt(F.avg(error * error)).alias("rmse"), F.corr("m.v", y).alias("corr"))
