"""Lag-safe windows: every frame here ends before the current row, so no metric sees its own outcome."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Keys = Sequence[str | Column]


def ordered(by: Keys, order: Keys) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def prior(by: Keys, order: Keys, last: int | None = None) -> WindowSpec:
    """All earlier rows of a key, or its last few."""
    return ordered(by, order).rowsBetween(Window.unboundedPreceding if last is None else -last, -1)


def prior_count(by: Keys, order: Keys) -> Column:
    return (F.row_number().over(ordered(by, order)) - 1).cast("long")


def prior_mean(x: Column, by: Keys, order: Keys, last: int | None = None, least: int = 1) -> Column:
    """Mean of earlier values, nulls skipped; null where there are fewer than `least`."""
    w = prior(by, order, last)
    return F.when(F.count(x).over(w) >= least, F.avg(x).over(w))


def prior_std(x: Column, by: Keys, order: Keys, last: int | None = None, least: int = 2) -> Column:
    w = prior(by, order, last)
    return F.when(F.count(x).over(w) >= least, F.stddev_samp(x).over(w))


def harmonic(x: Column, by: Keys, order: Keys, last: int) -> Column:
    """Sum of x_i / i over the last rows, i = 1 the latest; null on a key's first row."""
    w = ordered(by, order)
    terms = [F.coalesce(F.lag(x, i).over(w) / i, F.lit(0.0)) for i in range(1, last + 1)]
    return F.when(F.lag(F.lit(1), 1).over(w).isNotNull(), sum(terms[1:], terms[0]))


def harmonic_mean(x: Column, by: Keys, order: Keys, last: int) -> Column:
    """Mean of the last values with weights 1 / i, i = 1 the latest; missing values drop out of both sums."""
    w = ordered(by, order)
    lags = [F.lag(x, i).over(w) for i in range(1, last + 1)]
    top = [F.coalesce(v / i, F.lit(0.0)) for i, v in enumerate(lags, 1)]
    weight = [F.when(v.isNotNull(), F.lit(1 / i)).otherwise(0.0) for i, v in enumerate(lags, 1)]
    return F.try_divide(sum(top[1:], top[0]), F.nullif(sum(weight[1:], weight[0]), F.lit(0.0)))


def gaps_between(day: Column, by: Keys, order: Keys) -> tuple[Column, Column, Column]:
    """Days since the last run; the changes of the days to the last four, weighted 1, 0.5 and 0.33; and their sum by the number of the last three runs."""
    w = ordered(by, order)
    d = [F.date_diff(day, F.lag(day, i).over(w)) for i in (1, 2, 3, 4)]
    steps = [F.coalesce(weight * (b - a), F.lit(0.0)) for weight, a, b in zip((1.0, 0.5, 0.33), d, d[1:], strict=False)]
    trend = sum(steps[1:], steps[0])
    seen = sum([x.isNotNull().cast("int") for x in d[1:3]], d[0].isNotNull().cast("int"))
    return d[0], trend, F.try_divide(trend, F.nullif(seen, F.lit(0)))


# Scores of first, second and third places.
PLACE_SCORES = {1: 17.41, 2: 14.77, 3: 12.62}


def place_score(place: Column) -> Column:
    out = None
    for at, score in PLACE_SCORES.items():
        out = F.when(place == at, score) if out is None else out.when(place == at, score)
    return out.otherwise(0.0)


def decayed(x: Column, by: Keys, order: Keys, last: int, alpha: float) -> Column:
    """Weighted mean of the last values, weights alpha^0, alpha^1, ..., the latest first; missing values drop out of both sums."""
    w = ordered(by, order)
    lags = [F.lag(x, i).over(w) for i in range(1, last + 1)]
    top = [F.coalesce(v * alpha**i, F.lit(0.0)) for i, v in enumerate(lags)]
    weight = [F.when(v.isNotNull(), F.lit(alpha**i)).otherwise(0.0) for i, v in enumerate(lags)]
    return F.try_divide(sum(top[1:], top[0]), F.nullif(sum(weight[1:], weight[0]), F.lit(0.0)))


def distance_to_last(x: Column, by: Keys, order: Keys, last: int) -> Column:
    """Root mean square difference between the value and the last ones, by moments of the prior frame."""
    w = prior(by, order, last)
    value = x.cast("double")
    return F.sqrt(F.greatest(F.avg(value * value).over(w) - 2 * value * F.avg(value).over(w) + value * value, F.lit(0.0)))


def slope_of_last(x: Column, by: Keys, order: Keys, last: int) -> Column:
    """Least-squares slope over the last values against 0 (latest), 1, ...; missing values are skipped in the numerator alone."""
    w = ordered(by, order)
    middle = (last - 1) / 2
    terms = [F.coalesce(F.lag(x, i + 1).over(w) * (i - middle), F.lit(0.0)) for i in range(last)]
    seen = F.lag(x, 1).over(w).isNotNull()
    return F.when(seen, sum(terms[1:], terms[0]) / sum((i - middle) ** 2 for i in range(last)))


def last_value_when(x: Column, condition: Column, by: Keys, order: Keys) -> Column:
    """The latest earlier value for which a condition held."""
    return F.last(F.when(condition, x), ignorenulls=True).over(prior(by, order))


def recent(x: Column, by: Keys, day: Column, order: Keys, days: int) -> Column:
    """Sum over the earlier days within a span and over the earlier rows of the same day; null if nothing is there.

    day counts days. The first frame ranges over day numbers, the second over the rows of a key's day."""
    before = Window.partitionBy(*by).orderBy(day).rangeBetween(-(days - 1), -1)
    same = Window.partitionBy(*by, day).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.nullif(F.coalesce(F.sum(x).over(before), F.lit(0)) + F.coalesce(F.sum(x).over(same), F.lit(0)), F.lit(0))


def rank_desc(x: Column, by: Keys) -> Column:
    """Competition rank from the highest value, nulls last."""
    return F.rank().over(Window.partitionBy(*by).orderBy(x.desc_nulls_last())).cast("long")


def average_rank(x: Column, by: Keys) -> Column:
    """Rank from the lowest value with ties averaged."""
    return F.rank().over(Window.partitionBy(*by).orderBy(x)) + (F.count(F.lit(1)).over(Window.partitionBy(*by, x)) - 1) / 2


class Earlier:
    """Sums over a key's earlier rows, and over those of its last days; 0 where there are none. day: the column of the day."""

    def __init__(self, by: Sequence[str], order: Sequence[str], day: str):
        self.by, self.order, self.day = list(by), list(order), day

    def sum(self, c: str) -> Column:
        return F.coalesce(F.sum(c).over(prior(self.by, self.order)), F.lit(0.0))

    def count(self, c: str | None = None) -> Column:
        """Rows, or those with a value."""
        return F.count(F.lit(1) if c is None else c).over(prior(self.by, self.order))

    def mean(self, c: str) -> Column:
        return self.sum(c) / F.nullif(self.count(c), F.lit(0))

    def recent(self, c: str | None, days: int) -> Column:
        """The sum (without a column: the rows) within the last days, earlier rows of the day included."""
        return F.coalesce(recent(F.lit(1) if c is None else F.col(c), self.by, F.unix_date(self.day), self.order, days), F.lit(0))


class BySegment(Earlier):
    """The same from segments of the order: what earlier segments sum to comes from small tables, the rest from a window within the segment.

    Rows have a row id that ascends in the order, by monotonically_increasing_id() over sorted partitions; a partition is a segment. bundle.segmented() joins the tables."""

    ROW = "_row"

    def __init__(self, by: Sequence[str], day: str):
        super().__init__(by, [self.ROW], day)
        self.terms: dict[str, Column] = {}
        self.spans: set[int] = set()
        self.name = "_".join(["_before", *self.by])

    @classmethod
    def segment(cls) -> Column:
        return F.shiftright(cls.ROW, 33)  # the partition, by the form of these ids

    def _taken(self, term: str, total: Column) -> Column:
        self.terms[term] = total
        within = prior(["_segment", *self.by], self.order)
        return F.coalesce(F.col(f"{self.name}.{term}"), F.lit(0)) + F.coalesce(total.over(within), F.lit(0))

    def sum(self, c: str) -> Column:
        return self._taken(f"s_{c}", F.sum(c)).cast("double")

    def count(self, c: str | None = None) -> Column:
        return self._taken(f"n_{c}" if c else "n", F.count(F.lit(1) if c is None else c))

    def recent(self, c: str | None, days: int) -> Column:
        self.spans.add(days)
        return (self.count() if c is None else self.sum(c)) - F.coalesce(F.col(f"{self.name}_{days}.{f's_{c}' if c else 'n'}"), F.lit(0))

    def tables(self, rows: DataFrame, used: Collection[str]) -> dict[str, DataFrame]:
        """By name, those that hold used sums (name.sum): each segment's and key's sums over earlier segments, and each day's and key's sums over the days before a span. rows have _segment."""
        known = rows.where(" and ".join(f"{k} is not null" for k in self.by)) if self.by else rows

        parts = Window.partitionBy(*self.by)
        until = {self.name: ("_segment", parts.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1))}
        for days in self.spans:
            until[f"{self.name}_{days}"] = self.day, parts.orderBy(F.unix_date(self.day)).rangeBetween(Window.unboundedPreceding, -days)
        out = {}
        for name, (at, earlier) in until.items():
            if terms := [t for t in self.terms if f"{name}.{t}" in used]:
                sums = known.groupBy(at, *self.by).agg(*[self.terms[t].alias(t) for t in terms])
                out[name] = sums.select(at, *self.by, F.struct(*[F.sum(t).over(earlier).alias(t) for t in terms]).alias(name))
        return out
