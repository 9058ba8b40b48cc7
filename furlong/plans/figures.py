"""The figure pipeline: standard times and going allowances estimated in turn, figures of all runners, calibration.

One set of functions serves both regions and both modes; Settings holds what differs. Every stage is a join, window or aggregate; the
lookups (standards, allowances, offsets) are tables with typed keys, never dictionaries on the driver.

Runner rows need: race_id, meeting_id, day, course, surface, distance, going, race_no, position, winner_time, beaten (lengths behind the
winner), weight, age, horse. Distances are in the unit of Settings. Null positions, times or distances leave a runner without a
figure; they never stop a job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import binned, clamp
from ..functions.text import attenuated, is_maiden
from ..operators import interpolate, robust, shrink
from ..operators.calibrate import parabola
from ..operators.metrics import errors
from ..sources.staging import written
from .scales import FRENCH_GOOD_GOING, FRENCH_SEEDS, GOING_SEEDS, GOOD_GOING, IRISH, METRES, NOT_FRENCH, SURFACE_CUTOFFS, going_group

SURFACE_FACTORS = {"Turf": 1.0, "All Weather": 1.10}


@dataclass(frozen=True)
class Settings:
    unit: float = 1.0  # units of distance in a furlong
    base: float = 100.0
    base_weight: float = 126.0
    second_per_length: float = 0.2
    pounds_per_second: float = 20.0  # at five furlongs
    class_per_furlong: float = -0.9
    least_races: int = 20
    least_thin: int = 10
    thin_k: float = 15.0
    least_card: int = 3
    z: float = 3.0
    k: float = 3.0
    boost_from: float = 0.30
    boost: float = 0.25
    tolerance: float = 0.005
    passes: int = 5
    half_life: float = 4.0
    trim: float = 0.0
    default_prior: float = 0.0  # of goings that the seeds lack
    thin_k_irish: float = 10.0
    k_irish: float = 1.5
    caps: tuple[float, float] | None = None  # allowances are kept between the outer percentiles, or these where they are wider
    eligibility: str | None = "code"  # "code": by race_code and oldest_age; "name": by race_name and the winners' ages; None: every race
    seeds: dict = field(default_factory=lambda: dict(GOING_SEEDS))
    good_going: tuple[str, ...] = GOOD_GOING
    surface_factors: dict = field(default_factory=lambda: dict(SURFACE_FACTORS))


UK = Settings()
FRANCE = Settings(
    unit=METRES, class_per_furlong=0.0, trim=0.05, passes=2, tolerance=0.0, thin_k=10.0, default_prior=0.05, caps=(-1.5, 2.5), eligibility="name", seeds=dict(FRENCH_SEEDS), good_going=FRENCH_GOOD_GOING
)
CONFIG = ["course", "surface", "distance"]


def winners(runners: DataFrame) -> DataFrame:
    """One row per race: the first by position, then horse; races without a time or distance are left out."""
    w = Window.partitionBy("race_id").orderBy("position", "horse")
    first = runners.where("position = 1 and winner_time > 0 and distance > 0").withColumn("_i", F.row_number().over(w))
    return first.where("_i = 1").drop("_i")


def eligible(races: DataFrame, code: str = "race_code", oldest: str = "oldest_age") -> DataFrame:
    """Races fit for standards: neither maidens by their code nor for two-year-olds alone; unknown values count as fit."""
    maiden = F.coalesce(F.col(code).startswith("P") | F.col(code).startswith("S"), F.lit(False))
    return races.where(~maiden & ~F.coalesce(F.col(oldest) == 2, F.lit(False)))


def flat_runners(runners: DataFrame) -> DataFrame:
    """Runners on surfaces that are still there: those before the day on which a course's artificial surface changed go."""
    out = runners
    for course, day in SURFACE_CUTOFFS.items():
        out = out.where(~F.coalesce((F.col("course") == course) & (F.col("day") < F.lit(day).cast("date")), F.lit(False)))
    return out


def valid_french(runners: DataFrame) -> DataFrame:
    """Runners with a position and a distance, at French courses, of races whose winner has a time."""
    timed = F.max(F.when(F.col("position") == 1, F.col("winner_time"))).over(Window.partitionBy("race_id"))
    kept = runners.where(F.col("position").isNotNull() & (F.col("distance") > 0) & ~F.coalesce(F.col("course").isin(*NOT_FRENCH), F.lit(False)))
    return kept.withColumn("_timed", timed).where("_timed > 0").drop("_timed")


def eligible_french(wins: DataFrame) -> DataFrame:
    """Winners fit for standards: not of maiden races by name, nor of races whose winners are all two years old."""
    race = Window.partitionBy("race_id")
    young = (F.min("age").over(race) == 2) & (F.max("age").over(race) == 2)
    return wins.withColumn("_young", F.coalesce(young, F.lit(False))).where(~F.col("_young") & ~is_maiden(F.col("race_name"))).drop("_young")


def standards(wins: DataFrame, allowances: DataFrame | None, s: Settings) -> DataFrame:
    """(course, surface, distance, standard, n_races, provisional). Without allowances: medians on good going, or on all where that is thin.
    With them: recency-weighted medians of corrected times, trimmed if the settings say so, thin ones blended with their distance."""
    furlongs = F.col("distance") / s.unit
    if allowances is None:
        t = F.col("winner_time") - s.class_per_furlong * furlongs
        good = F.col("going").isin(*s.good_going)
        both = wins.groupBy(*CONFIG).agg(F.median(F.when(good, t)).alias("g"), F.count(F.when(good, t)).alias("ng"), F.median(t).alias("a"), F.count(t).alias("n_races"))
        value = F.when(F.col("ng") >= s.least_races, F.col("g")).when(F.col("n_races") >= s.least_races, F.col("a"))
        return both.select(*CONFIG, value.alias("standard"), "n_races", F.lit(False).alias("provisional")).where("standard is not null")
    corrected = wins.join(allowances.select("meeting_id", "ga"), "meeting_id").withColumn("t", F.col("winner_time") - s.class_per_furlong * furlongs - F.col("ga") * F.col("distance"))
    latest = wins.agg(F.max(F.year("day")).alias("latest"))
    weighed = corrected.crossJoin(F.broadcast(latest)).withColumn("w", F.pow(F.lit(0.5), (F.col("latest") - F.year("day")) / s.half_life))
    if s.trim:
        weighed = robust.trimmed(weighed, CONFIG, "t", s.trim, "race_id")
    medians = robust.weighted_median(weighed, CONFIG, "t", "w", "race_id", "standard").join(weighed.groupBy(*CONFIG).agg(F.count(F.lit(1)).alias("n_races")), CONFIG)
    n, near = F.col("n_races"), F.rint(F.col("distance") / s.unit).alias("_near")
    generic = medians.where(n >= s.least_races).groupBy(near).agg(F.median("standard").alias("generic"))  # of the well-sampled standards, by whole furlongs
    k = F.when(F.col("course").isin(*IRISH), s.thin_k_irish).otherwise(s.thin_k)
    blended = F.when(n >= s.least_races, F.col("standard")).otherwise(F.coalesce((n * F.col("standard") + k * F.col("generic")) / (n + k), "standard"))
    return medians.where(n >= s.least_thin).withColumn("_near", near).join(generic, "_near", "left").select(*CONFIG, blended.alias("standard"), "n_races", (n < 30).alias("provisional"))


def with_standard(rows: DataFrame, known: DataFrame, guard: float | None = None) -> DataFrame:
    """rows with the standard of their configuration, interpolated over distance where it has none of its own."""
    curve = interpolate.curves(known, ["course", "surface"], "distance", "standard")
    return interpolate.joined_by_value(rows, curve, ["course", "surface"], "distance", "standard", guard)


def split_cards(wins: DataFrame, s: Settings) -> DataFrame:
    """wins with meeting_id ending in _early or _late where the going broke within the card."""
    tested = robust.split_test(wins, ["meeting_id"], "per_unit", ["race_no", "race_id"], shift=0.10 / s.unit).where("is_split").select("meeting_id", "n")
    order = F.row_number().over(Window.partitionBy("meeting_id").orderBy("race_no", "race_id"))
    half = F.when(order <= F.floor(F.col("n") / 2), F.lit("_early")).otherwise(F.lit("_late"))
    return wins.join(tested, "meeting_id", "left").withColumn("_h", half).withColumn("meeting_id", F.when(F.col("n").isNotNull(), F.concat("meeting_id", "_h")).otherwise(F.col("meeting_id"))).drop("_h", "n")


def going_priors(spark, s: Settings) -> DataFrame:
    return spark.createDataFrame([(g, v / s.unit) for g, v in s.seeds.items()], "going string, prior double")


def allowances(wins: DataFrame, known: DataFrame, s: Settings, priors: DataFrame | None = None) -> DataFrame:
    """(meeting_id, base_id, ga, se, n) in seconds a unit: deviations from standard, outliers dropped, cards split, extremes winsorized, meetings with
    too few races estimated from the days next to them, all shrunk toward the prior of their going, large ones boosted.

    The deviations, and the tables with a row a meeting, are written: each is read several times, and would be made anew each time."""
    class_adjusted = F.col("winner_time") - s.class_per_furlong * F.col("distance") / s.unit
    rated = with_standard(wins, known).where("standard is not null").withColumn("per_unit", (class_adjusted - F.col("standard")) / F.col("distance")).withColumn("base_id", F.col("meeting_id"))
    deviations = written(robust.without_outliers(rated.select("meeting_id", "base_id", "race_no", "race_id", "per_unit"), ["meeting_id"], "per_unit", s.z), "deviations")
    winsorized = robust.winsorized(split_cards(deviations, s), ["meeting_id", "base_id"], "per_unit").where(F.col("n") >= s.least_card)
    means = written(winsorized.select("meeting_id", "base_id", F.col("winsor_mean").alias("raw"), F.col("winsor_se").alias("se"), "n"), "means")
    cards = wins.groupBy(F.col("meeting_id").alias("base_id")).agg(F.min("day").alias("day"), F.min("course").alias("course"), F.min("surface").alias("surface"), F.min_by("going", "race_no").alias("going"))
    meetings = written(cards, "meetings")
    placed = means.join(meetings, "base_id")
    near = interpolate.day_neighbours(placed.groupBy("course", "surface", "day").agg(F.avg("raw").alias("raw")), ["course", "surface"], "day", "raw", "raw")
    lacking = meetings.join(means.select("base_id"), "base_id", "left_anti").join(near, ["course", "surface", "day"])
    filled = lacking.select(F.col("base_id").alias("meeting_id"), "base_id", "raw", F.lit(None).cast("double").alias("se"), F.lit(s.least_card).cast("long").alias("n"), "going")
    every = placed.select("meeting_id", "base_id", "raw", "se", "n", "going").unionByName(filled).join(meetings.select("base_id", "course"), "base_id")
    priors = going_priors(wins.sparkSession, s) if priors is None else priors
    prior = F.coalesce("prior", F.lit(s.default_prior / s.unit))
    k = F.when(F.col("course").isin(*IRISH), s.k_irish).otherwise(s.k)
    shrunk = every.join(priors, "going", "left").withColumn("ga", (F.col("n") * F.col("raw") + k * prior) / (F.col("n") + k))
    boosted = shrunk.select("meeting_id", "base_id", shrink.boosted(F.col("ga"), s.boost_from / s.unit, s.boost * s.unit).alias("ga"), "se", "n")
    if s.caps is None:
        return boosted
    outer = boosted.agg(F.percentile("ga", 0.01).alias("_low"), F.percentile("ga", 0.99).alias("_high"))  # one row, of one value a meeting
    return boosted.crossJoin(F.broadcast(outer)).withColumn("ga", robust.soft_cap(F.col("ga"), F.col("_low"), F.col("_high"), s.caps[0] / s.unit, s.caps[1] / s.unit)).drop("_low", "_high")


def live_allowances(runners: DataFrame, known: DataFrame, s: Settings, priors: DataFrame | None = None) -> DataFrame:
    """allowances() for cards just run, every meeting of the runners included: medians of winsorized deviations, shrunk and boosted, without splits or
    neighbours; meetings with too few timed races take the prior of their going as it is (n is 0, se null). A missing going counts as good."""
    timed = with_standard(winners(runners), known).where("standard is not null")
    deviation = (F.col("winner_time") - s.class_per_furlong * F.col("distance") / s.unit - F.col("standard")) / F.col("distance")
    kept = robust.without_outliers(timed.withColumn("per_unit", deviation), ["meeting_id"], "per_unit", s.z)
    middles = robust.winsorized(kept, ["meeting_id"], "per_unit").where(F.col("n") >= s.least_card).select("meeting_id", F.col("winsor_median").alias("_raw"), F.col("winsor_se").alias("se"), "n")
    meetings = runners.groupBy("meeting_id").agg(F.min("course").alias("course"), F.coalesce(F.min_by("going", "race_no"), F.lit(s.good_going[0])).alias("going"))
    priors = going_priors(runners.sparkSession, s) if priors is None else priors
    prior, n = F.coalesce("prior", F.lit(s.default_prior / s.unit)), F.col("n")
    k = F.when(F.col("course").isin(*IRISH), s.k_irish).otherwise(s.k)
    shrunk = shrink.boosted((n * F.col("_raw") + k * prior) / (n + k), s.boost_from / s.unit, s.boost * s.unit)
    joined = meetings.join(middles, "meeting_id", "left").join(priors, "going", "left")
    return joined.select("meeting_id", F.col("meeting_id").alias("base_id"), F.coalesce(shrunk, prior).alias("ga"), "se", F.coalesce(n, F.lit(0)).alias("n"))


def converged(before: DataFrame, after: DataFrame) -> float | None:
    """Mean absolute change of the allowances that both have."""
    return before.select("meeting_id", F.col("ga").alias("old")).join(after, "meeting_id").agg(F.avg(F.abs(F.col("ga") - F.col("old")))).first()[0]


def estimate(runners: DataFrame, s: Settings = UK) -> tuple[DataFrame, DataFrame]:
    """Standards and allowances by turns, until the allowances move less than the tolerance or the passes are used up. Both are written at each pass.

    Races that are not fit for standards by the settings' rule take part in allowances alone; where runners lack the columns of the rule, every race counts as fit."""
    wins = written(winners(runners), "winners")
    rules = {"code": ({"race_code", "oldest_age"}, eligible), "name": ({"race_name"}, eligible_french)}
    needs, rule = rules[s.eligibility] if s.eligibility else (set(), lambda w: w)
    fit = rule(wins) if needs <= set(wins.columns) else wins
    known = written(standards(fit, None, s), "standards")
    going = written(allowances(wins, known, s), "allowances")
    for _ in range(s.passes):
        by_base = going.groupBy(F.col("base_id").alias("meeting_id")).agg(F.avg("ga").alias("ga"))
        known = written(standards(fit, by_base, s), "standards")
        last, going = going, written(allowances(wins, known, s), "allowances")
        moved = converged(last, going)
        if moved is None or moved < s.tolerance:
            break
    return known, going


def pounds_per_length(known: DataFrame, s: Settings) -> DataFrame:
    """(course, surface, distance, lpl): the generic value of the distance times the configuration's pace against that of its distance."""
    pace = F.col("standard") / F.col("distance")
    relative = F.avg(pace).over(Window.partitionBy("surface", F.rint(F.col("distance") / s.unit))) / pace
    return known.select(*CONFIG, (generic_lpl(F.col("distance"), F.col("surface"), s) * relative).alias("lpl"))


def generic_lpl(distance: Column, surface: Column, s: Settings) -> Column:
    factor = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in s.surface_factors.items() for v in kv]), surface), F.lit(1.0))
    return s.second_per_length * s.pounds_per_second * (5 * s.unit / distance) * factor


def figures(runners: DataFrame, known: DataFrame, going: DataFrame, s: Settings = UK, live: bool = False) -> DataFrame:
    """runners with standard, ga, lpl, winner_figure, raw_figure and weighted (raw plus weight above the base)."""
    wins = with_standard(winners(runners), known).join(pounds_per_length(known, s), CONFIG, "left")
    by_base = going.groupBy(F.col("base_id").alias("meeting_id")).agg(F.avg("ga").alias("ga"))
    rated = wins.join(by_base, "meeting_id").withColumn("lpl", F.coalesce("lpl", generic_lpl(F.col("distance"), F.col("surface"), s)))
    slower = (F.col("winner_time") - F.col("ga") * F.col("distance") - F.col("standard")) / s.second_per_length
    of_race = rated.select("race_id", "standard", "ga", "lpl", (s.base - slower * F.col("lpl")).alias("winner_figure"))
    joined = runners.join(of_race, "race_id", "left")
    pace = clamp(F.try_divide("standard", "winner_time"), 0.85, 1.15)
    limit = clamp(20 - 8 * F.col("ga"), 10.0, 30.0)
    behind = F.when(F.col("position") == 1, F.lit(0.0)).otherwise(F.when(F.lit(live) | (F.col("beaten") <= 20), F.greatest("beaten", F.lit(0.0))))
    raw = F.col("winner_figure") - attenuated(behind, limit, 0.5) * F.col("lpl") * pace
    return joined.withColumn("raw_figure", raw).withColumn("weighted", F.col("raw_figure") + F.coalesce(F.col("weight") - s.base_weight, F.lit(0.0)))


def add_age_allowance(runners: DataFrame, grid: DataFrame, figure: str = "weighted", name: str = "adjusted", unit: float = 1.0, oldest: int = 12, asked: DataFrame | None = None) -> DataFrame:
    """runners with name = figure + allowance. grid: (surface, age, month, distance in furlongs, pounds); older horses count as `oldest`, ages and months that the grid lacks are allowed 0.

    asked: the same runners before they were rated, from which ages, months and distances are read more cheaply."""
    keys = ["surface", "_age", "_month"]
    keyed = lambda df: df.withColumn("_age", F.least("age", F.lit(oldest))).withColumn("_month", F.month("day")).withColumn("_furlongs", F.col("distance") / unit)
    curves = interpolate.curves(grid, ["surface", "age", "month"], "distance", "pounds").select("surface", F.col("age").alias("_age"), F.col("month").alias("_month"), "curve")
    found = interpolate.joined_by_value(keyed(runners), curves, keys, "_furlongs", "allowance", asked=keyed(runners if asked is None else asked)).withColumn("allowance", F.coalesce("allowance", F.lit(0.0)))
    return found.withColumn(name, F.col(figure) + F.col("allowance")).drop("_age", "_month", "_furlongs")


def valid_target(target: Column, figure: Column) -> Column:
    """Rows that calibration may learn from."""
    return F.coalesce(target.isNotNull() & (target != 0) & target.between(-200, 200) & figure.isNotNull(), F.lit(False))


def calibrate(rated: DataFrame, target: str, figure: str = "adjusted", name: str = "calibrated") -> DataFrame:
    """rated with a calibrated figure: a line or parabola by surface, whichever fits better, then layers of shrunk offsets (class, course and
    distance, going group, margin band, age) of what is left. Surfaces with under a hundred rows keep their figure."""
    known = rated.where(valid_target(F.col(target), F.col(figure)))
    curve = parabola(known, ["surface"], figure, target)
    flat = known.groupBy("surface").agg(F.regr_slope(target, figure).alias("slope"), F.regr_intercept(target, figure).alias("intercept"))
    fits = curve.join(flat, "surface").where("n >= 100")
    line, arc = F.col("slope") * F.col(figure) + F.col("intercept"), F.col("b0") + F.col("b1") * (F.col(figure) - F.col("x_mean")) + F.col("b2") * (F.col(figure) - F.col("x_mean")) ** 2
    miss = known.join(F.broadcast(fits), "surface").groupBy("surface").agg((F.avg((arc - F.col(target)) ** 2) < 0.999 * F.avg((line - F.col(target)) ** 2)).alias("curved"))
    based = rated.join(F.broadcast(fits.join(miss, "surface").drop("n")), "surface", "left").withColumn("_base", F.coalesce(F.when(F.col("curved"), arc).otherwise(line), F.col(figure))).drop(*[c for c in fits.columns if c not in ("surface", "n")], "curved")
    banded = based.withColumn("_band", F.when(F.col("position") == 1, "winner").otherwise(binned(F.col("beaten"), [0, 1, 3, 5, 10, 15, 20], "other"))).withColumn("_age", F.least(F.greatest("age", F.lit(2)), F.lit(4))).withColumn("_going", F.coalesce(going_group(F.col("going")), F.col("going")))
    rest = F.when(valid_target(F.col(target), F.col(figure)), F.col(target) - F.col("_base"))
    layers = [(["surface", "race_class"], 0.0, None), (["surface", "course", "distance"], 100.0, 10.0), (["surface", "_going"], 100.0, None), (["surface", "_band"], 100.0, None), (["surface", "_age"], 100.0, None)]
    layered = shrink.residual_layers(banded.withColumn("_left", rest), "_left", layers, "_offset")
    return layered.withColumn(name, F.col("_base") + F.col("_offset")).drop("_base", "_band", "_age", "_going", "_left", "_offset")


def race_checks(runners: DataFrame, s: Settings = UK) -> DataFrame:
    """(race_id, no_standard, odd_pace, flat_margins, slow_winner, arabians, is_rejected) of rated runners."""
    pace = F.max("winner_time") / F.max("distance") * s.unit
    others = F.when(F.col("position") > 1, F.col("beaten"))
    checks = runners.groupBy("race_id").agg(
        F.max("standard").isNull().alias("no_standard"), (~pace.between(10, 18)).alias("odd_pace"), ((F.count(others) >= 3) & (F.min(others) == F.max(others))).alias("flat_margins"),
        F.coalesce(F.max("winner_time") > 1.07 * F.max("standard"), F.lit(False)).alias("slow_winner"), (F.avg(F.col("horse").rlike(r" AA$").cast("int")) >= 0.5).alias("arabians"),
    )
    bad = [F.coalesce(F.col(c), F.lit(False)) for c in ("no_standard", "odd_pace", "flat_margins", "slow_winner", "arabians")]
    return checks.withColumn("is_rejected", bad[0] | bad[1] | bad[2] | bad[3] | bad[4])


def compressed(figure: Column, race_class: Column) -> Column:
    """What exceeds a hundred, scaled by class: full at class 3 (or unknown), less above, more below."""
    factor = F.greatest(F.lit(0.0), 1 - 0.354 * (F.coalesce(race_class, F.lit(3)) - 3))
    return F.when(figure >= 100, 100 + (figure - 100) * factor).otherwise(figure)


def report(rated: DataFrame, by: list[str], figure: str, target: str) -> DataFrame:
    """Errors of a figure against a target by group."""
    return rated.where(valid_target(F.col(target), F.col(figure))).groupBy(*by).agg(*errors(F.col(figure), F.col(target)))
