"""The form features: what was known before each run, by horse, trainer, jockey and their pairings, conditions, pedigree and race.

history rows need: race_date date, race_time, track, horse_name, placing double, jockey, trainer, price double (decimal odds), runners double, prize double, going, furlongs double, race_class,
stall double, surface, margin string (lengths behind), seconds double, rating double, sire, damsire, headgear, comment, weight double, age double.
Windows are row lags ordered by date, race time, track and horse; nothing of the row itself or a later one enters a feature (two named exceptions:
race-wide sums of the pre-race card, and the relative speed's standard, which is the median of its configuration over the whole table).
Rows are sorted once and numbered in that order; every partitioning shuffles this number, its keys and the few columns that it reads (operators.bundle); rows without a key take no part in it and get nulls.
Records by keys of few values go by segments of the order instead, so no task holds such a key.

Not here: horse records by jockey pairings beyond trainer and jockey, sectional times, and the margins' field-adjusted form."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import binned
from ..functions.text import first_int, ground, margin, pace
from ..operators import windows as W
from ..operators.bundle import Family, bundled, chosen, ranked, read, segmented
from ..sources.staging import written

TIE = ["race_date", "race_time", "track", "horse_name"]
ROW = W.BySegment.ROW  # ascends in the order of TIE
HORSE = (["horse_name"], [ROW])
FEW = 100  # keys of at most so many values go by segments
SPANS = (3, 5, 10)
PEDIGREE = (("sire",), ("sire", "going"), ("sire", "band"), ("damsire",), ("damsire", "going"), ("damsire", "band"))
OUTCOMES = ("won", "placed", "nfp")
STRENGTHS = ("horse_nfp_career", "horse_rb_career", "horse_fsarb_career", "horse_over_chance_career", "horse_speed_career")


def card(history: DataFrame) -> DataFrame:
    """What each run and its race amount to: outcome measures, expectations, pace and strength of the field."""
    race = Window.partitionBy("race_id")
    n, pos, price = F.col("runners"), F.col("placing"), F.when(F.col("price") > 0, F.col("price"))
    base = history.withColumn("race_id", F.concat_ws("_", F.col("race_date").cast("string"), "track", F.col("race_time").cast("string"))).select(
        "*", F.coalesce((pos == 1).cast("double"), F.lit(0.0)).alias("won"), F.coalesce((pos <= 3).cast("double"), F.lit(0.0)).alias("placed"),
        F.try_divide(n - pos, n - 1).alias("nfp"), (1 - F.try_divide(pos - 1, n - 1)).alias("rb"), F.try_divide(F.lit(1.0), n).alias("chance"), (1 / price).alias("market"),
        pace(F.col("comment")).alias("pace"), first_int(F.col("race_class").cast("string")).cast("double").alias("class_no"), ground(F.col("going")).alias("going_no"),
        margin(F.col("margin")).alias("lengths"), binned(F.col("furlongs"), [0, 6, 8, 10, 12, 100], "other").alias("band"),
    )
    rank = W.rank_desc(-price, ["race_id"])
    speed = F.median("seconds").over(Window.partitionBy("track", "furlongs", "going"))
    rated = base.select(
        "*", (F.col("won") - F.col("chance")).alias("over_chance"), F.try_divide("market", "chance").alias("odds_ratio"), (F.col("market") - F.col("chance")).alias("price_gap"), (n / price).alias("odds_field"),
        (0.8637 * F.col("pace") + 0.09375 * n - 0.74).alias("pace_adj"), (F.col("pace") * F.col("nfp")).alias("pace_nfp"), F.sum("pace").over(race).alias("race_pace"),
        F.try_divide(100 * F.count(F.when(F.col("pace") > 4, 1)).over(race), n).alias("pace_pressure"), F.avg("rating").over(race).alias("race_rating"), (F.col("prize") / 100 * F.col("rb") ** 2).alias("prize_merit"),
        (F.col("weight") - F.avg("weight").over(race)).alias("weight_vs_mean"), (F.col("weight") - F.min("weight").over(race)).alias("weight_vs_min"),
        F.try_divide(F.col("stall") - 1, n - 1).alias("draw"), F.try_divide(n - rank, n - 1).alias("expected"), (F.try_divide(speed - F.col("seconds"), speed) * 100).alias("speed"),
    )
    middle = history.agg(F.median("runners").alias("_middle"))  # one row
    rated = rated.crossJoin(F.broadcast(middle)).withColumn("fsarb", F.col("rb") * n / F.col("_middle")).withColumn("fsarb2", F.col("fsarb") * F.col("fsarb")).drop("_middle")
    return rated.select("*", (F.col("nfp") - F.col("expected")).alias("surprise"), F.sum("prize_merit").over(race).alias("race_merit"), (F.col("won") * F.log1p(F.greatest("price", F.lit(1.0)) - 1)).alias("upset"))


def by_horse() -> Family:
    """A horse's own record before each run."""
    by, order = HORSE
    w = W.ordered(by, order)
    mean = lambda c, last=None, least=1: W.prior_mean(F.col(c), by, order, last, least)
    k = W.prior_count(by, order)
    out: dict[str, Column] = {"runs": k, "wins": F.coalesce(F.sum("won").over(W.prior(by, order)), F.lit(0.0)), "places": F.coalesce(F.sum("placed").over(W.prior(by, order)), F.lit(0.0))}
    for c in ("nfp", "rb", "fsarb", "fsarb2", "over_chance", "odds_ratio", "price_gap", "odds_field", "pace", "pace_adj", "prize_merit", "surprise", "upset", "speed", "lengths", "won", "placed"):
        out[f"{c}_career"] = mean(c)
        out[f"{c}_last"] = F.lag(c).over(w)
    out["over_chance_total"] = F.sum("over_chance").over(W.prior(by, order))
    for c in ("nfp", "rb", "speed", "lengths", "won", "placed"):
        out |= {f"{c}_mean_{k}": mean(c, k) for k in SPANS}
    for c in ("odds_ratio", "price_gap", "odds_field", "race_merit", "pace", "pace_nfp"):
        out |= {f"{c}_harmonic_{k}": W.harmonic(F.col(c), by, order, k) for k in (3, 5)}
    for c in ("odds_ratio", "price_gap", "prize", "prize_merit"):
        out |= {f"{c}_weighted_{k}": W.harmonic_mean(F.col(c), by, order, k) for k in SPANS}
    for c in ("nfp", "rb", "odds_ratio", "surprise"):
        out |= {f"{c}_decayed_{k}": W.decayed(F.col(c), by, order, k, 0.85) for k in (3, 5)}
    out |= {f"{c}_distance": W.distance_to_last(F.col(c), by, order, 10) for c in ("runners", "race_rating")}
    slope = W.slope_of_last(F.col("nfp"), by, order, 3)
    out |= {"nfp_spread": W.prior_std(F.col("nfp"), by, order), "nfp_spread_5": W.prior_std(F.col("nfp"), by, order, 5), "nfp_slope_3": slope, "nfp_slope_5": W.slope_of_last(F.col("nfp"), by, order, 5), "nfp_variance_5": F.var_pop("nfp").over(W.prior(by, order, 5))}
    out |= {"slope_up": slope > 0.05, "slope_down": slope < -0.05, "speed_best": F.max("speed").over(W.prior(by, order))}  # the latest run is at 0, so a slope up means that earlier runs were better
    out |= {f"days_{i}": F.date_diff("race_date", F.lag("race_date", i).over(w)) for i in (1, 2, 3, 4)}
    _, out["days_trend"], out["days_final"] = W.gaps_between(F.col("race_date"), by, order)
    out["last_score"] = W.place_score(F.lag("placing").over(w))
    for span in SPANS:
        held = F.least(k, F.lit(span))
        weights = F.array(*[F.lit(sum(1 / j for j in range(1, i + 1)) if i else None).cast("double") for i in range(span + 1)])
        out |= {f"count_{span}": held, f"weights_{span}": F.element_at(weights, (held + 1).cast("int")), f"interval_{span}": F.try_divide(held, F.col("runners") * float(span)) * 100}
    out |= {"class_step": F.col("class_no") - F.lag("class_no").over(w), "class_vs_3": F.col("class_no") - mean("class_no", 3), "weight_step": F.col("weight") - F.lag("weight").over(w)}
    rating = F.col("rating")
    out |= {"rating_step": rating - F.lag("rating").over(w), "rating_step_3": rating - F.lag("rating", 3).over(w), "rating_vs_best": rating - F.max("rating").over(W.prior(by, order)), "rating_vs_winning": rating - W.last_value_when(rating, F.col("won") == 1, by, order)}
    for c in ("furlongs", "going_no"):
        pref = F.try_divide(F.sum(F.col(c) * F.col("nfp")).over(W.prior(by, order)), F.nullif(F.sum(F.when(F.col(c).isNotNull(), F.col("nfp"))).over(W.prior(by, order)), F.lit(0.0)))
        out |= {f"{c}_preferred": pref, f"{c}_off": F.abs(F.col(c) - pref)}
    worn = F.col("headgear").isNotNull() & (F.trim("headgear") != "")
    before = F.lag(worn).over(w)
    out |= {"gear": worn, "gear_first": worn & (F.coalesce(F.sum(worn.cast("int")).over(W.prior(by, order)), F.lit(0)) == 0), "gear_changed": worn != before, "gear_removed": before & ~worn}
    needs = ("won placed nfp rb fsarb fsarb2 over_chance odds_ratio price_gap odds_field pace pace_adj pace_nfp prize prize_merit race_merit surprise upset speed lengths placing runners race_rating class_no weight rating furlongs going_no headgear").split()
    return Family(tuple(by), {f"horse_{name}": c for name, c in out.items()}, ("race_date", *needs))


def by_key(keys: Sequence[str], name: str, sums: W.Earlier) -> Family:
    """The record of any key before each run: runs, wins, rates against chance, mean finish and pace."""
    out = {
        "runs": sums.count().cast("long"), "wins": sums.sum("won"), "impact": F.try_divide(sums.sum("won"), F.nullif(sums.sum("chance"), F.lit(0.0))), "rate": sums.mean("won"),
        "over_chance_total": F.when(sums.count("over_chance") > 0, sums.sum("over_chance")), **{c: sums.mean(c) for c in ("over_chance", "nfp", "rb", "placed", "pace_adj")},
    }
    return Family(tuple(keys), {f"{name}_{part}": c for part, c in out.items()}, ("won", "placed", "chance", "over_chance", "nfp", "rb", "pace_adj"))


def hot_form(key: str, days: int, sums: W.Earlier) -> Family:
    """Runs and strike rate of a key within the last days, earlier runs of the day included, and the rate less that of all its earlier runs."""
    n = F.nullif(sums.recent(None, days), F.lit(0))
    rate = F.try_divide(sums.recent("won", days), n)
    return Family((key,), {f"{key}_runs_{days}d": n, f"{key}_rate_{days}d": rate, f"{key}_hot_{days}d": rate - sums.mean("won")}, ("race_date", "won"))


def pedigree(keys: Sequence[str], sums: W.Earlier, everyone: Callable[[str], Column] = lambda c: F.col(f"all_{c}"), k: float = 20.0) -> Family:
    """A parent's prior results, overall or by going or distance, shrunk to those of the population; its runs and wins against chance."""
    name = "_".join(keys)
    shrunk = {f"{name}_{c}_shrunk": (sums.sum(c) + k * everyone(c)) / (sums.count(c) + k) for c in OUTCOMES}
    impact = F.try_divide(sums.sum("won"), F.nullif(sums.sum("chance"), F.lit(0.0)))
    return Family(tuple(keys), {**shrunk, f"{name}_runs": sums.count().cast("long"), f"{name}_impact": impact}, ("chance", *OUTCOMES, *[f"all_{c}" for c in OUTCOMES]))


def with_population(runs: DataFrame) -> DataFrame:
    """runs with all_<outcome>, the mean of each outcome over all earlier runs of anyone."""
    sums = W.BySegment([], "race_date")
    return segmented(runs, [(Family((), {f"all_{c}": sums.mean(c) for c in OUTCOMES}, OUTCOMES), sums)])


RECORDS = (
    (["trainer"], "trainer"), (["jockey"], "jockey"), (["trainer", "jockey"], "pair"), (["horse_name", "band"], "horse_band"), (["horse_name", "going"], "horse_going"), (["horse_name", "track"], "horse_track"),
    (["horse_name", "surface"], "horse_surface"), (["trainer", "track"], "trainer_track"), (["jockey", "track"], "jockey_track"),
)


def records(keys: Sequence[str], sums: W.Earlier, everyone: Callable[[str], Column] = lambda c: F.col(f"all_{c}")) -> list[Family]:
    """What is summed by these keys."""
    out = [by_key(keys, name, sums) for by, name in RECORDS if tuple(by) == tuple(keys)]
    out += [hot_form(keys[0], days, sums) for days in (14, 30) if tuple(keys) in (("trainer",), ("jockey",))]
    return out + [pedigree(keys, sums, everyone) for by in PEDIGREE if by == tuple(keys)]


KEYS = (*[tuple(by) for by, _ in RECORDS], *PEDIGREE)


def families() -> list[Family]:
    """What needs the card alone, and the means of the population for pedigree."""
    return [by_horse(), *[f for keys in KEYS for f in records(keys, W.Earlier(keys, [ROW], "race_date"))]]


def by_segments(few: Collection[tuple[str, ...]], names: Collection[str] | None) -> list[tuple[Family, W.BySegment]]:
    """The records of keys of few values, those that are named, with their sums and the population's."""
    out: list[tuple[Family, W.BySegment]] = []
    for keys in few:
        sums, anyone = W.BySegment(keys, "race_date"), W.BySegment([], "race_date")
        every = records(keys, sums, anyone.mean)
        cut = every if names is None else chosen(every, names)
        out += [(f, sums) for f in cut]
        if any(keys == by for by in PEDIGREE) and cut:
            out.append((Family((), {}, ()), anyone))
    return out


def later_families(strengths: Sequence[str] = STRENGTHS) -> list[Family]:
    """What needs the first families: how strong each horse's last race was, and the places that a jockey's mounts came from."""
    w = W.ordered(*HORSE)
    scores = F.try_divide(F.sum("horse_last_score").over(W.prior(["jockey"], [ROW])), F.nullif(W.prior_count(["jockey"], [ROW]), F.lit(0))) * 10
    lags = {f"race_{c}_last": F.lag(f"race_{c}").over(w) for c in strengths}
    return [Family(("horse_name",), lags, tuple(f"race_{c}" for c in strengths)), Family(("jockey",), {"jockey_mounts": scores}, ("horse_last_score",))]


# What is ranked within the race.
RANKED = (
    *[f"horse_{c}" for c in ("runs", "wins", "places", "speed_best", "over_chance_total", "days_final", "last_score", "runners_distance", "race_rating_distance")],
    *[f"horse_{c}_career" for c in ("nfp", "rb", "fsarb", "fsarb2", "over_chance", "odds_ratio", "pace", "pace_adj", "prize_merit", "surprise", "speed", "lengths", "won", "placed")],
    *[f"horse_{c}_last" for c in ("nfp", "odds_ratio", "pace", "pace_adj", "speed", "lengths")], *[f"horse_{c}_mean_{k}" for c in ("nfp", "speed") for k in SPANS], *[f"horse_{c}_weighted_{k}" for c in ("odds_ratio", "price_gap", "prize_merit") for k in SPANS],
    *[f"horse_{c}_decayed_3" for c in ("nfp", "odds_ratio")], *[f"{who}_{c}" for who in ("trainer", "jockey", "pair") for c in ("impact", "nfp", "over_chance", "rate")], *[f"{who}_rb" for who in ("trainer", "jockey")], "trainer_pace_adj", "jockey_pace_adj",
    *[f"{who}_impact" for who in ("horse_band", "horse_going", "horse_track")], *[f"{parent}_{c}_shrunk" for parent in ("sire", "damsire") for c in OUTCOMES], "trainer_hot_14d", "jockey_hot_14d", "rating", "horse_rating_vs_best",
)


def features(history: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """One row for each row of history with every feature family: the card, records by key, pedigree, strength of the race and of the last one, ranks within the race.

    columns: those of the card and the features that are asked for, if not all; only what they need is computed, shuffled and written, and the order (TIE), race_id and jockey come with them.
    The card and the first families are written once each; what follows reads only the columns it needs from them."""
    asked = lambda c: columns is None or c in columns
    strengths = [c for c in STRENGTHS if asked(f"race_{c}") or asked(f"race_{c}_last")]
    places = [c for c in RANKED if asked(f"{c}_rank")]
    first, later_ones, runs = families(), later_families(strengths), card(history)
    if columns is not None:
        kept = {"race_id", "jockey", *TIE, "horse_last_score", *columns, *places, *strengths}
        first, later_ones = chosen(first, kept), chosen(later_ones, columns)
        needed = read(first, runs.columns) | (kept & set(runs.columns)) | set(OUTCOMES)
        runs = runs.select(*[c for c in runs.columns if c in needed])
    base = written(runs.orderBy(*TIE).withColumn(ROW, F.monotonically_increasing_id()), "card")
    keyed = [keys for keys in KEYS if any(f.keys == keys for f in first)]
    values = base.agg(*[F.approx_count_distinct(F.struct(*keys)).alias("_".join(keys)) for keys in keyed]).first() if keyed else {}
    few = [keys for keys in keyed if values["_".join(keys)] <= FEW]
    local = by_segments(few, None if columns is None else kept)
    rest = [f for f in first if f.keys not in few]
    if columns is None or any(f.keys in PEDIGREE for f in rest) or any(f"all_{c}" in columns for c in OUTCOMES):
        base = written(with_population(base), "population")
    wide = bundled(base, ROW, rest, segmented(base, local) if local else None)
    if columns is not None:
        wide = wide.select(ROW, *[c for c in wide.columns if c in kept])
    form = written(wide, "form")
    race = Window.partitionBy("race_id")
    strong = form.select(ROW, "race_id", *strengths).select(ROW, *[F.avg(c).over(race).alias(f"race_{c}") for c in strengths])
    later = written(form.select(ROW, "jockey", "horse_last_score", "horse_name").join(strong, ROW), "strength")
    out = form.join(bundled(later, ROW, later_ones).drop("jockey", "horse_last_score", "horse_name"), ROW)
    return (out.join(ranked(form, ROW, "race_id", places), ROW) if places else out).drop(ROW)
