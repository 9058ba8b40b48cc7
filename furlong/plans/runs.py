"""Whole runs: runners to corrected figures, as a batch that learns, or live with what a batch left.

A batch keeps the runners of its region, estimates standards and allowances, rates all runners, adds the age allowance, attaches each meeting's allowance,
its error and a confidence, and fits the chain of corrections. Its tables (standards, allowances and one a stage) are what a live run needs; store() and
stored() hold them as versions. Runners need the columns named in figures.py and the target; those of a live run need no target."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import binned
from ..operators import stages as S
from ..sources import artifacts
from ..sources.staging import written
from . import figures as G
from . import scales


@dataclass(frozen=True)
class Region:
    """What differs between regions beside the settings: the grid of age allowances, which runners count, and how goings are grouped."""

    name: str
    settings: G.Settings

    def kept(self, runners: DataFrame) -> DataFrame:
        if self.name == "France":
            return G.valid_french(runners)
        flat = G.flat_runners(runners)
        return flat.where(~scales.is_jump_race(F.col("race_type"))) if "race_type" in flat.columns else flat

    def going_key(self) -> Column:
        group = scales.going_group(F.col("going"))
        return F.coalesce(group, F.col("going"), F.lit("Good")) if self.name == "France" else F.coalesce(group, F.lit("Good"))


UK, FRANCE = Region("UK", G.UK), Region("France", G.FRANCE)


@dataclass(frozen=True)
class Run:
    rows: DataFrame
    tables: dict[str, DataFrame]


def corrections(region: Region, latest: int | None = None, drift_year: int = 2022, target: str = "target", figure: str = "calibrated") -> list[S.Stage]:
    """The chain: a line or parabola by surface; shrunk offsets by class, course and distance, and going; a slope on the allowance itself; offsets by margin
    band and age; then, from all years before the latest, offsets by distance and going and the drift of two years; and the final rescale.
    latest: the year that nothing is fitted on; it is not needed to apply the chain. drift_year: the first of the two, from which on the drift is added."""
    surface: dict[str, Column | str] = {"surface": "surface"}
    beaten, year = F.coalesce("beaten", F.lit(0.0)), F.year("day")
    band = F.when(F.col("position") == 1, "winner").otherwise(binned(F.col("beaten"), [0, 1, 3, 5, 10, 15, 20], "other"))
    age = F.least(F.greatest("age", F.lit(2)), F.lit(4))
    args = (figure, target)
    first = [
        S.curves("base", *args, surface),
        S.offsets("by_class", *args, surface | {"class": "race_class"}, 0.0),
        S.offsets("by_course", *args, surface | {"course": "course", "distance": "distance"}, 100.0, 10.0),
        S.offsets("by_going", *args, surface | {"going": region.going_key()}, 100.0),
        S.slopes("by_allowance", *args, surface, "ga_value", 200),
        S.offsets("by_band", *args, surface | {"band": band}, 100.0),
        S.offsets("by_age", *args, surface | {"age": age}, 100.0),
    ]
    later = [
        S.offsets("late_distance", *args, surface | {"distance": F.rint(F.col("distance") / region.settings.unit)}, 500.0, least=100, within=("surface", 500)),
        S.offsets("late_going", *args, surface | {"going": region.going_key()}, 500.0, least=200, within=("surface", 500)),
    ]
    drift = S.offsets("late_drift", *args, surface, 0.0, least=501, where=year >= drift_year)
    final = S.rescale("rescale", *args, surface)
    valid = G.valid_target(F.col(target), F.col(figure))
    if latest is not None:
        valid = valid & (year < latest)
    close = valid & ((beaten <= 20) | F.coalesce(F.col("position") == 1, F.lit(False))) & (F.abs("ga_value") <= 2.0)
    return [s.on(close) for s in first] + [s.on(valid) for s in later] + [drift.on(valid & year.between(drift_year, drift_year + 1)), final.on(valid & (beaten <= 20))]


def attached(rated: DataFrame, going: DataFrame, runners: DataFrame) -> DataFrame:
    """rated with ga_value (0 where the meeting has none), ga_se (half the spread of all values where it has none) and confidence.

    runners: those that were rated, a row for each row of rated; the spread is taken over them, so that it needs no figures."""
    base = going.groupBy(F.col("base_id").alias("meeting_id")).agg(F.avg("ga").alias("ga_value"), F.avg("se").alias("ga_se"))
    joined = rated.join(base, "meeting_id", "left").withColumn("ga_value", F.coalesce("ga_value", F.lit(0.0)))
    values = runners.select("meeting_id").join(F.broadcast(base), "meeting_id", "left").select(F.coalesce("ga_value", F.lit(0.0)).alias("ga_value"))  # base has a row a meeting
    spread = values.agg((F.stddev_samp("ga_value") * 0.5).alias("_fallback"))  # one row
    return joined.crossJoin(F.broadcast(spread)).withColumn("ga_se", F.coalesce("ga_se", "_fallback")).withColumn("confidence", scales.confidence(F.col("ga_value"))).drop("_fallback")


def adjusted(runners: DataFrame, known: DataFrame, going: DataFrame, region: Region, live: bool = False) -> DataFrame:
    rated = G.figures(runners, known, going, region.settings, live)
    aged = G.add_age_allowance(rated, scales.age_grid(runners.sparkSession, region.name), unit=region.settings.unit, asked=runners)
    return attached(aged, going, runners).withColumn("calibrated", F.col("adjusted"))


def batch(runners: DataFrame, region: Region = UK, drift_year: int = 2022) -> Run:
    """All runners of the region with `adjusted` and the corrected `calibrated`, and the tables for live runs."""
    kept = written(region.kept(runners), "runners")
    known, going = G.estimate(kept, region.settings)
    rated = written(adjusted(kept, known, going, region), "rated")
    latest = rated.agg(F.max(F.year("day"))).first()[0]
    rows, tables = S.fitted(rated, corrections(region, latest, drift_year))
    return Run(rows, {"standards": known, "allowances": going} | tables)


def live(runners: DataFrame, tables: Mapping[str, DataFrame], region: Region = UK, drift_year: int = 2022) -> DataFrame:
    """Cards just run, with a batch's tables: allowances of their own, every margin rated, confidence by standard and margin as well. The runners are read several times, so they are written."""
    kept = written(region.kept(runners), "live_runners")
    known = tables["standards"]
    rows = adjusted(kept, known, written(G.live_allowances(kept, known, region.settings), "live_allowances"), region, live=True)
    counted = S.applied(rows, corrections(region, drift_year=drift_year), tables).join(known.select(*G.CONFIG, "n_races"), G.CONFIG, "left")
    return counted.withColumn("confidence", scales.live_confidence(F.col("beaten"), F.col("position"), F.col("n_races"), F.col("calibrated")))


def store(spark: SparkSession, root: str, run: Run) -> int:
    """A new version of a batch's tables; returns its number."""
    return artifacts.save(spark, root, run.tables)


def stored(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version; those that it lacks are left out, and a live run leaves out their stages."""
    held = artifacts.Artifacts(spark, root, version)
    return {name: held.table(name) for name in held.manifest["tables"]}
