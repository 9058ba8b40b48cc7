"""Race cards in JSON: nested meetings, races and runners as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import packed_seconds


def pick(doc: Column, *paths: str) -> Column:
    """The first field of a JSON text that is there and no object or list."""
    found = [F.get_json_object(doc, p) for p in paths]
    return F.coalesce(*[F.when(~f.rlike(r"^\s*[\[{]"), f) for f in found])


def odds_of(runner: Column) -> Column:
    """The starting price: nested or plain, null unless positive."""
    price = pick(runner, "$.dernierRapportDirect.rapport", "$.dernierRapportDirect", "$.rapport").try_cast("double")
    return F.when(price > 0, price)


def weight_of(runner: Column) -> Column:
    """Kilograms: the handicap weight in tenths, else plain fields."""
    return F.coalesce(pick(runner, "$.handicapPoids").try_cast("double") / 10, pick(runner, "$.poids").try_cast("double"), pick(runner, "$.poidsConditionMonte").try_cast("double"))


def races(programmes: DataFrame, doc: str = "doc") -> DataFrame:
    """A row for each flat race of programme documents (day, doc): meeting and race fields, and the race's JSON."""
    listed = F.coalesce(F.get_json_object(doc, "$.programme.reunions"), F.get_json_object(doc, "$.reunions"))
    meetings = programmes.select("day", F.explode_outer(F.from_json(listed, "array<string>")).alias("meeting")).where("meeting is not null")
    each = meetings.select("*", F.explode_outer(F.from_json(F.get_json_object("meeting", "$.courses"), "array<string>")).alias("race"))
    return each.where(pick(F.col("race"), "$.discipline") == "PLAT").select(
        "day", pick(F.col("meeting"), "$.numOfficiel", "$.num").try_cast("int").alias("meeting_no"), pick(F.col("meeting"), "$.hippodrome.code", "$.hippodrome").alias("course"),
        pick(F.col("meeting"), "$.pays.code", "$.pays").alias("country"), pick(F.col("race"), "$.numOrdre", "$.num").try_cast("int").alias("race_no"),
        pick(F.col("race"), "$.distance").try_cast("int").alias("distance_m"), pick(F.col("race"), "$.penetrometre.intitule", "$.penetrometre").alias("going"),
        F.when(pick(F.col("race"), "$.dureeCourse").try_cast("double") > 0, pick(F.col("race"), "$.dureeCourse").try_cast("double") / 1000).alias("winner_time_s"), "race",
    )


def runners(participants: DataFrame, doc: str = "doc") -> DataFrame:
    """Flat runner rows of participant documents, other columns kept, the raw JSON as raw_json."""
    p = F.col(doc)
    return participants.select(
        *[c for c in participants.columns if c != doc], pick(p, "$.nom").alias("horse_name"), pick(p, "$.numPmu").try_cast("int").alias("number"), pick(p, "$.age").try_cast("int").alias("age"),
        pick(p, "$.sexe").alias("sex"), pick(p, "$.ordreArrivee").try_cast("int").alias("finish_position"), packed_seconds(pick(p, "$.tempsObtenu").try_cast("long")).alias("time_seconds"),
        pick(p, "$.distanceChevalPrecedent.libelleCourt", "$.distanceChevalPrecedent").alias("beaten_lengths"), weight_of(p).alias("weight_kg"), pick(p, "$.driver").alias("jockey"),
        pick(p, "$.entraineur").alias("trainer"), pick(p, "$.nomPere").alias("sire"), pick(p, "$.nomMere").alias("dam"), odds_of(p).alias("odds"), p.alias("raw_json"),
    )


def not_yet_stored(new: DataFrame, stored: DataFrame, natural_key: list[str]) -> DataFrame:
    """The rows of new whose natural key is not stored; one row per key, so an ingest can be repeated."""
    return new.dropDuplicates(natural_key).join(stored.select(*natural_key), natural_key, "left_anti")
