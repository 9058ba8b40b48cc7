"""Parsers of race texts as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(x: Column, ladder: Sequence[tuple[str, float]], default: float) -> Column:
    """The score of the first pattern that a text matches; null texts get the default."""
    out = None
    for pattern, score in ladder:
        out = F.when(x.rlike(pattern), F.lit(score)) if out is None else out.when(x.rlike(pattern), F.lit(score))
    return out.otherwise(F.lit(default))


def first_held(x: Column, ladder: Mapping[str, float], default: float) -> Column:
    """The score of the first word that a text holds anywhere; null texts get the default."""
    out = None
    for word, score in ladder.items():
        out = F.when(x.contains(word), F.lit(score)) if out is None else out.when(x.contains(word), F.lit(score))
    return out.otherwise(F.lit(default))


def first_int(x: Column) -> Column:
    return F.regexp_extract(x, r"(\d+)", 1).try_cast("int")


def attenuated(x: Column, threshold: Column, factor: float) -> Column:
    """x up to a threshold, beyond it only a share of the excess."""
    return F.when(x <= threshold, x).otherwise(threshold + factor * (x - threshold))


def packed_seconds(x: Column) -> Column:
    """Seconds of an integer that holds minutes, two digits of seconds and two of hundredths; null unless positive."""
    return F.when(x > 0, F.floor(x / 10000) * 60 + F.floor(x / 100) % 100 + (x % 100) / 100.0)


# Early pace by the first pattern that a lower-case comment matches, and the pace of all others.
PACE = [
    (r"made virtually all|made all|made most|led to\b|led,|led early|led after|led before|led until|led over|soon led", 6.0),
    (r"disputed|disputed lead|with leader", 5.5),
    (r"chased leader|tracked leader|chased winner", 5.0),
    (r"pressed leader|tracked leaders|chased leaders|prominent|close up|in touch|in-touch|pressing leaders|chasing leaders|tracked front pair|tracked leading pair|chased leading|tracked\s|tracking leaders", 4.0),
    (r"front of mid-division|front of mid division|front of midfield", 3.0),
    (r"held up in midfield|held up in mid-division|towards rear of midfield|held up in touch", 3.0),
    (r"towards rear|held up behind|behind|held up|held up,|last pair", 1.0),
    (r"in rear|always rear", 1.0),
]
PACE_DEFAULT = 3.0

# The ground by the first of these that a lower-case going holds, and that of all others.
GROUND = {"heavy": 1.0, "soft": 2.0, "yielding": 2.5, "good to soft": 3.0, "good": 4.0, "good to firm": 5.0, "firm": 6.0, "hard": 7.0, "standard": 4.0, "standard to slow": 3.0, "slow": 2.0}
GROUND_DEFAULT = 4.0

# Lengths of the words of margins, and of those that follow a number.
MARGINS = {"": 0.0, "0": 0.0, "dht": 0.0, "dh": 0.0, "nse": 0.05, "shd": 0.1, "hd": 0.15, "sht-hd": 0.15, "nk": 0.2, "snk": 0.2, "dist": 30.0}
ADDED = {"nk": 0.2, "shd": 0.1, "hd": 0.15, "nse": 0.05}

# Lengths of whole French margins (upper case), and of the fractions in the others.
FRENCH_MARGINS = [
    (r"^C(?:OURTE|TE)\.?\s+T[EÊÈ]?TE\.?$", 0.05), (r"^C\.?T\.?$", 0.05), (r"^C(?:OURTE|TE)\.?\s+ENC(?:OLURE)?\.?$", 0.15), (r"^NEZ$", 0.03),
    (r"^ENC(?:OLURE)?\.?$|^ENK$|^NK$", 0.25), (r"^LOIN$", 30.0), (r"^T[EÊÈ]TE$|^TTE$", 0.1),
]
FRENCH_FRACTIONS = {"1/4": 0.25, "1/2": 0.5, "3/4": 0.75, "1/3": 0.33, "2/3": 0.67}

# What names tell of a French race's class, the least prize of each other class, and the words of maiden races.
FRENCH_CLASSES = [(r"GROUP?E?\s*I\b|GR\.?\s*I\b", 1), (r"GROUP?E?\s*II\b|GR\.?\s*II\b", 1), (r"GROUP?E?\s*III\b|GR\.?\s*III\b", 2), (r"LIST[ÉE]{1,2}", 2), (r"R[ÉE]CLAM|CLAIMING", 6)]
FRENCH_PRIZES = [(200_000, 1), (100_000, 2), (50_000, 3), (25_000, 4), (15_000, 5), (8_000, 6)]
FRENCH_MAIDENS = ["MAIDEN", "DEBUTANT", "DÉBUTANT", "N'AYANT PAS COURU", "N'AYANT JAMAIS GAGN", "N'AYANT JAMAIS COURU"]

# Words of a course description that name an artificial surface.
ARTIFICIAL = ["PSF", "FIBRE", "FIBRESAND", "POLYTRACK", "SABLE"]


def values_of(table: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(v) for pair in table.items() for v in pair])


def pace(comment: Column) -> Column:
    """Early pace from 1 to 6 by a comment in running."""
    return first_match(F.lower(comment), PACE, PACE_DEFAULT)


def ground(going: Column) -> Column:
    """A going as a number, from heavy 1 to hard 7."""
    return first_held(F.lower(F.trim(going)), GROUND, GROUND_DEFAULT)


def margin(x: Column) -> Column:
    """Lengths of a margin such as '1.5', '.5', 'nk', '2nk' or 'dist'; nothing said means 0, null if it says something else."""
    said = F.coalesce(F.lower(F.trim(x)), F.lit(""))
    number = F.regexp_extract(said, r"^(\d+\.?\d*)", 1).try_cast("double")
    added = F.try_element_at(values_of(ADDED), F.regexp_extract(said, r"^\d+\.?\d*\s*(nk|shd|hd|nse)", 1))
    bare = F.when(said.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), said.try_cast("double"))
    return F.coalesce(F.try_element_at(values_of(MARGINS), said), number + F.coalesce(added, F.lit(0.0)), bare)


def french_margin(x: Column) -> Column:
    """Lengths of a French margin: words, '1 L 1/2', '3/4 L', '2 L', plain numbers; nothing said means 0, null if it says something else."""
    said = F.upper(F.trim(F.coalesce(x, F.lit(""))))
    form = r"^(\d+)?\s*(?:L\s+)?(\d+/\d+)?\s*(?:L\.?)?$"
    whole, fraction = F.regexp_extract(said, form, 1).try_cast("double"), F.try_element_at(values_of(FRENCH_FRACTIONS), F.regexp_extract(said, form, 2))
    sum_of = F.coalesce(whole, F.lit(0.0)) + F.coalesce(fraction, F.lit(0.0))
    plain = F.when(said.rlike(r"^\+?(\d+\.?\d*|\.\d+)$"), said.try_cast("double"))
    named = F.nullif(first_match(said, FRENCH_MARGINS, -1.0), F.lit(-1.0))
    return F.when(said == "", F.lit(0.0)).otherwise(F.coalesce(named, F.when(said.rlike(form) & (sum_of > 0), sum_of), plain))


def race_class(name: Column, prize: Column) -> Column:
    """The class from 1 to 7 of a French race: by its name, else by its prize, of which null counts as none."""
    said, money = F.upper(F.coalesce(name, F.lit(""))), F.coalesce(prize, F.lit(0.0))
    out = None
    for test, number in [(said.rlike(p), n) for p, n in FRENCH_CLASSES] + [(money >= least, n) for least, n in FRENCH_PRIZES]:
        out = F.when(test, number) if out is None else out.when(test, number)
    return out.otherwise(7)


def is_maiden(name: Column) -> Column:
    """Whether a French race's name says that its runners haven't run or won."""
    said = F.upper(F.coalesce(name, F.lit("")))
    found = F.lit(False)
    for word in FRENCH_MAIDENS:
        found = found | said.contains(word)
    return found


def surface(course: Column, going: Column) -> Column:
    """'All Weather' where the course's description names an artificial track or the going begins with PSF, else 'Turf'."""
    said = F.upper(F.coalesce(course, F.lit("")))
    artificial = F.startswith(F.upper(F.coalesce(going, F.lit(""))), F.lit("PSF"))
    for word in ARTIFICIAL:
        artificial = artificial | said.contains(word)
    return F.when(artificial, "All Weather").otherwise("Turf")


def allowances(x: Column) -> Column:
    """All 'TWFA age stones-pounds' of a text as a map from age to pounds."""
    pattern = F.lit(r"TWFA\s+(\d+)\s+(\d+)-(\d+)")
    take = lambda i: F.transform(F.regexp_extract_all(x, pattern, F.lit(i)), lambda v: v.cast("int"))
    return F.map_from_entries(F.transform(F.arrays_zip(take(1).alias("age"), take(2).alias("st"), take(3).alias("lb")), lambda e: F.struct(e["age"], e["st"] * 14 + e["lb"])))
