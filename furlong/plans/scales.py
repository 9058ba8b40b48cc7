"""Fixed tables of the figure pipeline, and the columns that read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import values_of

METRES = 201.168  # in a furlong
KILOS = 2.20462  # pounds in a kilogram

# Mean allowances by going in seconds a furlong, the seeds of the priors.
GOING_SEEDS = {
    "Hard": -0.25, "Firm": -0.21, "Good To Firm": -0.09, "Good to Firm": -0.09, "Gd/Frm": -0.09, "Good": 0.05, "Good to Yielding": 0.15, "Good To Yielding": 0.15,
    "Yielding": 0.35, "Yielding To Soft": 0.40, "Good to Soft": 0.25, "Good To Soft": 0.25, "Gd/Sft": 0.25, "Soft": 0.51, "Soft To Heavy": 0.65, "Sft/Hvy": 0.65, "Hvy/Sft": 0.65,
    "Heavy": 0.82, "Standard": 0.04, "Std": 0.04, "Standard To Slow": 0.06, "Std/Slow": 0.06, "Standard/Slow": 0.06, "Slow": 0.15, "Standard To Fast": 0.01, "Std/Fast": 0.01, "Fast": -0.03,
}
FRENCH_SEEDS = {
    "Très Sec": -0.25, "Tres Sec": -0.25, "Sec": -0.21, "Très leger": 0.375, "Tres leger": 0.375, "Très Leger": 0.05, "Tres Leger": 0.05, "Bon Léger": 0.02, "Bon Leger": 0.02,
    "Bon léger": 0.195, "Bon leger": 0.195, "Léger": 0.386, "Leger": 0.386, "Bon": 0.118, "Bon Souple": 0.14, "Bon souple": 0.196, "Souple": 0.332, "Très Souple": 0.52, "Tres Souple": 0.52,
    "Très souple": 0.569, "Tres souple": 0.52, "Collant": 0.919, "Lourd": 0.705, "Très lourd": 1.534, "Tres lourd": 1.31, "Très Lourd": 1.31, "Tres Lourd": 1.31,
    "PSF STANDARD": 0.087, "PSF RAPIDE": 0.019, "PSF LENTE": 0.125, "PSF": 0.012, "Standard": 0.06, "Inconnu": 0.143, "": 0.133,
}
GOOD_GOING = ("Good", "Standard", "Good To Firm", "Good to Firm", "Standard To Slow", "Standard to Slow", "Good to Yielding", "Good To Yielding", "Std", "Std/Slow", "Std/Fast", "Standard/Slow")
FRENCH_GOOD_GOING = ("Bon", "Bon Léger", "Bon Leger", "Bon léger", "PSF STANDARD", "PSF RAPIDE")
GOING_GROUPS = {
    "Firm": ("Hard", "Firm", "Fast"),
    "GdFm": ("Gd/Frm", "Good To Firm", "Good to Firm", "Std/Fast"),
    "Good": ("Good", "Standard", "Std"),
    "GdSft": ("Gd/Sft", "Good to Soft", "Good To Yielding", "Good to Yielding", "Std/Slow", "Standard/Slow", "Standard To Slow", "Standard to Slow", "Slow"),
    "Soft": ("Soft", "Yielding", "Yld/Sft", "Sft/Hvy", "Hvy/Sft"),
    "Heavy": ("Heavy",),
}

# Irish courses, whose goings are trusted less; codes of courses outside France; first days of new surfaces.
IRISH = (
    "BALLINROBE", "BELLEWSTOWN", "CLONMEL", "CORK", "CURRAGH", "DOWN ROYAL", "DOWNPATRICK", "DUNDALK", "FAIRYHOUSE", "GALWAY", "GOWRAN PARK", "KILBEGGAN", "KILLARNEY",
    "LAYTOWN", "LEOPARDSTOWN", "LIMERICK", "LISTOWEL", "NAAS", "NAVAN", "PUNCHESTOWN", "ROSCOMMON", "SLIGO", "THURLES", "TIPPERARY", "TRAMORE", "WEXFORD",
)
NOT_FRENCH = ("ASC", "DON", "EPS", "GOO", "HAY", "KEM", "MKT", "NBU", "SDW", "WAR", "YOR", "WVD", "CUR", "DUB", "GAL", "LEO", "BAD", "DUS", "FRA", "KOE", "ZUR", "HPV", "SHT", "F03", "VPR")
SURFACE_CUTOFFS = {"SOUTHWELL": "2022-01-01", "CHELMSFORD CITY": "2022-09-01"}

# Kinds of races over jumps, and words that name them (lower case).
JUMP_RACES = (
    "Maiden Hurdle", "Novices Hurdle", "Handicap Hurdle", "Handicap Chase", "Handicap Novices Chase", "Novices Chase", "Hurdle", "Chase", "NH Flat", "Bumper", "Hunters Chase", "National Hunt Flat", "Beginners Chase",
)
JUMP_WORDS = r"hurdle|chase|bumper|nh flat|national hunt|n\.?h\.?\s"

# Lengths of the margin codes of live results.
LIVE_MARGINS = {"NK": 0.15, "nk": 0.15, "HD": 0.10, "hd": 0.10, "SH": 0.05, "sh": 0.05, "NSE": 0.03, "nse": 0.03}

# Pounds that three- and two-year-olds are allowed, by month at distances in furlongs, and what older horses lose on turf.
AT = (5, 6, 7, 8, 10, 12, 14, 16)
TURF_3 = {
    1: (13, 13, 13, 12, 10, 9, 8, 7), 2: (13, 13, 13, 12, 10, 9, 8, 7), 3: (13, 13, 13, 12, 10, 8, 7, 6), 4: (12, 12, 11, 11, 10, 8, 7, 6), 5: (10, 10, 10, 10, 9, 7, 6, 5), 6: (8, 6, 5, 7, 5, 6, 4, 3),
    7: (7, 3, 2, 3, 2, 4, 1, 0), 8: (6, 2, 1, 2, 1, 1, 1, 0), 9: (5, 5, 4, 5, 4, 3, 3, 2), 10: (5, 4, 4, 4, 4, 4, 4, 4), 11: (3, 3, 3, 4, 4, 3, 3, 3), 12: (3, 3, 3, 4, 4, 3, 3, 3),
}
SAND_3 = {
    1: (13, 12, 8, 10, 6, 9), 2: (14, 12, 10, 11, 6, 10), 3: (13, 11, 8, 9, 6, 4), 4: (14, 15, 8, 11, 7, 7), 5: (9, 10, 9, 8, 7, 5), 6: (9, 12, 11, 11, 5, 5), 7: (8, 9, 8, 10, 5, 2, 0),
    8: (6, 7, 5, 6, 0, 1, 0, 0), 9: (10, 8, 3, 3, 0, 0, 0, 0), 10: (9, 7, 4, 3, 0, 1, 0, 0), 11: (8, 6, 3, 4, 0, 1, 0, 0), 12: (7, 6, 3, 2, 0, 0, 0, 0),
}
TURF_2 = {
    3: (30, 29, 24), 4: (20, 29, 20), 5: (19, 22, 12), 6: (20, 18, 15, 17), 7: (15, 15, 16, 17), 8: (12, 14, 11, 12), 9: (11, 13, 14, 15, 16), 10: (10, 11, 13, 15, 14), 11: (10, 13, 10, 11, 14), 12: (10, 13, 10, 11, 14),
}
SAND_2 = {
    3: (33, 30, 25), 4: (30, 27, 25), 5: (28, 27, 25), 6: (28, 26, 25), 7: (20, 24, 22, 19), 8: (19, 16, 16, 19), 9: (18, 17, 15, 16, 15), 10: (18, 17, 15, 16, 15), 11: (16, 16, 13, 13, 14), 12: (16, 15, 11, 12, 12),
}
OLDER_TURF = {7: -1.0, 8: -1.5, 9: -2.0, 10: -2.5, 11: -3.0, 12: -3.0}
FRENCH_3 = {
    1: (13, 13, 13, 12, 10, 9), 2: (13, 13, 13, 12, 10, 9), 3: (13, 13, 13, 12, 10, 8), 4: (12, 12, 11, 11, 10, 8), 5: (10, 10, 10, 10, 9, 7), 6: (1, 7, 4, 3, 2, 0),
    7: (2, 4, 6, 2, 2, 0), 8: (2, 4, 4, 3, 1, 0), 9: (2, 3, 2, 3, 1, 0), 10: (2, 2, 3, 1, 0, 0), 11: (3, 3, 3, 2, 1, 1), 12: (4, 0, 5, 1, 3, 0),
}
FRENCH_2 = 12.0


def grid_rows(region: str) -> list[tuple[str, int, int, float, float]]:
    """(surface, age, month, furlongs, pounds) of a region: 'UK' or 'France'."""
    if region == "UK":
        tables = [("Turf", 3, TURF_3), ("All Weather", 3, SAND_3), ("Turf", 2, TURF_2), ("All Weather", 2, SAND_2)]
        out = [(s, age, month, float(at), float(lb)) for s, age, table in tables for month, row in table.items() for at, lb in zip(AT, row, strict=False)]
        return out + [("Turf", age, month, 5.0, lb) for age, lb in OLDER_TURF.items() for month in range(1, 13)]
    both = ("Turf", "All Weather")
    return [(s, 3, month, float(at), float(lb)) for s in both for month, row in FRENCH_3.items() for at, lb in zip(AT, row, strict=False)] + [(s, 2, month, 5.0, FRENCH_2) for s in both for month in range(1, 13)]


def age_grid(spark: SparkSession, region: str) -> DataFrame:
    """The allowances of a region as a table; ages that it lacks are allowed nothing."""
    return spark.createDataFrame(grid_rows(region), "surface string, age int, month int, distance double, pounds double")


def going_group(going: Column) -> Column:
    return F.try_element_at(values_of({g: name for name, goings in GOING_GROUPS.items() for g in goings}), going)


def is_jump_race(kind: Column) -> Column:
    return F.coalesce(kind.isin(*JUMP_RACES) | F.lower(kind).rlike(JUMP_WORDS), F.lit(False))


def live_margin(said: Column) -> Column:
    """Lengths of a live result's margin: a code or a number, 0 if it is neither."""
    return F.coalesce(F.try_element_at(values_of(LIVE_MARGINS), F.trim(said)), F.trim(said).try_cast("double"), F.lit(0.0))


def sex_allowance(sex: Column, month: Column) -> Column:
    """Pounds by which fillies and mares are allowed: three from May to September, else five. It is recorded, never added to a figure."""
    return F.when(~F.coalesce(sex.isin("f", "m"), F.lit(False)), 0).when(month.between(5, 9), 3).otherwise(5)


def confidence(allowance: Column) -> Column:
    """How far an allowance is trusted, by its size; low where there is none."""
    return F.when(F.abs(allowance) <= 0.5, "high").when(F.abs(allowance) <= 1.5, "medium").otherwise("low")


def live_confidence(beaten: Column, position: Column, n_races: Column, figure: Column) -> Column:
    """How far a live figure is trusted: provisional with a standard of fewer than thirty races, low when beaten by more than twenty lengths."""
    far = F.coalesce((beaten > 20) & (F.coalesce(position, F.lit(0)) != 1), F.lit(False))
    return F.when(F.coalesce(n_races < 30, F.lit(False)) & figure.isNotNull(), "provisional").when(far, "low").otherwise("high")


def figure_label(figure: Column) -> Column:
    return F.when(figure.isNull(), "").when(figure >= 110, "high").when(figure >= 85, "good").otherwise("avg")
