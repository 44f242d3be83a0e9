"""Cell normalisers as column expressions: blanks, numbers, flags, names, keys, calibration, tiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings that stand for "no value", after trimming and upper-casing.
NULL_SPELLINGS = ("", "NAN", "NONE", "NOT_APPLICABLE", "NOT APPLICABLE", "NA", "N/A", "N.A.", "NIL", "NULL", "-", "--", "—", "–", "없음", "해당없음", "해당 없음", "미적용", "미해당")
#: The same once spaces, dots, slashes, underscores and hyphens are gone.
NULL_COMPACT = ("", "NA", "NAN", "NONE", "NOTAPPLICABLE", "NIL", "NULL")
#: Wording that is a non-answer or a hedge; the first that occurs is named.
UNRESOLVED = ("PLACEHOLDER", "UNRESOLVED", "TBD", "TODO", "UNKNOWN", "UNCLEAR", "NOT STATED", "NOT SPECIFIED", "NOT REPORTED", "NOT GIVEN", "NOT DEFINED", "ASSUMED", "PRESUMED", "GUESS", "FIXME", "XXX", "???", "HARNESS", "INFERRED", "INFERENCE", "PROBABLY", "LIKELY", "PRESUMABLY", "APPEARS TO", "SEEMS TO", "BY ANALOGY", "DEDUCED", "IMPLIED", "SUSPECT", "BELIEVED", "TAKEN TO BE", "INTERPRETED AS")
TRUE_WORDS = ("TRUE", "T", "YES", "Y", "1")
FALSE_WORDS = ("FALSE", "F", "NO", "N", "0")
#: Names of association statistics.
ASSOCIATIONS = {
    "PEARSON_R": "PEARSON_R",
    "PEARSON": "PEARSON_R",
    "PEARSON_CORRELATION": "PEARSON_R",
    "PEARSON_CORRELATION_COEFFICIENT": "PEARSON_R",
    "R": "PEARSON_R",
    "CORRELATION": "PEARSON_R",
    "CORRELATION_COEFFICIENT": "PEARSON_R",
    "SPEARMAN_RHO": "SPEARMAN_RHO",
    "SPEARMAN": "SPEARMAN_RHO",
    "SPEARMAN_CORRELATION": "SPEARMAN_RHO",
    "SPEARMAN_R": "SPEARMAN_RHO",
    "RHO": "SPEARMAN_RHO",
    "RS": "SPEARMAN_RHO",
    "KENDALL_TAU": "KENDALL_TAU",
    "KENDALL": "KENDALL_TAU",
    "TAU": "KENDALL_TAU",
    "R_SQUARED": "R_SQUARED",
    "R2": "R_SQUARED",
    "SLOPE": "SLOPE",
    "REGRESSION_SLOPE": "SLOPE",
    "BETA": "SLOPE",
}
TIERS = ("R0", "R1", "R2", "R3", "R4")
#: The spellings as one pattern, so that a cell is looked at once: whole between white space, or with separators anywhere.
BLANK = r"^({0}({1}){0}|\s*+({2})\s*+)\z".format(r"[\s./\\_-]*+", "|".join(r"[\s./\\_-]*+".join(w) for w in NULL_COMPACT), "|".join(re.escape(w) for w in NULL_SPELLINGS))
NUMBER = r"^\s*+[+-]?(?:{0}\.?(?:{0})?|\.{0})(?:[eE][+-]?{0})?\s*+\z".format(r"[0-9]++(?:_[0-9]++)*+")
#: What a blank and what a number can start with: cells that start otherwise need no pattern.
BLANK_STARTS = " \t\n\x0b\f\r./\\_-" + "".join(sorted({x for w in (*NULL_SPELLINGS, *NULL_COMPACT) for x in (w[:1], w[:1].lower())} - {*"./\\_-", ""}))
NUMBER_STARTS = " \t\n\x0b\f\r+-.0123456789"
#: What most numbers look like: no exponent, no underscore, and too few digits to be infinite.
PLAIN = r"^[+-]?[0-9]{1,100}+(?:\.[0-9]{0,100}+)?\z"


#: Rows of a table that may be broadcast.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows (no more than that and one are counted); beyond, joins shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def in_small_methods(c: Column) -> Column:
    """c as it is. Whole-stage code holds a projection in one method, which the JIT leaves alone beyond 8,000 bytes and Java refuses beyond 64 KB.

    A higher-order function keeps the projection that it stands in out of whole-stage code; Spark then compiles it in small methods.
    """
    return F.get(F.transform(F.array(c), lambda x: x), 0)


def folded(c: Column) -> Column:
    return F.upper(F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"^\s+|\s+$", "")))


def is_blank(c: Column) -> Column:
    """Null, not finite, or one of the null spellings."""
    raw = F.coalesce(c.cast("string"), F.lit(""))
    s = F.upper(raw)
    return F.contains(F.lit(BLANK_STARTS), F.substring(raw, 1, 1)) & s.rlike(BLANK) | s.isin("INFINITY", "-INFINITY") & (F.typeof(c).isin("double", "float"))


def only_space(c: Column) -> Column:
    """The stricter blank of manifests: null, NaN or white space."""
    s = folded(c)
    return (s == "") | (s == "NAN") & F.typeof(c).isin("double", "float")


def as_number(c: Column) -> Column:
    """A finite double, or null for anything else. A trailing type letter is no number; digit groups joined by an underscore are."""
    s = c.cast("string")
    v = F.replace(s, F.lit("_"), F.lit("")).try_cast("double")
    other = F.when(s.rlike(NUMBER), F.when(F.abs(v) < float("inf"), v))
    # the pattern goes first, as a cast that fails raises an error within
    return F.when((s != "") & F.contains(F.lit(NUMBER_STARTS), F.substring(s, 1, 1)), F.when(s.rlike(PLAIN), s.try_cast("double")).otherwise(other))


def is_bad_number(c: Column) -> Column:
    """Text that was meant to be a number and is none."""
    return ~is_blank(c) & as_number(c).isNull()


def as_flag(c: Column) -> Column:
    """TRUE, FALSE, BAD, or null where nobody answered."""
    s = folded(c)
    return F.when(is_blank(c), F.lit(None).cast("string")).when(s.isin(*TRUE_WORDS), "TRUE").when(s.isin(*FALSE_WORDS), "FALSE").otherwise("BAD")


def unresolved_marker(c: Column) -> Column:
    s = F.upper(c.cast("string"))
    return F.when(~is_blank(c), F.coalesce(*[F.when(F.contains(s, F.lit(w)), F.lit(w)) for w in UNRESOLVED]))


def name_set(c: Column) -> Column:
    """Sorted distinct names from a list with commas, semicolons, slashes, bars or wide gaps."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), r"[,;/|]+|\s{2,}"), lambda x: F.upper(F.trim(x)))
    return F.when(is_blank(c), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.filter(parts, lambda x: x != ""))))


def association_type(c: Column) -> Column:
    key = F.regexp_replace(F.trim(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[-_\s]+", " ")), " ", "_")
    pairs = [F.lit(x) for kv in ASSOCIATIONS.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def cell_key(pairs: Column) -> Column:
    """FACTOR=LEVEL;FACTOR=LEVEL from a map, upper-cased and in the order of factors."""
    each = F.transform(F.map_entries(pairs), lambda e: F.concat(F.upper(F.trim(e["key"])), F.lit("="), F.upper(F.trim(e["value"]))))
    return F.array_join(F.array_sort(each), ";")


def parse_cell_key(c: Column) -> Column:
    """The map of a cell key, or null where a part is malformed or a factor comes twice."""
    parts = F.transform(F.split(c, ";"), lambda x: F.split(F.upper(F.trim(x)), "=", 2))
    sound = F.forall(parts, lambda p: (F.size(p) == 2) & (F.trim(p[0]) != "") & (F.trim(p[1]) != "")) & (F.size(F.array_distinct(F.transform(parts, lambda p: F.trim(p[0])))) == F.size(parts))
    return F.when(sound, F.map_from_entries(F.transform(parts, lambda p: F.struct(F.trim(p[0]), F.trim(p[1])))))


def calibrated(px: Column, slope: Column, intercept: Column, scale: Column) -> Column:
    """The value at a pixel; a LOG axis is calibrated on natural logarithms."""
    z = slope * px + intercept
    return F.when(scale == "LOG", F.exp(z)).otherwise(z)


def to_pixel(value: Column, slope: Column, intercept: Column, scale: Column) -> Column:
    return (F.when(scale == "LOG", F.ln(value)).otherwise(value) - intercept) / slope


def half_spread(mean: Column, one: Column, other: Column) -> Column:
    """From the ends of a whisker: half their distance, or the distance of the only end from the mean."""
    return F.when(one.isNotNull() & other.isNotNull(), F.abs(one - other) / 2).otherwise(F.abs(F.coalesce(one, other) - mean))


def worst_tier(*tiers: Column) -> Column:
    """The worst of several review tiers; one that is unknown counts as the worst there is."""
    known = [F.when(t.isin(*TIERS), t).otherwise(F.lit(TIERS[-1])) for t in tiers]
    return F.greatest(*known) if len(known) > 1 else known[0]


def colour_distance(r1, g1, b1, r2, g2, b2) -> Column:
    return F.sqrt((r1 - r2) * (r1 - r2) + (g1 - g2) * (g1 - g2) + (b1 - b2) * (b1 - b2))


def data_shape(challenge: Column, timepoints: Column) -> Column:
    serial = ~is_blank(timepoints) & F.contains(F.upper(timepoints), F.lit("SERIAL"))
    return F.when(~is_blank(challenge) & serial, "A_CHALLENGE_TIMECOURSE").when(~is_blank(challenge), "B_CHALLENGE_2POINT").when(serial, "C_LONGITUDINAL_SERIAL").otherwise("D_SIMPLE_PREPOST")


def orcid_valid(c: Column) -> Column:
    """Format and the ISO 7064 MOD 11-2 check digit."""
    digits = F.regexp_replace(c, "-", "")
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(15)), lambda i: F.substring(digits, i, F.lit(1)).try_cast("int")), F.lit(0), lambda a, d: (a + d) * 2)
    check = (12 - total % 11) % 11
    return c.rlike(r"^[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]$") & (F.substring(digits, 16, 1) == F.when(check == 10, "X").otherwise(check.cast("string")))


def canonical_json(fields: dict[str, Column]) -> Column:
    """A JSON object with its keys in order and every value as text, so that no two rows share it; a null is JSON's null, unlike a blank."""
    return F.to_json(F.struct(*[fields[k].cast("string").alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})
