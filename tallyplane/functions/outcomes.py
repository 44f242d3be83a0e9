"""Outcome names folded onto canonical ones, and their plausible ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scalars import broadcast_if_small, is_blank

#: Plausible ranges of outcomes on their own scale.
RANGES = {
    "Heart rate": (30, 220), "Systolic blood pressure": (60, 220), "Diastolic blood pressure": (30, 130), "Mean arterial pressure": (45, 150), "Stroke volume": (15, 200), "Cardiac output": (1.5, 20),
    "Pulse pressure": (10, 100), "Total peripheral resistance": (0.3, 80), "Cerebral blood flow velocity": (15, 120), "MSNA": (2, 100), "Plasma volume": (1200, 5500), "Peak VO2": (8, 80), "HRV RMSSD": (1, 300), "HRV SDNN": (1, 300), "Minute ventilation": (3, 200),
}
#: Other spellings in a curated column; never to be used on prose.
ALIASES = {
    "HR": "Heart rate",
    "HEART RATE": "Heart rate",
    "PULSE RATE": "Heart rate",
    "SBP": "Systolic blood pressure",
    "SYSTOLIC BP": "Systolic blood pressure",
    "SYSTOLIC PRESSURE": "Systolic blood pressure",
    "DBP": "Diastolic blood pressure",
    "DIASTOLIC BP": "Diastolic blood pressure",
    "DIASTOLIC PRESSURE": "Diastolic blood pressure",
    "MAP": "Mean arterial pressure",
    "MEAN BP": "Mean arterial pressure",
    "MEAN ARTERIAL BLOOD PRESSURE": "Mean arterial pressure",
    "SV": "Stroke volume",
    "STROKE INDEX": "Stroke volume",
    "CO": "Cardiac output",
    "CARDIAC INDEX": "Cardiac output",
    "TPR": "Total peripheral resistance",
    "SVR": "Total peripheral resistance",
    "SYSTEMIC VASCULAR RESISTANCE": "Total peripheral resistance",
    "CBFV": "Cerebral blood flow velocity",
    "MCAV": "Cerebral blood flow velocity",
    "MIDDLE CEREBRAL ARTERY VELOCITY": "Cerebral blood flow velocity",
    "MUSCLE SYMPATHETIC NERVE ACTIVITY": "MSNA",
    "PV": "Plasma volume",
    "VO2PEAK": "Peak VO2",
    "PEAK VO2": "Peak VO2",
    "VO2 PEAK": "Peak VO2",
    "VO2MAX": "Peak VO2",
    "RMSSD": "HRV RMSSD",
    "SDNN": "HRV SDNN",
    "VE": "Minute ventilation",
    "MINUTE VENTILATION": "Minute ventilation",
}
#: Wording that names who or when, not what.
GROUP_LABELS = (r"presyncopal", r"nonpresyncopal", r"non-presyncopal", r"\bat presyncope\b", r"\bpresyncope and\b", r"\bpresyncope\b", r"\bfinishers?\b", r"\bnonfinishers?\b", r"\bfainters?\b", r"\bnonfainters?\b", r"\bmen\b", r"\bwomen\b", r"\bmales?\b", r"\bfemales?\b", r"crew ?members?", r"astronauts?", r"cosmonauts?", r"\bsubjects?\b", r"\bparticipants?\b", r"\bcontrols?\b", r"\bresponders?\b", r"\bnonresponders?\b", r"\btolerant\b", r"\bintolerant\b", r"\bbaseline\b", r"\brecovery\b")


def folded(c: Column) -> Column:
    """Without parentheses, single-spaced, upper case."""
    return F.upper(F.trim(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", " "), r"[\s\-_/]+", " ")))


def canonical(c: Column) -> Column:
    """The canonical outcome of a cell, or null."""
    pairs = ALIASES | {name.upper(): name for name in RANGES}
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.when(~is_blank(c), F.try_element_at(table, folded(c)))


def range_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in RANGES.items()], "outcome string, low double, high double")


def with_range(rows: DataFrame, outcome: str, ranges: DataFrame | None = None) -> DataFrame:
    """rows with low and high: the range of the cell as it is written, else of its canonical name. A caller's table of ranges is broadcast only where it is small."""
    r = F.broadcast(range_table(rows.sparkSession)) if ranges is None else broadcast_if_small(ranges)
    exact = r.select(F.col("outcome").alias("_e"), F.col("low").alias("_el"), F.col("high").alias("_eh"))
    known = r.select(F.col("outcome").alias("_k"), F.col("low").alias("_kl"), F.col("high").alias("_kh"))
    both = rows.join(exact, F.col(outcome) == F.col("_e"), "left").join(known, canonical(F.col(outcome)) == F.col("_k"), "left")
    return both.withColumns({"low": F.coalesce("_el", "_kl"), "high": F.coalesce("_eh", "_kh")}).drop("_e", "_el", "_eh", "_k", "_kl", "_kh")


def unranged(rows: DataFrame, outcome: str, ranges: DataFrame | None = None) -> DataFrame:
    """Names without a range and how many rows use them."""
    return with_range(rows, outcome, ranges).where("low is null").groupBy(F.col(outcome).alias("outcome")).agg(F.count("*").alias("n"))


def without_group_labels(caption: Column) -> Column:
    """A caption with who and when blanked out, so that they cannot pose as outcomes."""
    for p in GROUP_LABELS:
        caption = F.regexp_replace(caption, "(?i)" + p, " ")
    return F.trim(F.regexp_replace(caption, r"\s+", " "))
