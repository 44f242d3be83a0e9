"""A declarative rule gate: a rule is data, a list of rules is one projection.

Each rule is a code, a condition and a detail, all column expressions. apply() evaluates every rule in one pass over the
table and explodes the problems, so adding rules adds no scan, join or shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Vocabularies of units.
STATISTICS = ("CONTINUOUS", "BINARY_EVENT", "ASSOCIATION", "QUANTILE_SUMMARY")
EXTRACTION_METHODS = ("DIGITIZED", "TRANSCRIBED")
GRID_RULES = ("FULL", "SPARSE")
DISPERSIONS = ("SD", "SE", "SEM", "CI95", "IQR", "RANGE", "NO_ERRORBAR")
VALUE_SCALES = ("RATIO", "CHANGE")
TRANSFORMATIONS = ("UNTRANSFORMED", "LOG10", "LN", "LOG2", "SQRT", "RECIPROCAL", "RANK", "UNKNOWN")
SHAPES = ("SYMMETRIC", "RIGHT_SKEWED", "LEFT_SKEWED", "UNKNOWN")
BAR_TOPS = ("OUTLINE_CENTER", "FILL_EDGE", "MARKER_CENTER", "NOT_A_BAR", "FILL_ONLY")
AXIS_SCALES = ("LINEAR", "LOG")
#: So many rules fit one generated method that the JIT still compiles.
FEW = 8


@dataclass(frozen=True)
class Rule:
    code: str
    when: Column
    detail: Column | None = None


def apply(table: DataFrame, rules: list[Rule], scope: str, row: str) -> DataFrame:
    """(scope, row_id, code, detail) for every rule that holds of a row; a condition that is null does not hold."""
    hits = [F.when(r.when, F.struct(F.lit(r.code).alias("code"), F.coalesce(r.detail, F.lit("")).alias("detail") if r.detail is not None else F.lit("").alias("detail"))) for r in rules]
    row_id = F.col(row).cast("string")
    if len(rules) <= FEW:
        # exploded whole and then filtered: unlike a filter within the array, both stay in generated code
        each = table.select(row_id.alias("row_id"), F.explode(F.array(*hits)).alias("_p"))
    else:
        # a projection of small methods before explode, which would interpret the rules or take them all into one method; the outer form,
        # as for the other Spark adds a filter by the array's size that works every rule out again (the array is never empty)
        each = table.select(S.in_small_methods(row_id).alias("row_id"), F.array(*hits).alias("_ps")).select("row_id", F.explode_outer("_ps").alias("_p"))
    each = each.where("_p is not null")
    return each.select(F.lit(scope).alias("scope"), "row_id", "_p.code", "_p.detail")


def upper(name: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))))


def in_vocabulary(code: str, name: str, words: tuple[str, ...], only: Column | None = None) -> Rule:
    bad = ~upper(name).isin(*words)
    return Rule(code, bad if only is None else only & bad, F.concat(F.lit(f"{name}="), upper(name)))


def unit_rules() -> list[Rule]:
    """What one unit must declare by itself."""
    st, method, dt = upper("Statistic_Type"), upper("Extraction_Method"), upper("Dispersion_Type")
    measured = st.isin("CONTINUOUS", "QUANTILE_SUMMARY")
    digitized = method == "DIGITIZED"
    n = S.as_number(F.col("N_Outcome"))
    e1, e2 = F.lower(F.trim("Extractor_1")), F.lower(F.trim("Extractor_2"))
    hedge = S.unresolved_marker(F.col("Errorbar_Definition_Source"))
    stem = S.as_flag(F.col("Errorbar_Stem_Confirmed"))
    whisker = digitized & (st == "CONTINUOUS") & (dt != "NO_ERRORBAR")
    rules = [in_vocabulary("BAD_STATISTIC_TYPE", "Statistic_Type", STATISTICS), in_vocabulary("BAD_EXTRACTION_METHOD", "Extraction_Method", EXTRACTION_METHODS), in_vocabulary("BAD_GRID_RULE", "Grid_Rule", GRID_RULES)]
    rules += [Rule("MISSING_REQUIRED", S.is_blank(F.col(c)), F.lit(c)) for c in ("Unit_ID", "Figure_ID", "Grid_ID", "Panel", "Outcome_Variable", "Unit")]
    rules += [
        Rule("SAME_EXTRACTOR", (e1 != "") & (e1 == e2)),
        Rule("SPARSE_WITHOUT_JUSTIFICATION", (upper("Grid_Rule") == "SPARSE") & (S.is_blank(F.col("Sparse_Justification")) | S.unresolved_marker(F.col("Sparse_Justification")).isNotNull())),
        Rule("MISSING_REQUIRED", measured & S.is_blank(F.col("N_Outcome")), F.lit("N_Outcome")),
        Rule("NON_NUMERIC_VALUE", st.isin("CONTINUOUS", "QUANTILE_SUMMARY", "ASSOCIATION") & S.is_bad_number(F.col("N_Outcome")), F.lit("N_Outcome")),
        Rule("N_INVALID", st.isin("CONTINUOUS", "QUANTILE_SUMMARY", "ASSOCIATION") & ((n <= 0) | (n != F.floor(n))), n.cast("string")),
        in_vocabulary("BAD_DISPERSION_TYPE", "Dispersion_Type", DISPERSIONS, measured),
        Rule("BAD_DISPERSION_TYPE", (st == "QUANTILE_SUMMARY") & ~dt.isin("IQR", "RANGE"), F.lit("quantiles need IQR or RANGE")),
        in_vocabulary("BAD_VALUE_SCALE", "Value_Scale", VALUE_SCALES, measured),
        in_vocabulary("BAD_ANALYSIS_TRANSFORMATION", "Analysis_Transformation", TRANSFORMATIONS, measured),
        in_vocabulary("BAD_DISTRIBUTION_SHAPE", "Distribution_Shape", SHAPES, measured),
        Rule("TRANSFORMATION_UNSOURCED", measured & ~upper("Analysis_Transformation").isin("UNTRANSFORMED", "UNKNOWN", "") & S.is_blank(F.col("Transformation_Source"))),
        Rule("NO_ERRORBAR_SOURCE", measured & S.is_blank(F.col("Errorbar_Definition_Source"))),
        Rule("UNRESOLVED_ERRORBAR_DEFINITION", measured & hedge.isNotNull(), hedge),
        Rule("MISSING_BAR_TOP_DEFINITION", digitized & S.is_blank(F.col("Bar_Top_Definition"))),
        Rule("BAD_BAR_TOP_DEFINITION", digitized & ~S.is_blank(F.col("Bar_Top_Definition")) & ~upper("Bar_Top_Definition").isin(*BAR_TOPS)),
        Rule("BAR_TOP_READ_AT_FILL_EDGE", digitized & (upper("Bar_Top_Definition") == "FILL_EDGE")),
        Rule("BAD_ERRORBAR_STEM_FLAG", whisker & (stem == "BAD")),
        Rule("ERRORBAR_STEM_UNCONFIRMED", whisker & ~F.coalesce(stem.isin("TRUE", "BAD"), F.lit(False))),
        Rule("MISSING_PROVENANCE", digitized & S.is_blank(F.col("Extractor_1")), F.lit("Extractor_1")),
    ]
    one_slot = F.coalesce(S.as_number(F.col("Axis_Calib_X1_Value")) == 0, F.lit(False)) & S.is_blank(F.col("Axis_Calib_X2_Value")) & S.is_blank(F.col("Axis_Calib_X2_Pixel"))
    for ax in "XY":
        scale = upper(f"Axis_{ax}_Scale")
        v1, v2, p1, p2 = (S.as_number(F.col(f"Axis_Calib_{ax}{i}_{k}")) for k in ("Value", "Pixel") for i in (1, 2))
        for i in (1, 2):
            for kind in ("Value", "Pixel"):
                c = f"Axis_Calib_{ax}{i}_{kind}"
                asked = digitized & ~one_slot if (ax, i) == ("X", 2) else digitized
                rules += [Rule("MISSING_PROVENANCE", asked & S.is_blank(F.col(c)), F.lit(c)), Rule("NON_NUMERIC_VALUE", asked & S.is_bad_number(F.col(c)), F.lit(c))]
            rules.append(Rule("LOG_AXIS_NONPOSITIVE_CALIBRATION", digitized & (scale == "LOG") & ((v1 if i == 1 else v2) <= 0)))
        rules += [
            Rule(f"{ax}_CALIB_DEGENERATE", digitized & (v1 == v2)),
            Rule(f"{ax}_CALIB_PIXEL_DEGENERATE", digitized & (p1 == p2)),
            Rule("BAD_AXIS_SCALE", digitized & (scale != "") & ~scale.isin(*AXIS_SCALES)),
            Rule("MISSING_PROVENANCE", digitized & S.is_blank(F.col(f"Axis_{ax}_Scale")), F.lit(f"Axis_{ax}_Scale")),
        ]
    return rules


def dual_rules(r1: Column, r2: Column, consensus: Column, tolerance_pct: float = 5.0, exact: bool = False, reconciled: Column | None = None) -> list[Rule]:
    """Two readings of one cell; a recorded reconciliation waives the disagreement, not the consensus' range."""
    open_ = F.lit(True) if reconciled is None else ~F.coalesce(reconciled, F.lit(False))
    apart = r1 != r2 if exact else F.abs(r1 - r2) / F.greatest(F.abs(r1), F.abs(r2), F.lit(1e-9)) * 100 > tolerance_pct
    return [
        Rule("NO_INDEPENDENT_READINGS", r1.isNull() | r2.isNull()),
        Rule("DUAL_READINGS_DISAGREE", open_ & apart),
        Rule("CONSENSUS_OUTSIDE_READINGS", (consensus < F.least(r1, r2) - 1e-9) | (consensus > F.greatest(r1, r2) + 1e-9)),
    ]


def continuous_rules(mean: Column, spread: Column, n: Column, dispersion: Column, scale: Column, shape: Column) -> list[Rule]:
    """A mean with its spread; on a ratio scale a standard deviation of 1.5 times the mean is impossible unless the shape is skewed to the right."""
    sd = F.when(dispersion.isin("SE", "SEM"), spread * F.sqrt(n)).otherwise(spread)
    return [
        Rule("MISSING_VALUE", mean.isNull()),
        Rule("MISSING_DISPERSION", spread.isNull() & (dispersion != "NO_ERRORBAR")),
        Rule("NEGATIVE_DISPERSION", spread < 0),
        Rule("SE_IMPLIES_IMPOSSIBLE_SD", dispersion.isin("SE", "SEM") & (scale == "RATIO") & (shape != "RIGHT_SKEWED") & (sd > 1.5 * F.abs(mean))),
    ]


def quantile_rules(low: Column, q1: Column, median: Column, q3: Column, high: Column) -> list[Rule]:
    return [Rule("QUANTILES_OUT_OF_ORDER", (low > q1) | (q1 > median) | (median > q3) | (q3 > high)), Rule("ZERO_SPREAD", q1 == q3)]


def event_rules(events: Column, n: Column) -> list[Rule]:
    return [Rule("EVENTS_EXCEED_N", events > n), Rule("NEGATIVE_COUNT", (events < 0) | (n < 0)), Rule("N_INVALID", n <= 0), Rule("EVENTS_NOT_WHOLE", events != F.floor(events))]


def range_rules(value: Column, low: Column, high: Column) -> list[Rule]:
    return [Rule("IMPLAUSIBLE_VALUE", (value < low) | (value > high)), Rule("NO_RANGE", low.isNull() & high.isNull())]


def blame(problems: DataFrame, units: DataFrame) -> DataFrame:
    """(unit, code): problems of values and units charge their unit, those of figures and grids all units under them; what cannot be placed charges every unit.

    problems: scope (values, units, figures, grids or anything), key, code. units: unit, figure, grid.
    """
    direct = problems.where(F.col("scope").isin("values", "units")).select(F.col("key").alias("unit"), "code")
    by = lambda scope, col: problems.where(F.col("scope") == scope).join(units, F.col("key") == F.col(col)).select("unit", "code")
    lost = problems.where(~F.col("scope").isin("values", "units", "figures", "grids")).select(F.concat(F.lit("UNATTRIBUTED_QC_SCOPE:"), F.col("scope")).alias("code")).distinct()
    every = units.select("unit").distinct().join(F.broadcast(lost.agg(F.collect_set("code").alias("_c"))), F.lit(True)).select("unit", F.explode("_c").alias("code")) if lost.limit(1).count() else None
    out = direct.unionByName(by("figures", "figure")).unionByName(by("grids", "grid"))
    return (out if every is None else out.unionByName(every)).distinct()


def value_status(failed: Column, panel_state: Column) -> Column:
    """Failed checks first, then a panel that did not pass; a state that nobody gave is no pass."""
    return F.when(failed, "QC_FAILED").when(F.coalesce(panel_state, F.lit("")) != "AUTO_PASS", "PANEL_NOT_PASSED").otherwise("MACHINE_QC_PASSED")


def approvals(reviews: DataFrame, panels: DataFrame, registry: DataFrame, as_of: str) -> DataFrame:
    """panel, approved, reason: the first reason that speaks against a decision.

    reviews: panel, reviewer, decision, digest, reviewed_at (text). panels: panel, digest. registry: reviewer, kind. Two decisions on a panel void both.
    """
    r = reviews.withColumn("_n", F.count("*").over(Window.partitionBy("panel"))).join(panels.select("panel", F.col("digest").alias("_d")), "panel", "left").join(registry.select("reviewer", F.col("kind").alias("_kind")), "reviewer", "left")
    at = F.try_to_timestamp("reviewed_at")
    reason = (
        F.when(F.col("_n") > 1, "DUPLICATE_DECISION")
        .when(F.col("_d").isNull(), "UNKNOWN_PANEL")
        .when(F.col("_kind").isNull(), "UNREGISTERED_REVIEWER")
        .when(F.col("_kind") != "HUMAN", "REVIEWER_NOT_HUMAN")
        .when(~F.col("digest").eqNullSafe(F.col("_d")), "STALE_SUBJECT")
        .when(at.isNull(), "BAD_TIMESTAMP")
        .when(at > F.lit(as_of).cast("timestamp"), "TIMESTAMP_IN_FUTURE")
        .when(F.upper("decision") != "APPROVE", "NOT_APPROVED")
    )
    return r.select("panel", "reviewer", reason.isNull().alias("approved"), reason.alias("reason"))


def digest(rows: DataFrame, by: list[str], line: Column, name: str = "digest") -> DataFrame:
    """SHA-256 over a group's sorted lines, as subjects were recorded at first: the group stands in one row, so it is for small groups; else set_digest."""
    return rows.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias(name))


def set_digest(rows: DataFrame, by: list[str], line: Column, name: str = "digest") -> DataFrame:
    """One digest for a group's lines whatever their order: the number of lines and four sums of 60-bit parts of their SHA-256, so no group is gathered in one row."""
    row = F.sha2(line, 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    sums = rows.groupBy(*by).agg(F.count("*").alias("_n"), *[p.alias(f"_p{i}") for i, p in enumerate(parts)])
    return sums.select(*by, F.sha2(F.concat_ws("|", F.col("_n").cast("string"), *[F.col(f"_p{i}").cast("string") for i in range(4)]), 256).alias(name))
