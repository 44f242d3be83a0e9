"""The stand-alone gate: one table of values, judged row by row, figure by figure and unit by unit.

Three templates (means with spreads, associations, event counts) are told apart by their columns. Row rules are data (rules.apply): one
projection whatever their number; figures and units are two aggregations. Every cell is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import outcomes as O
from ..functions import scalars as S
from .rules import BAR_TOPS, DISPERSIONS, EXTRACTION_METHODS, SHAPES, TRANSFORMATIONS, Rule, apply, upper

#: Vocabularies of the templates.
DATA_SHAPES = ("A_CHALLENGE_TIMECOURSE", "B_CHALLENGE_2POINT", "C_LONGITUDINAL_SERIAL", "D_SIMPLE_PREPOST", "E_SCATTER_ASSOCIATION", "F_BINARY_EVENT", "G_FACTORIAL_CONDITIONS")
PHASES = ("PRE", "DURING", "POST", "RECOVERY", "DELTA", "ASSOCIATION")
FOLLOW_UPS = ("DURING", "POST", "RECOVERY")
ASYMMETRIC = ("CI95", "IQR", "RANGE")
PANEL_STATES = ("MATCHED", "UNLISTED_PANELS_FOUND", "WORKLIST_OVERCOUNTS", "PENDING")
CENTERS = ("MEAN", "MEDIAN")
AGREED = ("AGREED", "RECONCILED")
EFFECTS = ("RR", "OR", "RD", "HR")
CORRELATIONS = ("PEARSON_R", "SPEARMAN_RHO", "KENDALL_TAU")
#: Columns that each template must have, and that a digitized row must fill.
MEAN_REQUIRED = ("Publication_ID", "Source_File", "Source_Page", "Figure_Number", "Data_Shape", "Outcome_Variable", "Unit", "Arm", "Exposure_Phase", "Mean", "Dispersion_Type", "N_Outcome", "Extraction_Method", "Axis_X_Scale", "Axis_Y_Scale", "Axis_Calib_X1_Value", "Axis_Calib_X2_Value", "Axis_Calib_Y1_Value", "Axis_Calib_Y2_Value")
MEAN_PROVENANCE = ("Source_Image", "Source_Caption_Verbatim", "WPD_Project_File", "Image_Resolution_Or_Hash", "Extractor_1", "Axis_Calib_X1_Pixel", "Axis_Calib_X2_Pixel", "Axis_Calib_Y1_Pixel", "Axis_Calib_Y2_Pixel")
ASSOCIATION_REQUIRED = ("Publication_ID", "Source_File", "Source_Page", "Figure_Number", "Outcome_Variable", "Predictor_Variable", "Association_Type", "Association_Value", "N_Pairs", "Extraction_Method", "Extractor_1", "Source_Caption_Verbatim")
ASSOCIATION_DIGITIZED = ("Source_Image", "WPD_Project_File", "Image_Resolution_Or_Hash", "Axis_X_Scale", "Axis_Y_Scale", "Axis_Calib_X1_Value", "Axis_Calib_X2_Value", "Axis_Calib_Y1_Value", "Axis_Calib_Y2_Value")
EVENT_REQUIRED = ("Publication_ID", "Source_File", "Source_Page", "Figure_Number", "Outcome_Variable", "Event_Definition", "Arm", "Exposure_Phase", "Events", "N_at_Risk", "Effect_Measure", "Extraction_Method", "Extractor_1", "Source_Caption_Verbatim")
EVENT_DIGITIZED = ("Source_Image", "WPD_Project_File", "Image_Resolution_Or_Hash")
EVENT_CELLS = ("Events", "N_at_Risk", "Events_Comparator", "N_at_Risk_Comparator")
#: Columns that a template may leave out.
OPTIONAL = ("Posture_Condition", "Timepoint_Label", "Timepoint_Days", "Bar_Top_Definition", "Errorbar_Stem_Confirmed", "Dispersion_Value", "Errorbar_Lower", "Errorbar_Upper", "Panel_Reconciliation_Status", "Observed_Panel_Count", "Worklist_Panel_Count", "Unlisted_Panels", "Errorbar_Definition_Source", "Analysis_Transformation", "Center_Statistic", "Distribution_Shape", "Transformation_Source", "Mean_R1", "Mean_R2", "Dispersion_R1", "Dispersion_R2", "Independent_Verification_Status", "Discrepancy_Note", "Extractor_2", "Panel", "CI_Lower", "CI_Upper", "P_Value", "Association_Value_R1", "Association_Value_R2", "Arm_Comparator", "P_Value_Reported", *(f"{c}_R{i}" for c in EVENT_CELLS for i in (1, 2)), *EVENT_CELLS[2:])


def _n(name: str) -> Column:
    return F.col("_n_" + name)


def _blank(name: str) -> Column:
    return F.col("_b_" + name)


def prepared(rows: DataFrame, line: str = "_line") -> DataFrame:
    """rows with _n_ (its number) and _b_ (whether it is blank) of every text cell: worked out once a cell, whatever the number of rules that ask."""
    cells = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string" and f.name != "_line"]
    kept = [S.in_small_methods(F.col(c)).alias(c) if c == line else F.col(c) for c in rows.columns]
    return rows.select(*kept, *[S.as_number(F.col(c)).alias("_n_" + c) for c in cells], *[S.is_blank(F.col(c)).alias("_b_" + c) for c in cells])


def _numbers(names) -> list[Rule]:
    return [Rule("NON_NUMERIC_VALUE", ~_blank(c) & _n(c).isNull(), F.lit(c)) for c in names]


def _whole(x: Column) -> Column:
    return F.abs(x - F.rint(x)) <= 1e-9


def _outside(x: Column, lo: Column, hi: Column) -> Column:
    return (x < lo - 1e-9) | (x > hi + 1e-9)


def _spans(a: Column, b: Column) -> tuple[Column, Column]:
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.least(a, b)), F.when(both, F.greatest(a, b))


def _axis_rules(only: Column, pixels: bool, log_code: str = "LOG_AXIS_NONPOSITIVE") -> list[Rule]:
    out = []
    for ax in "XY":
        scale, values = upper(f"Axis_{ax}_Scale"), [_n(f"Axis_Calib_{ax}{i}_Value") for i in (1, 2)]
        out += [Rule("BAD_AXIS_SCALE", only & (scale != "") & ~scale.isin("LINEAR", "LOG"), F.lit(ax)), Rule(f"{ax}_CALIB_DEGENERATE", only & (values[0] == values[1]))]
        out += [Rule(log_code, only & (scale == "LOG") & (v <= 0), F.lit(f"{ax}{i + 1}")) for i, v in enumerate(values)]
        if pixels:
            out.append(Rule(f"{ax}_CALIB_PIXEL_DEGENERATE", only & (_n(f"Axis_Calib_{ax}1_Pixel") == _n(f"Axis_Calib_{ax}2_Pixel"))))
    return out


def _method_rules(required, digitized) -> list[Rule]:
    method = upper("Extraction_Method")
    return [
        *[Rule("MISSING_REQUIRED", _blank(c), F.lit(c)) for c in required],
        Rule("BAD_EXTRACTION_METHOD", (method != "") & ~method.isin(*EXTRACTION_METHODS)),
        *[Rule("MISSING_PROVENANCE", (method == "DIGITIZED") & _blank(c), F.lit(c)) for c in digitized],
    ]


def association_rules(require_dual: bool = False) -> list[Rule]:
    kind, value, n = S.association_type(F.col("Association_Type")), _n("Association_Value"), _n("N_Pairs")
    lo, hi, r1, r2 = (_n(c) for c in ("CI_Lower", "CI_Upper", "Association_Value_R1", "Association_Value_R2"))
    least = F.when(kind.isin(*CORRELATIONS), -1.0).when(kind == "R_SQUARED", 0.0)
    most = F.when(least.isNotNull(), 1.0)
    status = upper("Independent_Verification_Status")
    apart, low, high = F.abs(r1 - r2) > 0.05, *_spans(r1, r2)
    rules = _method_rules(ASSOCIATION_REQUIRED, ASSOCIATION_DIGITIZED) + _axis_rules(upper("Extraction_Method") == "DIGITIZED", pixels=False)
    rules += _numbers(("Association_Value", "N_Pairs", "CI_Lower", "CI_Upper", "P_Value", "Association_Value_R1", "Association_Value_R2", *(f"Axis_Calib_{a}{i}_Value" for a in "XY" for i in (1, 2))))
    rules += [
        Rule("BAD_ASSOCIATION_TYPE", ~_blank("Association_Type") & kind.isNull()),
        Rule("ASSOCIATION_VALUE_OUT_OF_RANGE", _outside(value, least, most)),
        Rule("N_PAIRS_TOO_SMALL", n < 3),
        Rule("N_INVALID", (n >= 3) & ~_whole(n)),
        Rule("CI_HALF_FILLED", _blank("CI_Lower") != _blank("CI_Upper")),
        Rule("CI_BOUNDS_INVERTED", lo > hi),
        Rule("ESTIMATE_OUTSIDE_CI", (lo <= hi) & _outside(value, lo, hi)),
        Rule("ASSOCIATION_CI_OUT_OF_RANGE", lo.isNotNull() & hi.isNotNull() & (_outside(lo, least, most) | _outside(hi, least, most))),
        Rule("P_VALUE_OUT_OF_RANGE", (_n("P_Value") < 0) | (_n("P_Value") > 1)),
        Rule("BAD_VERIFICATION_STATUS", (status != "") & ~status.isin(*AGREED)),
        Rule("DUAL_READINGS_DISAGREE", apart & (status != "RECONCILED")),
        Rule("RECONCILED_WITHOUT_NOTE", apart & (status == "RECONCILED") & _blank("Discrepancy_Note")),
        Rule("CONSENSUS_OUTSIDE_READINGS", (status != "RECONCILED") & _outside(value, low, high)),
    ]
    if require_dual:
        rules += [Rule("NO_SECOND_EXTRACTOR", _blank("Extractor_2")), Rule("NO_INDEPENDENT_READINGS", r1.isNull() | r2.isNull())]
    return rules


def event_rules(require_dual: bool = False) -> list[Rule]:
    rules = _method_rules(EVENT_REQUIRED, EVENT_DIGITIZED) + _numbers([*(f"{c}{s}" for c in EVENT_CELLS for s in ("", "_R1", "_R2")), "P_Value_Reported"])
    for ev, at_risk in (EVENT_CELLS[:2], EVENT_CELLS[2:]):
        e, n = _n(ev), _n(at_risk)
        rules += [
            Rule("N_AT_RISK_INVALID", n <= 0, F.lit(at_risk)),
            Rule("N_INVALID", (n > 0) & ~_whole(n), F.lit(at_risk)),
            Rule("EVENTS_INVALID", (e < 0) | ~_whole(e), F.lit(ev)),
            Rule("EVENTS_EXCEED_N", (e >= 0) & _whole(e) & (n > 0) & (e > n), F.lit(ev)),
        ]
    effect, status = upper("Effect_Measure"), upper("Independent_Verification_Status")
    empty = [_blank(c) for c in ("Arm_Comparator", "Events_Comparator", "N_at_Risk_Comparator")]
    none, some = empty[0] & empty[1] & empty[2], empty[0] | empty[1] | empty[2]
    readings = [(c, _n(c), _n(f"{c}_R1"), _n(f"{c}_R2"), F.lit(True) if k < 2 else ~none) for k, c in enumerate(EVENT_CELLS)]
    differ = F.lit(False)
    for _, _, a, b, counts in readings:
        differ = differ | F.coalesce(counts & (a != b), F.lit(False))
    rules += [
        Rule("BAD_EFFECT_MEASURE", (effect != "") & ~effect.isin(*EFFECTS)),
        Rule("COMPARATOR_HALF_FILLED", some & ~none),
        Rule("COMPARATOR_MISSING_FOR_RATIO", none & effect.isin("RR", "OR", "HR")),
        Rule("P_VALUE_OUT_OF_RANGE", (_n("P_Value_Reported") < 0) | (_n("P_Value_Reported") > 1)),
        Rule("BAD_VERIFICATION_STATUS", (status != "") & ~status.isin(*AGREED)),
        Rule("RECONCILED_WITHOUT_NOTE", differ & (status == "RECONCILED") & _blank("Discrepancy_Note")),
    ]
    for c, consensus, a, b, counts in readings:
        rules += [Rule("DUAL_READINGS_DISAGREE", counts & (a != b) & (status != "RECONCILED"), F.lit(c)), Rule("CONSENSUS_OUTSIDE_READINGS", counts & (a == b) & (consensus != a), F.lit(c))]
        if require_dual:
            rules.append(Rule("NO_INDEPENDENT_READINGS", counts & (a.isNull() | b.isNull()), F.lit(c)))
    return rules + ([Rule("NO_SECOND_EXTRACTOR", _blank("Extractor_2"))] if require_dual else [])


def mean_rules(se_ratio: float = 1.5, require_dual: bool = False, provenance: bool = True, tolerance_pct: float = 5.0) -> list[Rule]:
    """Rules of one row of means. It has low and high, the plausible range of its outcome."""
    shape, phase, method, dt = (upper(c) for c in ("Data_Shape", "Exposure_Phase", "Extraction_Method", "Dispersion_Type"))
    mean, spread, lo, hi, n = (_n(c) for c in ("Mean", "Dispersion_Value", "Errorbar_Lower", "Errorbar_Upper", "N_Outcome"))
    digitized = method == "DIGITIZED"
    top, stem = upper("Bar_Top_Definition"), S.as_flag(F.col("Errorbar_Stem_Confirmed"))
    bad_stem = F.coalesce(stem == "BAD", F.lit(False))
    state, seen, listed = upper("Panel_Reconciliation_Status"), _n("Observed_Panel_Count"), _n("Worklist_Panel_Count")
    pending = _blank("Panel_Reconciliation_Status") | (state == "PENDING")
    claimed = ~pending & state.isin(*PANEL_STATES)
    bad_count = lambda x: (x <= 0) | (x != F.floor(x))
    counted = claimed & seen.isNotNull() & listed.isNotNull()
    sound = counted & ~bad_count(seen) & ~bad_count(listed)
    want = F.when(seen == listed, "MATCHED").when(seen > listed, "UNLISTED_PANELS_FOUND").otherwise("WORKLIST_OVERCOUNTS")
    hedge = S.unresolved_marker(F.col("Errorbar_Definition_Source"))
    word = lambda c: F.when(_blank(c), "").otherwise(upper(c))
    scale, center, form = word("Analysis_Transformation"), word("Center_Statistic"), word("Distribution_Shape")
    sd = spread * F.sqrt(F.when(n > 0, n))
    huge = dt.isin("SE", "SEM") & ~form.isin("RIGHT_SKEWED", "LEFT_SKEWED") & (sd > F.abs(mean) * se_ratio)
    status = upper("Independent_Verification_Status")
    m1, m2, d1, d2 = (_n(c) for c in ("Mean_R1", "Mean_R2", "Dispersion_R1", "Dispersion_R2"))
    apart = lambda a, b: F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1e-9)) * 100 > tolerance_pct
    open_ = status != "RECONCILED"
    rules = [Rule("MISSING_REQUIRED", _blank(c), F.lit(c)) for c in MEAN_REQUIRED]
    if provenance:
        rules += [Rule("MISSING_PROVENANCE", _blank(c), F.lit(c)) for c in MEAN_PROVENANCE]
    rules += [
        Rule("BAD_DATA_SHAPE", ~shape.isin(*DATA_SHAPES), shape),
        Rule("WRONG_SCHEMA_FOR_SHAPE", shape.isin(*DATA_SHAPES[4:6])),
        Rule("BAD_EXPOSURE_PHASE", ~phase.isin(*PHASES), phase),
        Rule("MISSING_POSTURE_FOR_B", (shape == DATA_SHAPES[1]) & _blank("Posture_Condition")),
        Rule("MISSING_TIMEPOINT_FOR_A", (shape == DATA_SHAPES[0]) & _blank("Timepoint_Days") & _blank("Timepoint_Label")),
        Rule("BAD_EXTRACTION_METHOD", (method != "") & ~method.isin(*EXTRACTION_METHODS)),
        Rule("MISSING_BAR_TOP_DEFINITION", digitized & _blank("Bar_Top_Definition")),
        Rule("BAD_BAR_TOP_DEFINITION", digitized & ~_blank("Bar_Top_Definition") & ~top.isin(*BAR_TOPS)),
        Rule("BAR_TOP_READ_AT_FILL_EDGE", digitized & (top == "FILL_EDGE")),
        Rule("BAD_ERRORBAR_STEM_FLAG", digitized & bad_stem),
        Rule("ERRORBAR_STEM_UNCONFIRMED", digitized & ~bad_stem & F.coalesce(spread, lo, hi).isNotNull() & (dt != "NO_ERRORBAR") & ~F.coalesce(stem == "TRUE", F.lit(False))),
        Rule("PANEL_RECONCILIATION_PENDING", pending),
        Rule("BAD_PANEL_RECONCILIATION_STATUS", ~pending & ~state.isin(*PANEL_STATES)),
        Rule("MISSING_PANEL_COUNT", claimed & (seen.isNull() | listed.isNull())),
        Rule("PANEL_COUNT_INVALID", counted & bad_count(seen), F.lit("Observed_Panel_Count")),
        Rule("PANEL_COUNT_INVALID", counted & bad_count(listed), F.lit("Worklist_Panel_Count")),
        Rule("PANEL_STATUS_CONTRADICTS_COUNTS", sound & (state != want), want),
        Rule("UNLISTED_PANELS_NOT_RECORDED", sound & (seen > listed) & _blank("Unlisted_Panels")),
        Rule("NON_NUMERIC_MEAN", F.col("low").isNotNull() & ~_blank("Mean") & mean.isNull()),
        Rule("IMPLAUSIBLE_VALUE", (phase != "DELTA") & ((mean < F.col("low")) | (mean > F.col("high")))),
        Rule("BAD_DISPERSION_TYPE", ~dt.isin(*DISPERSIONS)),
        Rule("MISSING_DISPERSION", dt.isin("SD", "SE", "SEM") & spread.isNull() & (lo.isNull() | hi.isNull())),
        Rule("ASYMMETRIC_NEEDS_BOUNDS", dt.isin(*ASYMMETRIC) & (lo.isNull() | hi.isNull())),
        Rule("NO_ERRORBAR_SOURCE", _blank("Errorbar_Definition_Source")),
        Rule("UNRESOLVED_ERRORBAR_DEFINITION", hedge.isNotNull(), hedge),
        Rule("BAD_ANALYSIS_TRANSFORMATION", ~scale.isin(*TRANSFORMATIONS)),
        Rule("BAD_CENTER_STATISTIC", ~center.isin(*CENTERS)),
        Rule("BAD_DISTRIBUTION_SHAPE", ~form.isin(*SHAPES)),
        Rule("TRANSFORMATION_UNSOURCED", ~scale.isin("UNTRANSFORMED", "UNKNOWN", "") & _blank("Transformation_Source")),
        Rule("SE_IMPLIES_HUGE_SD", huge & (form == "SYMMETRIC")),
        Rule("DISPERSION_IMPLIES_SKEW", huge & (form != "SYMMETRIC")),
        Rule("NONCONVERTIBLE_NO_VARIANCE", dt == "NO_ERRORBAR"),
        Rule("DISPERSION_NONPOSITIVE", spread <= 0),
        Rule("N_INVALID", (n < 1) | ~_whole(n)),
        Rule("N_ONE_NO_DISPERSION", (n == 1) & ~dt.isin("NO_ERRORBAR", "")),
        Rule("ERRORBAR_BOUNDS_INVERTED", lo > hi),
        Rule("MEAN_OUTSIDE_ERRORBAR", (lo <= hi) & _outside(mean, lo, hi)),
        Rule("DUAL_READINGS_DISAGREE", open_ & apart(m1, m2)),
        Rule("CONSENSUS_OUTSIDE_READINGS", _outside(mean, *_spans(m1, m2))),
        Rule("DUAL_DISPERSION_DISAGREE", open_ & apart(d1, d2)),
        Rule("CONSENSUS_DISPERSION_OUTSIDE_READINGS", _outside(spread, *_spans(d1, d2))),
    ]
    numbers = ("Observed_Panel_Count", "Worklist_Panel_Count", "Mean", "Dispersion_Value", "N_Outcome", "Errorbar_Lower", "Errorbar_Upper", "Mean_R1", "Mean_R2", "Dispersion_R1", "Dispersion_R2", "Timepoint_Days", *(f"Axis_Calib_{a}{i}_{k}" for a in "XY" for i in (1, 2) for k in ("Value", "Pixel")))
    rules += _numbers(numbers) + _axis_rules(F.lit(True), pixels=True)
    if require_dual:
        rules += [
            Rule("NO_SECOND_EXTRACTOR", _blank("Extractor_2")),
            Rule("NO_INDEPENDENT_READINGS", m1.isNull() | m2.isNull()),
            Rule("NO_INDEPENDENT_DISPERSION", (dt != "NO_ERRORBAR") & (d1.isNull() | d2.isNull())),
            Rule("NO_DUAL_EXTRACTION", ~status.isin(*AGREED)),
        ]
    return rules


def figure_problems(rows: DataFrame) -> DataFrame:
    """(row_id, code): figures whose rows give different panel counts or name different unlisted panels."""
    seen, listed = _n("Observed_Panel_Count"), _n("Worklist_Panel_Count")
    pair = F.when(seen.isNotNull() | listed.isNotNull(), F.struct(seen.alias("o"), listed.alias("w")))
    names = S.name_set(F.col("Unlisted_Panels"))
    by = ("Publication_ID", "Figure_Number")
    g = rows.groupBy(*by).agg(F.size(F.collect_set(pair)).alias("pairs"), F.size(F.collect_set(F.when(F.size(names) > 0, F.array_join(names, "\u0001")))).alias("sets"))
    codes = F.filter(F.array(F.when(F.col("pairs") > 1, "PANEL_COUNT_INCONSISTENT_IN_FIGURE"), F.when(F.col("sets") > 1, "UNLISTED_PANELS_INCONSISTENT_IN_FIGURE")), lambda c: c.isNotNull())
    return g.select(F.concat_ws(" | ", *by).alias("row_id"), F.explode(codes).alias("code"))


UNIT_KEYS = ("Publication_ID", "Figure_Number", "Panel", "Outcome_Variable", "Arm")


def unit_problems(rows: DataFrame) -> DataFrame:
    """(row_id, code): units of mixed shapes, units or spreads, and what each shape needs of its phases and cells.

    Cells are counted first, so a unit's sets hold distinct phases, conditions and times, not its rows.
    """
    cell = lambda c: F.when(_blank(c), "").otherwise(upper(c))
    keyed = rows.select(*UNIT_KEYS, upper("Data_Shape").alias("shape"), F.trim(F.coalesce("Unit", F.lit(""))).alias("unit"), upper("Dispersion_Type").alias("dt"), upper("Exposure_Phase").alias("phase"), upper("Posture_Condition").alias("raw"), cell("Posture_Condition").alias("f1"), cell("Timepoint_Label").alias("f2"), _blank("Timepoint_Days").alias("no_day"))
    cells = keyed.groupBy(*UNIT_KEYS, "shape", "unit", "dt", "phase", "raw", "f1", "f2").agg(F.count("*").alias("n"), F.bool_or("no_day").alias("no_day"))
    texts = lambda c: F.collect_set(F.when(F.col(c) != "", F.col(c)))
    g = cells.groupBy(*UNIT_KEYS).agg(
        F.collect_set("shape").alias("shapes"), F.size(texts("unit")).alias("units"), F.size(texts("dt")).alias("dts"), F.collect_set("phase").alias("phases"), F.bool_or("no_day").alias("no_day"),
        F.collect_set(F.struct("phase", "raw")).alias("conditions"), texts("f1").alias("f1"), texts("f2").alias("f2"),
        F.size(F.collect_set(F.when((F.col("f1") != "") & (F.col("f2") != ""), F.struct("f1", "f2")))).alias("full"), F.bool_or((F.col("f1") == "") | (F.col("f2") == "")).alias("bare"),
    )
    # repeated cells: by phase and condition, by both factors, and the points of a phase
    repeated = lambda keys, name, when: cells.where(when).groupBy(*UNIT_KEYS, *keys).agg(F.sum("n").alias("_n")).groupBy(*UNIT_KEYS).agg(F.max("_n").alias(name), F.min("_n").alias(name + "_least"))
    for keys, name, when in ((("phase", "raw"), "b_most", F.lit(True)), (("f1", "f2"), "g_most", (F.col("f1") != "") & (F.col("f2") != "")), (("phase",), "phase_most", F.lit(True))):
        side = repeated(keys, name, when)
        on = [g[k].eqNullSafe(side[k]) for k in UNIT_KEYS]
        cond = on[0]
        for c in on[1:]:
            cond = cond & c
        g = g.join(side, cond, "left").select(*[g[c] for c in g.columns], side[name], side[name + "_least"])
    shape, phases = F.get("shapes", 0), F.col("phases")
    one, pre = F.size("shapes") == 1, F.array_contains(phases, "PRE")
    after = F.arrays_overlap(phases, F.array(*[F.lit(p) for p in FOLLOW_UPS]))
    of = lambda p: F.array_sort(F.transform(F.filter("conditions", lambda x: x["phase"] == p), lambda x: x["raw"]))
    uneven = F.lit(False)
    for p in FOLLOW_UPS:
        uneven = uneven | (F.array_contains(phases, p) & (of(p) != of("PRE")))
    is_ = lambda k: one & (shape == DATA_SHAPES[k])
    n1, n2 = F.size("f1"), F.size("f2")
    rules = {
        "MIXED_SHAPE_IN_UNIT": ~one,
        "MIXED_UNIT_IN_UNIT": one & (F.col("units") > 1),
        "MIXED_DISPERSION_TYPE_IN_UNIT": one & (F.col("dts") > 1),
        "B_PHASE_MISSING": is_(1) & ~(pre & after),
        "B_POSTURE_SET_ASYMMETRIC": is_(1) & pre & after & uneven,
        "B_GRID_COLLAPSED": is_(1) & pre & after & (F.size(of("PRE")) < 2),
        "B_DUPLICATE_CELL": is_(1) & (F.col("b_most") > 1),
        "A_PHASE_INCOMPLETE": is_(0) & ~(pre & after),
        "A_SINGLE_POINT_SERIES": is_(0) & (F.col("phase_most_least") < 2),
        "C_NO_BASELINE": is_(2) & ~pre,
        "C_NO_FOLLOWUP": is_(2) & ~after,
        "C_MISSING_DAYS": is_(2) & F.col("no_day"),
        "D_DELTA_MIXED_WITH_LEVELS": is_(3) & F.array_contains(phases, "DELTA") & (F.size(phases) > 1),
        "D_NO_PREPOST_PAIR": is_(3) & ~F.array_contains(phases, "DELTA") & ~(pre & after),
        "G_PHASE_NOT_DURING": is_(6) & (phases != F.array(F.lit("DURING"))),
        "G_NOT_A_GRID": is_(6) & ((n1 < 2) | (n2 < 2)),
        "G_FACTOR_MISSING": is_(6) & F.col("bare"),
        "G_DUPLICATE_CELL": is_(6) & (F.col("g_most") > 1),
        "G_INCOMPLETE_GRID": is_(6) & (n1 >= 2) & (n2 >= 2) & (F.col("full") < n1 * n2),
    }
    codes = F.filter(F.array(*[F.when(c, code) for code, c in rules.items()]), lambda c: c.isNotNull())
    return g.select(F.concat_ws(" | ", *[F.coalesce(F.col(k), F.lit("")) for k in UNIT_KEYS]).alias("row_id"), F.explode(codes).alias("code"))


def check_template(rows: DataFrame, line: str = "_line", ranges: DataFrame | None = None, require_dual: bool = False, **options) -> DataFrame:
    """(scope, row_id, code, detail) of a filled template. Which one it is, its columns tell; none that fits is SCHEMA_INCOMPLETE."""
    have = set(rows.columns)
    rows = rows.withColumn(line, S.in_small_methods(F.col(line))) if line in have else rows  # what the caller selects is as wide
    kind = next((k for k, need in (("mean", set(MEAN_REQUIRED)), ("association", {"Association_Value", "N_Pairs"}), ("event", {"Events", "N_at_Risk"})) if need <= have), None)
    need = {"mean": MEAN_REQUIRED, "association": ASSOCIATION_REQUIRED + ASSOCIATION_DIGITIZED, "event": EVENT_REQUIRED + EVENT_DIGITIZED, None: MEAN_REQUIRED}[kind]
    lost = [c for c in need if c not in have]
    if lost:
        return rows.sparkSession.createDataFrame([("table", "-", "SCHEMA_INCOMPLETE", ", ".join(lost))], "scope string, row_id string, code string, detail string")
    more = MEAN_PROVENANCE + OPTIONAL if kind == "mean" else OPTIONAL
    full = prepared(rows.withColumns({c: F.lit(None).cast("string") for c in more if c not in have}), line)
    if kind != "mean":
        return apply(full, association_rules(require_dual) if kind == "association" else event_rules(require_dual), "values", line)
    full = O.with_range(full, "Outcome_Variable", ranges)
    found = apply(full, mean_rules(require_dual=require_dual, **options), "values", line)
    bare = full.where(F.col("low").isNull() & ~_blank("Outcome_Variable") & ~_blank("Mean")).groupBy(F.trim("Outcome_Variable").alias("row_id")).agg(F.count("*").alias("n"))
    parts = [figure_problems(full).select(F.lit("figure").alias("scope"), "row_id", "code", F.lit("").alias("detail")), unit_problems(full).select(F.lit("unit").alias("scope"), "row_id", "code", F.lit("").alias("detail"))]
    parts.append(bare.select(F.lit("outcome").alias("scope"), "row_id", F.lit("PLAUSIBILITY_RANGE_NOT_APPLIED").alias("code"), F.col("n").cast("string").alias("detail")))
    for p in parts:
        found = found.unionByName(p)
    return found
