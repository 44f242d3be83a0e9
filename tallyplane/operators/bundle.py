"""The bundle gate: figures, grids, units and values checked against each other and each by itself.

Every check of a single row is a Rule; rows that need their unit get it by one left join, after which all of a
statistic's rules are one projection. Checks across rows are anti joins, group counts or the grid product. Nothing
is collected. Rows carry an explicit ``_line`` (their number in the file), never a generated id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .grid import expected_cells, first_rows, later_duplicates, level_order, union_all
from .rules import Rule, apply, dual_rules, unit_rules, upper

#: Vocabularies of figures and values.
PANEL_STATES = ("MATCHED", "UNLISTED_PANELS_FOUND", "WORKLIST_OVERCOUNTS", "PENDING")
EFFECTS = ("RR", "OR", "RD", "NONE")
DUAL_OK = ("AGREED", "RECONCILED")
COUNT_AGREEMENT = ("MATCH", "FEWER_DETECTED", "MORE_DETECTED", "NO_SOURCE_N")
FIELD_SOURCES = ("DIGITIZED", "TRANSCRIBED")
KENDALL_P = ("KENDALL_EXACT_PERMUTATION", "KENDALL_NORMAL_APPROX_N_GT_200", "SOURCE_P_REQUIRED_TIES")
P_OF = {"PEARSON_R": ("PEARSON_T_TEST", "FISHER_Z_APPROX"), "SPEARMAN_RHO": ("SPEARMAN_T_APPROX", "SOURCE_P_REQUIRED_TIES"), "KENDALL_TAU": KENDALL_P, "R_SQUARED": ("R_SQUARED_F_TEST",), "SLOPE": ("SLOPE_T_TEST",)}
P_COMPUTED = ("PEARSON_T_TEST", "SPEARMAN_T_APPROX", "SLOPE_T_TEST", "R_SQUARED_F_TEST", "FISHER_Z_APPROX", "KENDALL_EXACT_PERMUTATION", "KENDALL_NORMAL_APPROX_N_GT_200")
P_COPIED = ("SOURCE_REPORTED", "SOURCE_P_REQUIRED_TIES")
P_UNTIED = ("KENDALL_EXACT_PERMUTATION", "KENDALL_NORMAL_APPROX_N_GT_200", "SPEARMAN_T_APPROX")
IDENTITY_HUMAN = ("LEGEND_DECLARED", "TEXT_DECLARED", "REVIEWER_INSPECTION")

FIGURE_COLUMNS = ("Figure_ID", "Publication_ID", "Source_File", "Source_Page", "Figure_Number", "Image_Resolution_Or_Hash", "Panel_Reconciliation_Status", "Observed_Panel_Count", "Worklist_Panel_Count", "Unlisted_Panels")
GRID_COLUMNS = ("Grid_ID", "Factor_Name", "Factor_Level", "Level_Order")
UNIT_COLUMNS = ("Unit_ID", "Figure_ID", "Grid_ID", "Panel", "Outcome_Variable", "Unit", "Statistic_Type", "Extraction_Method", "Grid_Rule", "Sparse_Justification", "Dispersion_Type", "Errorbar_Definition_Source", "N_Outcome", "Value_Scale", "Analysis_Transformation", "Transformation_Source", "Distribution_Shape", "Bar_Top_Definition", "Errorbar_Stem_Confirmed", "Axis_X_Scale", "Axis_Y_Scale", "Extractor_1", "Extractor_2", "Independent_Verification_Status", "Discrepancy_Note", *(f"Axis_Calib_{a}{i}_{k}" for a in "XY" for i in (1, 2) for k in ("Value", "Pixel")))
MEASURES = ("Mean", "Dispersion_Value", "Errorbar_Lower", "Errorbar_Upper")
QUANTILES = ("Whisker_Lower", "Q1", "Median", "Q3", "Whisker_Upper")
COUNTS = ("Events", "N_at_Risk", "Events_Comparator", "N_at_Risk_Comparator")
POINTS = ("Detected_Unique_Point_Count", "Point_Count_Agreement", "Overplotting_Possible", "Series_Mask_Overlap_Count")
READINGS = tuple(f"{c}_{r}" for c in ("Mean", "Dispersion", "Median", "Q1", "Q3", "Whisker_Lower", "Whisker_Upper", *COUNTS, "Association_Value") for r in ("R1", "R2"))
VALUE_COLUMNS = ("Unit_ID", "Cell_Key", *MEASURES, *QUANTILES, *COUNTS, "Effect_Measure", "P_Value", "Association_Type", "Association_Value", "CI_Lower", "CI_Upper", "N_Pairs", "P_Value_Method", "P_Value_Extraction_Method", "Ties_Present", "Point_Data_Reference", *POINTS, "Expected_N_From_Source", "N_Cell", "Position_Assignment", "Verification_Status", "Reconciliation_Note", "Identity_Source", "Identity_Evidence_Type", "Resolution_ID", "Auto_Fill_Pattern", "Errorbar_Stem_Confirmed", "Dispersion_Method", *READINGS)
#: What a figure may say of spreads that are bounds or absent.
MEAN_ONLY, BOUND = "MEAN_ONLY", "UPPER_BOUND"


def complete(df: DataFrame, columns) -> DataFrame:
    """df with every column that it lacks as blank text, and a _line in file order if it has none (header is line 1)."""
    have = set(df.columns)
    return df.withColumns({c: F.lit("") for c in columns if c not in have})


def schema_problems(tables: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> list[tuple[str, str, str]]:
    """(table, SCHEMA_INCOMPLETE, missing columns) for each table without its required columns."""
    return [(name, "SCHEMA_INCOMPLETE", ", ".join(c for c in need if c not in df.columns)) for name, (df, need) in tables.items() if any(c not in df.columns for c in need)]


def _num(c: str) -> Column:
    return S.as_number(F.col(c))


def _blank(c: str) -> Column:
    return S.is_blank(F.col(c))


def _numbers(columns, only: Column) -> list[Rule]:
    return [Rule("NON_NUMERIC_VALUE", only & S.is_bad_number(F.col(c)), F.lit(c)) for c in columns]


def _dual(columns: tuple[str, str, str], only: Column, rec: Column, tol: float, exact: bool = False) -> list[Rule]:
    return [Rule(r.code, only & r.when, F.lit(columns[2])) for r in dual_rules(_num(columns[0]), _num(columns[1]), _num(columns[2]), tol, exact, rec)]


def figure_rules() -> list[Rule]:
    status = upper("Panel_Reconciliation_Status")
    seen, listed = _num("Observed_Panel_Count"), _num("Worklist_Panel_Count")
    pending = _blank("Panel_Reconciliation_Status") | (status == "PENDING")
    known = ~pending & status.isin(*PANEL_STATES)
    both = known & seen.isNotNull() & listed.isNotNull()
    whole = (seen > 0) & (listed > 0) & (seen == F.floor(seen)) & (listed == F.floor(listed))
    want = F.when(seen == listed, "MATCHED").when(seen > listed, "UNLISTED_PANELS_FOUND").otherwise("WORKLIST_OVERCOUNTS")
    name = F.trim("Image_Resolution_Or_Hash")
    return [
        *[Rule("MISSING_REQUIRED", _blank(c), F.lit(c)) for c in FIGURE_COLUMNS[:5]],
        Rule("IMAGE_HASH_UNPARSEABLE", (name != "") & ~name.rlike(r"(?i)\d+\s*x\s*\d+") & ~name.rlike(r"(?i)sha256\s*:\s*[0-9a-f]{8,64}")),
        Rule("PANEL_RECONCILIATION_PENDING", pending),
        Rule("BAD_PANEL_RECONCILIATION_STATUS", ~pending & ~status.isin(*PANEL_STATES), status),
        Rule("MISSING_PANEL_COUNT", known & (seen.isNull() | listed.isNull())),
        *[Rule("PANEL_COUNT_INVALID", both & ((v <= 0) | (v != F.floor(v)))) for v in (seen, listed)],
        Rule("PANEL_STATUS_CONTRADICTS_COUNTS", both & whole & (status != want), want),
        Rule("UNLISTED_PANELS_NOT_RECORDED", both & whole & (seen > listed) & _blank("Unlisted_Panels")),
    ]


def identity_rules() -> list[Rule]:
    """Who named a value's series, against what backs it."""
    source, evidence, res = upper("Identity_Source"), upper("Identity_Evidence_Type"), F.trim("Resolution_ID")
    told = (upper("u_Extraction_Method") == "DIGITIZED") & ((source != "") | (evidence != "") | (res != ""))
    human = told & (source == "HUMAN")
    auto = told & (source == "AUTO")
    return [
        Rule("BAD_IDENTITY_SOURCE", told & ~source.isin("AUTO", "HUMAN")),
        Rule("IDENTITY_SOURCE_INCONSISTENT", auto & (evidence != "FILL_MEASURED"), evidence),
        Rule("IDENTITY_SOURCE_INCONSISTENT", auto & (res != ""), res),
        Rule("IDENTITY_SOURCE_INCONSISTENT", human & ~evidence.isin(*IDENTITY_HUMAN), evidence),
        Rule("IDENTITY_RESOLUTION_UNIDENTIFIED", human & (res == "")),
        Rule("IDENTITY_OVERRODE_MEASUREMENT", human & (upper("Auto_Fill_Pattern") != "")),
    ]


def value_rules(dual: bool = False, tolerance_pct: float = 5.0) -> list[Rule]:
    """All checks of one value, with its unit's columns prefixed u_ and its plausible range as u_low, u_high."""
    st, dt, scale = upper("u_Statistic_Type"), upper("u_Dispersion_Type"), upper("u_Value_Scale")
    status, note = upper("Verification_Status"), _blank("Reconciliation_Note")
    rec = (status == "RECONCILED") & ~note
    rules = [Rule("BAD_CELL_VERIFICATION_STATUS", ~_blank("Verification_Status") & ~status.isin(*DUAL_OK), status), Rule("CELL_RECONCILED_WITHOUT_NOTE", (status == "RECONCILED") & note), *identity_rules()]

    c = st == "CONTINUOUS"
    m, sym, lo, hi = (_num(x) for x in MEASURES)
    only_mean, bound = upper("Dispersion_Method") == MEAN_ONLY, upper("Dispersion_Method") == BOUND
    n = F.when(~_blank("N_Cell"), _num("N_Cell")).otherwise(_num("u_N_Outcome"))
    transform, shape = upper("u_Analysis_Transformation"), upper("u_Distribution_Shape")
    huge = c & (scale == "RATIO") & dt.isin("SE", "SEM") & (n > 0) & ~bound & (sym * F.sqrt(n) > F.abs(m) * 1.5)
    out = lambda v: (scale != "CHANGE") & ((v < F.col("u_low")) | (v > F.col("u_high")))
    rules += _numbers((*MEASURES, "Mean_R1", "Mean_R2", "Dispersion_R1", "Dispersion_R2"), c)
    rules += [
        Rule("MISSING_REQUIRED", c & _blank("Mean"), F.lit("Mean")),
        Rule("IMPLAUSIBLE_VALUE", c & out(m), m.cast("string")),
        Rule("MEAN_ONLY_WITH_SPREAD", c & only_mean & (sym.isNotNull() | lo.isNotNull() | hi.isNotNull())),
        Rule("MISSING_DISPERSION", c & dt.isin("SD", "SE", "SEM") & sym.isNull() & (lo.isNull() | hi.isNull()) & ~only_mean),
        Rule("DISPERSION_NONPOSITIVE", c & dt.isin("SD", "SE", "SEM") & (sym <= 0)),
        Rule("ASYMMETRIC_NEEDS_BOUNDS", c & dt.isin("CI95", "IQR", "RANGE") & (lo.isNull() | hi.isNull()) & ~only_mean),
        Rule("NONCONVERTIBLE_NO_VARIANCE", c & (dt == "NO_ERRORBAR")),
        Rule("ERRORBAR_BOUNDS_INVERTED", c & (lo > hi)),
        Rule("MEAN_OUTSIDE_ERRORBAR", c & (lo <= hi) & ((m < lo) | (m > hi))),
        Rule("TRANSFORMED_SCALE_UNRESOLVED", c & (transform == "UNKNOWN")),
        Rule("TRANSFORMED_SCALE_NOT_POOLABLE", c & ~transform.isin("UNTRANSFORMED", "UNKNOWN", ""), transform),
        Rule("SE_IMPLIES_HUGE_SD", huge & (shape == "SYMMETRIC")),
        Rule("DISPERSION_IMPLIES_SKEW", huge & ~shape.isin("SYMMETRIC", "RIGHT_SKEWED", "LEFT_SKEWED")),
    ]

    q = st == "QUANTILE_SUMMARY"
    low, q1, med, q3, high = (_num(x) for x in QUANTILES)
    row = F.filter(F.array(low, q1, med, q3, high), lambda x: x.isNotNull())
    rules += _numbers((*QUANTILES, *(f"{x}_{r}" for x in QUANTILES for r in ("R1", "R2"))), q)
    rules += [
        *[Rule("MISSING_REQUIRED", q & _blank(x), F.lit(x)) for x in QUANTILES[1:4]],
        Rule("WHISKER_HALF_FILLED", q & (low.isNull() != high.isNull())),
        Rule("QUANTILE_ORDER_INVALID", q & (F.size(row) >= 3) & (row != F.array_sort(row))),
        Rule("IMPLAUSIBLE_VALUE", q & out(med), med.cast("string")),
    ]

    b = st == "BINARY_EVENT"
    e, k, ec, kc = (_num(x) for x in COUNTS)
    effect, p = upper("Effect_Measure"), _num("P_Value")
    part = lambda v: (v < 0) | (v != F.floor(v))
    rules += _numbers((*COUNTS, "P_Value"), b)
    rules += [
        *[Rule("MISSING_REQUIRED", b & _blank(x), F.lit(x)) for x in COUNTS[:2]],
        Rule("EVENTS_INVALID", b & part(e)),
        Rule("N_AT_RISK_INVALID", b & (part(k) | (k <= 0))),
        Rule("EVENTS_EXCEED_N", b & (e > k)),
        Rule("BAD_EFFECT_MEASURE", b & (effect != "") & ~effect.isin(*EFFECTS), effect),
        Rule("EVENTS_INVALID", b & part(ec), F.lit("Events_Comparator")),
        Rule("N_AT_RISK_INVALID", b & ((kc <= 0) | (kc != F.floor(kc))), F.lit("N_at_Risk_Comparator")),
        Rule("COMPARATOR_HALF_FILLED", b & (ec.isNull() != kc.isNull())),
        Rule("COMPARATOR_MISSING_FOR_RATIO", b & effect.isin("RR", "OR") & (ec.isNull() | kc.isNull())),
        Rule("EVENTS_EXCEED_N", b & (ec > kc), F.lit("comparator")),
        Rule("P_VALUE_OUT_OF_RANGE", b & ((p < 0) | (p > 1))),
    ]
    rules += association_value_rules()
    if dual:
        d = tolerance_pct
        rules += _dual(("Mean_R1", "Mean_R2", "Mean"), c, rec, d) + _dual(("Dispersion_R1", "Dispersion_R2", "Dispersion_Value"), c & (dt != "NO_ERRORBAR"), rec, d)
        rules += [r for x in QUANTILES for r in _dual((f"{x}_R1", f"{x}_R2", x), q & (low.isNotNull() if x.startswith("Wh") else F.lit(True)), rec, d)]
        rules += [r for x in COUNTS for r in _dual((f"{x}_R1", f"{x}_R2", x), b & (_num(x).isNotNull() if "Comparator" in x else F.lit(True)), rec, 0, exact=True)]
        rules += _dual(("Association_Value_R1", "Association_Value_R2", "Association_Value"), st == "ASSOCIATION", rec, d)
    return rules


def association_value_rules() -> list[Rule]:
    a = upper("u_Statistic_Type") == "ASSOCIATION"
    kind, v, lo, hi = S.association_type(F.col("Association_Type")), _num("Association_Value"), _num("CI_Lower"), _num("CI_Upper")
    least = F.when(kind.isin("PEARSON_R", "SPEARMAN_RHO", "KENDALL_TAU"), -1.0).when(kind == "R_SQUARED", 0.0)
    pairs, p = _num("N_Pairs"), _num("P_Value")
    method = F.when(_blank("P_Value_Method"), "").otherwise(upper("P_Value_Method"))
    every = sorted({x for xs in P_OF.values() for x in xs} | {"SOURCE_REPORTED"})
    wrong = F.lit(False)
    for name, xs in P_OF.items():
        wrong = wrong | ((kind == name) & ~method.isin(*xs, "SOURCE_REPORTED"))
    named = a & method.isin(*every)
    fits = named & ~F.coalesce(wrong, F.lit(False))
    by_n = F.when(pairs <= 200, "KENDALL_EXACT_PERMUTATION").otherwise("KENDALL_NORMAL_APPROX_N_GT_200")
    source = F.when(_blank("P_Value_Extraction_Method"), "").otherwise(upper("P_Value_Extraction_Method"))
    has_p = a & p.isNotNull()
    unit = upper("u_Extraction_Method")
    against = (method.isin(*P_COMPUTED) & (source != "DIGITIZED")) | (method.isin(*P_COPIED) & (source != "TRANSCRIBED"))
    rank, ties = a & kind.isin("SPEARMAN_RHO", "KENDALL_TAU"), S.as_flag(F.col("Ties_Present"))
    digit, agree = a & (unit == "DIGITIZED"), F.when(_blank("Point_Count_Agreement"), "").otherwise(upper("Point_Count_Agreement"))
    unique, overlap = _num("Detected_Unique_Point_Count"), _num("Series_Mask_Overlap_Count")
    outside = lambda x: a & ((x < least) | (x > 1.0)) & least.isNotNull()
    return [
        *_numbers(("Association_Value", "CI_Lower", "CI_Upper", "P_Value", "N_Pairs", "Association_Value_R1", "Association_Value_R2"), a),
        Rule("BAD_ASSOCIATION_TYPE", a & kind.isNull()),
        Rule("MISSING_REQUIRED", a & _blank("Association_Value"), F.lit("Association_Value")),
        Rule("ASSOCIATION_VALUE_OUT_OF_RANGE", outside(v)),
        *[Rule("ASSOCIATION_CI_OUT_OF_RANGE", outside(x)) for x in (lo, hi)],
        Rule("CI_HALF_FILLED", a & (lo.isNull() != hi.isNull())),
        Rule("CI_BOUNDS_INVERTED", a & (lo > hi)),
        Rule("ESTIMATE_OUTSIDE_CI", a & (lo <= hi) & ((v < lo) | (v > hi))),
        Rule("MISSING_REQUIRED", a & pairs.isNull(), F.lit("N_Pairs")),
        Rule("N_PAIRS_TOO_SMALL", a & ((pairs < 3) | (pairs != F.floor(pairs)))),
        Rule("P_VALUE_OUT_OF_RANGE", a & ((p < 0) | (p > 1))),
        Rule("MISSING_P_VALUE_METHOD", a & (method == "")),
        Rule("BAD_P_VALUE_METHOD", a & (method != "") & ~method.isin(*every), method),
        Rule("P_METHOD_WRONG_FOR_STATISTIC", named & wrong, method),
        Rule("P_METHOD_CLAIMS_UNCOMPUTED_P", fits & p.isNull() & (((kind == "KENDALL_TAU") & ~method.isin("SOURCE_P_REQUIRED_TIES", "SOURCE_REPORTED")) | ((kind == "SPEARMAN_RHO") & (method != "SOURCE_P_REQUIRED_TIES")))),
        Rule("P_METHOD_CONTRADICTS_N", fits & (kind == "KENDALL_TAU") & p.isNotNull() & method.isin(*KENDALL_P[:2]) & (method != by_n), by_n),
        Rule("P_METHOD_CLAIMS_UNCOMPUTED_P", a & p.isNull() & method.isin(*P_COMPUTED), method),
        Rule("MISSING_P_VALUE_PROVENANCE", has_p & (source == "")),
        Rule("BAD_P_VALUE_PROVENANCE", has_p & (source != "") & ~source.isin(*FIELD_SOURCES), source),
        Rule("P_PROVENANCE_CONTRADICTS_METHOD", has_p & source.isin(*FIELD_SOURCES) & against),
        Rule("P_PROVENANCE_CONTRADICTS_UNIT", has_p & source.isin(*FIELD_SOURCES) & ~against & (source == "DIGITIZED") & (unit == "TRANSCRIBED")),
        Rule("MISSING_TIES_PRESENT", rank & ties.isNull()),
        Rule("BAD_TIES_PRESENT", rank & (ties == "BAD")),
        Rule("TIES_CONTRADICT_P_METHOD", rank & (((ties == "TRUE") & method.isin(*P_UNTIED)) | ((ties == "FALSE") & (method == "SOURCE_P_REQUIRED_TIES")))),
        Rule("MISSING_POINT_DATA_REFERENCE", digit & _blank("Point_Data_Reference")),
        *[Rule("MISSING_POINT_COUNT_AUDIT", digit & _blank(x), F.lit(x)) for x in POINTS],
        Rule("MISSING_POINT_COUNT_AUDIT", digit & _blank("Expected_N_From_Source") & ~agree.isin("", "NO_SOURCE_N"), F.lit("Expected_N_From_Source")),
        Rule("POINT_COUNT_AUDIT_CONTRADICTS_SOURCE", digit & ~_blank("Expected_N_From_Source") & (agree == "NO_SOURCE_N")),
        Rule("BAD_POINT_COUNT_AGREEMENT", a & (agree != "") & ~agree.isin(*COUNT_AGREEMENT), agree),
        Rule("POINT_COUNT_DISAGREES_WITH_SOURCE", a & agree.isin("FEWER_DETECTED", "MORE_DETECTED"), agree),
        Rule("POINT_COUNT_INCLUDES_COINCIDENT_MARKS", a & (unique < pairs)),
        Rule("SERIES_MASK_OVERLAP", a & (overlap > 0)),
        Rule("BAD_OVERPLOTTING_POSSIBLE", a & (S.as_flag(F.col("Overplotting_Possible")) == "BAD")),
    ]


def check_bundle(figures: DataFrame, grids: DataFrame, units: DataFrame, values: DataFrame, ranges: DataFrame | None = None, dual: bool = False, tolerance_pct: float = 5.0) -> DataFrame:
    """(scope, row_id, code, detail). Each table has a _line; ranges has outcome, low, high (small: its rows are outcomes)."""
    f, g, u, v = complete(figures, FIGURE_COLUMNS), complete(grids, GRID_COLUMNS), complete(units, UNIT_COLUMNS), complete(values, VALUE_COLUMNS)
    f, u = (x.withColumn(k, F.trim(k)) for x, k in ((f, "Figure_ID"), (u, "Unit_ID")))
    v = v.withColumn("Unit_ID", F.trim("Unit_ID"))
    g = g.withColumns({"Grid_ID": F.trim("Grid_ID"), "Factor_Name": upper("Factor_Name"), "Factor_Level": upper("Factor_Level")})
    at = lambda df, scope, code, detail=F.lit(""), key="_line": df.select(F.lit(scope).alias("scope"), F.col(key).cast("string").alias("row_id"), F.lit(code).alias("code"), detail.cast("string").alias("detail"))
    out = [apply(f, figure_rules(), "figures", "_line"), at(later_duplicates(f.where("Figure_ID <> ''"), ["Figure_ID"], ["_line"]), "figures", "DUPLICATE_FIGURE_ID", F.col("Figure_ID"))]

    named = (F.col("Grid_ID") != "") & (F.col("Factor_Name") != "") & (F.col("Factor_Level") != "")
    order = _num("Level_Order")
    sound = g.where(named)
    out += [
        apply(g, [Rule("MISSING_REQUIRED", ~named), Rule("BAD_LEVEL_ORDER", named & (order.isNull() | (order != F.floor(order))))], "grids", "_line"),
        at(later_duplicates(sound, ["Grid_ID", "Factor_Name", "Factor_Level"], ["_line"]), "grids", "DUPLICATE_FACTOR_LEVEL", F.col("Factor_Level")),
        at(level_order(sound.where(order == F.floor(order)).withColumn("_o", order), ["Grid_ID", "Factor_Name"], "_o").where("not contiguous"), "grid", "BAD_LEVEL_ORDER", F.col("Factor_Name"), "Grid_ID"),
    ]

    first_u = first_rows(u.where("Unit_ID <> ''"), ["Unit_ID"])
    own_n = v.where(~_blank("N_Cell")).select("Unit_ID").distinct().withColumn("_own", F.lit(True))
    spreads = v.groupBy("Unit_ID").agg(F.bool_and(upper("Dispersion_Method") == BOUND).alias("_bound"))
    u2 = u.join(own_n, "Unit_ID", "left").join(spreads, "Unit_ID", "left")
    waived = apply(u2, [Rule(r.code, r.when & ~F.coalesce("_own", F.lit(False)) if r.code == "MISSING_REQUIRED" and "N_Outcome" in str(r.detail) else r.when & ~F.coalesce("_bound", F.lit(False)) if r.code == "ERRORBAR_STEM_UNCONFIRMED" else r.when, r.detail) for r in unit_rules()], "units", "_line")
    out += [
        waived,
        at(later_duplicates(u.where("Unit_ID <> ''"), ["Unit_ID"], ["_line"]), "units", "DUPLICATE_UNIT_ID", F.col("Unit_ID")),
        at(u.join(f.select("Figure_ID").distinct(), "Figure_ID", "left_anti"), "units", "UNKNOWN_FIGURE_ID", F.col("Figure_ID")),
        at(u.join(sound.select("Grid_ID").distinct(), "Grid_ID", "left_anti"), "units", "UNKNOWN_GRID_ID", F.col("Grid_ID")),
        at(v.join(first_u.select("Unit_ID"), "Unit_ID", "left_anti"), "values", "UNKNOWN_UNIT_ID", F.col("Unit_ID")),
    ]

    # values with their unit, their grid's factors and levels, and their plausible range
    levels = sound.groupBy("Grid_ID").agg(F.collect_set("Factor_Name").alias("_factors"), F.collect_set(F.concat_ws("=", "Factor_Name", "Factor_Level")).alias("_levels"))
    limits = (ranges.select(F.upper("outcome").alias("_oc"), F.col("low").cast("double").alias("u_low"), F.col("high").cast("double").alias("u_high")) if ranges is not None else None)
    wide = first_u.select(F.col("Unit_ID"), *[F.col(c).alias("u_" + c) for c in UNIT_COLUMNS if c != "Unit_ID"])
    wide = wide.join(S.broadcast_if_small(limits), upper("u_Outcome_Variable") == F.col("_oc"), "left") if limits is not None else wide.withColumns({"u_low": F.lit(None).cast("double"), "u_high": F.lit(None).cast("double")})
    placed = v.join(wide, "Unit_ID").join(levels, F.trim("u_Grid_ID") == F.col("Grid_ID"), "left").join(own_n, "Unit_ID", "left")
    cell = S.parse_cell_key(F.col("Cell_Key"))
    placed = placed.withColumn("_cell", cell).withColumn("_key", S.cell_key(F.col("_cell")))
    factors = F.coalesce("_factors", F.array().cast("array<string>"))
    same = (F.size(F.array_except(F.map_keys("_cell"), factors)) == 0) & (F.size(F.array_except(factors, F.map_keys("_cell"))) == 0)
    fits = F.col("_cell").isNotNull() & same
    stray = F.array_except(F.transform(F.map_entries("_cell"), lambda e: F.concat_ws("=", e["key"], e["value"])), "_levels")
    stem = S.as_flag(F.col("Errorbar_Stem_Confirmed"))
    whisker = fits & (upper("u_Extraction_Method") == "DIGITIZED") & (upper("u_Statistic_Type") == "CONTINUOUS") & (upper("u_Dispersion_Type") != "NO_ERRORBAR") & ~_blank("Dispersion_Value")
    own, measured = _num("N_Cell"), upper("u_Statistic_Type").isin("CONTINUOUS", "QUANTILE_SUMMARY")
    good_own = F.coalesce((own > 0) & (own == F.floor(own)), F.lit(False))
    rules = [
        Rule("BAD_CELL_KEY", F.col("_cell").isNull(), F.col("Cell_Key")),
        Rule("FACTOR_SET_INCONSISTENT", F.col("_cell").isNotNull() & ~same),
        Rule("UNDECLARED_FACTOR_LEVEL", fits & (F.size(stray) > 0), F.array_join(stray, ";")),
        Rule("BAD_ERRORBAR_STEM_FLAG", whisker & (stem == "BAD")),
        Rule("CELL_ERRORBAR_STEM_UNCONFIRMED", whisker & (stem == "FALSE") & (upper("Dispersion_Method") != BOUND)),
        Rule("POSITION_INFERRED", fits & ~_blank("Position_Assignment") & (upper("Position_Assignment") != "DECLARED_ANCHOR")),
        Rule("N_INVALID", fits & measured & ~_blank("N_Cell") & ~good_own, F.lit("N_Cell")),
        Rule("N_CELL_AND_UNIT_N", fits & measured & ~_blank("N_Cell") & good_own & ~_blank("u_N_Outcome")),
        Rule("MISSING_REQUIRED", fits & measured & _blank("N_Cell") & F.coalesce("_own", F.lit(False)) & _blank("u_N_Outcome"), F.lit("N_Cell")),
        *[Rule(r.code, fits & r.when, r.detail) for r in value_rules(dual, tolerance_pct)],
    ]
    out.append(apply(placed, rules, "values", "_line"))
    read = placed.where(fits).select("Unit_ID", "_key", "_line", "_cell")
    out.append(at(later_duplicates(read, ["Unit_ID", "_key"], ["_line"]), "values", "FACTORIAL_CELL_DUPLICATE", F.col("_key")))

    # the declared product against what was read
    expected = first_u.select("Unit_ID", F.trim("Grid_ID").alias("Grid_ID"), upper("Grid_Rule").alias("rule")).join(expected_cells(sound, "Grid_ID", "Factor_Name", "Factor_Level"), "Grid_ID")
    got = read.select("Unit_ID", F.col("_key").alias("cell")).distinct()
    miss = expected.where("rule <> 'SPARSE'").join(got, ["Unit_ID", "cell"], "left_anti").groupBy("Unit_ID").agg(F.concat_ws(",", F.slice(F.array_sort(F.collect_list("cell")), 1, 4)).alias("_d"))
    extra = got.join(expected.select("Unit_ID", "cell"), ["Unit_ID", "cell"], "left_anti").groupBy("Unit_ID").agg(F.min("cell").alias("_d"))
    used = read.select("Unit_ID", F.explode("_cell").alias("fac", "lvl")).distinct()
    unread = first_u.select("Unit_ID", F.trim("Grid_ID").alias("Grid_ID")).join(sound.select("Grid_ID", F.col("Factor_Name").alias("fac"), F.col("Factor_Level").alias("lvl")).distinct(), "Grid_ID").join(used, ["Unit_ID", "fac", "lvl"], "left_anti")
    out += [
        at(miss, "unit", "FACTORIAL_CELL_MISSING", F.col("_d"), "Unit_ID"),
        at(extra, "unit", "UNDECLARED_FACTOR_LEVEL", F.col("_d"), "Unit_ID"),
        at(unread, "unit", "FACTOR_LEVEL_MISSING", F.concat_ws("=", "fac", "lvl"), "Unit_ID"),
    ]
    if dual:
        vs = upper("Independent_Verification_Status")
        out.append(apply(first_u, [Rule("NO_SECOND_EXTRACTOR", _blank("Extractor_2")), Rule("NO_DUAL_EXTRACTION", ~vs.isin(*DUAL_OK)), Rule("RECONCILED_WITHOUT_NOTE", (vs == "RECONCILED") & _blank("Discrepancy_Note"))], "unit", "Unit_ID"))
    return union_all(out)
