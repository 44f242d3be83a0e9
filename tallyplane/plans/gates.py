"""Queries of the stand-alone gate. Orders stand for rows of a template; remainders of their keys put every kind of fault into the cells.

The rows are made by one plain SELECT that both engines run; the rules are written twice, as column rules in the library and as SQL here.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import template_gate as K
from .catalog import query, t


def _rows(spark, d, sql, **tables):
    return spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=t(spark, d, "orders"))


def _unnested(base, codes, scope="values", row="_line"):
    """SQL: each code whose condition holds of a row."""
    hits = ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in codes)
    return f"SELECT '{scope}' AS scope, row_id, code FROM (SELECT {row} AS row_id, unnest([{hits}]) AS code FROM ({base})) WHERE code IS NOT NULL"


def _num(c):
    return f"TRY_CAST({c} AS DOUBLE)"


def _blank(c):
    return f"(trim({c}) = '' OR {c} = 'N/A')"


def _bad(c):
    return f"(NOT {_blank(c)} AND {_num(c)} IS NULL)"


_FIXED = "'PUB' AS Publication_ID, 'a.pdf' AS Source_File, '3' AS Source_Page, 'FIG1' AS Figure_Number, 'cap' AS Source_Caption_Verbatim, 'E1' AS Extractor_1"
_DIGI = "CASE WHEN i % 13 = 0 THEN '' ELSE 'img' END AS Source_Image, 'p.tar' AS WPD_Project_File, 'h' AS Image_Resolution_Or_Hash"
_METHOD = "CASE i % 17 WHEN 0 THEN 'GUESSED' WHEN 1 THEN '' WHEN 2 THEN 'TRANSCRIBED' ELSE 'digitized' END AS Extraction_Method"
_STATUS = "CASE i % 5 WHEN 0 THEN 'RECONCILED' WHEN 1 THEN 'AGREED' WHEN 2 THEN 'MAYBE' ELSE '' END AS Independent_Verification_Status, CASE WHEN i % 10 = 0 THEN 'looked again' ELSE '' END AS Discrepancy_Note"
_AXES = "CASE i % 7 WHEN 0 THEN 'LOG' WHEN 1 THEN 'CURVED' ELSE 'LINEAR' END AS Axis_X_Scale, 'LINEAR' AS Axis_Y_Scale, CASE WHEN i % 14 = 0 THEN '-1' ELSE '0.5' END AS Axis_Calib_X1_Value, CASE WHEN i % 19 = 0 THEN '0.5' ELSE '10' END AS Axis_Calib_X2_Value, '0' AS Axis_Calib_Y1_Value, CASE WHEN i % 23 = 0 THEN '0.0' ELSE '5' END AS Axis_Calib_Y2_Value"
_METHOD_SQL = [("BAD_EXTRACTION_METHOD", "Extraction_Method NOT IN ('', 'digitized', 'TRANSCRIBED')"), ("MISSING_REQUIRED", "Extraction_Method = ''"), ("MISSING_PROVENANCE", "Extraction_Method = 'digitized' AND Source_Image = ''")]

_ASSOCIATIONS = f"""SELECT CAST(i AS STRING) AS _line, {_FIXED}, {_DIGI}, {_METHOD}, {_STATUS}, {_AXES}, 'Heart rate' AS Outcome_Variable, 'dose' AS Predictor_Variable,
CASE i % 6 WHEN 0 THEN 'Pearson' WHEN 1 THEN 'spearman rho' WHEN 2 THEN 'R2' WHEN 3 THEN 'eta' WHEN 4 THEN 'slope' ELSE 'kendall-tau' END AS Association_Type,
CASE i % 9 WHEN 0 THEN '1.2' WHEN 1 THEN '-0.3' WHEN 2 THEN 'o.5' WHEN 3 THEN '0.95' ELSE '0.5' END AS Association_Value,
CASE i % 8 WHEN 0 THEN '2' WHEN 1 THEN '7.5' WHEN 2 THEN 'N/A' ELSE '12' END AS N_Pairs,
CASE i % 11 WHEN 0 THEN '' WHEN 1 THEN '0.9' WHEN 2 THEN '-1.4' ELSE '0.2' END AS CI_Lower, CASE i % 12 WHEN 0 THEN '' WHEN 1 THEN '1.1' ELSE '0.8' END AS CI_Upper,
CASE i % 16 WHEN 0 THEN '1.5' WHEN 1 THEN '<.05' ELSE '0.04' END AS P_Value, CASE WHEN i % 4 = 0 THEN '' ELSE '0.5' END AS Association_Value_R1, CASE i % 18 WHEN 0 THEN '' WHEN 1 THEN '0.7' WHEN 2 THEN '0.46' ELSE '0.52' END AS Association_Value_R2
FROM (SELECT o_orderkey AS i FROM orders) x"""

_KIND = "CASE Association_Type WHEN 'Pearson' THEN 'C' WHEN 'spearman rho' THEN 'C' WHEN 'kendall-tau' THEN 'C' WHEN 'R2' THEN 'Q' WHEN 'slope' THEN 'S' END"
_LEAST = f"CASE {_KIND} WHEN 'C' THEN -1.0 WHEN 'Q' THEN 0.0 END"
_MOST = f"CASE WHEN {_KIND} IN ('C', 'Q') THEN 1.0 END"
_V, _LO, _HI, _A1, _A2 = (_num(c) for c in ("Association_Value", "CI_Lower", "CI_Upper", "Association_Value_R1", "Association_Value_R2"))
_ASSOCIATION_SQL = _METHOD_SQL + [
    ("BAD_AXIS_SCALE", "Extraction_Method = 'digitized' AND Axis_X_Scale = 'CURVED'"),
    ("X_CALIB_DEGENERATE", f"Extraction_Method = 'digitized' AND {_num('Axis_Calib_X1_Value')} = {_num('Axis_Calib_X2_Value')}"),
    ("Y_CALIB_DEGENERATE", f"Extraction_Method = 'digitized' AND {_num('Axis_Calib_Y1_Value')} = {_num('Axis_Calib_Y2_Value')}"),
    ("LOG_AXIS_NONPOSITIVE", "Extraction_Method = 'digitized' AND Axis_X_Scale = 'LOG' AND Axis_Calib_X1_Value = '-1'"),
    ("MISSING_REQUIRED", "N_Pairs = 'N/A'"),
    *[("NON_NUMERIC_VALUE", _bad(c)) for c in ("Association_Value", "N_Pairs", "CI_Lower", "CI_Upper", "P_Value", "Association_Value_R1", "Association_Value_R2")],
    ("BAD_ASSOCIATION_TYPE", "Association_Type = 'eta'"),
    ("ASSOCIATION_VALUE_OUT_OF_RANGE", f"{_V} < {_LEAST} OR {_V} > {_MOST}"),
    ("N_PAIRS_TOO_SMALL", f"{_num('N_Pairs')} < 3"),
    ("N_INVALID", f"{_num('N_Pairs')} >= 3 AND {_num('N_Pairs')} <> round({_num('N_Pairs')})"),
    ("CI_HALF_FILLED", "(CI_Lower = '') <> (CI_Upper = '')"),
    ("CI_BOUNDS_INVERTED", f"{_LO} > {_HI}"),
    ("ESTIMATE_OUTSIDE_CI", f"{_LO} <= {_HI} AND ({_V} < {_LO} OR {_V} > {_HI})"),
    ("ASSOCIATION_CI_OUT_OF_RANGE", f"{_LO} IS NOT NULL AND {_HI} IS NOT NULL AND (least({_LO}, {_HI}) < {_LEAST} OR greatest({_LO}, {_HI}) > {_MOST})"),
    ("P_VALUE_OUT_OF_RANGE", f"{_num('P_Value')} NOT BETWEEN 0 AND 1"),
    ("BAD_VERIFICATION_STATUS", "Independent_Verification_Status = 'MAYBE'"),
    ("DUAL_READINGS_DISAGREE", f"abs({_A1} - {_A2}) > 0.05 AND Independent_Verification_Status <> 'RECONCILED'"),
    ("RECONCILED_WITHOUT_NOTE", f"abs({_A1} - {_A2}) > 0.05 AND Independent_Verification_Status = 'RECONCILED' AND Discrepancy_Note = ''"),
    ("CONSENSUS_OUTSIDE_READINGS", f"Independent_Verification_Status <> 'RECONCILED' AND {_A1} IS NOT NULL AND {_A2} IS NOT NULL AND ({_V} < least({_A1}, {_A2}) - 1e-9 OR {_V} > greatest({_A1}, {_A2}) + 1e-9)"),
    ("NO_SECOND_EXTRACTOR", "TRUE"),
    ("NO_INDEPENDENT_READINGS", f"{_A1} IS NULL OR {_A2} IS NULL"),
]


@query(_unnested(_ASSOCIATIONS, _ASSOCIATION_SQL))
def association_template(spark, d):
    return K.check_template(_rows(spark, d, _ASSOCIATIONS), require_dual=True).select("scope", "row_id", "code")


_EVENTS = f"""SELECT CAST(i AS STRING) AS _line, {_FIXED}, {_DIGI}, {_METHOD}, {_STATUS}, 'Syncope' AS Outcome_Variable, 'fainted' AS Event_Definition, 'A' AS Arm, 'POST' AS Exposure_Phase,
CASE i % 9 WHEN 0 THEN '-1' WHEN 1 THEN '2.5' WHEN 2 THEN '30' WHEN 3 THEN 'two' ELSE '4' END AS Events, CASE i % 7 WHEN 0 THEN '0' WHEN 1 THEN '9.5' WHEN 2 THEN 'N/A' ELSE '20' END AS N_at_Risk,
CASE i % 4 WHEN 0 THEN '' ELSE 'B' END AS Arm_Comparator, CASE i % 8 WHEN 0 THEN '' WHEN 4 THEN '' WHEN 1 THEN '50' ELSE '3' END AS Events_Comparator, CASE i % 12 WHEN 0 THEN '' WHEN 4 THEN '' WHEN 1 THEN '-5' ELSE '20' END AS N_at_Risk_Comparator,
CASE i % 6 WHEN 0 THEN 'RR' WHEN 1 THEN 'or' WHEN 2 THEN 'ODDS' WHEN 3 THEN 'RD' ELSE 'HR' END AS Effect_Measure, CASE i % 16 WHEN 0 THEN '-0.1' WHEN 1 THEN 'n.s.' ELSE '0.04' END AS P_Value_Reported,
CASE WHEN i % 10 = 3 THEN '' ELSE '4' END AS Events_R1, CASE WHEN i % 11 = 0 THEN '5' ELSE '4' END AS Events_R2, '20' AS N_at_Risk_R1, '20' AS N_at_Risk_R2, '3' AS Events_Comparator_R1, CASE WHEN i % 13 = 0 THEN '6' ELSE '3' END AS Events_Comparator_R2, '20' AS N_at_Risk_Comparator_R1, '20' AS N_at_Risk_Comparator_R2
FROM (SELECT o_orderkey AS i FROM orders) x"""
_NONE = "(Arm_Comparator = '' AND Events_Comparator = '' AND N_at_Risk_Comparator = '')"
_CELLS = (("Events", "TRUE"), ("N_at_Risk", "TRUE"), ("Events_Comparator", f"NOT {_NONE}"), ("N_at_Risk_Comparator", f"NOT {_NONE}"))
_DIFFER = " OR ".join(f"({on} AND {_num(c + '_R1')} <> {_num(c + '_R2')})" for c, on in _CELLS)
_EVENT_SQL = _METHOD_SQL + [("MISSING_REQUIRED", "N_at_Risk = 'N/A'")] + [("NON_NUMERIC_VALUE", _bad(c)) for c in (*(x + s for x, _ in _CELLS for s in ("", "_R1", "_R2")), "P_Value_Reported")]
for _e, _r in (("Events", "N_at_Risk"), ("Events_Comparator", "N_at_Risk_Comparator")):
    _en, _rn = _num(_e), _num(_r)
    _EVENT_SQL += [("N_AT_RISK_INVALID", f"{_rn} <= 0"), ("N_INVALID", f"{_rn} > 0 AND {_rn} <> round({_rn})"), ("EVENTS_INVALID", f"{_en} < 0 OR {_en} <> round({_en})"), ("EVENTS_EXCEED_N", f"{_en} >= 0 AND {_en} = round({_en}) AND {_rn} > 0 AND {_en} > {_rn}")]
_EVENT_SQL += [
    ("BAD_EFFECT_MEASURE", "Effect_Measure = 'ODDS'"),
    ("COMPARATOR_HALF_FILLED", f"(Arm_Comparator = '' OR Events_Comparator = '' OR N_at_Risk_Comparator = '') AND NOT {_NONE}"),
    ("COMPARATOR_MISSING_FOR_RATIO", f"{_NONE} AND Effect_Measure IN ('RR', 'or', 'HR')"),
    ("P_VALUE_OUT_OF_RANGE", f"{_num('P_Value_Reported')} NOT BETWEEN 0 AND 1"),
    ("BAD_VERIFICATION_STATUS", "Independent_Verification_Status = 'MAYBE'"),
    ("RECONCILED_WITHOUT_NOTE", f"({_DIFFER}) AND Independent_Verification_Status = 'RECONCILED' AND Discrepancy_Note = ''"),
    *[("DUAL_READINGS_DISAGREE", f"{on} AND {_num(c + '_R1')} <> {_num(c + '_R2')} AND Independent_Verification_Status <> 'RECONCILED'") for c, on in _CELLS],
    *[("CONSENSUS_OUTSIDE_READINGS", f"{on} AND {_num(c + '_R1')} = {_num(c + '_R2')} AND {_num(c)} <> {_num(c + '_R1')}") for c, on in _CELLS],
    *[("NO_INDEPENDENT_READINGS", f"{on} AND ({_num(c + '_R1')} IS NULL OR {_num(c + '_R2')} IS NULL)") for c, on in _CELLS],
    ("NO_SECOND_EXTRACTOR", "TRUE"),
]


@query(_unnested(_EVENTS, _EVENT_SQL))
def event_template(spark, d):
    return K.check_template(_rows(spark, d, _EVENTS), require_dual=True).select("scope", "row_id", "code")


_MEANS = f"""SELECT CAST(i AS STRING) AS _line, CAST(c % 5 AS STRING) AS Publication_ID, 'a.pdf' AS Source_File, '3' AS Source_Page, 'FIG' || CAST(c % 7 AS STRING) AS Figure_Number, 'cap' AS Source_Caption_Verbatim, 'E1' AS Extractor_1, {_DIGI}, {_METHOD}, {_STATUS}, {_AXES},
'P' || CAST(c % 3 AS STRING) AS Panel, CASE c % 8 WHEN 0 THEN 'A_CHALLENGE_TIMECOURSE' WHEN 1 THEN 'B_CHALLENGE_2POINT' WHEN 2 THEN 'C_LONGITUDINAL_SERIAL' WHEN 3 THEN 'D_SIMPLE_PREPOST' WHEN 4 THEN 'G_FACTORIAL_CONDITIONS' WHEN 5 THEN CASE WHEN i % 2 = 0 THEN 'F_BINARY_EVENT' ELSE 'D_SIMPLE_PREPOST' END WHEN 6 THEN 'Z' ELSE 'G_FACTORIAL_CONDITIONS' END AS Data_Shape,
CASE c % 4 WHEN 0 THEN 'HR' WHEN 1 THEN 'Cardiac output' WHEN 2 THEN 'Gene X' ELSE 'mean bp (arm)' END AS Outcome_Variable, CASE WHEN i % 29 = 0 THEN 'mmHg' ELSE 'bpm' END AS Unit, 'A' || CAST(c AS STRING) AS Arm,
CASE WHEN c % 8 IN (4, 7) THEN CASE WHEN i % 31 = 0 THEN 'PRE' ELSE 'DURING' END ELSE CASE i % 7 WHEN 0 THEN 'PRE' WHEN 1 THEN 'POST' WHEN 2 THEN 'DURING' WHEN 3 THEN 'PRE' WHEN 4 THEN 'RECOVERY' WHEN 5 THEN 'post' ELSE CASE WHEN c % 3 = 0 THEN 'DELTA' ELSE 'LATER' END END END AS Exposure_Phase,
CASE i % 5 WHEN 0 THEN 'rest' WHEN 1 THEN 'TILT' WHEN 2 THEN 'N/A' ELSE 'stand' END AS Posture_Condition, CASE i % 3 WHEN 0 THEN 't0' WHEN 1 THEN 't1' ELSE CASE WHEN i % 33 = 2 THEN '' ELSE 't2' END END AS Timepoint_Label, CASE WHEN i % 21 = 0 THEN '' WHEN i % 21 = 1 THEN 'day two' ELSE '3' END AS Timepoint_Days,
CASE i % 37 WHEN 0 THEN 'seventy' WHEN 1 THEN '999' WHEN 2 THEN 'N/A' ELSE '70' END AS Mean, CASE i % 11 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '60' ELSE '4' END AS Dispersion_Value, CASE i % 13 WHEN 0 THEN '' WHEN 1 THEN '95' ELSE '60' END AS Errorbar_Lower, CASE i % 12 WHEN 0 THEN '' WHEN 1 THEN '66' ELSE '80' END AS Errorbar_Upper,
CASE i % 10 WHEN 0 THEN 'NO_ERRORBAR' WHEN 1 THEN 'CI95' WHEN 2 THEN 'VAR' WHEN 3 THEN 'SE' WHEN 4 THEN 'sem' ELSE 'SD' END AS Dispersion_Type, CASE i % 14 WHEN 0 THEN 'N/A' WHEN 1 THEN 'probably SEM' ELSE 'means with SD' END AS Errorbar_Definition_Source, CASE i % 17 WHEN 3 THEN '0' WHEN 4 THEN '7.5' WHEN 5 THEN '1' ELSE '12' END AS N_Outcome,
CASE i % 15 WHEN 0 THEN 'LOG10' WHEN 1 THEN 'CUBE' ELSE 'UNTRANSFORMED' END AS Analysis_Transformation, CASE i % 9 WHEN 0 THEN 'MODE' ELSE 'mean' END AS Center_Statistic, CASE i % 8 WHEN 0 THEN 'ROUND' WHEN 1 THEN 'RIGHT_SKEWED' WHEN 2 THEN 'UNKNOWN' ELSE 'SYMMETRIC' END AS Distribution_Shape, CASE WHEN i % 2 = 0 THEN 'text' ELSE '' END AS Transformation_Source,
CASE i % 6 WHEN 0 THEN '' WHEN 1 THEN 'FILL_EDGE' WHEN 2 THEN 'TOP' ELSE 'OUTLINE_CENTER' END AS Bar_Top_Definition, CASE i % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'perhaps' WHEN 2 THEN '' ELSE 'no' END AS Errorbar_Stem_Confirmed,
CASE i % 20 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'DONE' WHEN 2 THEN 'UNLISTED_PANELS_FOUND' ELSE 'MATCHED' END AS Panel_Reconciliation_Status, CASE i % 22 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '5' ELSE '4' END AS Observed_Panel_Count, CASE i % 26 WHEN 0 THEN '' WHEN 1 THEN '2.5' ELSE '4' END AS Worklist_Panel_Count, CASE i % 40 WHEN 2 THEN 'MAP; PAP' WHEN 3 THEN 'PAP / map' WHEN 4 THEN 'HR' ELSE '' END AS Unlisted_Panels,
'70' AS Mean_R1, CASE i % 19 WHEN 0 THEN '90' WHEN 1 THEN '' ELSE '70.5' END AS Mean_R2, CASE WHEN i % 28 = 0 THEN '' ELSE '4' END AS Dispersion_R1, CASE i % 27 WHEN 0 THEN '9' ELSE '4.1' END AS Dispersion_R2, CASE WHEN i % 30 = 0 THEN '' ELSE 'E2' END AS Extractor_2,
'100' AS Axis_Calib_X1_Pixel, CASE WHEN i % 41 = 0 THEN '100.0' ELSE '300' END AS Axis_Calib_X2_Pixel, '400' AS Axis_Calib_Y1_Pixel, CASE WHEN i % 43 = 0 THEN '' ELSE '20' END AS Axis_Calib_Y2_Pixel
FROM (SELECT o_orderkey AS i, o_custkey AS c FROM orders) x"""

_M, _D, _L, _H, _N = (_num(c) for c in ("Mean", "Dispersion_Value", "Errorbar_Lower", "Errorbar_Upper", "N_Outcome"))
_SEEN, _LISTED = _num("Observed_Panel_Count"), _num("Worklist_Panel_Count")
_RANGE = "CASE Outcome_Variable WHEN 'HR' THEN [30, 220] WHEN 'Cardiac output' THEN [1.5, 20] WHEN 'mean bp (arm)' THEN [45, 150] END"
_DIG, _RECON = "Extraction_Method = 'digitized'", "Panel_Reconciliation_Status IN ('MATCHED', 'UNLISTED_PANELS_FOUND')"
_SOUND = f"{_RECON} AND {_SEEN} > 0 AND {_LISTED} > 0 AND {_SEEN} = floor({_SEEN}) AND {_LISTED} = floor({_LISTED})"
_HUGE = f"lower(Dispersion_Type) IN ('se', 'sem') AND Distribution_Shape <> 'RIGHT_SKEWED' AND {_N} > 0 AND {_D} * sqrt(greatest({_N}, 0)) > abs({_M}) * 1.5"
_PHASE = "upper(Exposure_Phase)"
_NOT_OPEN = "Independent_Verification_Status <> 'RECONCILED'"
_R1, _R2, _S1, _S2 = (_num(c) for c in ("Mean_R1", "Mean_R2", "Dispersion_R1", "Dispersion_R2"))
_MEAN_SQL = [
    ("MISSING_REQUIRED", "Extraction_Method = ''"),
    ("MISSING_REQUIRED", "Mean = 'N/A'"),
    ("MISSING_PROVENANCE", "Source_Image = ''"),
    ("MISSING_PROVENANCE", "Axis_Calib_Y2_Pixel = ''"),
    ("BAD_DATA_SHAPE", "Data_Shape = 'Z'"),
    ("WRONG_SCHEMA_FOR_SHAPE", "Data_Shape = 'F_BINARY_EVENT'"),
    ("BAD_EXPOSURE_PHASE", "Exposure_Phase = 'LATER'"),
    ("MISSING_POSTURE_FOR_B", "Data_Shape LIKE 'B%' AND Posture_Condition = 'N/A'"),
    ("MISSING_TIMEPOINT_FOR_A", "Data_Shape LIKE 'A%' AND Timepoint_Days = '' AND Timepoint_Label = ''"),
    ("BAD_EXTRACTION_METHOD", "Extraction_Method = 'GUESSED'"),
    ("MISSING_BAR_TOP_DEFINITION", f"{_DIG} AND Bar_Top_Definition = ''"),
    ("BAD_BAR_TOP_DEFINITION", f"{_DIG} AND Bar_Top_Definition = 'TOP'"),
    ("BAR_TOP_READ_AT_FILL_EDGE", f"{_DIG} AND Bar_Top_Definition = 'FILL_EDGE'"),
    ("BAD_ERRORBAR_STEM_FLAG", f"{_DIG} AND Errorbar_Stem_Confirmed = 'perhaps'"),
    ("ERRORBAR_STEM_UNCONFIRMED", f"{_DIG} AND Errorbar_Stem_Confirmed IN ('', 'no') AND Dispersion_Type <> 'NO_ERRORBAR' AND coalesce({_D}, {_L}, {_H}) IS NOT NULL"),
    ("PANEL_RECONCILIATION_PENDING", "Panel_Reconciliation_Status = 'PENDING'"),
    ("BAD_PANEL_RECONCILIATION_STATUS", "Panel_Reconciliation_Status = 'DONE'"),
    ("MISSING_PANEL_COUNT", f"{_RECON} AND ({_SEEN} IS NULL OR {_LISTED} IS NULL)"),
    ("PANEL_COUNT_INVALID", f"{_RECON} AND {_LISTED} IS NOT NULL AND Observed_Panel_Count = '0'"),
    ("PANEL_COUNT_INVALID", f"{_RECON} AND {_SEEN} IS NOT NULL AND Worklist_Panel_Count = '2.5'"),
    ("PANEL_STATUS_CONTRADICTS_COUNTS", f"{_SOUND} AND Panel_Reconciliation_Status <> CASE WHEN {_SEEN} = {_LISTED} THEN 'MATCHED' WHEN {_SEEN} > {_LISTED} THEN 'UNLISTED_PANELS_FOUND' ELSE 'WORKLIST_OVERCOUNTS' END"),
    ("UNLISTED_PANELS_NOT_RECORDED", f"{_SOUND} AND {_SEEN} > {_LISTED} AND Unlisted_Panels = ''"),
    ("NON_NUMERIC_MEAN", f"{_RANGE} IS NOT NULL AND Mean = 'seventy'"),
    ("IMPLAUSIBLE_VALUE", f"{_PHASE} <> 'DELTA' AND {_M} NOT BETWEEN ({_RANGE})[1] AND ({_RANGE})[2]"),
    ("BAD_DISPERSION_TYPE", "Dispersion_Type = 'VAR'"),
    ("MISSING_DISPERSION", f"Dispersion_Type IN ('SD', 'SE', 'sem') AND {_D} IS NULL AND ({_L} IS NULL OR {_H} IS NULL)"),
    ("ASYMMETRIC_NEEDS_BOUNDS", f"Dispersion_Type = 'CI95' AND ({_L} IS NULL OR {_H} IS NULL)"),
    ("NO_ERRORBAR_SOURCE", "Errorbar_Definition_Source = 'N/A'"),
    ("UNRESOLVED_ERRORBAR_DEFINITION", "Errorbar_Definition_Source = 'probably SEM'"),
    ("BAD_ANALYSIS_TRANSFORMATION", "Analysis_Transformation = 'CUBE'"),
    ("BAD_CENTER_STATISTIC", "Center_Statistic = 'MODE'"),
    ("BAD_DISTRIBUTION_SHAPE", "Distribution_Shape = 'ROUND'"),
    ("TRANSFORMATION_UNSOURCED", "Analysis_Transformation IN ('LOG10', 'CUBE') AND Transformation_Source = ''"),
    ("SE_IMPLIES_HUGE_SD", f"{_HUGE} AND Distribution_Shape = 'SYMMETRIC'"),
    ("DISPERSION_IMPLIES_SKEW", f"{_HUGE} AND Distribution_Shape <> 'SYMMETRIC'"),
    ("NONCONVERTIBLE_NO_VARIANCE", "Dispersion_Type = 'NO_ERRORBAR'"),
    ("DISPERSION_NONPOSITIVE", f"{_D} <= 0"),
    ("N_INVALID", "N_Outcome IN ('0', '7.5')"),
    ("N_ONE_NO_DISPERSION", "N_Outcome = '1' AND Dispersion_Type <> 'NO_ERRORBAR'"),
    ("ERRORBAR_BOUNDS_INVERTED", f"{_L} > {_H}"),
    ("MEAN_OUTSIDE_ERRORBAR", f"{_L} <= {_H} AND {_M} NOT BETWEEN {_L} AND {_H}"),
    ("DUAL_READINGS_DISAGREE", f"{_NOT_OPEN} AND Mean_R2 = '90'"),
    ("CONSENSUS_OUTSIDE_READINGS", f"{_R2} IS NOT NULL AND {_M} NOT BETWEEN least({_R1}, {_R2}) AND greatest({_R1}, {_R2})"),
    ("DUAL_DISPERSION_DISAGREE", f"{_NOT_OPEN} AND {_S1} IS NOT NULL AND Dispersion_R2 = '9'"),
    ("CONSENSUS_DISPERSION_OUTSIDE_READINGS", f"{_S1} IS NOT NULL AND {_D} NOT BETWEEN {_S1} AND {_S2}"),
    *[("NON_NUMERIC_VALUE", _bad(c)) for c in ("Mean", "Timepoint_Days")],
    ("BAD_AXIS_SCALE", "Axis_X_Scale = 'CURVED'"),
    ("X_CALIB_DEGENERATE", f"{_num('Axis_Calib_X1_Value')} = {_num('Axis_Calib_X2_Value')}"),
    ("Y_CALIB_DEGENERATE", "Axis_Calib_Y2_Value = '0.0'"),
    ("X_CALIB_PIXEL_DEGENERATE", "Axis_Calib_X2_Pixel = '100.0'"),
    ("LOG_AXIS_NONPOSITIVE", "Axis_X_Scale = 'LOG' AND Axis_Calib_X1_Value = '-1'"),
    ("NO_SECOND_EXTRACTOR", "Extractor_2 = ''"),
    ("NO_INDEPENDENT_READINGS", "Mean_R2 = ''"),
    ("NO_INDEPENDENT_DISPERSION", "Dispersion_Type <> 'NO_ERRORBAR' AND Dispersion_R1 = ''"),
    ("NO_DUAL_EXTRACTION", "Independent_Verification_Status NOT IN ('AGREED', 'RECONCILED')"),
]


@query(_unnested(_MEANS, _MEAN_SQL))
def mean_template(spark, d):
    """The row rules of the template of means; figures and units have their own queries."""
    return K.check_template(_rows(spark, d, _MEANS), require_dual=True).where("scope = 'values'").select("scope", "row_id", "code")


@query(f"""WITH m AS ({_MEANS}), f AS (SELECT Publication_ID || ' | ' || Figure_Number AS row_id, {_SEEN} AS o, {_LISTED} AS w, list_sort(list_distinct(list_filter([upper(trim(x)) for x in string_split_regex(Unlisted_Panels, '[,;/|]')], lambda x: x <> ''))) AS s FROM m)
SELECT row_id, 'PANEL_COUNT_INCONSISTENT_IN_FIGURE' AS code FROM (SELECT DISTINCT row_id, o, w FROM f WHERE o IS NOT NULL OR w IS NOT NULL) GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT row_id, 'UNLISTED_PANELS_INCONSISTENT_IN_FIGURE' FROM (SELECT DISTINCT row_id, s FROM f WHERE len(s) > 0) GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT Outcome_Variable, 'PLAUSIBILITY_RANGE_NOT_APPLIED' FROM m WHERE {_RANGE} IS NULL AND Mean <> 'N/A' GROUP BY 1""")
def template_figures(spark, d):
    return K.check_template(_rows(spark, d, _MEANS)).where("scope IN ('figure', 'outcome')").select("row_id", "code")


_UNITS = f"""WITH m AS ({_MEANS}), r AS (SELECT concat_ws(' | ', Publication_ID, Figure_Number, Panel, Outcome_Variable, Arm) AS row_id, upper(Data_Shape) AS shape, Unit, upper(Dispersion_Type) AS dt, upper(Exposure_Phase) AS phase, upper(Posture_Condition) AS raw,
CASE WHEN Posture_Condition = 'N/A' THEN '' ELSE upper(Posture_Condition) END AS f1, upper(Timepoint_Label) AS f2, Timepoint_Days = '' AS no_day FROM m),
g AS (SELECT row_id, count(DISTINCT shape) AS shapes, min(shape) AS shape, count(DISTINCT Unit) AS units, count(DISTINCT dt) AS dts, bool_or(phase = 'PRE') AS pre, bool_or(phase IN ('DURING', 'POST', 'RECOVERY')) AS after, bool_or(phase = 'DELTA') AS delta, count(DISTINCT phase) AS phases, bool_and(phase = 'DURING') AS during, bool_or(no_day) AS no_day,
count(DISTINCT CASE WHEN phase = 'PRE' THEN raw END) AS pre_n, count(DISTINCT CASE WHEN f1 <> '' THEN f1 END) AS n1, count(DISTINCT CASE WHEN f2 <> '' THEN f2 END) AS n2, count(DISTINCT CASE WHEN f1 <> '' AND f2 <> '' THEN f1 || '/' || f2 END) AS cells, bool_or(f1 = '' OR f2 = '') AS bare FROM r GROUP BY 1),
b AS (SELECT DISTINCT row_id FROM r GROUP BY row_id, phase, raw HAVING count(*) > 1), gd AS (SELECT DISTINCT row_id FROM r WHERE f1 <> '' AND f2 <> '' GROUP BY row_id, f1, f2 HAVING count(*) > 1), thin AS (SELECT DISTINCT row_id FROM r GROUP BY row_id, phase HAVING count(*) < 2),
p AS (SELECT DISTINCT row_id, phase, raw FROM r), pre AS (SELECT row_id, list_sort(list(raw)) AS s FROM p WHERE phase = 'PRE' GROUP BY 1), fol AS (SELECT row_id, phase, list_sort(list(raw)) AS s FROM p WHERE phase IN ('DURING', 'POST', 'RECOVERY') GROUP BY 1, 2), uneven AS (SELECT DISTINCT row_id FROM pre JOIN fol USING (row_id) WHERE pre.s <> fol.s)
SELECT row_id, code FROM (SELECT row_id, unnest([CASE WHEN shapes > 1 THEN 'MIXED_SHAPE_IN_UNIT' END, CASE WHEN shapes = 1 AND units > 1 THEN 'MIXED_UNIT_IN_UNIT' END, CASE WHEN shapes = 1 AND dts > 1 THEN 'MIXED_DISPERSION_TYPE_IN_UNIT' END,
CASE WHEN shapes = 1 AND shape LIKE 'B%' AND NOT (pre AND after) THEN 'B_PHASE_MISSING' END, CASE WHEN shapes = 1 AND shape LIKE 'B%' AND pre AND after AND row_id IN (SELECT row_id FROM uneven) THEN 'B_POSTURE_SET_ASYMMETRIC' END, CASE WHEN shapes = 1 AND shape LIKE 'B%' AND pre AND after AND pre_n < 2 THEN 'B_GRID_COLLAPSED' END, CASE WHEN shapes = 1 AND shape LIKE 'B%' AND row_id IN (SELECT row_id FROM b) THEN 'B_DUPLICATE_CELL' END,
CASE WHEN shapes = 1 AND shape LIKE 'A%' AND NOT (pre AND after) THEN 'A_PHASE_INCOMPLETE' END, CASE WHEN shapes = 1 AND shape LIKE 'A%' AND row_id IN (SELECT row_id FROM thin) THEN 'A_SINGLE_POINT_SERIES' END, CASE WHEN shapes = 1 AND shape LIKE 'C%' AND NOT pre THEN 'C_NO_BASELINE' END, CASE WHEN shapes = 1 AND shape LIKE 'C%' AND NOT after THEN 'C_NO_FOLLOWUP' END, CASE WHEN shapes = 1 AND shape LIKE 'C%' AND no_day THEN 'C_MISSING_DAYS' END,
CASE WHEN shapes = 1 AND shape LIKE 'D%' AND delta AND phases > 1 THEN 'D_DELTA_MIXED_WITH_LEVELS' END, CASE WHEN shapes = 1 AND shape LIKE 'D%' AND NOT delta AND NOT (pre AND after) THEN 'D_NO_PREPOST_PAIR' END, CASE WHEN shapes = 1 AND shape LIKE 'G%' AND NOT during THEN 'G_PHASE_NOT_DURING' END, CASE WHEN shapes = 1 AND shape LIKE 'G%' AND (n1 < 2 OR n2 < 2) THEN 'G_NOT_A_GRID' END, CASE WHEN shapes = 1 AND shape LIKE 'G%' AND bare THEN 'G_FACTOR_MISSING' END,
CASE WHEN shapes = 1 AND shape LIKE 'G%' AND row_id IN (SELECT row_id FROM gd) THEN 'G_DUPLICATE_CELL' END, CASE WHEN shapes = 1 AND shape LIKE 'G%' AND n1 >= 2 AND n2 >= 2 AND cells < n1 * n2 THEN 'G_INCOMPLETE_GRID' END]) AS code FROM g) WHERE code IS NOT NULL"""


@query(_UNITS)
def template_units(spark, d):
    return K.check_template(_rows(spark, d, _MEANS)).where("scope = 'unit'").select("row_id", "code")
