"""A clean bundle and what single changes must raise."""

import itertools

import pytest

from tallyplane.operators import bundle as B

from .test_operators import CLEAN

FIGURE = {"_line": "2", "Figure_ID": "F1", "Publication_ID": "1", "Source_File": "a.pdf", "Source_Page": "4", "Figure_Number": "FIG1", "Image_Resolution_Or_Hash": "10x10 sha256:0123456789abcdef", "Panel_Reconciliation_Status": "MATCHED", "Observed_Panel_Count": "1", "Worklist_Panel_Count": "1", "Unlisted_Panels": ""}
LEVELS = [("TIMEPOINT", x) for x in ("PRE", "POST")] + [("POSTURE", x) for x in ("SUPINE", "TILT")]
GRIDS = [{"_line": str(i + 2), "Grid_ID": "G1", "Factor_Name": f, "Factor_Level": x, "Level_Order": str(i % 2)} for i, (f, x) in enumerate(LEVELS)]
UNIT = {"_line": "2", **CLEAN}
VALUES = [{"_line": str(i + 2), "Unit_ID": "U1", "Cell_Key": f"TIMEPOINT={t};POSTURE={p}", "Mean": str(60 + i), "Dispersion_Value": "3", "Errorbar_Stem_Confirmed": "TRUE", "Association_Type": "", "N_Cell": ""} for i, (t, p) in enumerate(itertools.product(("PRE", "POST"), ("SUPINE", "TILT")))]


def codes(spark, figure=(), grids=GRIDS, unit=(), values=VALUES, dual=False):
    table = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{c}` string" for c in rows[0]))
    ranges = spark.createDataFrame([("Heart rate", 30, 220)], "outcome string, low int, high int")
    return {r["code"] for r in B.check_bundle(table([FIGURE | dict(figure)]), table(grids), table([UNIT | dict(unit)]), table(values), ranges, dual).select("code").distinct().collect()}


def changed(i, **k):
    return [v | k if j == i else v for j, v in enumerate(VALUES)]


CASES = [
    ({}, set()),
    ({"figure": {"Panel_Reconciliation_Status": "PENDING"}}, {"PANEL_RECONCILIATION_PENDING"}),
    ({"figure": {"Observed_Panel_Count": "2"}}, {"PANEL_STATUS_CONTRADICTS_COUNTS", "UNLISTED_PANELS_NOT_RECORDED"}),
    ({"unit": {"Figure_ID": "F9"}}, {"UNKNOWN_FIGURE_ID"}),
    ({"values": VALUES[:3]}, {"FACTORIAL_CELL_MISSING"}),
    ({"values": VALUES[:2]}, {"FACTORIAL_CELL_MISSING", "FACTOR_LEVEL_MISSING"}),
    ({"values": VALUES + [VALUES[0] | {"_line": "9"}]}, {"FACTORIAL_CELL_DUPLICATE"}),
    ({"values": changed(0, Cell_Key="TIMEPOINT=MID;POSTURE=SUPINE")}, {"UNDECLARED_FACTOR_LEVEL", "FACTORIAL_CELL_MISSING"}),
    ({"values": changed(0, Cell_Key="TIMEPOINT=PRE")}, {"FACTOR_SET_INCONSISTENT", "FACTORIAL_CELL_MISSING"}),
    ({"values": changed(0, Cell_Key="TIMEPOINT")}, {"BAD_CELL_KEY", "FACTORIAL_CELL_MISSING"}),
    ({"values": changed(0, Unit_ID="U9")}, {"UNKNOWN_UNIT_ID", "FACTORIAL_CELL_MISSING"}),
    ({"values": changed(0, Mean="abc")}, {"NON_NUMERIC_VALUE"}),
    ({"values": changed(0, Mean="500")}, {"IMPLAUSIBLE_VALUE"}),
    ({"values": changed(0, Dispersion_Value="0")}, {"DISPERSION_NONPOSITIVE"}),
    ({"values": changed(0, Dispersion_Value="")}, {"MISSING_DISPERSION"}),
    ({"values": changed(0, Dispersion_Value="90")}, {"SE_IMPLIES_HUGE_SD"}),
    ({"values": changed(0, Errorbar_Stem_Confirmed="no")}, {"CELL_ERRORBAR_STEM_UNCONFIRMED"}),
    ({"values": changed(0, N_Cell="4")}, {"N_CELL_AND_UNIT_N"}),
    ({"grids": GRIDS[:3] + [GRIDS[3] | {"Level_Order": "5"}]}, {"BAD_LEVEL_ORDER"}),
    ({"grids": GRIDS + [GRIDS[0] | {"_line": "8", "Level_Order": "2"}]}, {"DUPLICATE_FACTOR_LEVEL"}),
    ({"unit": {"Grid_Rule": "SPARSE", "Sparse_Justification": "supine only"}, "values": VALUES[:3]}, set()),
    ({"dual": True}, {"NO_INDEPENDENT_READINGS", "NO_DUAL_EXTRACTION"}),
]


@pytest.mark.parametrize("change,want", CASES)
def test_bundle(spark, change, want):
    assert codes(spark, **change) == want
