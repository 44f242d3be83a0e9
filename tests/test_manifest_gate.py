import pytest

from tallyplane.operators import manifest_gate as M
from tallyplane.plans import run

from .test_bundle import FIGURE, GRIDS, UNIT


def table(spark, rows, columns=None):
    if not rows:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{c}` string" for c in rows[0]))


def codes(df):
    return {r["code"] for r in df.collect()}


PERSON = {"_line": "2", "Reviewer_ID": "R1", "Reviewer_Name": "Jane Doe", "Reviewer_Record_Type": "HUMAN", "Contact_Type": "EMAIL", "Reviewer_Contact": "a@b.org", "Registered_By": "John Roe", "Registration_Date": "2024-01-01", "Human_Attestation": "HUMAN_CONFIRMED"}
PANEL = {"_line": "2", "Panel_ID": "p1", "Unit_ID": "U1", "Mark_Type": "LINE_COLOR", "Panel_Mode": "MANUAL", "Panel_X0": "0", "Panel_X1": "100", "Panel_Y0": "0", "Panel_Y1": "200", "Y_Ticks": "0:200;100:0", "Y_Scale": "LINEAR", "Raster_SHA256": "ab"}
SERIES = [{"_line": "2", "Panel_ID": "p1", "Series_ID": "a", "Colour_Hex": "#ff0000", "Colour_Tolerance": "40"}, {"_line": "3", "Panel_ID": "p1", "Series_ID": "b", "Colour_Hex": "#0000ff", "Colour_Tolerance": "40"}]
POSITIONS = [{"_line": str(i + 2), "Panel_ID": "p1", "Position_ID": f"T{i}", "X_Pixel": str(20 + 40 * i)} for i in range(2)]
UNITS = [{"_line": "2", "Unit_ID": "U1", "Panel_ID": "p1", "Statistic_Type": "CONTINUOUS", "N_Outcome": ""}]
READING = {"_line": "2", "Reading_ID": "r1", "Panel_ID": "p1", "Series_ID": "a", "Position_ID": "T0", "Mark_X_Px": "21", "Mark_Y_Px": "100", "Upper_Y_Px": "80", "Lower_Y_Px": "120", "Box_Upper_Y_Px": "", "Box_Lower_Y_Px": "", "End_Basis": "", "Reader_Kind": "PERSON", "Read_By": "R1", "Read_At": "2024-02-01", "Raster_SHA256": "AB"}
OWN = [{"_line": str(i + 2), "Panel_ID": "p1", "Series_ID": s, "Position_ID": "", "N_Outcome": "7", "N_Source": "text"} for i, s in enumerate("ab")]


@pytest.mark.parametrize("change,want", [({}, set()), ({"Reviewer_Name": "GPT4"}, {"REVIEWER_NOT_HUMAN"}), ({"Reviewer_Name": "??"}, {"UNRESOLVED_REVIEWER_IDENTITY"}), ({"Reviewer_Contact": "none@"}, {"BAD_REVIEWER_CONTACT"}), ({"Contact_Type": "ORCID", "Reviewer_Contact": "0000-0002-1825-0098"}, {"BAD_REVIEWER_CONTACT"}), ({"Registration_Date": "soon"}, {"BAD_REGISTRATION_DATE"}), ({"Human_Attestation": "AUTOMATED_AGENT"}, {"REVIEWER_NOT_HUMAN"})])
def test_reviewers(spark, change, want):
    assert codes(M.reviewer_problems(table(spark, [PERSON | change]))) == want


@pytest.mark.parametrize(
    "panel,series,positions,want",
    [
        ({}, SERIES, POSITIONS, set()),
        ({"Panel_X1": "0"}, SERIES, POSITIONS, {"BAD_PANEL_BOX"}),
        ({"Mark_Type": "PIE"}, SERIES, POSITIONS, {"BAD_MARK_TYPE"}),
        ({"Y_Ticks": "0:1"}, SERIES, POSITIONS, {"BAD_AXIS_CALIBRATION"}),
        ({"Y_Ticks": "0:900;1:0"}, SERIES, POSITIONS, {"CALIBRATION_OUTSIDE_PANEL"}),
        ({}, [SERIES[0], SERIES[1] | {"Colour_Hex": "#f00010"}], POSITIONS, {"SERIES_COLOURS_OVERLAP"}),
        ({}, [SERIES[0], SERIES[1] | {"Colour_Hex": "red"}], POSITIONS, {"BAD_SERIES_COLOUR"}),
        ({}, SERIES + [SERIES[0] | {"_line": "9", "Colour_Hex": ""}], POSITIONS, {"DUPLICATE_SERIES_ID"}),
        ({}, SERIES, [POSITIONS[0], POSITIONS[1] | {"X_Pixel": "500"}], {"POSITION_OUTSIDE_PANEL"}),
        ({"Unit_ID": "U9"}, SERIES, POSITIONS, {"UNIT_NOT_FOUND"}),
    ],
)
def test_panels(spark, panel, series, positions, want):
    assert codes(M.panel_problems(table(spark, [PANEL | panel]), table(spark, series), table(spark, positions), table(spark, UNITS))) == want


@pytest.mark.parametrize("own,n,want", [(OWN, "", set()), (OWN[:1], "", {"SERIES_N_PARTIAL"}), (OWN, "5", {"SERIES_N_WITH_UNIT_N"}), (OWN + [OWN[0] | {"_line": "9"}], "", {"SERIES_N_DUPLICATE"}), (OWN + [OWN[0] | {"_line": "9", "Position_ID": "T0"}], "", {"SERIES_N_LEVEL_MIXED"}), ([OWN[0] | {"N_Outcome": "x"}], "", {"SERIES_N_BAD"}), (OWN + [OWN[0] | {"_line": "9", "Panel_ID": "z"}], "", {"SERIES_N_PANEL_UNKNOWN"})])
def test_own_n(spark, own, n, want):
    assert codes(M.own_n_problems(table(spark, own), table(spark, [PANEL]), table(spark, SERIES), table(spark, POSITIONS), table(spark, [UNITS[0] | {"N_Outcome": n}]))) == want


@pytest.mark.parametrize(
    "change,want",
    [
        ({}, set()),
        ({"Reading_ID": "a b"}, {"SUPPLIED_READING_ID_BAD"}),
        ({"Panel_ID": "z"}, {"SUPPLIED_READING_PANEL_UNKNOWN"}),
        ({"Series_ID": "z"}, {"SUPPLIED_READING_SERIES_UNKNOWN"}),
        ({"Position_ID": "z"}, {"SUPPLIED_READING_POSITION_UNKNOWN"}),
        ({"Box_Upper_Y_Px": "90"}, {"SUPPLIED_READING_BOX_ON_MEAN"}),
        ({"Mark_X_Px": "55"}, {"SUPPLIED_READING_NOT_AT_ITS_POSITION"}),
        ({"Upper_Y_Px": "110"}, {"SUPPLIED_READING_ENDS_INVERTED"}),
        ({"Lower_Y_Px": "300"}, {"SUPPLIED_READING_OUTSIDE_PANEL"}),
        ({"Read_By": "R9"}, {"SUPPLIED_READER_NOT_REGISTERED"}),
        ({"Read_At": "2999-01-01"}, {"SUPPLIED_READING_DATE_FUTURE"}),
        ({"End_Basis": "NONE"}, {"SUPPLIED_END_NONE_WITH_END"}),
        ({"Raster_SHA256": "cd"}, {"SUPPLIED_READING_RASTER_MISMATCH"}),
        ({"Mark_Y_Px": "x"}, {"SUPPLIED_READING_PIXEL_BAD"}),
    ],
)
def test_readings(spark, change, want):
    rows = [READING | change, READING | {"_line": "3", "Reading_ID": "r2", "Series_ID": "b"}]
    assert codes(M.reading_problems(table(spark, rows), table(spark, [PANEL]), table(spark, SERIES), table(spark, POSITIONS), table(spark, UNITS), table(spark, [PERSON]), "2025-01-01")) == want


def test_run(spark):
    cells = [(s, p) for s in ("SUPINE", "TILT") for p in ("PRE", "POST")]
    t = {
        "figures": table(spark, [FIGURE]),
        "grids": table(spark, GRIDS),
        "units": table(spark, [UNIT, UNIT | {"_line": "3", "Unit_ID": "U2"}]),
        "panels": table(spark, [{"panel": "p1", "unit": "U1", "y_ticks": "0:200;100:0", "y_scale": "LINEAR", "source_panel": "s1"}, {"panel": "p2", "unit": "U2", "y_ticks": "0:200;100:0", "y_scale": "LINEAR", "source_panel": "s2"}]),
        "series": table(spark, [{"panel": p, "series": s, "factor": "posture", "level": s} for p in ("p1", "p2") for s in ("SUPINE", "TILT")]),
        "positions": table(spark, [{"panel": p, "position": q, "factor": "timepoint", "level": q} for p in ("p1", "p2") for q in ("PRE", "POST")]),
        "readings": spark.createDataFrame([(p, s, q, 60.0, 56.0, 64.0) for p in ("p1", "p2") for s, q in cells if (p, s, q) != ("p2", "TILT", "POST")], "panel string, series string, position string, y_px double, upper_px double, lower_px double"),
        "source_panels": table(spark, [{"source_panel": f"s{i}", "disposition": "EXTRACT" if i < 4 else "SKIP"} for i in range(1, 5)]),
    }
    out = run.run_batch(t)
    assert {(r["Unit_ID"], r["Value_Status"]) for r in out["values"].collect()} == {("U1", "MACHINE_QC_PASSED"), ("U2", "PANEL_NOT_PASSED")}
    assert {r["source_panel"]: r["coverage"] for r in out["coverage"].collect()} == {"s1": "COVERED", "s2": "QUEUED", "s3": "NOT_RUN", "s4": "NOT_TARGET"}
    assert {(r["panel"], r["reason"]) for r in out["queue"].collect()} == {("p2", "QC_REJECTED"), ("s3", "NOT_LINKED")}
