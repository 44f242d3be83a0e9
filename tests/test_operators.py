import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from tallyplane.functions import captions as C
from tallyplane.functions import scalars as S
from tallyplane.operators import association as A
from tallyplane.operators import grid as G
from tallyplane.operators import matching as M
from tallyplane.operators import relate as R
from tallyplane.operators import rules as Q


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("v,want", [("", True), (" n/a ", True), ("N. A.", True), ("—", True), ("없음", True), ("0", False), ("not applicable", True), (None, True), ("UNTRANSFORMED", False), ("none", True)])
def test_blank(spark, v, want):
    assert one(spark, v, S.is_blank) is want


@pytest.mark.parametrize("v,want", [("1.5", 1.5), (" -2e3 ", -2000.0), ("1_0", 10.0), ("1d", None), ("inf", None), ("nan", None), ("abc", None), (None, None), (".5", 0.5), ("5.", 5.0)])
def test_number(spark, v, want):
    assert one(spark, v, S.as_number) == want


@pytest.mark.parametrize("v,want", [("yes", "TRUE"), ("0", "FALSE"), ("maybe", "BAD"), ("-", None)])
def test_flag(spark, v, want):
    assert one(spark, v, S.as_flag) == want


def test_names_and_keys(spark):
    assert one(spark, "map; PAP ,pap", S.name_set) == ["MAP", "PAP"]
    assert one(spark, "Pearson correlation", S.association_type) == "PEARSON_R"
    assert one(spark, "b=x;a=y", lambda c: S.cell_key(S.parse_cell_key(c))) == "A=Y;B=X"
    assert one(spark, "a=1;a=2", S.parse_cell_key) is None
    assert one(spark, "probably SEM", S.unresolved_marker) == "PROBABLY"
    assert one(spark, "0000-0002-1825-0097", S.orcid_valid) is True
    assert one(spark, "0000-0002-1825-0098", S.orcid_valid) is False


@pytest.mark.parametrize("v,want", [("Means ± SEM", "SEM"), ("values are mean ± s.d.", "SD"), ("SD and SE", "AMBIGUOUS"), ("a ± b", "PM_UNNAMED"), ("bars", "UNSTATED"), ("standard error of the mean", "SEM")])
def test_errorbars(spark, v, want):
    assert one(spark, v, C.errorbar_definition) == want


@pytest.mark.parametrize("v,want", [("eso señal", "SE"), ("Käse, s.d.", "AMBIGUOUS"), ("s.e.x", "SE"), ("the base, used", "UNSTATED"), ("s.e.m.; IQR", "AMBIGUOUS"), ("s.e.m.s", "SEM"), (None, "UNSTATED")])
def test_errorbars_as_the_sql_says(spark, v, want):
    """Bounds of words are those of the SQL's engine: a letter beyond ASCII ends a word."""
    import duckdb

    from tallyplane.plans import catalog

    assert one(spark, v, C.errorbar_definition) == want
    sql = catalog.SQL["errorbar_definition"]
    k = sql[sql.index(", m AS (") + 2 :]
    assert duckdb.execute("WITH k AS (SELECT 1 AS doc_id, coalesce(?, '') AS cap), " + k, [v]).fetchone()[1] == want


def test_route(spark):
    r = lambda v: one(spark, v, lambda c: C.route(c, F.lit(False)))
    assert r("rela- tionships between x and y") == "ASSOCIATION_ONLY_NOT_TARGET"
    assert r("Schematic") == "NOT_DATA"
    assert r("Incidence of syncope") == "BINARY_EVENT_NOT_MEAN"
    assert r("Heart rate") == "DIGITIZE"


def test_panels_and_own_caption(spark):
    assert one(spark, "Fig. 4A shows (c); panels e-g", C.panel_letters) == ["A", "C", "E", "F", "G"]
    assert one(spark, "Fig. 1 Time course of HR. Fig. 2 Sectional change", C.own_caption) == "Fig. 1 Time course of HR."
    assert one(spark, "Time course", C.own_caption) == "Time course"


def test_expected_cells(spark):
    levels = spark.createDataFrame([("g", "A", "1"), ("g", "A", "2"), ("g", "B", "x"), ("g", "B", "y"), ("g", "C", "z"), ("h", "A", "1")], "grid string, factor string, level string")
    got = {(r["grid"], r["cell"]) for r in G.expected_cells(levels, "grid", "factor", "level").collect()}
    assert got == {("g", f"A={a};B={b};C=z") for a in "12" for b in "xy"} | {("h", "A=1")}
    assert {r["grid"]: r["n_cells"] for r in G.expected_count(levels, "grid", "factor", "level").collect()} == {"g": 4, "h": 1}


def test_p_values():
    assert A.t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert A.t_two_sided(1.0, 1) == pytest.approx(0.5, abs=1e-12)
    for n in (4, 5, 6):
        counts = [sum(p[i] > p[j] for i in range(n) for j in range(i + 1, n)) for p in itertools.permutations(range(n))]
        for d in range(n * (n - 1) // 2 + 1):
            low = min(d, n * (n - 1) // 2 - d)
            assert A.kendall_exact_p(n, d) == pytest.approx(min(1, 2 * sum(c <= low for c in counts) / math.factorial(n)))


def test_matching_is_optimal():
    r = random.Random(5)
    for _ in range(60):
        a, b = sorted(r.uniform(0, 10) for _ in range(r.randint(0, 5))), sorted(r.uniform(0, 10) for _ in range(r.randint(0, 5)))
        best = (0, 0.0)
        for k in range(min(len(a), len(b)), 0, -1):
            costs = [sum(abs(x - y) for x, y in zip(p, q)) for p in itertools.combinations(a, k) for q in itertools.permutations(b, k) if all(abs(x - y) <= 2 for x, y in zip(p, q))]
            if costs:
                best = (k, min(costs))
                break
        got = M.least_cost(a, b, 2.0)
        assert (len(got), round(sum(abs(a[i] - b[j]) for i, j in got), 9)) == (best[0], round(best[1], 9))


def test_greedy(spark):
    rows = [("p", "c1", "r1", 0.9), ("p", "c2", "r1", 0.8), ("p", "c3", "r2", 0.5), ("p", "c3", "r3", 0.49), ("p", "c4", None, 0.0)]
    got = M.assign_greedily(spark.createDataFrame(rows, "page string, c string, r string, s double"), "page", "c", "r", "s", 0.05)
    assert {r["c"]: r["state"] for r in got.collect()} == {"c1": "ASSIGNED", "c2": "TAKEN", "c3": "AMBIGUOUS", "c4": "NO_CANDIDATE"}


def test_greedy_page_of_many_captions():
    """A page's time grows with its rows: captions were each looked up among all rows of the page."""
    import pyarrow as pa

    seen = {}

    class Rows:
        dtypes = [("page", "bigint"), ("c", "bigint"), ("r", "bigint"), ("s", "double")]

        def select(self, *names):
            from pyspark.sql.types import LongType, StructField, StructType

            self.schema = StructType([StructField(n, LongType()) for n in names if n != "s"])
            return self

        def groupBy(self, by):
            return self

        def applyInArrow(self, f, schema):
            seen["f"] = f

    M.assign_greedily(Rows(), "page", "c", "r", "s", 0.5)
    n = 30_000
    page = pa.table({"page": [7] * 2 * n, "c": [i % n for i in range(2 * n)], "r": [i // 2 for i in range(2 * n)], "s": [float(i) for i in range(2 * n)]})
    began = time.process_time()
    got = seen["f"]((pa.scalar(7),), page).to_pylist()
    assert time.process_time() - began < 10
    assert len(got) == n and got[0] == {"page": 7, "c": n - 1, "r": n - 1, "state": "ASSIGNED"}


def test_greedy_keeps_wide_keys(spark):
    rows = [(1, 1, 2**60 + 1, 0.9), (1, 2, None, 0.5), (1, None, 3, 0.4), (1, 3, 2**60 + 1, None)]
    got = M.assign_greedily(spark.createDataFrame(rows, "page long, c long, r long, s double"), "page", "c", "r", "s", 0.05)
    assert {(r["c"], r["r"], r["state"]) for r in got.collect()} == {(1, 2**60 + 1, "ASSIGNED"), (2, None, "NO_CANDIDATE"), (None, None, "NO_CANDIDATE"), (3, None, "TAKEN")}


def test_matching_of_many_equal_values(spark):
    """Equal values are counted, so a group's task does not grow with its rows."""
    rows = spark.range(40_000).select(F.lit("p").alias("g"), (F.col("id") % 10 + 1).cast("double").alias("x"), "id")
    odd = [("p", None), ("p", float("nan")), ("q", 1.0)]
    left = rows.where("id % 4 = 1").select("g", F.col("x").alias("a")).unionByName(spark.createDataFrame(odd, "g string, a double"))
    right = rows.where("id % 4 = 2").select("g", (F.col("x") + 2).alias("b"))
    began = time.perf_counter()
    got = M.match(left, right, "g", "a", "b", 2.0).groupBy("g", "a", "b").count().collect()
    assert time.perf_counter() - began < 60
    # 2, 4, 6, 8 and 10 on either side, 2,000 each
    assert sum(r["count"] for r in got) == 10_000 and sum(r["count"] * abs(r["a"] - r["b"]) for r in got) == 10_000
    assert {r["g"] for r in got} == {"p"}


def test_matching_agrees_with_every_choice():
    r = random.Random(11)
    for _ in range(150):
        a, b = [float(r.randint(0, 6)) for _ in range(r.randint(0, 5))], [float(r.randint(0, 6)) for _ in range(r.randint(0, 5))]
        tolerance, best = r.choice([0, 1, 2, 3]), (0, 0.0)
        for k in range(min(len(a), len(b)), 0, -1):
            costs = [sum(abs(x - y) for x, y in zip(p, q)) for p in itertools.combinations(a, k) for q in itertools.permutations(b, k) if all(abs(x - y) <= tolerance for x, y in zip(p, q))]
            if costs:
                best = (k, min(costs))
                break
        got = M.least_cost(a, b, tolerance)
        assert (len(got), sum(abs(a[i] - b[j]) for i, j in got)) == best and all(abs(a[i] - b[j]) <= tolerance for i, j in got)


def test_nearest(spark):
    p = spark.createDataFrame([("g", 1, 0.0), ("g", 2, 5.0), ("g", 3, 9.0), ("h", 4, 1.0)], "g string, id int, x double")
    a = spark.createDataFrame([("g", 4.0), ("g", 6.0)], "g string, at double")
    assert {r["id"]: r["at"] for r in R.nearest_anchor(p, a, ["g"], "x", "at", ["id"]).collect()} == {1: 4.0, 2: 4.0, 3: 6.0, 4: None}


CLEAN = {
    "Unit_ID": "U1", "Figure_ID": "F1", "Grid_ID": "G1", "Panel": "A", "Outcome_Variable": "Heart rate", "Unit": "bpm", "Statistic_Type": "CONTINUOUS", "Grid_Rule": "FULL", "Sparse_Justification": "",
    "Dispersion_Type": "SEM", "Errorbar_Definition_Source": "Values are means ± SEM", "N_Outcome": "10", "Value_Scale": "RATIO", "Analysis_Transformation": "UNTRANSFORMED", "Transformation_Source": "", "Distribution_Shape": "SYMMETRIC",
    "Extraction_Method": "DIGITIZED", "Bar_Top_Definition": "OUTLINE_CENTER", "Errorbar_Stem_Confirmed": "TRUE", "Axis_X_Scale": "LINEAR", "Axis_Y_Scale": "LINEAR", "Extractor_1": "A", "Extractor_2": "B",
    **{f"Axis_Calib_{a}{i}_{k}": str(i * (10 if k == "Value" else 100)) for a in "XY" for i in (1, 2) for k in ("Value", "Pixel")},
}


@pytest.mark.parametrize(
    "change,want",
    [
        ({}, set()),
        ({"Statistic_Type": "MEAN"}, {"BAD_STATISTIC_TYPE"}),
        ({"N_Outcome": "10.5"}, {"N_INVALID"}),
        ({"N_Outcome": "ten"}, {"NON_NUMERIC_VALUE"}),
        ({"N_Outcome": ""}, {"MISSING_REQUIRED"}),
        ({"Errorbar_Definition_Source": "probably SEM"}, {"UNRESOLVED_ERRORBAR_DEFINITION"}),
        ({"Extractor_2": " a "}, {"SAME_EXTRACTOR"}),
        ({"Grid_Rule": "SPARSE"}, {"SPARSE_WITHOUT_JUSTIFICATION"}),
        ({"Bar_Top_Definition": "FILL_EDGE"}, {"BAR_TOP_READ_AT_FILL_EDGE"}),
        ({"Errorbar_Stem_Confirmed": ""}, {"ERRORBAR_STEM_UNCONFIRMED"}),
        ({"Axis_Calib_Y2_Value": "10"}, {"Y_CALIB_DEGENERATE"}),
        ({"Axis_Y_Scale": "LOG", "Axis_Calib_Y1_Value": "0"}, {"LOG_AXIS_NONPOSITIVE_CALIBRATION"}),
        ({"Axis_Calib_X1_Value": "0", "Axis_Calib_X2_Value": "", "Axis_Calib_X2_Pixel": ""}, set()),
        ({"Analysis_Transformation": "LOG10"}, {"TRANSFORMATION_UNSOURCED"}),
        ({"Statistic_Type": "QUANTILE_SUMMARY"}, {"BAD_DISPERSION_TYPE"}),
    ],
)
def test_unit_gate(spark, change, want):
    row = CLEAN | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    assert {r["code"] for r in Q.apply(df, Q.unit_rules(), "units", "Unit_ID").collect()} == want
