import itertools

import pytest
from pyspark.sql import functions as F

from tallyplane.operators import measure as E
from tallyplane.operators import review as V
from tallyplane.operators import tiers as T
from tallyplane.sources import manifests as M
from tallyplane.streaming import resume


def test_tiers(spark):
    rows = [("MEASURED_COLOUR", "MARKER_CENTER", "DIRECT_CONNECTED_CAP", True, "R0"), ("DECLARED_SINGLE_SERIES", "MARKER_CENTER", "", False, "R1"), ("MEASURED_COLOUR", "FIT_FALLBACK", "", False, "R4"), ("MEASURED_COLOUR", "MARKER_CENTER", "", True, "R4"), ("?", "MARKER_CENTER", "", False, "R4"), ("MEASURED_COLOUR", "MARKER_CENTER", "UNSTEMMED_CAP", True, "R3")]
    df = spark.createDataFrame(rows, "i string, v string, d string, h boolean, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", T.row_tier(F.col("i"), F.col("v"), F.col("d"), F.col("h"))).collect())
    v = spark.createDataFrame([("LINE_COLOR", "MEASURED_COLOUR", "MARKER_CENTER"), ("LINE_COLOR", "HUMAN_RESOLUTION", "MARKER_CENTER"), ("SUPPLIED", "AI_ASSIGNED_SERIES", "MANUAL_DIGITIZED")], "route string, identity_method string, value_method string")
    assert T.outside_contract(v).count() == 2
    g = spark.createDataFrame([(3.0, 4.0, 0.0, "NONE"), (5.0, 4.0, 0.0, "NONE"), (3.0, 1.0, 3.0, "MIXED"), (2.0, 2.0, 0.0, "STEM")], "s double, k double, d double, o string")
    assert [r[0] for r in g.select(T.interpolation_method(*map(F.col, "skdo"))).collect()] == ["RESTORED_LINE_PATTERN_GAP", "NONLOCAL_INTERPOLATION", "LOCAL_BRACKETED_INTERPOLATION", "RESTORED_MASKED_FURNITURE"]


def test_parsers(spark):
    df = spark.createDataFrame([("0:100;50:50;100:0", "1,9,2,8", "#ff0080"), ("1:5;2:5", "9,1,2,8", "1,2,256"), ("x", "1,2,3", "1,2,3")], "t string, b string, c string")
    got = df.select(F.size(E.ticks(F.col("t"))).alias("t"), E.box(F.col("b")).isNotNull().alias("b"), E.colour(F.col("c")).alias("c")).collect()
    assert [r["b"] for r in got] == [True, False, False] and [r["c"] for r in got] == [[255, 0, 128], None, [1, 2, 3]] and got[0]["t"] == 3


def test_supplied(spark):
    panels = spark.createDataFrame([("P", "0:100;100:0", "LINEAR"), ("L", "1:100;100:0", "LOG"), ("B", "1:1", "LINEAR")], "panel string, y_ticks string, y_scale string")
    r = spark.createDataFrame([("P", "s", "t", 40.0, 30.0, 50.0), ("P", "s", "u", 40.0, None, 45.0), ("L", "s", "t", 50.0, None, None), ("B", "s", "t", 1.0, None, None)], "panel string, series string, position string, y_px double, upper_px double, lower_px double")
    got = {(x["panel"], x["position"]): (x["mean"], x["dispersion"], x["spread_from"]) for x in E.supplied_values(r, panels).collect()}
    assert got["P", "t"][2] == "BOTH_ENDS" and got["P", "u"][2] == "ONE_END"
    assert got["P", "t"][0] == pytest.approx(60) and got["P", "t"][1] == pytest.approx(10) and got["P", "u"][1] == pytest.approx(5)
    assert got["L", "t"][0] == pytest.approx(10) and got["B", "t"][0] is None


def test_cells_and_n(spark):
    s = spark.createDataFrame([("P", "a"), ("P", "b"), ("Q", "a")], "panel string, series string")
    p = spark.createDataFrame([("P", "1"), ("P", "2"), ("R", "9")], "panel string, position string")
    assert {tuple(r) for r in E.declared_cells(s, p).collect()} == {("P", x, y) for x, y in itertools.product("ab", "12")} | {("Q", "a", None), ("R", None, "9")}
    v = spark.createDataFrame([("P", "a", "1", 10), ("P", "a", "2", 10), ("P", "b", "1", 10)], "panel string, series string, position string, n int")
    own = spark.createDataFrame([("P", "a", None, 7), ("P", "a", "2", 5)], "panel string, series string, position string, n int")
    assert {(r["series"], r["position"]): r["n"] for r in E.own_n(v, own).collect()} == {("a", "1"): 7, ("a", "2"): 5, ("b", "1"): 10}
    units = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "unit string")
    panels = spark.createDataFrame([("p1", "u1"), ("p2", "u1"), ("p3", "u9"), ("p4", "u3")], "panel string, unit string")
    assert {tuple(r) for r in E.bijection_problems(panels, units).collect()} == {("u1", "UNIT_SHARED_BY_PANELS"), ("u2", "UNIT_WITHOUT_PANEL"), ("u9", "PANEL_NAMES_UNKNOWN_UNIT")}


def test_points_and_fills(spark):
    pts = spark.createDataFrame([("p", 1, 0.0, 0.0, 10.0, 0), ("p", 2, 2.0, 0.0, 10.0, 1), ("p", 3, 10.0, 0.0, 20.0, 0), ("q", 1, 0.0, 0.0, 5.0, 0)], "panel string, seq int, x double, y double, area double, overlap int")
    n = spark.createDataFrame([("p", 3.0)], "panel string, n double")
    got = {r["panel"]: r for r in E.point_audit(pts, n, "panel").collect()}
    assert (got["p"]["unique"], got["p"]["agreement"], got["p"]["overplotting"], got["p"]["overlap"]) == (2, "FEWER_DETECTED", True, 1)
    assert (got["q"]["agreement"], got["q"]["overplotting"]) == ("NO_SOURCE_N", False)
    rows = [("d", g, s, i, ["OPEN", "HATCHED", "SOLID"]) for g, inks in (("1", (0.0, 0.4, 1.0)), ("2", (0.02, 0.42, 0.98)), ("3", (0.41,)), ("4", (0.7,))) for s, i in enumerate(inks)]
    f = {(r["group"], r["slot"]): (r["pattern"], r["state"]) for r in E.fill_identity(spark.createDataFrame(rows, "domain string, group string, slot int, ink double, patterns array<string>"), 0.05).collect()}
    assert f["1", 2] == ("SOLID", "ESTABLISHED") and f["3", 0] == ("HATCHED", "PROTOTYPE") and f["4", 0] == (None, "AMBIGUOUS")


def test_review(spark):
    v = spark.createDataFrame([("u1", "p1", "R0", "i1"), ("u2", "p2", "R3", "i2"), ("u3", "p3", "R4", "i3"), ("u4", "p1", "R2", "i4"), ("u5", "p5", "R0", "i5"), ("u6", "p6", "R0", "i6")], "unit string, panel string, tier string, inference_id string")
    blamed = spark.createDataFrame([("u6",)], "unit string")
    ok = spark.createDataFrame([(f"p{i}", i != 5) for i in (1, 2, 3, 5, 6)], "panel string, approved boolean")
    declared = spark.createDataFrame([("i2", "p2"), ("i4", "p1")], "inference_id string, panel string")
    answers = spark.createDataFrame([("i4", "p1", False)], "inference_id string, panel string, confirmed boolean")
    got = {r["unit"]: r["reason"] for r in V.finalize(v, blamed, ok, answers, declared).collect()}
    assert got == {"u1": None, "u2": "INFERENCE_SET_INCOMPLETE", "u3": "MODEL_ESTIMATE_ONLY", "u4": "INFERENCE_REFUSED", "u5": "NOT_APPROVED", "u6": "QC_FAILED"}
    items = [("a", False, "Y", ["Y", "N"], "y", "HIGH", "seen", "t", "T "), ("b", False, "Y", ["Y"], "N", "HIGH", "e", "", ""), ("c", False, "Y", ["Y"], "Y", "HIGH", "e", "", ""), ("d", False, "Y", ["Y"], "Y", "HIGH", "e", "", ""), ("e", False, "Y", ["Y"], "Y", "LOW", "e", "", ""), ("f", False, "Y", ["Y"], None, None, None, "", "")]
    df = spark.createDataFrame(items, "item string, person_only boolean, proposal string, options array<string>, choice string, confidence string, evidence string, text string, v_text string")
    cards = spark.createDataFrame([("a", "k1"), ("b", "k2"), ("c", "k2"), ("c", "k3"), ("d", "k3"), ("e", "k9"), ("f", "k8")], "item string, card string")
    got = {r["item"]: r["code"] for r in V.cross_check(df, cards).collect()}
    assert got == {"a": "AGREE", "b": "UNKNOWN_CHOICE", "c": "SHARED_CARD", "d": "SHARED_CARD", "e": "LOW_CONFIDENCE", "f": "NO_VERDICT"}
    q = spark.createDataFrame([("p", "BAR_MONO_GEOMETRY"), ("r", "OVERLAY")], "panel string, mode string")
    a = spark.createDataFrame([("p", "OVERLAY"), ("r", "OVERLAY")], "panel string, type string")
    assert [tuple(r) for r in V.missing_artifacts(q, a).collect()] == [("p", ["GEOMETRY"])]


def test_manifests(spark, tmp_path):
    (tmp_path / "units.csv").write_text('Unit_ID,Note\nU1,"a ""b"", c"\nU2,\n')
    m = M.load_manifests(spark, str(tmp_path), {"units": ["Unit_ID"]}, {"series_n": ["Panel_ID", "N"]})
    assert [tuple(r) for r in m["units"].orderBy("Unit_ID").collect()] == [("U1", 'a "b", c'), ("U2", "")] and m["series_n"].columns == ["Panel_ID", "N"]
    with pytest.raises(M.ManifestError):
        M.read_manifest(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(M.ManifestError):
        M.read_manifest(spark, str(tmp_path / "units.csv"), ["Other"])
    sha = M.hashes(spark, str(tmp_path), "units.csv").first()["sha256"]
    assert M.verified(spark, str(tmp_path / "units.csv"), sha).count() == 4 and M.verified(spark, str(tmp_path / "units.csv"), "0" * 64).count() == 0
    out = str(tmp_path / "out")
    M.write_outputs({"units": m["units"]}, out, spark.createDataFrame([("DONE",)], "status string"))
    assert spark.read.parquet(f"{out}/units").count() == 2 and spark.read.parquet(f"{out}/run_stamp").first()[0] == "DONE"
    M.withdraw(spark, out)
    assert not M._exists(spark, f"{out}/run_stamp")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert M.frame_digest(a).first() == M.frame_digest(a.orderBy(F.desc("a"))).first() != M.frame_digest(a.limit(1)).first()


def test_xml_and_kinds(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<article><fig><label>Fig. 1</label><caption><p>One.</p><p>Two.</p></caption></fig></article>")
    assert [tuple(r) for r in M.xml_captions(spark, str(tmp_path / "a.xml")).collect()] == [("Fig. 1", "One. Two.")]
    df = spark.createDataFrame([(bytearray(b"%PDF-1.7"),), (bytearray(b"<?xml?><article >"),), (bytearray(b"text"),), (bytearray(b"\x00\x01"),)], "c binary")
    assert [r[0] for r in df.select(M.source_kind(F.col("c"))).collect()] == ["PDF", "JATS_XML", "PLAIN_TEXT", "UNREADABLE"]


def test_resume(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    sink = resume.once(lambda df: df.withColumn("done", F.lit(True)), "id", ledger)
    rows = lambda ids: spark.createDataFrame([(i,) for i in ids], "id int")
    sink(rows([1, 2, 2]), 0)
    sink(rows([2, 3]), 1)
    sink(rows([2, 3]), 1)
    assert sorted(r["id"] for r in spark.read.parquet(ledger).collect()) == [1, 2, 3]


def test_cross_check_spreads_to_the_end_or_fails(spark):
    rows = [(str(i), i == 0, "A", ["A"], "A", "HIGH", "e", "t", "t") for i in range(4)]
    df = spark.createDataFrame(rows, "item string, person_only boolean, proposal string, options array<string>, choice string, confidence string, evidence string, text string, v_text string")
    cards = spark.createDataFrame([(str(i), c) for i in range(4) for c in (i, i + 1)], "item string, card int")
    assert {r["to"] for r in V.cross_check(df, cards).collect()} == {"PERSON"}
    assert {r["to"] for r in V.cross_check(df, cards, max_rounds=3).collect()} == {"PERSON"}
    with pytest.raises(RuntimeError):
        V.cross_check(df, cards, max_rounds=2)
