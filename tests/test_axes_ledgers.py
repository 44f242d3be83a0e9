"""Axes, ledgers, sinks and captions against plain versions and odd inputs."""

import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyplane.functions import captions as C
from tallyplane.functions import scalars as S
from tallyplane.operators import association as A
from tallyplane.operators import axes as X
from tallyplane.operators import grid as G
from tallyplane.operators import ledger as L
from tallyplane.operators import relate as R
from tallyplane.operators import review as V
from tallyplane.operators import template_gate as K
from tallyplane.plans import catalog
from tallyplane.sources import manifests as M


def test_kendall_counts_pairs(spark):
    r = random.Random(1)
    rows = [(g, i, float(r.randrange(k)), float(r.randrange(k))) for g, k in enumerate((1, 2, 5, 50, 1000)) for i in range(120)] + [(9, 0, None, 1.0), (9, 1, 1.0, 2.0), (8, 0, 1.0, 1.0)]
    got = {x["g"]: x for x in A.kendall(spark.createDataFrame(rows, "g int, i int, x double, y double"), ["g"], "x", "y", "i").collect()}
    for g in range(5):
        pts = [(x, y) for h, _, x, y in rows if h == g]
        pairs = list(itertools.combinations(pts, 2))
        s = [(a[0] - b[0]) * (a[1] - b[1]) for a, b in pairs]
        want = (sum(v > 0 for v in s), sum(v < 0 for v in s), sum(a[0] == b[0] and a[1] != b[1] for a, b in pairs), sum(a[0] != b[0] and a[1] == b[1] for a, b in pairs))
        assert tuple(got[g][c] for c in ("concordant", "discordant", "ties_x", "ties_y")) == want
    assert got[0]["tau_b"] is None and got[9]["tau_b"] is None and got[8]["tau_b"] is None


def test_tails(spark):
    df = spark.createDataFrame([(4.0, 1, 10, 0.5, 12, 0.4), (2.5, 3, 20, 1.0, 9, 1.0), (0.0, 2, 5, -0.9, 3, 0.0)], "f double, a int, b int, r double, n int, r2 double")
    got = df.select(A.p_value("F")("f", "a", "b").alias("f"), A.p_value("FISHER")("r", "n").alias("z"), A.p_value("R_SQUARED")("r2", "n").alias("r2"), A.p_value("PEARSON")(F.sqrt("r2"), "n").alias("p")).collect()

    def beta_tail(f, u, v):  # by plain summation of the density
        a, b, top = v / 2, u / 2, v / (v + u * f)
        n = 400_000
        area = sum(((k + 0.5) / n * top) ** (a - 1) * (1 - (k + 0.5) / n * top) ** (b - 1) for k in range(n)) * top / n
        return area / math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))

    assert abs(got[0]["f"] - beta_tail(4.0, 1, 10)) < 1e-5 and abs(got[1]["f"] - beta_tail(2.5, 3, 20)) < 1e-5 and got[2]["f"] == 1.0
    assert abs(got[0]["z"] - math.erfc(math.atanh(0.5) * 3 / math.sqrt(2))) < 1e-12 and got[1]["z"] == 0.0 and got[2]["z"] is None
    assert all(abs(x["r2"] - x["p"]) < 1e-9 for x in got)
    line = spark.createDataFrame([(1.0, float(i), 2.0 * i + 1) for i in range(5)], "g double, x double, y double")
    m = A.moments(line, ["g"], "x", "y")
    assert m.select(A.slope_p(F.col("slope"), F.col("slope_se"), F.col("n"))).first()[0] == 0.0


def test_ladders_refuse(spark):
    df = spark.createDataFrame([("double", 10.0, 1.0), ("double", 10.0, 2.0), ("double", 30.0, 3.0), ("flat", 10.0, 1.0), ("flat", 20.0, 2.0), ("flat", 30.0, 1.0)] + [("even", 10.0 * i, 5.0 * i) for i in range(4)], "a string, px double, v double")
    got = {r["a"]: r["is_ladder"] for r in A.ladder(df, ["a"], "px", "v").collect()}
    assert got == {"double": False, "flat": False, "even": True}
    assert {r["a"]: (r["labels"], r["n_longest"]) for r in X.longest_ladder(df, ["a"], "px", "v").collect()} == {"even": (4, 1)}
    off = X.labels_off_ticks(spark.createDataFrame([("p", 12.0), ("p", 29.0), ("p", 60.0)], "a string, px double"), spark.createDataFrame([("p", 10.0), ("p", 20.0), ("p", 30.0)], "a string, tick double"), ["a"], "px", "tick").collect()
    assert [r["px"] for r in off] == [60.0]


def test_overlap_of_nothing(spark):
    assert spark.range(1).select(R.overlap_share(F.lit(5), F.lit(5), F.lit(1), F.lit(9))).first()[0] == 0.0


def test_first_rows_are_the_first(spark):
    df = spark.createDataFrame([("U", "10", "b"), ("U", "9", "a"), ("V", "3", "c")], "Unit_ID string, _line string, x string")
    for _ in range(3):
        assert sorted((r["Unit_ID"], r["x"]) for r in G.first_rows(df.repartition(3), ["Unit_ID"]).collect()) == [("U", "a"), ("V", "c")]


def test_ids_tell_contents_apart(spark):
    cols = "panel string, unit string, cell string, identity_method string, value_method string, dispersion_method string, value string, tier string"
    rows = [("a|b", "c", "x", "m", "v", "", "1", "R3"), ("a", "b|c", "x", "m", "v", "", "1", "R3"), ("a", "b|c", "x", "m", "v", None, "1", "R3")]
    assert V.inference_ids(spark.createDataFrame(rows, cols)).select("inference_id").distinct().count() == 3


def test_verified_rows_are_parsed_from_the_hashed_bytes(spark, tmp_path):
    f = tmp_path / "t.csv"
    f.write_bytes('id,note\nU1,"two\nlines, ""quoted"""\nU2\n'.encode())
    sha = hashlib.sha256(f.read_bytes()).hexdigest()
    got = [(r["_line"], r["id"], r["note"]) for r in M.verified_rows(spark, str(f), sha).orderBy("_line").collect()]
    assert got == [(2, "U1", 'two\nlines, "quoted"'), (3, "U2", "")]
    assert M.verified_rows(spark, str(f), "0" * 64).count() == 0


def test_a_failed_promotion_is_rolled_back(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    one = lambda x: spark.createDataFrame([(x,)], "v string")
    M.write_outputs({"a": one("old"), "b": one("old")}, out, one("old"))
    real, calls = M._rename, []

    def fails(fs, path, old, new):
        calls.append(new)
        if old.endswith("/a") and ".staging" in old:
            raise OSError("disk")
        real(fs, path, old, new)

    monkeypatch.setattr(M, "_rename", fails)
    with pytest.raises(OSError):
        M.write_outputs({"a": one("new"), "b": one("new")}, out, one("new"))
    assert calls and {n: spark.read.parquet(f"{out}/{n}").first()[0] for n in ("a", "b", "run_stamp")} == dict.fromkeys(("a", "b", "run_stamp"), "old")


def test_template_that_fits_nothing(spark):
    assert [r["code"] for r in K.check_template(spark.createDataFrame([("1",)], "_line string")).collect()] == ["SCHEMA_INCOMPLETE"]
    assert [r["code"] for r in K.check_template(spark.createDataFrame([("1", "2", "3")], "_line string, Events string, N_at_Risk string")).collect()] == ["SCHEMA_INCOMPLETE"]


def test_boxes_and_exceptions(spark):
    df = spark.createDataFrame([("means ± SEM, other than figures (SD or SE)",), ("Values are means ± SD except for weights.",), ("The black box and the median of all",), (None,)], "c string")
    got = df.select(C.figure_exception(F.col("c")), C.box_elements(F.col("c")), C.errorbar_definition(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("", None, "AMBIGUOUS"), ("", None, "SD"), ("", None, "UNSTATED"), ("", None, "UNSTATED")]


def test_separation_needs_proof(spark):
    people = spark.createDataFrame([("A", "ORCID", "0000-0002-1825-0097"), ("B", "ORCID", "0000-0002-1825-0097"), ("C", "EMAIL", "c@x"), ("D", "ORCID", "0000-0001-5109-3700")], "reviewer string, contact_type string, contact string")
    side = lambda *rows: spark.createDataFrame(rows, "panel string, reviewer string")
    got = L.separation_problems(side(("p1", "A"), ("p2", "A"), ("p3", "A")), side(("p1", "B"), ("p2", "C"), ("p3", "D")), people).collect()
    assert {(r["panel"], r["code"]) for r in got} == {("p1", "RESOLVER_IS_APPROVER"), ("p2", "REVIEWER_IDENTITY_UNPROVABLE")}


def test_run_mode_of_nobody(spark):
    none = spark.createDataFrame([], "reviewer string, record_type string")
    assert L.run_mode(none, none.select("reviewer")).first()[0] == "ATTESTED"
    assert L.bytes_bound(spark.createDataFrame([], "s string"), "s").first()[0] == "NO_DOCUMENTS"


def test_broadcast_only_if_small(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    small = spark.range(100_000)
    assert "strategy=broadcast" in plan(spark.range(10).join(S.broadcast_if_small(small), "id")) and "strategy=broadcast" not in plan(spark.range(10).join(S.broadcast_if_small(small, 50), "id"))


def test_envelopes_refuse_what_is_not_finite(spark):
    df = spark.createDataFrame([("p", 1.0, 2.0), ("p", 2.0, 3.0), ("q", float("nan"), 1.0)], "panel string, x double, y double")
    got = {r["panel"]: (r["finite"], r["document"]) for r in M.envelope(df, "panel").collect()}
    assert got == {"p": (True, '[{"x":1.0,"y":2.0},{"x":2.0,"y":3.0}]'), "q": (False, None)}


def test_sessions_end_at_a_pause(spark):
    from tallyplane.streaming.resume import gap_sessions

    rows = spark.createDataFrame([("u", 0), ("u", 50), ("u", 500), ("v", 0)], "k string, s long").select("k", F.timestamp_seconds("s").alias("at"))
    got = gap_sessions(rows, "k", "at", "2 minutes", "1 hour").collect()
    assert sorted((r["k"], r["n"]) for r in got) == [("u", 1), ("u", 2), ("v", 1)]


def method_sizes(spark, df):
    """Bytes of the largest method of each piece of whole-stage code; -1 where it did not compile."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    pieces = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [pieces.apply(i)._3().maxMethodCodeSize() for i in range(pieces.size())]


@pytest.mark.parametrize("name", ["mean_template", "association_template", "event_template"])
def test_template_rules_are_compiled(spark, sf, name):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # the JIT compiles no method of 8,000 bytes or more, and Java none of 64 KB
        sizes = method_sizes(spark, catalog.queries()[name](spark, sf))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert sizes and all(0 < n < 8000 for n in sizes), sizes


def test_blank_and_number_spellings(spark):
    blank = [f"{a}{w}{b}" for w in S.NULL_SPELLINGS for a in ("", " \t", "\u000b") for b in ("", "\n ", "\r")] + [w.lower() for w in S.NULL_SPELLINGS] + ["-/".join(w) + "_ " for w in S.NULL_COMPACT]
    full = ["N A B", "NOT", "0", "—-", "없 음", "\u00a0", "NA" + " " * 20000 + "x", " " * 20000 + "x"]
    got = spark.createDataFrame([(v, v in blank) for v in blank + full], "v string, want boolean").select("v", "want", S.is_blank(F.col("v")).alias("b"), S.as_number(F.col("v")).alias("n")).collect()
    assert [r["v"] for r in got if r["b"] != r["want"]] == [] and [r["v"] for r in got if r["n"] is not None] == ["0"]
    numbers = {"\u000b1_0.5_0e1_0\n": 1.05e11, "+.5": 0.5, "1e999": None, "1_": None, "1__0": None, "_1": None, "1.\u0085": None, "12" + " " * 20000 + "x": None, "1f": None}
    got = spark.createDataFrame([(v,) for v in numbers], "v string").select("v", S.as_number(F.col("v")).alias("n")).collect()
    assert {r["v"]: r["n"] for r in got} == numbers


def test_looks_at_a_cell_are_few_calls(spark, monkeypatch):
    # a template has some fifty cells, and each literal of its conditions is a call to the JVM: a literal for each first character made 424
    client, calls = spark._jvm._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(a[0]) or send(*a, **k))
    S.is_blank(F.col("v")), S.as_number(F.col("v"))
    monkeypatch.undo()
    made = len([c for c in calls if not c.startswith("m\n")])  # m: releases of what is no longer held
    assert 0 < made <= 350, made


def test_long_and_plain_numbers(spark):
    want = {"5.": 5.0, "-0": -0.0, "+0012.50": 12.5, "0" * 120 + "7": 7.0, "9" * 101: float("9" * 101), "9" * 400: None, "1." + "0" * 101: 1.0, "": None, ".": None, "1.2.3": None, "0x1p3": None, "1_0": 10.0, "5\n": 5.0, "٥": None}
    got = spark.createDataFrame([(v,) for v in want], "v string").select("v", S.as_number(F.col("v")).alias("n")).collect()
    assert {r["v"]: r["n"] for r in got} == want
