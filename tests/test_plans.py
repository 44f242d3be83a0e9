import copy
import json

from tallyplane.operators import intake as I
from tallyplane.plans import compile as K

READ = {"mark_type": "line_color", "unit_id": "U1", "figure_view": "V1", "box": [0, 10, 0, 20], "y_ticks": [[0, 20], [10, 0]], "x_ticks": [], "series": [{"series_id": "a", "colour": "#ff0000"}], "positions": [{"position_id": "T0", "x": 1.0}, {"position_id": "T1", "x": 5.0}], "readings": [{"reading_id": "r", "series_id": "a", "position_id": "T0", "y_px": 3.0}]}
PLAN = {"schema": "1", "publication_id": "7", "reviewers": [{"reviewer_id": "R", "name": "N", "record_type": "human"}], "documents": [{"document_id": "D", "role": "main"}], "grids": [{"grid_id": "G", "factors": {"time": ["PRE", "POST"], "arm": ["A"]}}], "reader_configs": [{"config_id": "C", "options": {"tol": "5"}}], "figures": [{"source_figure_id": "F", "document_id": "D", "figure_number": "1", "observed_panel_count": 2, "panels": [{"panel_id": "p1", "label": "", "read": READ}, {"panel_id": "p2", "label": "B"}]}], "units": [{"unit_id": "U1", "grid_id": "G"}]}


def parsed(spark, plan):
    from pyspark.sql import functions as F

    return spark.createDataFrame([(json.dumps(plan),)], "j string").select(F.from_json("j", K.SCHEMA).alias("p")).select("p.*")


def test_compile(spark):
    t = {n: df.collect() for n, df in K.compile_plan(parsed(spark, PLAN)).items()}
    assert {n: len(r) for n, r in t.items()} == {"reviewer_registry": 1, "source_document_manifest": 1, "source_figure_manifest": 1, "source_panel_inventory": 2, "figure_manifest": 1, "grid_definitions": 3, "unit_manifest": 1, "panel_manifest": 1, "series_manifest": 1, "position_manifest": 2, "reader_config": 1, "supplied_readings": 1}
    assert t["figure_manifest"][0]["worklist_panel_count"] == 1 and t["panel_manifest"][0]["y_ticks"] == "0.0:20.0;10.0:0.0" and t["panel_manifest"][0]["mark_type"] == "LINE_COLOR"
    assert {r["label"] for r in t["source_panel_inventory"]} == {"p1", "B"}


def test_problems(spark):
    assert K.problems(parsed(spark, PLAN)).count() == 0
    bad = copy.deepcopy(PLAN)
    bad["figures"][0]["observed_panel_count"] = 3
    bad["figures"][0]["document_id"] = "X"
    bad["figures"][0]["panels"][0]["read"]["box"] = [10, 0, 0, 20]
    bad["units"][0]["grid_id"] = "H"
    bad["figures"][0]["panels"][0]["read"]["unit_id"] = "U9"
    assert {r["code"] for r in K.problems(parsed(spark, bad)).collect()} == {"PANEL_COUNT_DIFFERS", "UNKNOWN_DOCUMENT_ID", "BAD_BOX", "UNKNOWN_GRID_ID", "UNKNOWN_UNIT_ID"}


def test_intake(spark):
    text = "Intro text\nFig. 1. Heart rate during tilt in all subjects\nas shown in Fig. 2 here\nFigure 2 short\nFig. 1. heart rate again and again and again\nFig. 3A. panel only"
    got = {(r["line"], r["number"]): r["confidence"] for r in I.caption_candidates(spark.createDataFrame([(1, text)], "doc int, text string"), "doc", "text").collect()}
    assert got == {(1, 1): 0.7, (3, 2): 0.3, (4, 1): 0.4}
    rows = [(1, p, f"Journal of X, page {p}") for p in range(4)] + [(1, p, f"body {'abcd'[p]}") for p in range(4)] + [(2, 1, "Journal"), (2, 2, "Journal")]
    assert [(r["doc"], r["seen"]) for r in I.furniture(spark.createDataFrame(rows, "doc int, page int, text string"), "doc", "page", "text").collect()] == [(1, 4)]
    a, b = (spark.createDataFrame(x, "page int, number int") for x in ([(1, 1)], [(1, 1), (2, 2), (2, 2)]))
    assert [tuple(r) for r in I.only_in_second(a, b, ["page", "number"]).collect()] == [(2, 2)]
    caps = spark.createDataFrame([(1, "c", 0, 50, 100), (2, "d", 0, 50, 30)], "page int, caption string, x0 int, x1 int, top int")
    blocks = spark.createDataFrame([(1, "head", 0, 50, 90), (1, "text", 0, 50, 40), (1, "other", 60, 90, 80), (1, "below", 0, 50, 150)], "page int, block string, x0 int, x1 int, bottom int")
    heads = spark.createDataFrame([(1, "head")], "page int, block string")
    assert {r["caption"]: (r["y0"], r["y1"]) for r in I.box_above(caps, blocks, heads).collect()} == {"c": (40, 100), "d": (0, 30)}
    d = spark.createDataFrame([(1, "We did it. Values are means ± SEM. Data were SD.")], "doc int, text string")
    assert I.document_statement(d, "doc", "text").first()["sentence"] == "Values are means ± SEM."
