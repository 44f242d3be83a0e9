import copy
import json

from tallyplane.__main__ import main

from .test_plans import PLAN


def test_compile(spark, tmp_path):
    (tmp_path / "plan.json").write_text(json.dumps(PLAN))
    assert main(["compile", str(tmp_path / "plan.json"), str(tmp_path / "out"), "--format", "parquet"]) == 0
    assert spark.read.parquet(str(tmp_path / "out/grid_definitions")).count() == 3
    assert spark.read.parquet(str(tmp_path / "out/run_stamp")).first()["status"] == "DONE"
    bad = copy.deepcopy(PLAN)
    bad["units"][0]["grid_id"] = "H"
    (tmp_path / "bad.json").write_text(json.dumps(bad))
    assert main(["compile", str(tmp_path / "bad.json"), str(tmp_path / "bad"), "--format", "parquet"]) == 1
    assert [r["code"] for r in spark.read.parquet(str(tmp_path / "bad/problems")).collect()] == ["UNKNOWN_GRID_ID"]


def test_templates(spark, tmp_path):
    assert main(["templates", str(tmp_path / "t")]) == 0
    assert (tmp_path / "t/units").exists()
