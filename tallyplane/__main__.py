"""python -m tallyplane compile PLAN.json OUT | gate FOLDER OUT | templates OUT

compile turns a plan into manifests; gate checks the bundle of four CSV tables in FOLDER (figures, grids, units, values) and writes its
problems; templates writes empty tables. Outputs are promoted as a whole, with a stamp last.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import bundle
from .plans import compile as plans
from .sources import manifests

TABLES = {"figures": list(bundle.FIGURE_COLUMNS), "grids": list(bundle.GRID_COLUMNS), "units": list(bundle.UNIT_COLUMNS), "values": list(bundle.VALUE_COLUMNS)}
KEYS = {"figures": ["Figure_ID"], "grids": ["Grid_ID", "Factor_Name", "Factor_Level"], "units": ["Unit_ID"], "values": ["Unit_ID", "Cell_Key"]}


def with_lines(df, keys: list[str]):
    """Rows named by their key where the file gives no _line: a file that is read in parallel has no numbers of its own."""
    return df if "_line" in df.columns else df.withColumn("_line", F.concat_ws("/", *keys))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallyplane", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in (("compile", ("plan", "out")), ("gate", ("folder", "out")), ("templates", ("out",))):
        q = sub.add_parser(name)
        for a in args:
            q.add_argument(a)
        q.add_argument("--format", default="csv", choices=("csv", "parquet"))
        q.add_argument("--dual", action="store_true", help="ask for two independent readings")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tallyplane").getOrCreate()
    if a.command == "templates":
        manifests.write_templates(spark, TABLES, a.out)
        return 0
    if a.command == "compile":
        plan = spark.read.schema(plans.SCHEMA).json(a.plan, multiLine=True)
        found = plans.problems(plan)
        n = found.count()
        outputs = {"problems": found} if n else plans.compile_plan(plan)
    else:
        t = {k: with_lines(manifests.read_manifest(spark, f"{a.folder}/{k}.csv"), KEYS[k]) for k in TABLES}
        found = bundle.check_bundle(t["figures"], t["grids"], t["units"], t["values"], dual=a.dual)
        n = found.count()
        outputs = {"problems": found}
    stamp = spark.createDataFrame([("REJECTED" if n else "DONE", n)], "status string, problems long")
    manifests.write_outputs(outputs, a.out, stamp, a.format)
    print(f"{n} problems" if n else "clean")
    return int(n > 0)


if __name__ == "__main__":
    raise SystemExit(main())
