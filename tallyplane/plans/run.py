"""A batch from manifests to machine-checked values: read, gate, blame, states, queue, coverage. Tables in, tables out; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bundle as B
from ..operators import measure as E
from ..operators import rules as Q


def cut(df: DataFrame) -> DataFrame:
    """df written to the session's shared checkpoint folder: what follows is planned on its own, and survives a lost executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or "/tmp/checkpoints/tallyplane")
    return df.checkpoint()


def placed_problems(problems: DataFrame, figures: DataFrame, grids: DataFrame, units: DataFrame, values: DataFrame) -> DataFrame:
    """The gate's problems with the key that their scope names: a line becomes its row's id, so that blame can follow."""
    by = lambda scope, df, col: problems.where(F.col("scope") == scope).join(df.select(F.col("_line").cast("string").alias("row_id"), F.trim(col).alias("key")), "row_id").select("scope", "key", "code")
    named = problems.where(F.col("scope").isin("unit", "grid")).select(F.when(F.col("scope") == "unit", "units").otherwise("grids").alias("scope"), F.col("row_id").alias("key"), "code")
    rest = problems.where(~F.col("scope").isin("unit", "grid", "figures", "grids", "units", "values")).select("scope", F.col("row_id").alias("key"), "code")
    return by("figures", figures, "Figure_ID").unionByName(by("grids", grids, "Grid_ID")).unionByName(by("units", units, "Unit_ID")).unionByName(by("values", values, "Unit_ID")).unionByName(named).unionByName(rest)


def coverage(source_panels: DataFrame, states: DataFrame) -> DataFrame:
    """source_panel, disposition, coverage: what became of every panel of the inventory. states: source_panel, state."""
    seen = states.groupBy("source_panel").agg(F.bool_or(F.col("state") == "AUTO_PASS").alias("_passed"))
    state = F.when(F.col("disposition") != "EXTRACT", "NOT_TARGET").when(F.col("_passed").isNull(), "NOT_RUN").when(F.col("_passed"), "COVERED").otherwise("QUEUED")
    return source_panels.join(seen, "source_panel", "left").select("source_panel", "disposition", state.alias("coverage"))


def run_batch(t: dict[str, DataFrame], ranges: DataFrame | None = None, dual: bool = False) -> dict[str, DataFrame]:
    """values with Value_Status, problems, panel states, review queue and coverage.

    t: figures, grids, units, panels (panel, unit, y_ticks, y_scale, source_panel), series (panel, series, factor, level), positions (panel,
    position, factor, level), readings (panel, series, position, y_px, upper_px, lower_px), source_panels (source_panel, disposition).
    """
    read = E.supplied_values(t["readings"], t["panels"].select("panel", "y_ticks", "y_scale"))
    # a series or a position may carry any number of factors, or none
    levels = lambda df, k: df.where("trim(factor) <> ''").groupBy("panel", k).agg(F.collect_set(F.concat(F.upper("factor"), F.lit("="), F.upper("level"))).alias("_" + k))
    known = lambda df, k: df.select("panel", k).distinct()
    cells = read.join(known(t["series"], "series"), ["panel", "series"]).join(known(t["positions"], "position"), ["panel", "position"])
    cells = cells.join(levels(t["series"], "series"), ["panel", "series"], "left").join(levels(t["positions"], "position"), ["panel", "position"], "left")
    none = F.array().cast("array<string>")
    key = F.array_join(F.array_sort(F.array_union(F.coalesce("_series", none), F.coalesce("_position", none))), ";")
    values = cells.join(t["panels"].select("panel", "unit"), "panel").select(F.concat_ws("/", "panel", "series", "position").alias("_line"), F.col("unit").alias("Unit_ID"), key.alias("Cell_Key"), F.col("mean").cast("string").alias("Mean"), F.coalesce(F.col("dispersion").cast("string"), F.lit("")).alias("Dispersion_Value"), "panel")
    values = cut(values)
    problems = cut(B.check_bundle(t["figures"], t["grids"], t["units"], values.drop("panel"), ranges, dual))
    units = t["units"].select(F.trim("Unit_ID").alias("unit"), F.trim("Figure_ID").alias("figure"), F.trim("Grid_ID").alias("grid"))
    blamed = cut(Q.blame(placed_problems(problems, t["figures"], t["grids"], t["units"], values), units))
    bad = blamed.groupBy("unit").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    marks = read.groupBy("panel").agg(F.count("mean").alias("marks"))
    states = t["panels"].join(marks, "panel", "left").join(bad, "unit", "left").select("panel", "unit", "source_panel", "codes", F.when(F.coalesce("marks", F.lit(0)) == 0, "MANUAL_POINT_READ").when(F.col("codes").isNotNull(), "QC_REJECTED").otherwise("AUTO_PASS").alias("state"))
    own = problems.where("scope = 'values'").select(F.col("row_id").alias("_line")).distinct().withColumn("_bad", F.lit(True))
    out = values.join(own, "_line", "left").join(states.select("panel", "state"), "panel", "left").withColumn("Value_Status", Q.value_status(F.col("_bad").isNotNull(), F.col("state"))).drop("_bad", "_line", "state")
    ledger = coverage(t["source_panels"], states)
    queue = states.where("state <> 'AUTO_PASS'").select("panel", F.col("state").alias("reason")).unionByName(ledger.where("coverage = 'NOT_RUN'").select(F.col("source_panel").alias("panel"), F.lit("NOT_LINKED").alias("reason")))
    return {"values": out, "problems": problems, "states": states, "queue": queue, "coverage": ledger}
