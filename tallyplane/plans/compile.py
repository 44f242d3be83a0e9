"""An extraction plan, one nested document, becomes flat tables. What can be counted is counted, not read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Rule, apply

#: The plan's shape; keys that are not in it are refused by sources.manifests.unknown_keys.
SCHEMA = """schema string, publication_id string,
reviewers array<struct<reviewer_id:string,name:string,record_type:string,contact_type:string,contact:string,registered_by:string,registration_date:string,human_attestation:string,note:string>>,
documents array<struct<document_id:string,role:string,source_file:string,source_file_sha256:string,page_range:string,observed_figure_count:int,inventory_status:string,figure_count_method:string,reviewer_id:string,inspection_date:string,note:string>>,
grids array<struct<grid_id:string,factors:map<string,array<string>>,note:string>>,
reader_configs array<struct<config_id:string,options:map<string,string>>>,
figures array<struct<source_figure_id:string,document_id:string,figure_number:string,image:string,observed_panel_count:int,inventory_status:string,panels:array<struct<panel_id:string,label:string,outcome_label:string,target_status:string,disposition:string,reason:string,read:struct<mark_type:string,unit_id:string,figure_view:string,box:array<int>,y_ticks:array<array<double>>,x_ticks:array<array<double>>,series:array<struct<series_id:string,colour:string>>,positions:array<struct<position_id:string,x:double>>,readings:array<struct<reading_id:string,series_id:string,position_id:string,y_px:double,upper_px:double,lower_px:double>>>>>>>,
units array<struct<unit_id:string,grid_id:string,outcome:string,unit:string,statistic_type:string>>"""


def _each(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.explode(column).alias("_e")).select(*keep, "_e.*")


def tick_text(c: str):
    return F.array_join(F.transform(c, lambda t: F.concat_ws(":", t[0].cast("string"), t[1].cast("string"))), ";")


def compile_plan(plan: DataFrame) -> dict[str, DataFrame]:
    """The manifests of a parsed plan (SCHEMA), one select a table; nothing is written if problems(plan) has rows."""
    pub = F.col("publication_id")
    reviewers = _each(plan, "reviewers", ["publication_id"])
    documents = _each(plan, "documents", ["publication_id"])
    figures = _each(plan, "figures", ["publication_id"])
    panels = _each(figures.withColumnRenamed("inventory_status", "_s"), "panels", ["source_figure_id", "publication_id", "image"])
    read = panels.where("read is not null").select("source_figure_id", "publication_id", "image", "panel_id", "label", "read.*")
    levels = _each(plan, "grids", []).select("grid_id", F.explode("factors").alias("factor", "levels")).select("grid_id", F.upper("factor").alias("factor"), F.posexplode("levels").alias("order", "level"))
    up = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit(""))))
    views = read.groupBy("figure_view").agg(F.first("source_figure_id").alias("source_figure_id"), F.first("image").alias("image"), F.count("*").alias("worklist_panel_count"))
    return {
        "reviewer_registry": reviewers.select("reviewer_id", "name", up("record_type").alias("record_type"), up("contact_type").alias("contact_type"), "contact", "registered_by", "registration_date", up("human_attestation").alias("human_attestation")),
        "source_document_manifest": documents.select("document_id", pub, up("role").alias("role"), "source_file", "source_file_sha256", "page_range", "observed_figure_count", up("inventory_status").alias("inventory_status")),
        "source_figure_manifest": figures.select("source_figure_id", "document_id", pub, "figure_number", "image", "observed_panel_count", up("inventory_status").alias("inventory_status")),
        "source_panel_inventory": panels.select(F.col("panel_id").alias("source_panel_id"), "source_figure_id", F.coalesce(F.nullif(F.trim("label"), F.lit("")), "panel_id").alias("label"), "outcome_label", up("target_status").alias("target_status"), up("disposition").alias("disposition"), "reason"),
        "figure_manifest": views,
        "grid_definitions": levels.select("grid_id", "factor", "level", "order"),
        "unit_manifest": _each(plan, "units", ["publication_id"]),
        "panel_manifest": read.select("panel_id", "figure_view", "unit_id", up("mark_type").alias("mark_type"), "image", *[F.col("box")[i].alias(n) for i, n in enumerate(("x0", "x1", "y0", "y1"))], tick_text("y_ticks").alias("y_ticks"), tick_text("x_ticks").alias("x_ticks")),
        "series_manifest": _each(read, "series", ["panel_id"]),
        "position_manifest": read.select("panel_id", F.posexplode("positions").alias("display_order", "_e")).select("panel_id", "_e.*", "display_order"),
        "reader_config": _each(plan, "reader_configs", []).select("config_id", F.explode("options").alias("option", "value")),
        "supplied_readings": _each(read, "readings", ["panel_id"]),
    }


def problems(plan: DataFrame) -> DataFrame:
    """What a plan says that does not hold together: (scope, row_id, code, detail)."""
    t = compile_plan(plan)
    units, panels, grids, inventory = t["unit_manifest"], t["panel_manifest"], t["grid_definitions"], t["source_panel_inventory"]
    row = lambda df, scope, key, code: df.select(F.lit(scope).alias("scope"), F.col(key).cast("string").alias("row_id"), F.lit(code).alias("code"), F.lit("").alias("detail"))
    seen = inventory.groupBy("source_figure_id").agg(F.count("*").alias("c"))
    counts = t["source_figure_manifest"].join(seen, "source_figure_id", "left")
    box = F.col("x0").isNull() | (F.col("x0") >= F.col("x1")) | (F.col("y0") >= F.col("y1"))
    out = [
        apply(panels, [Rule("BAD_BOX", box), Rule("BAD_PANEL_ID", ~F.col("panel_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"))], "panels", "panel_id"),
        row(panels.groupBy("panel_id").count().where("count > 1"), "panels", "panel_id", "DUPLICATE_PANEL_ID"),
        row(panels.join(units, "unit_id", "left_anti"), "panels", "panel_id", "UNKNOWN_UNIT_ID"),
        row(units.join(grids, "grid_id", "left_anti"), "units", "unit_id", "UNKNOWN_GRID_ID"),
        row(t["source_figure_manifest"].join(t["source_document_manifest"], "document_id", "left_anti"), "figures", "source_figure_id", "UNKNOWN_DOCUMENT_ID"),
        row(counts.where(F.coalesce("c", F.lit(0)) != F.coalesce("observed_panel_count", F.lit(-1))), "figures", "source_figure_id", "PANEL_COUNT_DIFFERS"),
    ]
    first = out[0]
    for df in out[1:]:
        first = first.unionByName(df)
    return first
