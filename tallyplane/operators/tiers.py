"""What a value costs a reviewer: tiers by how it was identified, measured and spread, and which methods a reader may claim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

#: The tier of each method.
IDENTITY = {"MEASURED_COLOUR": "R0", "MEASURED_MARKER_SHAPE": "R0", "MEASURED_MARKER_FILL": "R0", "MEASURED_MARKER_SHAPE_FILL": "R0", "MEASURED_LINE_STYLE": "R0", "MEASURED_FILL_RELATION": "R0", "DECLARED_SINGLE_SERIES": "R1", "COMPLEMENT_OF_DECLARED_STYLES": "R2", "FIGURE_PROTOTYPE_MATCH": "R2", "CONTINUITY_TRACK": "R3", "HUMAN_RESOLUTION": "R0", "AI_ASSIGNED_SERIES": "R2", "PERSON_ASSIGNED_SERIES": "R0"}
VALUE = {"BAR_OUTLINE_CENTER": "R0", "MARKER_CENTER": "R0", "BOX_GEOMETRY": "R0", "POINT_CLOUD_ASSOCIATION": "R0", "DIRECT_CURVE_INK": "R0", "MANUAL_DIGITIZED": "R0", "AI_PLACED_POINT": "R2", "RESTORED_MASKED_FURNITURE": "R1", "RESTORED_LINE_PATTERN_GAP": "R1", "LOCAL_BRACKETED_INTERPOLATION": "R3", "NONLOCAL_INTERPOLATION": "R4", "INTERPOLATED_CURVE_INK": "R3", "MERGED_RUN_EDGE": "R3", "EXTRAPOLATED_CURVE_INK": "R4", "FIT_FALLBACK": "R4"}
DISPERSION = {"DIRECT_CONNECTED_CAP": "R0", "DIRECT_BOUND_PAIR": "R0", "DIRECT_BOX_GEOMETRY": "R0", "SOURCE_TRANSCRIBED": "R0", "UNSTEMMED_CAP": "R3", "RESTORED_MASKED_CAP": "R3", "INTERPOLATED_DISPERSION": "R3", "FITTED_DISPERSION": "R4", "NO_DISPERSION": "R0", "AI_PLACED_CAP": "R2", "MANUAL_PLACED_CAP": "R0", "BOUND_HIDDEN_END": "R3", "MEAN_ONLY_DECLARED": "R0"}
#: Which (identity, value) pairs and spreads each reader may claim.
CURVE_VALUES = ("DIRECT_CURVE_INK", "RESTORED_MASKED_FURNITURE", "RESTORED_LINE_PATTERN_GAP", "LOCAL_BRACKETED_INTERPOLATION", "INTERPOLATED_CURVE_INK", "MERGED_RUN_EDGE", "NONLOCAL_INTERPOLATION", "EXTRAPOLATED_CURVE_INK", "FIT_FALLBACK")
CONTRACT = {
    "LINE_COLOR": (("MEASURED_COLOUR",), ("MARKER_CENTER",)),
    "LINE_MONO": (("MEASURED_MARKER_SHAPE", "MEASURED_MARKER_FILL", "DECLARED_SINGLE_SERIES"), ("MARKER_CENTER",)),
    "LINE_MONO_STYLE": (("MEASURED_LINE_STYLE", "COMPLEMENT_OF_DECLARED_STYLES", "CONTINUITY_TRACK"), CURVE_VALUES),
    "BAR_COLOR": (("MEASURED_COLOUR",), ("BAR_OUTLINE_CENTER",)),
    "BAR_MONO": (("MEASURED_FILL_RELATION", "FIGURE_PROTOTYPE_MATCH", "HUMAN_RESOLUTION"), ("BAR_OUTLINE_CENTER",)),
    "BOX_VIOLIN": (("DECLARED_SINGLE_SERIES",), ("BOX_GEOMETRY",)),
    "SCATTER": (("MEASURED_COLOUR", "DECLARED_SINGLE_SERIES", "MEASURED_MARKER_SHAPE_FILL", "MEASURED_MARKER_FILL", "MEASURED_MARKER_SHAPE"), ("POINT_CLOUD_ASSOCIATION",)),
}
SUPPLIED_PAIRS = (("AI_ASSIGNED_SERIES", "AI_PLACED_POINT"), ("DECLARED_SINGLE_SERIES", "AI_PLACED_POINT"), ("PERSON_ASSIGNED_SERIES", "MANUAL_DIGITIZED"), ("DECLARED_SINGLE_SERIES", "MANUAL_DIGITIZED"))
SPREAD_CONTRACT = {
    "LINE_COLOR": ("DIRECT_CONNECTED_CAP", "UNSTEMMED_CAP"),
    "LINE_MONO": ("DIRECT_CONNECTED_CAP", "UNSTEMMED_CAP", "NO_DISPERSION"),
    "LINE_MONO_STYLE": ("DIRECT_CONNECTED_CAP", "NO_DISPERSION"),
    "BAR_COLOR": ("DIRECT_CONNECTED_CAP", "NO_DISPERSION"),
    "BAR_MONO": ("DIRECT_CONNECTED_CAP", "NO_DISPERSION"),
    "BOX_VIOLIN": ("DIRECT_BOX_GEOMETRY",),
    "SCATTER": ("NO_DISPERSION",),
    "SUPPLIED": ("AI_PLACED_CAP", "MANUAL_PLACED_CAP", "BOUND_HIDDEN_END", "MEAN_ONLY_DECLARED", "NO_DISPERSION"),
}
FINALIZABLE = ("R0", "R1", "R2", "R3")
PANEL_CONFIRMATION = ("R2", "R3")
CELL_CONFIRMATION = ("R3",)


def _lookup(table: dict[str, str], c: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(F.trim(c), F.lit(""))), F.lit("R4"))


def row_tier(identity: Column, value: Column, dispersion: Column, has_spread: Column) -> Column:
    """The worst over the three axes; a spread without a method, and any unknown method, is R4."""
    spread = F.when(~has_spread, F.lit("R0")).otherwise(_lookup(DISPERSION, dispersion))
    return S.worst_tier(_lookup(IDENTITY, identity), _lookup(VALUE, value), spread)


def interpolation_method(span: Column, stroke: Column, dash_gap: Column, occlusion: Column, none: str = "NONE", mixed: str = "MIXED") -> Column:
    """Local if the gap is no wider than what the figure itself draws; then by whose gap it was."""
    reach = F.greatest(F.coalesce(stroke, F.lit(0.0)), F.coalesce(dash_gap, F.lit(0.0)))
    return F.when(F.coalesce(span, F.lit(0.0)) > reach, "NONLOCAL_INTERPOLATION").when(occlusion == none, "RESTORED_LINE_PATTERN_GAP").when(occlusion == mixed, "LOCAL_BRACKETED_INTERPOLATION").otherwise("RESTORED_MASKED_FURNITURE")


def route(mark_type: Column, panel_mode: Column) -> Column:
    return F.when(F.upper(F.trim(F.coalesce(panel_mode, F.lit("")))) == "MANUAL", "SUPPLIED").otherwise(F.upper(F.trim(mark_type)))


def contract(spark: SparkSession) -> DataFrame:
    rows = [(r, i, v) for r, (ids, vals) in CONTRACT.items() for i in ids for v in vals] + [("SUPPLIED", i, v) for i, v in SUPPLIED_PAIRS]
    return spark.createDataFrame(rows, "route string, identity_method string, value_method string")


def outside_contract(values: DataFrame) -> DataFrame:
    """values (route, identity_method, value_method) whose pair their route may not claim."""
    return values.join(F.broadcast(contract(values.sparkSession)), ["route", "identity_method", "value_method"], "left_anti")


def outside_spread_contract(values: DataFrame) -> DataFrame:
    rows = [(r, m) for r, ms in SPREAD_CONTRACT.items() for m in ms]
    return values.join(F.broadcast(values.sparkSession.createDataFrame(rows, "route string, dispersion_method string")), ["route", "dispersion_method"], "left_anti")
