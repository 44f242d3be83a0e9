"""The manifest gate: people, panels, series, positions, own sample sizes and supplied readings against each other.

Checks that depend on each other go in order: a row's first failing lookup decides (a CASE), as later checks would have
nothing to stand on; independent checks are rules of one projection. Tables carry a _line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from . import measure as E
from .grid import first_rows, later_duplicates, union_all
from .rules import Rule, apply, upper

SAFE_ID = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"
#: Vocabularies of people, marks and readings.
RECORD_TYPES = ("HUMAN", "DEMO")
CONTACTS = ("EMAIL", "ORCID")
MARK_TYPES = ("LINE_COLOR", "LINE_MONO", "LINE_MONO_STYLE", "BAR_COLOR", "BAR_MONO", "BOX_VIOLIN", "SCATTER")
COLOUR_MARKS = ("LINE_COLOR", "BAR_COLOR", "SCATTER")
PANEL_MODES = ("", "AUTO", "MANUAL")
READER_KINDS = ("AI_AGENT", "PERSON")
END_BASES = ("", "CAP", "BOUND", "NONE")
#: Names that are no person's.
ROBOTS = ("AI", "BOT", "LLM", "GPT", "CHATGPT", "CODEX", "CLAUDE", "COPILOT", "GEMINI", "LLAMA", "ROBOT", "SCRIPT", "AUTO", "AUTOMATED", "AUTOMATION", "MACHINE", "AGENT", "ASSISTANT", "MODEL", "SYSTEM", "PIPELINE", "TOOL")


def _t(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


def _line_of(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "_line"]


def _at(df: DataFrame, scope: str, code: Column | str, key: str = "_line", detail: Column | None = None) -> DataFrame:
    c = F.lit(code) if isinstance(code, str) else code
    return df.select(F.lit(scope).alias("scope"), F.col(key).cast("string").alias("row_id"), c.alias("code"), (detail if detail is not None else F.lit("")).cast("string").alias("detail"))


def first_failure(*checks: tuple[str, Column]) -> Column:
    """The code of the first condition that holds; a condition that is null does not."""
    c = F.when(F.coalesce(checks[0][1], F.lit(False)), checks[0][0])
    for code, cond in checks[1:]:
        c = c.when(F.coalesce(cond, F.lit(False)), code)
    return c


def reviewer_problems(reviewers: DataFrame) -> DataFrame:
    name = lambda c: F.filter(F.split(F.upper(_t(c)), r"[^\p{L}\p{N}]+"), lambda x: x.rlike(r"\p{L}"))
    thin = lambda c: (_t(c) != "") & ((F.length(F.regexp_replace(_t(c), r"[^\p{L}\p{N}]", "")) < 2) | (F.size(name(c)) == 0))
    robot = lambda c: (_t(c) != "") & ~thin(c) & F.forall(name(c), lambda x: F.regexp_replace(x, r"[0-9]+$", "").isin(*ROBOTS))
    kind, contact, att = upper("Contact_Type"), _t("Reviewer_Contact"), upper("Human_Attestation")
    rules = [Rule("MISSING_REQUIRED", S.is_blank(F.col(c)), F.lit(c)) for c in ("Reviewer_ID", "Reviewer_Name", "Reviewer_Record_Type", "Contact_Type", "Reviewer_Contact", "Registered_By", "Registration_Date", "Human_Attestation")]
    rules += [Rule("UNRESOLVED_REVIEWER_IDENTITY", S.unresolved_marker(F.col(c)).isNotNull(), F.lit(c)) for c in ("Reviewer_ID", "Reviewer_Name", "Reviewer_Contact", "Registered_By")]
    rules += [r for c in ("Reviewer_Name", "Registered_By") for r in (Rule("UNRESOLVED_REVIEWER_IDENTITY", thin(c), F.lit(c)), Rule("REVIEWER_NOT_HUMAN", robot(c), F.lit(c)))]
    rules += [
        Rule("BAD_REVIEWER_RECORD_TYPE", (upper("Reviewer_Record_Type") != "") & ~upper("Reviewer_Record_Type").isin(*RECORD_TYPES)),
        Rule("REVIEWER_NOT_HUMAN", att == "AUTOMATED_AGENT"),
        Rule("BAD_CONTACT_TYPE", (kind != "") & ~kind.isin(*CONTACTS)),
        Rule("BAD_REVIEWER_CONTACT", (contact != "") & (kind == "EMAIL") & ~contact.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")),
        Rule("BAD_REVIEWER_CONTACT", (contact != "") & (kind == "ORCID") & ~F.coalesce(S.orcid_valid(contact), F.lit(False))),
        Rule("BAD_REGISTRATION_DATE", (_t("Registration_Date") != "") & F.col("Registration_Date").try_cast("date").isNull()),
    ]
    named = reviewers.where(_t("Reviewer_ID") != "").withColumn("_id", _t("Reviewer_ID"))
    return apply(reviewers, rules, "reviewers", "_line").unionByName(_at(later_duplicates(named, ["_id"], ["_line"]), "reviewers", "DUPLICATE_REVIEWER_ID"))


def panel_problems(panels: DataFrame, series: DataFrame, positions: DataFrame, units: DataFrame) -> DataFrame:
    """Panels by themselves, their children, and the one-to-one between panels and units."""
    p = panels.withColumn("_box", E.box(F.concat_ws(",", "Panel_X0", "Panel_X1", "Panel_Y0", "Panel_Y1"))).withColumn("_id", _t("Panel_ID"))
    p = p.withColumn("_yt", E.ticks(F.col("Y_Ticks")))
    inside = F.forall("_yt", lambda t: (t["px"] >= F.col("_box.y0")) & (t["px"] <= F.col("_box.y1")))
    mark, mode = upper("Mark_Type"), upper("Panel_Mode")
    rules = [
        Rule("UNSAFE_ID", ~F.col("_id").rlike(SAFE_ID)),
        Rule("BAD_MARK_TYPE", ~mark.isin(*MARK_TYPES), mark),
        Rule("BAD_PANEL_MODE", ~mode.isin(*PANEL_MODES), mode),
        Rule("BAD_PANEL_BOX", F.col("_box").isNull()),
        Rule("MISSING_AXIS_CALIBRATION", S.is_blank(F.col("Y_Ticks"))),
        Rule("BAD_AXIS_CALIBRATION", ~S.is_blank(F.col("Y_Ticks")) & F.col("_yt").isNull()),
        Rule("CALIBRATION_OUTSIDE_PANEL", F.col("_yt").isNotNull() & F.col("_box").isNotNull() & ~inside),
        Rule("BAD_AXIS_SCALE", (upper("Y_Scale") != "") & ~upper("Y_Scale").isin("LINEAR", "LOG")),
    ]
    s, q = series.withColumn("_p", _t("Panel_ID")).withColumn("_s", _t("Series_ID")), positions.withColumn("_p", _t("Panel_ID")).withColumn("_q", _t("Position_ID"))
    ids = p.select(F.col("_id").alias("_p"), mark.alias("_mark"), "_box")
    x = S.as_number(F.col("X_Pixel"))
    placed = q.join(ids, "_p", "left")
    coloured = s.join(ids.where(F.col("_mark").isin(*COLOUR_MARKS)), "_p").withColumn("_rgb", E.colour(F.col("Colour_Hex")))
    a = coloured.where("_rgb is not null").select("_p", F.col("_s").alias("_a"), F.col("_rgb").alias("_ra"), F.coalesce(S.as_number(F.col("Colour_Tolerance")), F.lit(60.0)).alias("_ta"))
    b = a.select("_p", F.col("_a").alias("_b"), F.col("_ra").alias("_rb"), F.col("_ta").alias("_tb"))
    near = a.join(b, "_p").where(F.col("_a") < F.col("_b")).where(S.colour_distance(*[F.col("_ra")[i] for i in range(3)], *[F.col("_rb")[i] for i in range(3)]) <= F.col("_ta") + F.col("_tb"))
    u = units.select(_t("Unit_ID").alias("unit"), _t("Panel_ID").alias("_up"))
    pairs = p.select("_line", "_id", _t("Unit_ID").alias("unit")).join(u, "unit", "left")
    return union_all([
        apply(p, rules, "panels", "_line"),
        _at(later_duplicates(p, ["_id"], ["_line"]), "panels", "DUPLICATE_PANEL_ID"),
        _at(p.join(s.select("_p").distinct(), p["_id"] == F.col("_p"), "left_anti"), "panels", "PANEL_HAS_NO_SERIES"),
        _at(p.where(mark != "SCATTER").join(q.select("_p").distinct(), F.col("_id") == F.col("_p"), "left_anti"), "panels", "PANEL_HAS_NO_POSITIONS"),
        _at(s.join(ids, "_p", "left_anti"), "series", "PANEL_NOT_FOUND"),
        _at(later_duplicates(s, ["_p", "_s"], ["_line"]), "series", "DUPLICATE_SERIES_ID"),
        _at(coloured.where(F.col("_rgb").isNull() & ~S.is_blank(F.col("Colour_Hex"))), "series", "BAD_SERIES_COLOUR"),
        _at(near, "panels", "SERIES_COLOURS_OVERLAP", "_p", F.concat_ws("/", "_a", "_b")),
        _at(later_duplicates(q, ["_p", "_q"], ["_line"]), "positions", "DUPLICATE_POSITION_ID"),
        _at(placed.where(F.col("_mark").isNull()), "positions", "PANEL_NOT_FOUND"),
        _at(placed.where((F.col("_mark") != "SCATTER") & x.isNull()), "positions", "BAD_X_PIXEL"),
        _at(placed.where((x < F.col("_box.x0")) | (x > F.col("_box.x1"))), "positions", "POSITION_OUTSIDE_PANEL"),
        _at(pairs.where(F.col("_up").isNull()), "panels", "UNIT_NOT_FOUND"),
        _at(pairs.where(F.col("_up") != F.col("_id")), "panels", "PANEL_UNIT_MISMATCH"),
        _at(u.join(p.select(F.col("_id").alias("_up")), "_up", "left_anti"), "units", "UNIT_PANEL_NOT_FOUND", "unit"),
        _at(p.groupBy(_t("Unit_ID").alias("unit")).agg(F.count("*").alias("c")).where("c > 1"), "units", "UNIT_FILLED_TWICE", "unit"),
    ])


def own_n_problems(own: DataFrame, panels: DataFrame, series: DataFrame, positions: DataFrame, units: DataFrame) -> DataFrame:
    """A group's own n: declared, once, on one level, for all of a panel's series or none, and never beside the unit's."""
    p = panels.select(_t("Panel_ID").alias("_p"), _t("Unit_ID").alias("_u")).distinct().join(units.select(_t("Unit_ID").alias("_u"), upper("Statistic_Type").alias("_st"), F.col("N_Outcome").alias("_un")), "_u", "left")
    s = series.select(_t("Panel_ID").alias("_p"), _t("Series_ID").alias("_s")).distinct()
    q = positions.select(_t("Panel_ID").alias("_p"), _t("Position_ID").alias("_q")).distinct()
    o = own.withColumns({"_p": _t("Panel_ID"), "_s": _t("Series_ID"), "_q": _t("Position_ID")})
    o = o.join(p.withColumn("_hp", F.lit(True)), "_p", "left").join(s.withColumn("_hs", F.lit(True)), ["_p", "_s"], "left").join(q.withColumn("_hq", F.lit(True)), ["_p", "_q"], "left")
    o = o.withColumn("_lookup", first_failure(("SERIES_N_PANEL_UNKNOWN", F.col("_hp").isNull()), ("SERIES_N_SERIES_UNKNOWN", F.col("_hs").isNull()), ("SERIES_N_POSITION_UNKNOWN", (F.col("_q") != "") & F.col("_hq").isNull())))
    first = F.first(F.col("_q") == "").over(Window.partitionBy("_p", "_s").orderBy("_line"))
    known = o.where(F.col("_lookup").isNull()).withColumn("_mixed", (F.col("_q") == "") != first)
    good = known.where("not _mixed").withColumn("_k", F.row_number().over(Window.partitionBy("_p", "_s", "_q").orderBy("_line")))
    once = good.where("_k = 1").withColumn("_bad", ~_t("N_Outcome").rlike("^[0-9]+$") | (S.as_number(F.col("N_Outcome")) <= 0))
    have = once.where("not _bad").select("_p", "_s").distinct()
    part = have.select("_p").distinct().join(s, "_p").join(have, ["_p", "_s"], "left_anti").select("_p").distinct()
    both = have.select("_p").distinct().join(p.where(~S.is_blank(F.col("_un"))), "_p")
    return union_all([
        _at(o.where(F.col("_lookup").isNotNull()), "series_n", F.col("_lookup")),
        _at(known.where("_mixed"), "series_n", "SERIES_N_LEVEL_MIXED"),
        _at(good.where("_k > 1"), "series_n", "SERIES_N_DUPLICATE"),
        _at(once.where("_bad"), "series_n", "SERIES_N_BAD"),
        _at(once.where(~F.col("_bad") & S.only_space(F.col("N_Source"))), "series_n", "MISSING_REQUIRED"),
        _at(once.where(~F.col("_bad") & F.col("_st").isNotNull() & ~F.col("_st").isin("CONTINUOUS", "QUANTILE_SUMMARY")), "series_n", "SERIES_N_STATISTIC_UNSUPPORTED"),
        _at(part, "panels", "SERIES_N_PARTIAL", "_p"),
        _at(both, "panels", "SERIES_N_WITH_UNIT_N", "_p"),
    ])


def reading_problems(readings: DataFrame, panels: DataFrame, series: DataFrame, positions: DataFrame, units: DataFrame, reviewers: DataFrame, as_of: str) -> DataFrame:
    """Each supplied reading names a cell that a manual panel declares, once, by somebody, inside the panel, with its ends on their sides and nearest to its own position."""
    p = first_rows(panels.select(*_line_of(panels), _t("Panel_ID").alias("_p"), _t("Unit_ID").alias("_u"), upper("Panel_Mode").alias("_mode"), E.box(F.concat_ws(",", "Panel_X0", "Panel_X1", "Panel_Y0", "Panel_Y1")).alias("_box"), _t("Raster_SHA256").alias("_sha")), ["_p"]).drop("_line")
    st = first_rows(units.select(*_line_of(units), _t("Unit_ID").alias("_u"), upper("Statistic_Type").alias("_st")), ["_u"]).drop("_line")
    s = series.select(_t("Panel_ID").alias("_p"), _t("Series_ID").alias("_s")).distinct().withColumn("_hs", F.lit(True))
    q = first_rows(positions.select(*_line_of(positions), _t("Panel_ID").alias("_p"), _t("Position_ID").alias("_q"), S.as_number(F.col("X_Pixel")).alias("_ax")), ["_p", "_q"]).drop("_line")
    people = first_rows(reviewers.select(*_line_of(reviewers), _t("Reviewer_ID").alias("_who"), upper("Reviewer_Record_Type").alias("_rt")), ["_who"]).drop("_line")
    anchors = q.groupBy("_p").agg(F.collect_list("_ax").alias("_all"))
    r = readings.withColumns({"_id": _t("Reading_ID"), "_p": _t("Panel_ID"), "_s": _t("Series_ID"), "_q": _t("Position_ID"), "_who": _t("Read_By"), "_kind": upper("Reader_Kind"), "_basis": upper("End_Basis")})
    r = r.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy("_line")))
    r = r.join(p, "_p", "left").join(st, "_u", "left").join(s, ["_p", "_s"], "left").join(q, ["_p", "_q"], "left").join(anchors, "_p", "left").join(people, "_who", "left")
    edge = lambda c: ~S.only_space(F.col(c))
    up, low = edge("Box_Upper_Y_Px"), edge("Box_Lower_Y_Px")
    quantile, mean = F.col("_st") == "QUANTILE_SUMMARY", F.col("_st") == "CONTINUOUS"
    order = first_failure(
        ("SUPPLIED_READING_ID_BAD", ~F.col("_id").rlike(SAFE_ID)),
        ("SUPPLIED_READING_DUPLICATE", F.col("_n") > 1),
        ("SUPPLIED_READING_PANEL_UNKNOWN", F.col("_mode").isNull()),
        ("SUPPLIED_READING_ON_READER_PANEL", F.col("_mode") != "MANUAL"),
        ("SUPPLIED_READING_STATISTIC_UNSUPPORTED", ~F.coalesce(quantile | mean, F.lit(False))),
        ("SUPPLIED_READING_BOX_EDGES_MISSING", quantile & ~(up & low)),
        ("SUPPLIED_READING_BOX_ON_MEAN", mean & (up | low)),
        ("SUPPLIED_END_BASIS_UNKNOWN", ~F.col("_basis").isin(*END_BASES)),
        ("SUPPLIED_END_BOUND_ON_BOX", (F.col("_basis") == "BOUND") & quantile),
        ("SUPPLIED_END_NONE_ON_BOX", (F.col("_basis") == "NONE") & quantile),
        ("SUPPLIED_READING_SERIES_UNKNOWN", F.col("_hs").isNull()),
        ("SUPPLIED_READING_POSITION_UNKNOWN", F.col("_all").isNull() | (F.col("_ax").isNull() & ~F.coalesce(F.array_contains("_all", F.col("_ax")), F.lit(False)))),
    )
    r = r.withColumn("_first", order)
    fine = r.where(F.col("_first").isNull()).withColumn("_c", F.row_number().over(Window.partitionBy("_p", "_s", "_q").orderBy("_line")))
    one = fine.where("_c = 1")
    y, x = S.as_number(F.col("Mark_Y_Px")), S.as_number(F.col("Mark_X_Px"))
    ends = [S.as_number(F.col(c)) for c in ("Upper_Y_Px", "Lower_Y_Px")]
    pixels = ("Mark_X_Px", "Mark_Y_Px", "Upper_Y_Px", "Lower_Y_Px", "Box_Upper_Y_Px", "Box_Lower_Y_Px")
    bad = lambda c: ~S.only_space(F.col(c)) & S.as_number(F.col(c)).isNull()
    out = lambda c: ((S.as_number(F.col(c)) < F.col("_box.y0")) | (S.as_number(F.col(c)) > F.col("_box.y1"))) if c != "Mark_X_Px" else ((x < F.col("_box.x0")) | (x > F.col("_box.x1")))
    person = F.col("_kind") == "PERSON"
    when = F.col("Read_At").try_cast("date")
    dated = _t("Read_At").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    any_end = ends[0].isNotNull() | ends[1].isNotNull()
    rules = [
        Rule("SUPPLIED_READER_KIND_UNKNOWN", ~F.col("_kind").isin(*READER_KINDS)),
        Rule("MISSING_REQUIRED", F.col("_who") == "", F.lit("Read_By")),
        Rule("SUPPLIED_READER_NOT_REGISTERED", (F.col("_who") != "") & person & F.col("_rt").isNull()),
        Rule("SUPPLIED_READER_NOT_HUMAN", (F.col("_who") != "") & person & (F.col("_rt") != "HUMAN")),
        Rule("SUPPLIED_READING_DATE_BAD", ~dated | (person & when.isNull())),
        Rule("SUPPLIED_READING_DATE_FUTURE", dated & person & (when > F.lit(as_of).cast("date"))),
        *[Rule("MISSING_REQUIRED", S.only_space(F.col(c)), F.lit(c)) for c in pixels[:2]],
        *[Rule("SUPPLIED_READING_PIXEL_BAD", bad(c), F.lit(c)) for c in pixels],
        *[Rule("SUPPLIED_READING_OUTSIDE_PANEL", out(c), F.lit(c)) for c in pixels],
        Rule("SUPPLIED_END_BOUND_WITHOUT_END", (F.col("_basis") == "BOUND") & ~any_end),
        Rule("SUPPLIED_END_NONE_WITH_END", (F.col("_basis") == "NONE") & any_end),
        Rule("SUPPLIED_READING_ENDS_INVERTED", (ends[0] > y) | (ends[1] < y)),
        Rule("SUPPLIED_READING_BOX_INVERTED", (S.as_number(F.col("Box_Upper_Y_Px")) > y) | (S.as_number(F.col("Box_Lower_Y_Px")) < y)),
        Rule("SUPPLIED_READING_NOT_AT_ITS_POSITION", F.exists("_all", lambda a: F.abs(a - x) < F.abs(F.col("_ax") - x))),
        Rule("SUPPLIED_READING_RASTER_MISMATCH", (F.col("_sha") != "") & (F.lower(_t("Raster_SHA256")) != F.lower(F.col("_sha")))),
    ]
    return union_all([_at(r.where(F.col("_first").isNotNull()), "readings", F.col("_first")), _at(fine.where("_c > 1"), "readings", "SUPPLIED_READING_CELL_TWICE"), apply(one, rules, "readings", "_line")])
