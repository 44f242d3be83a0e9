"""Ledgers: who stands behind a run, what moved, what repeats, what a value's evidence is, and what was counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import orcid_valid

#: From a caption's route to what its panels are, and from there to the statistic.
DISPOSITIONS = {"DIGITIZE": "GEOMETRY_NOT_AUTHORED", "PARTIAL_PANEL_TARGET": "GEOMETRY_NOT_AUTHORED", "NOT_DATA": "NOT_DATA", "ASSOCIATION_ONLY_NOT_TARGET": "ASSOCIATION_EXTRACT", "BINARY_EVENT_NOT_MEAN": "BINARY_EXTRACT", "NO_TARGET_OUTCOME": "NON_TARGET_OUTCOME", "MIXED_CAPTION_NOT_DECIDABLE": "UNRESOLVED"}
STATISTICS = {"ASSOCIATION_EXTRACT": "ASSOCIATION", "BINARY_EXTRACT": "BINARY_EVENT"}
QUANTILE_SPREADS = ("IQR", "RANGE")
#: Answers about error bars that name no spread.
NO_SPREAD = ("UNSTATED", "AMBIGUOUS", "PM_UNNAMED")


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def disposition(route: Column) -> Column:
    """What a route makes of a panel; a route that nobody listed is unresolved."""
    return F.coalesce(F.try_element_at(_map(DISPOSITIONS), route), F.lit("UNRESOLVED"))


def statistic(disposition_: Column, spread: Column) -> Column:
    """The statistic of a panel's values, blank where there is nothing to extract or no spread is known."""
    code = F.upper(F.trim(F.coalesce(spread, F.lit(""))))
    read = F.when((code == "") | code.isin(*NO_SPREAD), "").when(code.isin(*QUANTILE_SPREADS), "QUANTILE_SUMMARY").otherwise("CONTINUOUS")
    return F.coalesce(F.try_element_at(_map(STATISTICS), disposition_), F.when(disposition_ == "GEOMETRY_NOT_AUTHORED", read), F.lit(""))


def answer_problems(seen: Column, observed_by: Column, approval_ref: Column, who: Column) -> Column:
    """Array of what is wrong with an answer's provenance: a person saw it, or somebody's observation was approved by another, with a reference."""
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    o, r, w = text(observed_by), text(approval_ref), text(who)
    bare = (o == "") & (r == "")
    found = F.array(F.when(bare, "NOT_SEEN_BY_PERSON"), F.when(~bare & ((o == "") | (r == "")), "APPROVAL_INCOMPLETE"), F.when((o != "") & (w != "") & (F.lower(o) == F.lower(w)), "OBSERVER_IS_APPROVER"))
    return F.when(F.coalesce(seen, F.lit(False)), F.array().cast("array<string>")).otherwise(F.filter(found, lambda x: x.isNotNull()))


def person_keys(reviewers: DataFrame) -> DataFrame:
    """reviewer, person: the contact that tells people apart, null where there is none."""
    kind, contact = F.upper(F.trim("contact_type")), F.trim("contact")
    key = F.when((kind == "ORCID") & (contact != ""), F.concat(F.lit("ORCID:"), F.upper(contact))).when((kind == "EMAIL") & (contact != ""), F.concat(F.lit("EMAIL:"), F.lower(contact)))
    return reviewers.select("reviewer", key.alias("person"), (F.coalesce(kind == "ORCID", F.lit(False)) & F.coalesce(orcid_valid(contact), F.lit(False))).alias("provable"))


def separation_problems(resolvers: DataFrame, approvers: DataFrame, reviewers: DataFrame) -> DataFrame:
    """(panel, code): a panel whose resolver and approver are, or cannot be shown not to be, one person. resolvers, approvers: panel, reviewer."""
    p = person_keys(reviewers)
    side = lambda df, n: df.select("panel", F.col("reviewer").alias(n)).join(p.select(F.col("reviewer").alias(n), F.col("person").alias(n + "_key"), F.col("provable").alias(n + "_ok")), n, "left")
    both = side(resolvers, "a").join(side(approvers, "b"), "panel")
    same = (F.col("a") == F.col("b")) | F.coalesce(F.col("a_key") == F.col("b_key"), F.lit(False))
    unsure = ~F.coalesce(F.col("a_ok"), F.lit(False)) | ~F.coalesce(F.col("b_ok"), F.lit(False))
    return both.select("panel", F.when(same, "RESOLVER_IS_APPROVER").when(unsure, "REVIEWER_IDENTITY_UNPROVABLE").alias("code")).where("code is not null").distinct()


def run_mode(reviewers: DataFrame, used: DataFrame) -> DataFrame:
    """One row: DEMO_ONLY if a reviewer that the inventory rests on is a demonstration; with nobody named, any reviewer counts. used: reviewer."""
    named = used.select("reviewer").where("trim(reviewer) <> ''").distinct()
    r = reviewers.join(named.withColumn("_u", F.lit(True)), "reviewer", "left").agg(F.bool_or((F.upper(F.trim("record_type")) == "DEMO_IDENTITY") & F.col("_u")).alias("used"), F.bool_or(F.upper(F.trim("record_type")) == "DEMO_IDENTITY").alias("any"))
    n = named.agg(F.count("*").alias("n"))
    return r.join(n, F.lit(True)).select(F.when(F.coalesce(F.when(F.col("n") > 0, F.col("used")).otherwise(F.col("any")), F.lit(False)), "DEMO_ONLY").otherwise("ATTESTED").alias("run_mode"))


def bytes_bound(documents: DataFrame, digest: str) -> DataFrame:
    """One row: ALL, PARTIAL or NONE of the documents have their bytes bound; UNDECLARED or NO_DOCUMENTS."""
    text = F.lower(F.trim(F.coalesce(F.col(digest), F.lit(""))))
    s = documents.agg(F.count("*").alias("n"), F.count_if(text.rlike("^[0-9a-f]{64}$")).alias("h"), F.count_if(text == "not_held").alias("m"))
    state = F.when(F.col("n") == 0, "NO_DOCUMENTS").when((F.col("h") > 0) & (F.col("m") == 0), "ALL").when((F.col("h") == 0) & (F.col("m") > 0), "NONE").when((F.col("h") > 0) & (F.col("m") > 0), "PARTIAL").otherwise("UNDECLARED")
    return s.select(state.alias("bytes_bound"))


def adjacent_twins(rows: DataFrame, by: list[str], page: str, key: str, order: str) -> DataFrame:
    """key, twin, twin_page: the first other row (by order) of the same figure on the page before or after. An equality join on the page."""
    near = rows.select(*by, F.explode(F.array(F.col(page) - 1, F.col(page) + 1)).alias(page), F.col(key).alias("_k"))
    firsts = rows.groupBy(*by, page).agg(F.min(F.struct(F.col(order), F.col(key))).alias("_f"))
    hit = near.join(firsts, [*by, page])
    best = hit.groupBy("_k").agg(F.min_by(F.struct(F.col(f"_f.{key}").alias("twin"), F.col(page).alias("twin_page")), F.col(f"_f.{order}")).alias("_b"))
    return best.select(F.col("_k").alias(key), "_b.twin", "_b.twin_page")


def shared_crops(rows: DataFrame, duplicates: DataFrame, key: str, digest: str) -> DataFrame:
    """key, n_others: rows whose crop equals that of others which are not known duplicates. duplicates: loser, winner.

    Counted, not paired: a digest's rows less the row itself and less its own duplicates of that digest.
    """
    n = rows.where(F.col(digest).isNotNull()).select(F.col(key), F.col(digest)).withColumn("_n", F.count("*").over(Window.partitionBy(digest)) - 1)
    d = rows.select(F.col(key).alias("loser"), F.col(digest).alias("_dl")).join(duplicates.select("loser", "winner").distinct(), "loser").join(rows.select(F.col(key).alias("winner"), F.col(digest).alias("_dw")), "winner").where("_dl = _dw")
    known = d.select(F.explode(F.array("loser", "winner")).alias(key)).groupBy(key).agg(F.count("*").alias("_k"))
    left = n.join(known, key, "left").withColumn("n_others", F.col("_n") - F.coalesce("_k", F.lit(0)))
    return left.where("n_others > 0").select(key, "n_others")


def moved(rows: DataFrame, moves: DataFrame, columns: list[str]) -> DataFrame:
    """rows with old names replaced by new ones in each column. moves: old, new; a name that does not move stays."""
    for c in columns:
        m = moves.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
        rows = rows.join(m, F.col(c) == F.col("_old"), "left").withColumn(c, F.coalesce("_new", c)).drop("_old", "_new")
    return rows


def move_problems(rows: DataFrame, moves: DataFrame, key: str) -> DataFrame:
    """(old, code): moves of nothing, onto something that stays, or two onto one; one problem stops the whole plan."""
    known = rows.select(F.col(key).alias("old")).distinct()
    gone = moves.join(known, "old", "left_anti").select("old", F.lit("MOVE_OF_UNKNOWN").alias("code"))
    stays = known.join(moves.select("old"), "old", "left_anti").select(F.col("old").alias("new"))
    onto = moves.join(stays, "new").select("old", F.lit("MOVE_ONTO_EXISTING").alias("code"))
    twice = moves.withColumn("_n", F.count("*").over(Window.partitionBy("new"))).where("_n > 1").select("old", F.lit("TWO_MOVES_ONTO_ONE").alias("code"))
    return gone.unionByName(onto).unionByName(twice)


def all_or_nothing(rows: DataFrame, by: list[str], problem: Column) -> DataFrame:
    """Rows of the groups without any problem."""
    bad = rows.where(F.coalesce(problem, F.lit(False))).select(*by).distinct()
    return rows.join(bad, by, "left_anti")


def declared_and_detected(declared: DataFrame, detected: DataFrame, by: list[str], name: str) -> DataFrame:
    """by, both, only_declared, only_detected: sorted sets of names."""
    side = lambda df, n: df.groupBy(*by).agg(F.collect_set(name).alias(n))
    j = side(declared, "_a").join(side(detected, "_b"), by, "full")
    none = F.array().cast("array<string>")
    a, b = F.coalesce("_a", none), F.coalesce("_b", none)
    return j.select(*by, F.array_sort(F.array_intersect(a, b)).alias("both"), F.array_sort(F.array_except(a, b)).alias("only_declared"), F.array_sort(F.array_except(b, a)).alias("only_detected"))


def last_match(probes: DataFrame, trace: DataFrame, on: list[str], seq: str, value: str) -> DataFrame:
    """probes with the value of the latest trace row that agrees on every given field, null where none does."""
    last = trace.groupBy(*on).agg(F.max_by(value, seq).alias("last_" + value))
    return probes.join(last, on, "left")


def counts(rows: DataFrame, *by: str) -> DataFrame:
    """How many rows of each kind; blanks are a kind."""
    return rows.groupBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in by]).agg(F.count("*").alias("n"))


def confirmations(values: DataFrame) -> DataFrame:
    """panel, n_inferred, n_cells, panel_needed, cell_needed: what a person must confirm, from the panel's own tiers."""
    inferred, each = F.col("tier").isin("R2", "R3"), F.col("tier") == "R3"
    s = values.groupBy("panel").agg(F.count_if(inferred).alias("n_inferred"), F.count_if(each).alias("n_cells"))
    return s.withColumn("panel_needed", F.col("n_inferred") > 0).withColumn("cell_needed", F.col("n_cells") > 0)


def candidates_not_raw(raw: DataFrame, candidates: DataFrame, columns: list[str]) -> DataFrame:
    """Candidate rows beyond those of the raw table, counted: twice the same candidate needs twice the raw row."""
    text = lambda df: df.select(*[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in columns])
    return text(candidates).exceptAll(text(raw))


def manifest_changes(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, code) for manifests that are missing, added or changed since the run. Both: name, sha256."""
    j = recorded.select("name", F.col("sha256").alias("_r")).join(actual.select("name", F.col("sha256").alias("_a")), "name", "full")
    code = F.when(F.col("_r").isNull() | F.col("_a").isNull(), "RUN_MANIFEST_SET_CHANGED").when(F.lower("_r") != F.lower("_a"), "RUN_MANIFEST_MODIFIED")
    return j.select("name", code.alias("code")).where("code is not null")


def mark_evidence(values: DataFrame, marks: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(value, code): what speaks against a value's mark record. values: value, panel, mark, mean, cell, method; marks: mark, panel, mean, cell, method.

    One record is one value's: a record that several values name is evidence for none. Numbers agree within a relative tolerance.
    """
    m = marks.select("mark", F.col("panel").alias("_panel"), F.col("mean").alias("_mean"), F.col("cell").alias("_cell"), F.col("method").alias("_method"))
    shares = values.where("trim(mark) <> ''").groupBy("mark").agg(F.count("*").alias("_n"))
    j = values.join(shares, "mark", "left").join(m, "mark", "left")
    off = F.abs(F.col("mean") - F.col("_mean")) > tolerance * F.greatest(F.lit(1.0), F.abs("_mean"))
    code = (
        F.when(F.col("_mean").isNull() | F.coalesce(F.trim("mark") == "", F.lit(True)) | (F.col("_panel") != F.col("panel")), "MARK_EVIDENCE_MISSING")
        .when(F.col("_n") > 1, "MARK_EVIDENCE_SHARED")
        .when(~F.col("method").eqNullSafe(F.col("_method")), "METHOD_CONTRADICTS_MARK")
        .when(F.coalesce(off, F.lit(True)), "VALUE_CONTRADICTS_MARK")
        .when(~F.col("cell").eqNullSafe(F.col("_cell")), "CELL_CONTRADICTS_MARK")
    )
    return j.select("value", code.alias("code")).where("code is not null")


def point_problems(points: DataFrame, calibration: DataFrame, by: list[str]) -> DataFrame:
    """Points whose value is not what their pixel gives on their own axis, or that have no axis. points: by, point, px, value; calibration: by, slope, intercept, scale."""
    j = points.join(calibration.select(*by, "slope", "intercept", "scale"), by, "left")
    z = F.col("slope") * F.col("px") + F.col("intercept")
    want = F.when(F.col("scale") == "LOG", F.exp(z)).otherwise(z)
    code = F.when(F.col("slope").isNull(), "AXIS_MISSING").when(F.coalesce(F.abs(want - F.col("value")) > 1e-6 * F.greatest(F.lit(1.0), F.abs("value")), F.lit(True)), "POINT_NOT_REDERIVED")
    return j.select(*by, "point", code.alias("code")).where("code is not null")


def cloud_problems(associations: DataFrame, points: DataFrame) -> DataFrame:
    """(association, code): associations without points, of fewer than three, whose count differs, or whose points were identified in several ways. points: cloud, method."""
    g = points.groupBy("cloud").agg(F.count("*").alias("_n"), F.countDistinct("method").alias("_m"))
    j = associations.join(g, "cloud", "left")
    code = F.when(F.col("_n").isNull(), "CLOUD_MISSING").when(F.col("_n") < 3, "CLOUD_TOO_SMALL").when(F.col("_n") != F.col("n"), "CLOUD_COUNT_DIFFERS").when(F.col("_m") > 1, "CLOUD_IDENTITY_MIXED")
    return j.select("association", code.alias("code")).where("code is not null")


def clipped(x0: Column, x1: Column, y0: Column, y1: Column, width: Column, height: Column) -> Column:
    """A drawn frame cut to the image, null where nothing of it is left."""
    a, b, c, d = F.greatest(x0, F.lit(0)), F.least(x1, width), F.greatest(y0, F.lit(0)), F.least(y1, height)
    return F.when((a < b) & (c < d), F.struct(a.alias("x0"), b.alias("x1"), c.alias("y0"), d.alias("y1")))


def lowest_first(rows: DataFrame, confidence: str, key: str, k: int) -> DataFrame:
    """The k rows that most need a look, least confident first; a report, so it is ordered and limited."""
    return rows.orderBy(F.col(confidence).asc_nulls_first(), key).limit(k)


def first_reason(*reasons: tuple[str, Column]) -> Column:
    """Why a row is held back: the first reason in order that holds, null where none does. A condition that is null does not hold."""
    out = F.lit(None).cast("string")
    for code, when in reversed(reasons):
        out = F.when(F.coalesce(when, F.lit(False)), code).otherwise(out)
    return out


def crop_score(x0: Column, x1: Column, y0: Column, y1: Column, tx0: Column, tx1: Column, ty0: Column, ty1: Column) -> Column:
    """Of a crop and the true region: the share of the region that is covered, and the share of the crop that lies outside it."""
    common = F.greatest(F.least(x1, tx1) - F.greatest(x0, tx0), F.lit(0)) * F.greatest(F.least(y1, ty1) - F.greatest(y0, ty0), F.lit(0))
    area, true = (x1 - x0) * (y1 - y0), (tx1 - tx0) * (ty1 - ty0)
    return F.struct(F.try_divide(common, true).alias("covered"), F.try_divide(area - common, area).alias("outside"))


def updated(rows: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """rows with a column replaced where changes (key, column) has a newer value; keys that are not there are ignored."""
    new = changes.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str = "order") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
