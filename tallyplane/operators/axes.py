"""Axes: ladders of labels, grids of ticks, shared and transferred scales. Ticks of an axis are declared and few; axes are many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import association as A

#: Least labels of a ladder, its tolerance, pixels on a tick, change of value a tick, share of a step, share of a frame's height.
LEAST_LABELS, LADDER_TOLERANCE, ON_TICK_PX, TICK_STEP, TICK_HIT, SHARED_ROWS = 3, 0.08, 3, 0.01, 0.6, 0.02


def longest_ladder(ticks: DataFrame, by: list[str], px: str, value: str, tolerance: float = LADDER_TOLERANCE) -> DataFrame:
    """The longest run of neighbouring labels that is a ladder: first and last pixel, labels, and how many runs are as long (more than one: refused).

    Sums over the ordered steps tell of every run whether it is even, so a run is two rows' difference.
    """
    w = Window.partitionBy(*by).orderBy(px)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    t = ticks.select(*by, F.col(px).cast("double").alias("_p"), F.col(value).cast("double").alias("_v"))
    w, up = Window.partitionBy(*by).orderBy("_p"), Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_i", F.row_number().over(w)).withColumn("_dv", F.col("_v") - F.lag("_v").over(w)).withColumn("_dp", F.col("_p") - F.lag("_p").over(w))
    rate = F.coalesce(F.try_divide("_dv", "_dp"), F.lit(0.0))
    sums = {"_s": rate, "_q": rate * rate, "_rise": (F.col("_dv") > 0).cast("int"), "_fall": (F.col("_dv") < 0).cast("int"), "_bad": (F.col("_dp") <= 0).cast("int")}
    t = t.select(*by, "_i", "_p", *[F.sum(F.coalesce(c, F.lit(0))).over(up).alias(k) for k, c in sums.items()])
    a = t.select(*by, *[F.col(c).alias("a" + c) for c in ("_i", "_p", *sums)])
    b = t.select(*by, *[F.col(c).alias("b" + c) for c in ("_i", "_p", *sums)])
    k = F.col("b_i") - F.col("a_i")
    d = {c: F.col("b" + c) - F.col("a" + c) for c in sums}
    mean = d["_s"] / k
    cv = F.try_divide(F.sqrt(F.greatest(d["_q"] / k - mean * mean, F.lit(0.0))), F.abs(mean))
    runs = a.join(b, by).where(F.col("b_i") - F.col("a_i") >= LEAST_LABELS - 1).where(((d["_rise"] == k) | (d["_fall"] == k)) & (d["_bad"] == 0) & F.coalesce(cv <= tolerance, F.lit(False)))
    best = runs.select(*by, (k + 1).alias("labels"), F.col("a_p").alias("first_px"), F.col("b_p").alias("last_px"))
    best = best.withColumn("_r", F.rank().over(Window.partitionBy(*by).orderBy(F.desc("labels")))).where("_r = 1").drop("_r")
    return best.groupBy(*by).agg(F.first("labels").alias("labels"), F.count("*").alias("n_longest"), F.min("first_px").alias("first_px"), F.min("last_px").alias("last_px"))


def x_ladder(ticks: DataFrame, by: list[str], px: str, value: str) -> DataFrame:
    """A ladder whose values rise with the column."""
    w = Window.partitionBy(*by).orderBy(px)
    rising = ticks.withColumn("_dv", F.col(value) - F.lag(value).over(w)).groupBy(*by).agg((F.min("_dv") > 0).alias("_rise"))
    return A.ladder(ticks, by, px, value).join(rising, by).select(*by, "labels", "cv", (F.col("is_ladder") & F.coalesce("_rise", F.lit(False))).alias("is_ladder"))


def labels_off_ticks(labels: DataFrame, ticks: DataFrame, by: list[str], px: str, tick: str) -> DataFrame:
    """Labels that stand over no tick: further from the nearest than TICK_HIT of the mean step; fewer than two ticks say nothing."""
    from .relate import nearest_anchor

    step = ticks.groupBy(*by).agg(F.try_divide(F.max(tick) - F.min(tick), F.count("*") - 1).alias("_step"), F.count("*").alias("_n")).where("_n >= 2")
    near = nearest_anchor(labels, ticks, by, px, tick, [px])
    return near.join(step, by).where(F.abs(F.col(px) - F.col(tick)) > TICK_HIT * F.col("_step")).select(*by, px, F.abs(F.col(px) - F.col(tick)).alias("off"))


def _wrapped(x: Column, pitch: Column) -> Column:
    m = F.pmod(x, pitch)
    return F.when(m > pitch / 2, m - pitch).otherwise(m)


def grid_verdict(labels: DataFrame, ticks: DataFrame, by: list[str], px: str, value: str, tick: str) -> DataFrame:
    """Whether an axis' labels agree with its measured ticks: CONSISTENT, CONTRADICTED, OFF_GRID, or UNMEASURED.

    The pitch is the upper median of the ticks' gaps. Ticks off their own grid measure nothing; labels must share one shift from the grid, and
    the value a tick must not vary along it.
    """
    w = Window.partitionBy(*by).orderBy(tick)
    gaps = ticks.select(*by, F.col(tick).cast("double").alias(tick)).withColumn("_gap", F.col(tick) - F.lag(tick).over(w))
    g = gaps.groupBy(*by).agg(F.count("*").alias("_nt"), F.min(tick).alias("_t0"), F.sort_array(F.collect_list("_gap")).alias("_g"))
    g = g.withColumn("_pitch", F.get("_g", F.floor(F.size("_g") / 2).cast("int"))).drop("_g")
    pitch = F.when(F.col("_pitch") > 0, F.col("_pitch"))
    astray = ticks.join(g, by).groupBy(*by).agg(F.max(F.abs(_wrapped(F.col(tick) - F.col("_t0"), pitch))).alias("_astray"))
    v = Window.partitionBy(*by).orderBy(px)
    lab = labels.select(*by, F.col(px).cast("double").alias(px), F.col(value).cast("double").alias(value)).join(g, by, "left")
    lab = lab.withColumn("_shift", _wrapped(F.col(px) - F.col("_t0"), pitch)).withColumn("_k", F.rint(F.try_divide(F.col(px) - F.lag(px).over(v), pitch))).withColumn("_dv", F.lag(value).over(v) - F.col(value))
    lab = lab.withColumn("_step", F.try_divide("_dv", F.when(F.col("_k") >= 1, F.col("_k"))))
    s = lab.groupBy(*by).agg(F.count("*").alias("_nl"), F.first("_nt").alias("_nt"), F.first("_pitch").alias("_pitch"), (F.max("_shift") - F.min("_shift")).alias("_spread"), F.min("_k").alias("_least"), F.avg("_step").alias("_mean"), (F.max("_step") - F.min("_step")).alias("_vary")).join(astray, by, "left")
    few = (F.col("_nl") < LEAST_LABELS) | F.coalesce(F.col("_nt") < LEAST_LABELS, F.lit(True))
    verdict = (
        F.when(few | F.coalesce(F.col("_pitch") < 2 * ON_TICK_PX, F.lit(True)) | (F.col("_astray") > ON_TICK_PX), "UNMEASURED")
        .when(F.col("_spread") > ON_TICK_PX, "OFF_GRID")
        .when((F.col("_least") < 1) | F.coalesce(F.col("_mean") == 0, F.lit(True)), "UNMEASURED")
        .when(F.try_divide("_vary", F.abs("_mean")) > TICK_STEP, "CONTRADICTED")
        .otherwise("CONSISTENT")
    )
    return s.select(*by, verdict.alias("verdict"))


def best_per_value(candidates: DataFrame, by: list[str], value: str, confidence: str, keep: list[str]) -> DataFrame:
    """Of the readings of one value the one with the highest confidence (ties: the first by keep)."""
    w = Window.partitionBy(*by, value).orderBy(F.desc(confidence), *keep)
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def chosen_values(candidates: DataFrame, by: list[str], px: str, value: str) -> DataFrame:
    """The one combination of the values read at the ticks that is a ladder: n_ladders, and the pairs (px, value) where there is exactly one.

    All combinations of an axis are formed as one array, a tick at a time; candidates of a tick are few by declaration.
    """
    rows = candidates.select(*by, F.col(px).cast("double").alias("_p"), F.col(value).cast("double").alias("_v")).distinct().groupBy(*by, "_p").agg(F.sort_array(F.collect_list("_v")).alias("_c"))
    axis = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_p", "_c"))).alias("_rows"))
    pair = "array<array<struct<px:double,value:double>>>"
    start = F.array(F.array().cast("array<struct<px:double,value:double>>")).cast(pair)
    grown = F.aggregate("_rows", start, lambda acc, r: F.flatten(F.transform(acc, lambda a: F.transform(r["_c"], lambda v: F.concat(a, F.array(F.struct(r["_p"].alias("px"), v.alias("value"))))))))
    combos = axis.select(*by, F.posexplode(grown).alias("_id", "_pairs"))
    ladders = A.ladder(combos.select(*by, "_id", F.explode("_pairs").alias("_x")).select(*by, "_id", "_x.px", "_x.value"), [*by, "_id"], "px", "value").where("is_ladder")
    won = combos.join(ladders.select(*by, "_id"), [*by, "_id"]).groupBy(*by).agg(F.count("*").alias("n_ladders"), F.first("_pairs").alias("_pairs"))
    return axis.select(*by).join(won, by, "left").select(*by, F.coalesce("n_ladders", F.lit(0).cast("long")).alias("n_ladders"), F.when(F.col("n_ladders") == 1, F.col("_pairs")).alias("pairs"))


def category_spacing(centres: DataFrame, by: list[str], x: str, count: Column, uniformity: float = 0.05) -> DataFrame:
    """Whether as many clusters as declared stand at even gaps: n, cv of the gaps and even. A declared count (a column that is the same within the group) below two has no spacing."""
    w = Window.partitionBy(*by).orderBy(x)
    g = centres.withColumn("_gap", F.col(x) - F.lag(x).over(w)).withColumn("_want", count).groupBy(*by).agg(F.count("*").alias("n"), F.max("_want").alias("_want"), F.min("_gap").alias("_least"), F.try_divide(F.stddev_pop("_gap"), F.avg("_gap")).alias("cv"))
    even = (F.col("_want") >= 2) & (F.col("n") == F.col("_want")) & (F.col("_least") > 0) & (F.col("cv") <= uniformity)
    return g.select(*by, "n", "cv", F.coalesce(even, F.lit(False)).alias("even"))


def transfer_error(target: DataFrame, provider: DataFrame, by: list[str], px: str, value: str) -> DataFrame:
    """What the provider's line would get wrong at the target's ticks: max_abs and max_rel (over the target's span), line_residual in pixels, and the slopes' relative difference."""
    fit = lambda df, n: df.groupBy(*by).agg(F.regr_slope(value, px).alias(f"{n}_slope"), F.regr_intercept(value, px).alias(f"{n}_intercept"))
    slope, intercept = F.col("provider_slope"), F.col("provider_intercept")
    t = target.join(fit(provider, "provider"), by).join(fit(target, "target"), by).where("provider_slope <> 0 and target_slope <> 0")
    s = t.groupBy(*by).agg(F.max(F.abs(slope * F.col(px) + intercept - F.col(value))).alias("max_abs"), F.abs(F.max(value) - F.min(value)).alias("span"), F.max(F.abs(F.col(px) - F.try_divide(F.col(value) - intercept, slope))).alias("line_residual"), F.first(F.abs(slope - F.col("target_slope")) / F.abs("target_slope")).alias("slope_rel_err"))
    return s.select(*by, "max_abs", F.try_divide("max_abs", "span").alias("max_rel"), "line_residual", "slope_rel_err")


def scale_eligibility(ladder_ok: Column, geometry: Column, completeness: Column, axis_break: Column) -> Column:
    """ELIGIBLE, INELIGIBLE, or UNKNOWN where an input was not supplied (the first missing one decides before what follows it)."""
    missing = lambda c: c.isNull() | (c == "")
    bad = ~F.coalesce(ladder_ok, F.lit(False)) | geometry.isin("GEOMETRY_UNRESOLVED", "GEOMETRY_UNOBSERVED", "FALLBACK_LONGEST") | (completeness == "FRAGMENT") | (axis_break != "NONE")
    return F.when(missing(geometry) | missing(completeness) | missing(axis_break), "UNKNOWN").when(bad, "INELIGIBLE").otherwise("ELIGIBLE")


def series_axis(series: DataFrame, axes: DataFrame) -> DataFrame:
    """panel, series, axis and why a series has none. series: panel, series, axis. axes: axis (unique), dimension, panel."""
    a = axes.select(F.col("axis").alias("_axis"), F.upper(F.trim("dimension")).alias("_dim"), F.col("panel").alias("_panel"))
    named = F.when(F.trim("axis") != "", F.col("axis"))
    reason = F.when(named.isNull(), "SERIES_AXIS_NOT_DECLARED").when(F.col("_axis").isNull(), "SERIES_AXIS_NOT_IN_MANIFEST").when(F.coalesce(F.col("_dim") != "Y", F.lit(True)), "SERIES_AXIS_WRONG_DIMENSION").when(~F.col("_panel").eqNullSafe(F.col("panel")), "SERIES_AXIS_WRONG_PANEL")
    return series.join(a, F.col("axis") == F.col("_axis"), "left").select("panel", "series", F.when(reason.isNull(), F.col("axis")).alias("axis"), reason.alias("refusal"))


def shared_axis_candidates(frames: DataFrame, by: list[str], key: str) -> DataFrame:
    """For each frame that has no axis of its own, the nearest frame to its left on the same raster and rows with at least two ticks.

    frames: by, key, x0, x1, y0, y1, read (has its own axis), ticks. Frames of a raster are few.
    """
    cols = ("x0", "x1", "y0", "y1", "ticks")
    me = frames.where(~F.coalesce("read", F.lit(False))).select(*by, F.col(key).alias(key), *[F.col(c) for c in cols])
    them = frames.where("ticks >= 2").select(*by, F.col(key).alias("_key"), *[F.col(c).alias("_" + c) for c in cols])
    height = F.least(F.col("y1") - F.col("y0"), F.col("_y1") - F.col("_y0"))
    off = F.greatest(F.abs(F.col("y0") - F.col("_y0")), F.abs(F.col("y1") - F.col("_y1")))
    left = F.col("_x1") <= F.col("x0") + 0.1 * (F.col("x1") - F.col("x0"))
    near = me.join(them, by).where((F.col(key) != F.col("_key")) & left & (height > 0) & (off <= SHARED_ROWS * height))
    return near.groupBy(*by, key).agg(F.max_by("_key", F.struct(F.col("_x0"), F.col("_key"))).alias("candidate"), F.max_by(off, F.struct(F.col("_x0"), F.col("_key"))).alias("edge_px"))
