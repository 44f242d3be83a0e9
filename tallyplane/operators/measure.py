"""From readings to values without pixels: calibration of supplied readings, own sample sizes, declared cells, point audits."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Points closer than this are one mark; a marker so many times the median's area is several.
COINCIDENT_PX, MERGED_RATIO = 3.0, 1.6


def ticks(text: Column) -> Column:
    """"v:px;v:px" as an array of (value, px); null if a part is malformed or fewer than two values or pixels differ."""
    parts = F.transform(F.split(F.trim(text), ";"), lambda x: F.struct(S.as_number(F.split_part(x, F.lit(":"), F.lit(1))).alias("value"), S.as_number(F.split_part(x, F.lit(":"), F.lit(2))).alias("px")))
    fine = F.forall(parts, lambda t: t["value"].isNotNull() & t["px"].isNotNull()) & (F.size(F.array_distinct(F.transform(parts, lambda t: t["px"]))) >= 2) & (F.size(F.array_distinct(F.transform(parts, lambda t: t["value"]))) >= 2)
    return F.when(fine, parts)


def box(text: Column) -> Column:
    """"x0,x1,y0,y1" with x0 < x1 and y0 < y1, else null."""
    p = F.transform(F.split(text, ","), lambda x: S.as_number(x))
    fine = (F.size(p) == 4) & F.forall(p, lambda x: x.isNotNull()) & (p[0] < p[1]) & (p[2] < p[3])
    return F.when(fine, F.struct(*[p[i].cast("int").alias(n) for i, n in enumerate(("x0", "x1", "y0", "y1"))]))


def colour(text: Column) -> Column:
    """"#rrggbb" or "r,g,b" with channels up to 255, else null."""
    t = F.lower(F.trim(text))
    hexa = F.transform(F.array(*[F.substring(t, i, 2) for i in (2, 4, 6)]), lambda x: F.conv(x, 16, 10).cast("int"))
    dec = F.transform(F.split(t, ","), lambda x: F.trim(x).try_cast("int"))
    rgb = F.when(t.rlike("^#[0-9a-f]{6}$"), hexa).when(F.size(dec) == 3, dec)
    return F.when(F.forall(rgb, lambda x: x.isNotNull() & (x >= 0) & (x <= 255)), rgb)


def axis_of(ticks_col: Column, scale: Column) -> Column:
    """slope and intercept of value (its logarithm on a LOG axis) on pixel by least squares, over the tick array."""
    y = lambda t: F.when(scale == "LOG", F.ln(t["value"])).otherwise(t["value"])
    n = F.size(ticks_col).cast("double")
    add = lambda f: F.aggregate(ticks_col, F.lit(0.0), lambda a, t: a + f(t))
    sx, sy, sxx, sxy = add(lambda t: t["px"]), add(y), add(lambda t: t["px"] * t["px"]), add(lambda t: t["px"] * y(t))
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    return F.struct(slope.alias("slope"), ((sy - slope * sx) / n).alias("intercept"))


def supplied_values(readings: DataFrame, panels: DataFrame) -> DataFrame:
    """Readings become values through their panel's axis; one without a panel or a calibration stays, without a value.

    readings: panel, series, position, y_px, upper_px, lower_px. panels: panel, y_ticks, y_scale.
    """
    cal = panels.withColumn("_t", ticks(F.col("y_ticks"))).select("panel", "y_scale", F.when(F.col("_t").isNotNull(), axis_of(F.col("_t"), F.col("y_scale"))).alias("_a"))
    at = lambda c: S.calibrated(F.col(c), F.col("_a.slope"), F.col("_a.intercept"), F.col("y_scale"))
    r = readings.join(S.broadcast_if_small(cal), "panel", "left").withColumns({"mean": at("y_px"), "_u": at("upper_px"), "_l": at("lower_px")})
    spread = S.half_spread(F.col("mean"), F.col("_u"), F.col("_l"))
    method = F.when(F.col("_u").isNotNull() & F.col("_l").isNotNull(), "BOTH_ENDS").when(F.col("_u").isNotNull() | F.col("_l").isNotNull(), "ONE_END").otherwise("NO_DISPERSION")
    return r.select("panel", "series", "position", "mean", spread.alias("dispersion"), method.alias("spread_from"), F.least("_u", "_l").alias("lower"), F.greatest("_u", "_l").alias("upper"))


def declared_cells(series: DataFrame, positions: DataFrame) -> DataFrame:
    """Series by positions of each panel; a panel with only one kind has that kind's levels."""
    s = series.groupBy("panel").agg(F.collect_set("series").alias("_s"))
    p = positions.groupBy("panel").agg(F.collect_set("position").alias("_p"))
    both = s.join(p, "panel", "full")
    return both.select("panel", F.explode_outer("_s").alias("series"), "_p").select("panel", "series", F.explode_outer("_p").alias("position"))


def own_n(values: DataFrame, own: DataFrame) -> DataFrame:
    """values (panel, series, position, n) with the series' own n in place of the unit's; one given for the position comes first."""
    exact = own.where(F.col("position").isNotNull()).select("panel", "series", "position", F.col("n").alias("_e"))
    wide = own.where(F.col("position").isNull()).select("panel", "series", F.col("n").alias("_w"))
    return values.join(exact, ["panel", "series", "position"], "left").join(wide, ["panel", "series"], "left").withColumn("n", F.coalesce("_e", "_w", "n")).drop("_e", "_w")


def bijection_problems(panels: DataFrame, units: DataFrame) -> DataFrame:
    """(side, key, code) where panels and units do not name each other one to one. panels: panel, unit. units: unit."""
    per = panels.groupBy("unit").agg(F.count("*").alias("c"))
    both = per.join(units.select("unit").distinct().withColumn("_u", F.lit(True)), "unit", "full")
    return both.where(F.col("c").isNull() | F.col("_u").isNull() | (F.col("c") > 1)).select("unit", F.when(F.col("c").isNull(), "UNIT_WITHOUT_PANEL").when(F.col("_u").isNull(), "PANEL_NAMES_UNKNOWN_UNIT").otherwise("UNIT_SHARED_BY_PANELS").alias("code"))


def point_audit(points: DataFrame, expected: DataFrame, by: str) -> DataFrame:
    """Distinct marks (in the order given, one within 3 px of an earlier one is not new), likely mergers, overlaps, and agreement with the source's n.

    points: by, seq, x, y, area, overlap. expected: by, n. The walk is by order, so each panel is one group.
    """

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[tuple[float, float]] = []
        for x, y in pdf.sort_values("seq")[["x", "y"]].itertuples(index=False):
            if all(math.hypot(x - a, y - b) >= COINCIDENT_PX for a, b in kept):
                kept.append((x, y))
        areas = sorted(pdf["area"].fillna(0))
        middle = areas[len(areas) // 2]
        return pd.DataFrame({by: [key[0]], "marks": [len(pdf)], "unique": [len(kept)], "merged": [bool(middle > 0 and areas[-1] > MERGED_RATIO * middle)], "overlap": [int(pdf["overlap"].fillna(0).sum())]})

    t = dict(points.dtypes)[by]
    seen = points.groupBy(by).applyInPandas(one, f"{by} {t}, marks long, unique long, merged boolean, overlap long").join(expected.select(by, F.col("n").alias("_n")), by, "left")
    n = F.when((F.col("_n") > 0) & (F.col("_n") == F.floor("_n")), F.col("_n").cast("long"))
    agreement = F.when(n.isNull(), "NO_SOURCE_N").when(n == F.col("unique"), "MATCH").when(F.col("unique") < n, "FEWER_DETECTED").otherwise("MORE_DETECTED")
    out = seen.select(by, n.alias("expected"), "unique", agreement.alias("agreement"), "merged", "marks", "overlap")
    return out.withColumn("overplotting", (F.col("agreement") == "FEWER_DETECTED") | F.col("merged") | (F.col("unique") < F.col("marks"))).drop("merged", "marks")


def fill_identity(bars: DataFrame, noise: float) -> DataFrame:
    """Identity of fills over a figure: (domain, group, slot, pattern, state).

    bars: domain, group, slot, ink, patterns (the declared patterns in the order of rising ink). A group with as many bars as patterns is
    named by the order of its ink. Per pattern, the inks of complete groups give a range; ranges that lie apart by more than their widest
    spread and the noise are prototypes, and a bar of an incomplete group that falls within exactly one (widened by the noise) takes its name.
    """
    w = Window.partitionBy("domain", "group").orderBy("ink", "slot")
    g = Window.partitionBy("domain", "group")
    b = bars.withColumn("_k", F.row_number().over(w)).withColumn("_n", F.count("*").over(g)).withColumn("_whole", F.col("_n") == F.size("patterns"))
    named = b.where("_whole").withColumn("pattern", F.element_at("patterns", F.col("_k")))
    proto = named.groupBy("domain", "pattern").agg(F.min("ink").alias("lo"), F.max("ink").alias("hi"))
    d = Window.partitionBy("domain").orderBy("lo")
    gap = proto.withColumn("_gap", F.lead("lo").over(d) - F.col("hi"))
    verdict = gap.groupBy("domain").agg(F.min("_gap").alias("_g"), F.max(F.col("hi") - F.col("lo")).alias("_s"))
    verdict = verdict.select("domain", F.when(F.col("_g").isNull(), "NOT_ENOUGH").when(F.col("_g") > F.greatest("_s", F.lit(noise)), "ESTABLISHED").otherwise("DIRECT_ONLY").alias("_v"))
    direct = named.join(verdict, "domain").select("domain", "group", "slot", "pattern", F.when(F.col("_v") == "ESTABLISHED", "ESTABLISHED").otherwise("DIRECT_ONLY").alias("state"))
    open_ = b.where("not _whole").join(verdict, "domain", "left")
    near = open_.where("_v = 'ESTABLISHED'").join(proto, "domain").where((F.col("ink") >= F.col("lo") - noise) & (F.col("ink") <= F.col("hi") + noise)).groupBy("domain", "group", "slot").agg(F.count("*").alias("_c"), F.min("pattern").alias("_p"))
    rest = open_.join(near, ["domain", "group", "slot"], "left")
    state = F.when(F.coalesce("_v", F.lit("")) != "ESTABLISHED", "NOT_ENOUGH").when(F.col("_c") == 1, "PROTOTYPE").otherwise("AMBIGUOUS")
    return direct.unionByName(rest.select("domain", "group", "slot", F.when(state == "PROTOTYPE", F.col("_p")).alias("pattern"), state.alias("state")))


def _rank(by: list[str], keys: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*keys))


def strongest_box(boxes: DataFrame, by: list[str], claim: str, key: str) -> DataFrame:
    """Rows of overlapping boxes (by, run) with the strongest claim kept and the others blocked; ties go to the smaller key."""
    return boxes.withColumn("blocked", _rank([*by, "run"], [F.desc(claim), F.asc(key)]) > 1)
