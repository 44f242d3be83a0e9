"""Joins by nearness, overlap, carry and difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_anchor(points: DataFrame, anchors: DataFrame, by: list[str], x: str, at: str, keep: list[str]) -> DataFrame:
    """Each point with the nearest anchor of its group (ties: the lower one), in one sort.

    Points and anchors are put in one order; the last anchor at or below and the first at or above are
    carried along, so no pair is made.
    """
    nothing = F.lit(None)
    p = points.select(*by, F.col(x).alias("_x"), nothing.cast(dict(anchors.dtypes)[at]).alias("_a"), F.struct(*keep).alias("_k"))
    a = anchors.select(*by, F.col(at).alias("_x"), F.col(at).alias("_a"), nothing.cast(p.schema["_k"].dataType).alias("_k"))
    w = Window.partitionBy(*by).orderBy("_x")
    both = p.unionByName(a).withColumn("_lo", F.last("_a", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    both = both.withColumn("_hi", F.first("_a", ignorenulls=True).over(w.rangeBetween(Window.currentRow, Window.unboundedFollowing))).where("_k is not null")
    lower = F.col("_hi").isNull() | (F.col("_lo").isNotNull() & (F.col("_x") - F.col("_lo") <= F.col("_hi") - F.col("_x")))
    return both.select(*by, "_k.*", F.when(lower, F.col("_lo")).otherwise(F.col("_hi")).alias(at))


def _with_nearest(points: DataFrame, others: DataFrame, by: list[str], x: str, at: str) -> DataFrame:
    """by, x and the nearest of the other side, null where its group has none."""
    return nearest_anchor(points.select(*by, x), others.select(*by, at), by, x, at, [x])


def mutual_nearest(left: DataFrame, right: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Pairs (a, b) of a group that are each other's nearest; ties go to the smaller value. One sort a side, no list of pairs."""
    to_b = _with_nearest(left.distinct(), right.distinct(), by, a, b)
    to_a = _with_nearest(right.distinct(), left.distinct(), by, b, a)
    return to_b.join(to_a, [*by, a, b]).select(*by, a, b, F.abs(F.col(a) - F.col(b)).alias("distance"))


def match_summary(left: DataFrame, right: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Of each group: pairs, what stays unpaired on either side, and the largest distance to the other side's nearest."""
    side = lambda df, other, x, at, n: _with_nearest(df.distinct(), other.distinct(), by, x, at).groupBy(*by).agg(F.count("*").alias(n), F.max(F.abs(F.col(x) - F.col(at))).alias(f"far_{n}"))
    both = side(left, right, a, b, "n_left").join(side(right, left, b, a, "n_right"), by, "full")
    pairs = mutual_nearest(left, right, by, a, b).groupBy(*by).agg(F.count("*").alias("matched"), F.max("distance").alias("matched_max"))
    out = both.join(pairs, by, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    far = F.when(F.col("far_n_left").isNotNull() & F.col("far_n_right").isNotNull(), F.greatest("far_n_left", "far_n_right"))
    return out.select(*by, n("matched").alias("matched"), (n("n_left") - n("matched")).alias("left_unmatched"), (n("n_right") - n("matched")).alias("right_unmatched"), far.alias("symmetric_max"), "matched_max")


def overlap_share(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    """Common length over the shorter interval's; nothing is shared with an interval without length."""
    return F.coalesce(F.try_divide(F.greatest(F.least(hi1, hi2) - F.greatest(lo1, lo2), F.lit(0)), F.least(hi1 - lo1, hi2 - lo2)), F.lit(0.0))


def overlap_runs(rows: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """rows with the number of their run of overlapping intervals, by one sweep."""
    w = Window.partitionBy(*by).orderBy(lo, hi)
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_new", F.when(reach.isNull() | (F.col(lo) > reach), 1).otherwise(0)).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def gap_runs(rows: DataFrame, by: list[str], at: Column, order: list[str], gap) -> DataFrame:
    """rows with the number of their run: a step of more than ``gap`` starts a new one."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("_at", at).withColumn("_new", F.when(F.col("_at") - F.lag("_at").over(w) <= gap, 0).otherwise(1)).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_at", "_new")


def merge_with_carry(carried: DataFrame, new: DataFrame, key: str, value: str, non_answers: list[str]) -> DataFrame:
    """New answers over carried ones, unless the new is a non-answer."""
    both = carried.select(key, F.col(value).alias("_old"), F.lit(True).alias("_c")).join(new.select(key, F.col(value).alias("_new"), F.lit(True).alias("_n")), key, "full")
    real = F.col("_new").isNotNull() & ~F.col("_new").isin(*non_answers)
    return both.select(key, F.when(real, F.col("_new")).otherwise(F.coalesce("_old", "_new")).alias(value), F.when(real & F.col("_c").isNull(), "NEW").when(real, "REPLACED").when(F.col("_c").isNotNull(), "CARRIED").otherwise("UNANSWERED").alias("origin"))


def changed(before: DataFrame, after: DataFrame, on: list[str], value: str) -> DataFrame:
    """Keys whose value differs between two censuses; absent counts as null."""
    a, b = before.select(*on, F.col(value).alias("before")), after.select(*on, F.col(value).alias("after"))
    return a.join(b, on, "full").where(~F.col("before").eqNullSafe(F.col("after")))


def exact_set(declared: DataFrame, answered: DataFrame, on: str) -> DataFrame:
    """Keys of one side only, with what is wrong."""
    a, b = declared.select(on).distinct().withColumn("_a", F.lit(True)), answered.select(on).distinct().withColumn("_b", F.lit(True))
    return a.join(b, on, "full").where("_a is null or _b is null").select(on, F.when(F.col("_a").isNull(), "UNKNOWN_ANSWER").otherwise("MISSING_ANSWER").alias("problem"))


def conflicts(effects: DataFrame, on: list[str], value: str) -> DataFrame:
    """Targets that different answers set differently."""
    return effects.groupBy(*on).agg(F.countDistinct(value).alias("n_values"), F.count("*").alias("n_items")).where("n_values > 1")
