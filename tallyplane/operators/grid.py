"""Declared grids: the expected cells, and what the observed cells lack, add or repeat."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def expected_cells(levels: DataFrame, grid: str, factor: str, level: str) -> DataFrame:
    """(grid, cell) for the product of the levels of any number of factors.

    The product grows inside one aggregate over the grid's factors, so no join is needed and each
    grid is built in parallel; a grid is as large as its declaration makes it.
    """
    per_factor = levels.select(grid, factor, level).distinct().groupBy(grid, factor).agg(F.array_sort(F.collect_list(F.concat(F.col(factor), F.lit("="), F.col(level)))).alias("_l"))
    lists = per_factor.groupBy(grid).agg(F.array_sort(F.collect_list(F.struct(factor, "_l"))).alias("_f"))
    product = F.aggregate("_f", F.array(F.lit("")), lambda acc, f: F.flatten(F.transform(acc, lambda a: F.transform(f["_l"], lambda x: F.when(a == "", x).otherwise(F.concat(a, F.lit(";"), x))))))
    return lists.select(grid, F.explode(product).alias("cell"))


def expected_count(levels: DataFrame, grid: str, factor: str, level: str) -> DataFrame:
    """The number of cells of each grid as an exact product."""
    n = levels.groupBy(grid, factor).agg(F.countDistinct(level).alias("_n"))
    return n.groupBy(grid).agg(F.aggregate(F.collect_list("_n"), F.lit(1).cast("long"), lambda a, b: a * b).alias("n_cells"))


def first_rows(rows: DataFrame, keys: list[str], line: str = "_line") -> DataFrame:
    """Of the rows with one key the first by line (numbers by value), or by all columns where there is no line: the same row on every run."""
    order = [F.col(line).try_cast("long"), F.col(line).cast("string")] if line in rows.columns else []
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order, *[F.col(c).cast("string") for c in rows.columns])).alias("_first")).select(*keys, "_first.*") if len(rows.columns) > len(keys) else rows.distinct()


def missing(expected: DataFrame, observed: DataFrame, on: list[str]) -> DataFrame:
    return expected.join(observed.select(*on).distinct(), on, "left_anti")


def extra(expected: DataFrame, observed: DataFrame, on: list[str]) -> DataFrame:
    return observed.select(*on).distinct().join(expected, on, "left_anti")


def later_duplicates(rows: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """Rows after the first of their cell."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*on).orderBy(*order))).where("_n > 1").drop("_n")


def all_duplicates(rows: DataFrame, on: list[str]) -> DataFrame:
    """Keys that occur more than once: order must not decide between them."""
    return rows.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1")


def level_order(levels: DataFrame, by: list[str], order: str) -> DataFrame:
    """Groups with whether their order numbers run on without gap or repeat."""
    return levels.groupBy(*by).agg(F.count("*").alias("n"), ((F.max(order) - F.min(order) + 1 == F.count("*")) & (F.countDistinct(order) == F.count("*"))).alias("contiguous"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
