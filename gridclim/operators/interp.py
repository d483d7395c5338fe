"""Interpolation along curves: a curve's few rows are gathered into one sorted array, which its points are joined to by key."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def curves(rows: DataFrame, keys: list[str], x: str, y: str, name: str) -> DataFrame:
    """keys, `name`: array<struct<x, y>> by x, each x once with its smallest y. A curve has a row for each year, duration or
    design rate, some tens at most, so that an array stays small whatever the number of curves."""
    known = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    found = known.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))).alias("_all"))
    once = F.filter("_all", lambda p, i: (i == 0) | (F.get(F.col("_all"), i - 1)["x"] < p["x"]))
    return found.select(*keys, once.alias(name))


def value_at(curve: Column, at: Column) -> Column:
    """The curve's y at a place, linear between its points, null outside."""
    below = F.size(F.filter(curve, lambda p: p["x"] <= at))
    a, b = F.get(curve, below - 1), F.get(curve, below)
    between = a["y"] + (at - a["x"]) / (b["x"] - a["x"]) * (b["y"] - a["y"])
    return F.when(b.isNotNull(), between).when(a["x"] == at, a["y"])


def interpolate(points: DataFrame, rows: DataFrame, keys: list[str], at: str, x: str, y: str, name: str) -> DataFrame:
    """points with `name`: the y at the column `at` of the curve with the same keys, null without or outside it. There may be as many curves
    as points, so they are merged, not brought to the driver to be broadcast."""
    joined = points.join(curves(rows, keys, x, y, "_curve").hint("merge"), keys, "left")
    return joined.select(*(joined[c] for c in points.columns), value_at(F.col("_curve"), F.col(at)).alias(name))
