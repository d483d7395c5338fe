"""Ensemble operators: members are (gcm, rcm); statistics run over members, per cell or per area."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.operators.guards import some_rows
from gridclim.operators.temporal import CELL, MEMBER, SERIES, mean
from gridclim.sources import store


def _keys(df: DataFrame, *names: str) -> list[str]:
    return [c for c in names if c in df.columns]


def select_layers(stats: DataFrame, variables: list[str] | None = None, scenarios: list[str] | None = None, horizons: list[str] | None = None, stat_names: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of the wanted variables (by what their names begin with), scenarios and horizons, all without regard to case, and of
    the statistics' columns the wanted ones; None takes all."""
    if variables is not None:
        begins = [F.startswith(F.lower("variable"), F.lit(v.lower())) for v in variables]
        stats = stats.where(reduce(lambda a, b: a | b, begins, F.lit(False)))
    for column, wanted in (("scenario", scenarios), ("horizon", horizons)):
        if wanted is not None:
            stats = stats.where(F.lower(column).isin([w.lower() for w in wanted]))
    every = [f"{a}{b}" for a in ("", "baseline_", "change_") for b in ("min", "mean", "max")]
    return stats.drop(*(c for c in every if c not in stat_names)) if stat_names is not None else stats


def duplicate_periods(series: DataFrame) -> DataFrame:
    """Member, period and cell of values that occur more than once."""
    keys = _keys(series, *SERIES, *MEMBER, "period", *CELL)
    return series.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def align_members(series: DataFrame) -> DataFrame:
    """Only periods that all members of a series have, and only cells that all have. Nothing shared is an error that tells what periods
    the members have.

    The series is written once. A member is a bit, and one aggregate joins the bits of each period, of each cell and of the whole.
    """
    keys = _keys(series, *SERIES)
    series = store.settle(series, "series")
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*MEMBER)) - 1  # members of a series are few
    wrong = F.raise_error(F.lit("a series has more than 63 members")).cast("bigint")
    bit = F.when(F.col("_place") > 62, wrong).otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_place")))
    members = series.select(*keys, *MEMBER).distinct().withColumn("_place", place).select(*keys, *MEMBER, bit.alias("_bit"))
    marked = series.join(members, [*keys, *MEMBER]).select(*keys, "period", *CELL, "_bit")
    of = [F.col(k) for k in keys]
    sets = marked.groupingSets([[*of, F.col("period")], [*of, *map(F.col, CELL)], of], *of, "period", *CELL)
    held = store.settle(sets.agg(F.bit_or("_bit").alias("_bits"), F.grouping("period").alias("_no_period"), F.grouping(CELL[0]).alias("_no_cell")), "member-bits")
    every = held.where("_no_period = 1 and _no_cell = 1").select(*keys, F.col("_bits").alias("_all"))
    whole = held.join(every, keys).where("_bits = _all")
    ends = series.groupBy(*MEMBER).agg(F.min("period").alias("first"), F.max("period").alias("last"))
    range_ = F.concat_ws(" ", F.concat_ws("_", *MEMBER), F.concat("first", F.lit(" to "), "last"))
    ranges = ends.agg(F.array_join(F.array_sort(F.collect_list(range_)), ", ").alias("ranges"))
    message = F.concat(F.lit("the members share no period and cell; they have "), F.coalesce(F.nullif("ranges", F.lit("")), F.lit("no rows")))
    periods, cells = whole.where("_no_period = 0").select(*keys, "period"), whole.where("_no_cell = 0").select(*keys, *CELL)
    aligned = series.join(periods, [*keys, "period"], "left_semi").join(cells, [*keys, *CELL], "left_semi")
    return some_rows(some_rows(aligned, message, ranges, periods), message, ranges, cells)


def stats_by_time(series: DataFrame) -> DataFrame:
    """Minimum, mean and maximum over the members of each period and cell, nulls aside."""
    keys = _keys(series, *SERIES, "period", "time", *CELL)
    return series.groupBy(*keys).agg(F.min("value").alias("min"), mean("value").alias("mean"), F.max("value").alias("max"))


def member_area_series(series: DataFrame) -> DataFrame:
    """The unweighted mean over cells of each member and period."""
    keys = _keys(series, *SERIES, *MEMBER, "period", "time")
    return series.groupBy(*keys).agg(mean("value").alias("value"))


def area_stats(series: DataFrame) -> DataFrame:
    """Over cells first, then minimum, mean and maximum over members."""
    area = member_area_series(series)
    keys = _keys(area, *SERIES, "period", "time")
    return area.groupBy(*keys).agg(
        F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"),
        F.count_distinct(F.struct(*MEMBER)).alias("ensemble_members"),
    )


def envelope(series: DataFrame) -> DataFrame:
    """Each member's area value beside the ensemble's minimum, mean and maximum of the period."""
    keys = _keys(series, *SERIES, "period", "time")
    return member_area_series(series).join(area_stats(series), keys)


def horizon_stats(means: DataFrame, include_mean: bool = True, exact: bool = True) -> DataFrame:
    """Statistics of the members' horizon means per cell, with the members' number and labels.

    exact: a cell that a member of its series lacks raises an error.
    """
    keys = _keys(means, *SERIES)
    label = F.concat_ws("_", *MEMBER)
    found = [F.min("value").alias("min"), *([mean("value").alias("mean")] if include_mean else []), F.max("value").alias("max")]
    done = means.groupBy(*keys, *CELL).agg(
        *found, F.count_distinct(label).alias("member_count"), F.array_sort(F.collect_set(label)).alias("members")
    )
    if exact:
        total = means.groupBy(*keys).agg(F.count_distinct(label).alias("_total"))
        short = F.col("member_count") != F.col("_total")
        checked = F.when(short, F.raise_error(F.lit("members don't share the same cells")).cast("bigint")).otherwise(F.col("member_count"))
        done = done.join(total, keys).withColumn("member_count", checked).drop("_total")
    return done
