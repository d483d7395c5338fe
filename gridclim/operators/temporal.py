"""Time operators over obs(variable, scenario, horizon, gcm, rcm, feature_id, grid_row, grid_col, time, year, month, value)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.functions import labels
from gridclim.operators.guards import some_rows

#: What a series is known by. Columns that a table lacks count as equal; the domain is one where a table has several.
SERIES = ("variable", "scenario", "horizon", "domain", "feature_id")
MEMBER = ("gcm", "rcm")
#: What a cell is known by within its domain.
CELL = ("grid_row", "grid_col")
FREQUENCIES = ("Monthly", "Seasonal", "Annual")


def mean(value: str | Column) -> Column:
    """A mean whose sum is exact for decimals, so that it doesn't depend on the order of rows."""
    c = F.col(value) if isinstance(value, str) else value
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def subset_time(obs: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Years from start to end, both included; a table without time stays as it is."""
    return obs.where(F.year("time").between(start_year, end_year)) if "time" in obs.columns else obs


def dedup_time(obs: DataFrame, order: str = "source") -> DataFrame:
    """Of rows with one timestamp of one cell and member, the first by source stays."""
    keys = [c for c in (*SERIES, *MEMBER, *CELL, "time") if c in obs.columns]
    return obs.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


def _reduce(obs: DataFrame, keys: list[str], how: str) -> DataFrame:
    """how: sum (null if all values are null) or mean."""
    value = F.sum("value").cast("double") if how == "sum" else mean("value")
    return obs.groupBy(*keys).agg(value.alias("value"))


def _present(obs: DataFrame, period: Column, needed: int, *extra: str) -> DataFrame:
    """Periods of a member with all their months among its timestamps, whatever the values are."""
    keys = [c for c in (*SERIES, *MEMBER) if c in obs.columns]
    held = obs.withColumn("period", period)
    return held.groupBy(*keys, "period").agg(F.count_distinct("month").alias("n")).where(F.col("n") == needed).drop("n")


def aggregate(obs: DataFrame, frequency: str, how: str = "sum") -> DataFrame:
    """Monthly, Seasonal or Annual values of each member and cell, with period, time and calendar columns.

    Months are taken as they are; a season needs its three months and a year its twelve among the timestamps.
    """
    frequency = frequency.title()
    if frequency not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {FREQUENCIES}")
    keys = [c for c in (*SERIES, *MEMBER, *CELL) if c in obs.columns]
    if frequency == "Monthly":
        done = _reduce(obs, [*keys, "year", "month"], how)
        parts = (F.col("year"), F.col("month"))
        done = done.withColumn("month_name", F.date_format(F.make_date(F.lit(2001), "month", F.lit(1)), "MMM"))
    elif frequency == "Annual":
        period = labels.analysis_period("Annual", F.col("year"))
        done = _reduce(obs.withColumn("period", period), [*keys, "period", "year"], how)
        done = done.join(_present(obs, period, 12), [c for c in (*SERIES, *MEMBER, "period") if c in done.columns], "left_semi")
        parts = (F.col("year"),)
    else:
        seasonal = obs.withColumns({"season": labels.season(F.col("month")), "season_year": labels.season_year(F.col("year"), F.col("month"))})
        period = labels.analysis_period("Seasonal", F.col("season_year"), season_name=F.col("season"))
        done = _reduce(seasonal.withColumn("period", period), [*keys, "period", "season_year", "season"], how)
        done = done.join(_present(seasonal, period, 3), [c for c in (*SERIES, *MEMBER, "period") if c in done.columns], "left_semi")
        parts = (F.col("season_year"), None, F.col("season"))
    return done.withColumns({"period": labels.analysis_period(frequency, *parts), "time": labels.analysis_time(frequency, *parts)})


def horizon_mean(obs: DataFrame, file: str | None = None) -> DataFrame:
    """Mean of all time steps of a horizon for each member and cell, nulls aside.

    file: the column that names the file of each row. Where it is given, the files of a member must have exactly the same
    cells, or an error is raised.
    """
    keys = [c for c in (*SERIES, *MEMBER, *CELL) if c in obs.columns]
    done = obs.groupBy(*keys).agg(mean("value").alias("value"))
    if file is None:
        return done
    own = [k for k in keys if k not in CELL]
    held = obs.groupBy(*own, file).agg(F.count_distinct(*CELL).alias("_cells")).groupBy(*own).agg(F.min("_cells").alias("_least"))
    total = obs.groupBy(*own).agg(F.count_distinct(*CELL).alias("_total")).join(held, own)
    wrong = F.raise_error(F.lit("the files of a member don't share their cells")).cast("double")
    return done.join(total, own).withColumn("value", F.when(F.col("_least") < F.col("_total"), wrong).otherwise(F.col("value"))).drop("_least", "_total")


def period_metadata(obs: DataFrame) -> DataFrame:
    """First and last year that a series has, the middle year, and the label."""
    years = obs.groupBy(*(c for c in SERIES if c in obs.columns)).agg(F.min("year").alias("start_year"), F.max("year").alias("end_year"))
    start, end = F.col("start_year"), F.col("end_year")
    return years.withColumns({
        "mid_year": labels.representative_year(start, end),
        "horizon_label": labels.horizon_label_long(F.col("horizon"), start, end),
    })


def exceedance_days(daily: DataFrame, threshold: Column | float) -> DataFrame:
    """Days above the threshold for each member, cell and year; null, not zero, where no day has a value."""
    keys = [c for c in (*SERIES, *MEMBER, *CELL, "year") if c in daily.columns]
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    above = F.sum(F.when(F.col("value") > limit, 1).otherwise(0))
    return daily.groupBy(*keys).agg(F.when(F.count("value") > 0, above).cast("float").alias("value"), F.min("time").alias("time"))


def derive_mean_temp(tmax: DataFrame, tmin: DataFrame, variable: str = "tasmeanAdjust") -> DataFrame:
    """(max + min) / 2 where both have the time and the cell; members that only one has are left out. Nothing shared is an error."""
    keys = [c for c in (*SERIES[1:], *MEMBER, *CELL, "time", "year", "month") if c in tmax.columns and c in tmin.columns]
    low = tmin.select(*keys, F.col("value").alias("low"))
    made = tmax.drop("variable").join(low, keys).withColumns({
        "value": (F.col("value") + F.col("low")) / F.lit(2), "variable": F.lit(variable)
    }).drop("low")
    return some_rows(made, "maximum and minimum temperatures share no time step")


def empty_subsets(plan: DataFrame, obs: DataFrame, keys: list[str]) -> DataFrame:
    """plan with status empty_subset where obs has no row, else processed, and the number of rows."""
    counts = obs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return plan.join(counts, keys, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).withColumn(
        "status", F.when(F.col("n_rows") == 0, "empty_subset").otherwise("processed")
    )
