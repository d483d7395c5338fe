"""Change against a baseline, complete groups, wide layers and unions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclim.functions.labels import round_output, safe_name
from gridclim.operators.grid import PIXEL, bilinear, keys_of
from gridclim.operators.guards import some_rows
from gridclim.operators.temporal import CELL


def _known(table: DataFrame, *keys: str) -> list[str]:
    """The keys, with the domain where the table has one."""
    return [*(c for c in ("domain",) if c in table.columns), *keys]


def is_baseline(scenario: str = "historical", horizon: str = "baseline") -> Column:
    return (F.col("scenario") == scenario) & F.col("horizon").startswith(horizon)


def round_stats(stats: DataFrame, names: tuple[str, ...] = ("min", "mean", "max")) -> DataFrame:
    """Statistics as they are stored: rounded by their variable."""
    return stats.withColumns({n: round_output(F.col(n), F.col("variable")) for n in names if n in stats.columns})


def change_raster(stats: DataFrame, names: tuple[str, ...] = ("min", "mean", "max"), scenario: str = "historical", horizon: str = "baseline") -> DataFrame:
    """Stored statistics less the stored baseline of the same variable, feature and cell, rounded again; cells need
    both, and the baseline itself has no row."""
    keys = _known(stats, "variable", "feature_id", *CELL)
    base_rows = (F.col("scenario") == scenario) & (F.col("horizon") == horizon)
    base = stats.where(base_rows).select(*keys, *(F.col(n).alias(f"_{n}") for n in names))
    done = stats.where(~base_rows).join(base, keys)
    return done.select(*_known(stats, "variable", "scenario", "horizon", "feature_id", *CELL), *(round_output(F.col(n) - F.col(f"_{n}"), F.col("variable")).alias(f"change_{n}") for n in names))


def change_points(stats: DataFrame, names: tuple[str, ...] = ("min", "mean", "max"), scenario: str = "historical", horizon: str = "baseline") -> DataFrame:
    """Every row with its baseline and change columns: zero on the baseline itself, null where there is none. No baseline at all is an
    error."""
    keys = _known(stats, "variable", "feature_id", *CELL)
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("more than one baseline row for a cell")).cast("double"))
    base = stats.where(is_baseline(scenario, horizon)).groupBy(*keys).agg(*(F.coalesce(once, F.first(n)).alias(f"baseline_{n}") for n in names))
    change = {
        f"change_{n}": F.when(is_baseline(scenario, horizon), F.lit(0.0)).otherwise(round_output(F.col(n) - F.col(f"baseline_{n}"), F.col("variable")))
        for n in names
    }
    lacking = f"no baseline: no row of scenario {scenario} and a horizon that begins with {horizon}"
    return some_rows(stats.join(base, keys, "left").withColumns(change), lacking, of=base)


def complete_groups(rasters: DataFrame, include_mean: bool = True, required: bool = False) -> DataFrame:
    """Combinations of rasters(variable, scenario, horizon, source_feature, stat) that have all statistics wanted; none is an
    error if required."""
    wanted = ["min", "max", *(["mean"] if include_mean else [])]
    held = rasters.groupBy(*keys_of(rasters)).agg(F.array_sort(F.collect_set("stat")).alias("stats"))
    whole = held.where(reduce(lambda a, b: a & b, (F.array_contains("stats", s) for s in wanted)))
    lacking = f"no combination of variable, scenario, horizon and source has all of {', '.join(sorted(wanted))}"
    return some_rows(whole, lacking) if required else whole


def feature_change(summary: DataFrame, names: tuple[str, ...] = ("min", "mean", "max"), scenario: str = "historical", horizon: str = "baseline") -> DataFrame:
    """Feature summaries with baseline and change; the baseline is one row for each feature, source and variable."""
    keys = _known(summary, "variable", "feature_id", "source_feature")
    base_rows = (F.col("scenario") == scenario) & (F.col("horizon") == horizon)
    # of several rows one is taken whole, the first by its values, null before others
    first = F.min(F.struct(*names)).alias("_base")
    base = summary.where(base_rows).groupBy(*keys).agg(first).select(*keys, *(F.col(f"_base.{n}").alias(f"baseline_{n}") for n in names))
    return summary.join(base, keys, "left").withColumns({f"change_{n}": round_output(F.col(n) - F.col(f"baseline_{n}"), F.col("variable")) for n in names})


def spi_change(pixels: DataFrame, scenario: str = "historical") -> DataFrame:
    """pixels(variable, scenario, horizon, source_feature, stat, px, py, value, west, north, res) -> the future pixels that have a
    baseline of the same variable, feature and statistic, with value: future less baseline, null where either is missing.

    The baseline is brought to the future's grid bilinearly, which leaves its values as they are where both grids agree. A future
    without a baseline is left out.
    """
    keys = tuple(_known(pixels, "variable", "source_feature", "stat"))
    future = pixels.where(F.col("scenario") != scenario)
    base = pixels.where(F.col("scenario") == scenario)
    moved = bilinear(base, future, keys).withColumnRenamed("value", "_base").drop("source_west", "source_north", "source_res")
    held = future.join(moved, [*keys, *PIXEL])
    return held.withColumn("value", F.col("value") - F.col("_base")).drop("_base").select(*(c for c in pixels.columns))


def wide_change_layer(changes: DataFrame, features: DataFrame, field: str = "change_mean", layers: list[str] | None = None) -> DataFrame:
    """A row for each feature, a column for each variable, scenario, year and source with the first change found.

    layers: the column names to make; found from the data if not given.
    """
    name = safe_name(F.concat_ws("_", "variable", "scenario", F.col("horizon_year").cast("string"), "source_feature", F.lit(field)), "layer")
    future = changes.where(~is_baseline()).withColumn("layer", name)
    pivoted = future.groupBy("feature_id").pivot("layer", layers).agg(F.first(field, ignorenulls=True))
    return features.join(pivoted, "feature_id", "left")


def union_variables(*frames: DataFrame) -> DataFrame:
    """All frames under one another, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
