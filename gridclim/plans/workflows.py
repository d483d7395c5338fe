"""The whole workflows, each from DataFrames to a DataFrame, and their queries with SQL for the same rows.

Flood screening is `gridclim.operators.flood.flood_hazard`.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.operators import change, ensemble, geometry, grid, temporal, zonal
from gridclim.operators.guards import unless
from gridclim.plans import climate, proxy, request, spatial
from gridclim.plans.proxy import OBS
from gridclim.sources import store

QUERIES, SQL = {}, {}


def extract(raw: DataFrame, cell_feature: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of the features' cells under every window that holds their year, with how the cells were found."""
    return geometry.extract(request.assign_window(raw, windows), cell_feature)


def extract_totals(raw: DataFrame, cell_feature: DataFrame, windows: DataFrame, *by: str) -> DataFrame:
    """The rows of extract() by the columns `by`, counted and summed before cells meet features."""
    return geometry.extract_totals(request.assign_window(raw, windows), cell_feature, *by)


def ensemble_summary(obs: DataFrame, include_mean: bool = True, exact: bool = True, calculate_change: bool = True) -> DataFrame:
    """Horizon means of the members, their statistics per cell as they are stored, and the change against the baseline."""
    names = ("min", "mean", "max") if include_mean else ("min", "max")
    stored = change.round_stats(ensemble.horizon_stats(temporal.horizon_mean(obs), include_mean, exact), names)
    return change.change_points(stored, names) if calculate_change else stored


def spatial_summary(
    pixels: DataFrame, features: DataFrame, geometry_mode: str = "polygon", all_touched: bool = True, calculate_change: bool = True,
    variables: list[str] | None = None, scenarios: list[str] | None = None, horizons: list[str] | None = None,
    source_feature_ids: list[str] | None = None, include_mean: bool = True, keep_fields: list[str] | None = None,
    baseline: tuple[str, str] = ("historical", "baseline"),
) -> DataFrame:
    """Statistics of ensemble pixels for each feature, polygons(feature_id, rings) by zonal means or points(feature_id, lon, lat) by the
    pixel they lie in, and the change against the baseline. The rasters may lie on grids of their own.

    Lists choose rasters, None all. Rasters of changes and combinations that lack a statistic are left out; that none is left is an error.
    The baseline, a scenario and a horizon, is found by the variables and sources alone, so that choosing scenarios and horizons
    leaves changes as they are; its own rows are in the result only if chosen. keep_fields names columns of the features to carry along.
    """
    chosen = lambda column, wanted: F.lit(True) if wanted is None else F.col(column).isin(list(wanted))
    shared = chosen("variable", variables) & chosen("source_feature", source_feature_ids) & ~F.endswith("variable", F.lit("_Change"))
    asked = shared & chosen("scenario", scenarios) & chosen("horizon", horizons)
    base = shared & (F.col("scenario") == baseline[0]) & (F.col("horizon") == baseline[1])
    names = ("min", "mean", "max") if include_mean else ("min", "max")
    rasters = pixels.where(asked | base if calculate_change else asked).where(F.col("stat").isin(*names))
    whole = store.settle(change.complete_groups(rasters, include_mean), "complete-rasters")  # as many rows as there are combinations
    keys = grid.keys_of(pixels)
    own = whole.select(*(F.col(k).alias(f"_whole_{k}") for k in keys))
    held = rasters.join(own, [F.col(k).eqNullSafe(F.col(f"_whole_{k}")) for k in keys], "left_semi")
    places = features.select("feature_id", *(("lon", "lat") if geometry_mode == "point" else ("rings",)))
    made = zonal.feature_summary(zonal.sample_point(held, places) if geometry_mode == "point" else zonal.zonal_mean(held, places, all_touched))
    made = made if include_mean else made.drop("mean")
    made = store.settle(made, "feature-summary") if calculate_change else made  # the baseline and the rows beside it come from one run
    done = change.feature_change(made, names, *baseline).where(asked) if calculate_change else made
    done = done.join(features.select("feature_id", *keep_fields), "feature_id", "left") if keep_fields else done
    lacking = f"no combination of variable, scenario, horizon and source has all of {', '.join(sorted(names))}"
    seen = whole.agg(F.coalesce(F.max(asked), F.lit(False)).alias("_asked"), F.coalesce(F.max(base), F.lit(False)).alias("_base"))
    wrong = ~F.col("_asked") | ~F.col("_base") if calculate_change else ~F.col("_asked")
    message = F.when(F.col("_asked"), f"{lacking} for the baseline, {' '.join(baseline)}").otherwise(lacking)
    return unless(done, seen, wrong, message)  # guarded last and once, so that the plan raises once


def time_series(obs: DataFrame, frequency: str, how: str = "sum", units: str = "mm") -> DataFrame:
    """Area series of the ensemble: minimum, mean and maximum over members of the mean over cells, for shared periods and cells."""
    done = ensemble.area_stats(ensemble.align_members(temporal.aggregate(obs, frequency, how)))
    return done.withColumn("units", F.lit(units))


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(f"""WITH {OBS}, {spatial.NEAREST}, {proxy.WINDOWS} SELECT n.feature_id, windows.horizon, scenario, count(*) AS n_rows, sum(value)::DOUBLE AS total
  FROM obs JOIN nearest n ON obs.grid_row = n.grid_row AND obs.grid_col = n.grid_col JOIN windows ON obs.year BETWEEN start_year AND end_year GROUP BY ALL""")
def w1_extraction(spark, sf):
    chosen = geometry.nearest_cell(spatial.cells(spark, sf), spatial.points(spark, sf)).withColumn("method", F.lit("nearest"))
    found = extract_totals(proxy.obs(spark, sf).drop("horizon"), chosen, proxy.windows(spark), "feature_id", "horizon", "scenario")
    return found.withColumn("total", F.col("total").cast("double"))


@query(climate.SQL["e8_change_points"])
def w2_ensemble_summary(spark, sf):
    # members of the given tables don't share their cells; e6_horizon_stats_exact has such as do
    return ensemble_summary(proxy.obs(spark, sf), exact=False).drop("members")


def _horizons(pixels: DataFrame) -> DataFrame:
    """The pixels as a future horizon, and less ten, of one scenario, as the baseline."""
    base = pixels.where("scenario = 'ssp245'").withColumns({"scenario": F.lit("historical"), "horizon": F.lit("baseline"), "value": F.col("value") - 10})
    return pixels.unionByName(base)


@query(f"""WITH {spatial.SAMPLED}, both_horizons AS (SELECT * FROM sampled UNION ALL SELECT feature_id, lon, lat, variable, 'historical', 'baseline', source_feature, stat, value - 10 FROM sampled WHERE scenario = 'ssp245'),
  summary AS (SELECT {spatial.K}, feature_id, {", ".join(f"round_even(max(value) FILTER (WHERE stat = '{s}'), 1) AS {s}" for s in climate.STATS)}, CAST(count(value) > 0 AS BIGINT) AS n_pixels FROM both_horizons GROUP BY ALL),
  base AS (SELECT variable, feature_id, source_feature, {", ".join(f"{s} AS baseline_{s}" for s in climate.STATS)} FROM summary WHERE scenario = 'historical')
  SELECT summary.*, {", ".join(f"baseline_{s}, round_even({s} - baseline_{s}, 1) AS change_{s}" for s in climate.STATS)} FROM summary LEFT JOIN base USING (variable, feature_id, source_feature)""")
def w3_spatial_summary(spark, sf):
    return spatial_summary(_horizons(spatial.pixels(spark, sf)), spatial.sample_sites(spark, sf), "point")


@query(f"""WITH {spatial.PIXELS.replace("pixels AS", "future AS", 1)}, pixels AS (SELECT * FROM future UNION ALL SELECT * REPLACE ('historical' AS scenario, 'baseline' AS horizon, value - 10 AS value) FROM future WHERE scenario = 'ssp245'),
  {spatial.POLYGONS}, {spatial.TOUCHED}, {spatial.ZONAL},
  summary AS (SELECT {spatial.K}, feature_id, round_even(max(value) FILTER (WHERE stat = 'min'), 1) AS min, round_even(max(value) FILTER (WHERE stat = 'max'), 1) AS max, max(n_pixels) AS n_pixels FROM zonal GROUP BY ALL),
  base AS (SELECT feature_id, source_feature, variable, min AS baseline_min, max AS baseline_max FROM summary WHERE scenario = 'historical')
  SELECT summary.*, baseline_min, round_even(min - baseline_min, 1) AS change_min, baseline_max, round_even(max - baseline_max, 1) AS change_max, 'shape ' || feature_id AS name
  FROM summary LEFT JOIN base USING (feature_id, source_feature, variable) WHERE scenario = 'ssp370'""")
def w3_chosen_polygons(spark, sf):
    """One future of polygons without means; the baseline isn't chosen and still there for the changes."""
    features = spatial.polygons(spark, sf).withColumn("name", F.concat(F.lit("shape "), "feature_id"))
    return spatial_summary(_horizons(spatial.pixels(spark, sf)), features, scenarios=["ssp370"], include_mean=False, keep_fields=["name"])


@query(f"""WITH {OBS}, {climate.ANNUAL}, {climate.ALIGNED}, {climate.AREA} SELECT variable, scenario, horizon, feature_id, period, time, round(min(value), 4) AS min, round(avg(value), 4) AS mean, round(max(value), 4) AS max,
  count(DISTINCT (gcm, rcm)) AS ensemble_members, 'mm' AS units FROM area GROUP BY ALL""")
def w4_time_series(spark, sf):
    done = time_series(proxy.obs(spark, sf), "Annual")
    return done.withColumns({c: F.round(c, 4) for c in ("min", "mean", "max")})
