"""Planning of requests: the lattice of wanted units, their validity, their status, and what is there already."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HISTORICAL_END = 2014


def validate_choices(wanted: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """wanted, checked: an unknown value of the column raises with the sorted list of unknown values."""
    unknown = wanted.join(known, column, "left_anti").agg(F.array_sort(F.collect_set(F.col(column).cast("string"))).alias("_unknown"))
    checked = F.when(F.size("_unknown") > 0, F.raise_error(F.concat(F.lit(f"unknown {column}: "), F.array_join("_unknown", ", ")))).otherwise(F.lit(True))
    return wanted.crossJoin(unknown).where(checked.cast("boolean")).drop("_unknown")  # one row on the right


def unknown_choices(wanted: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """The values of wanted that known lacks."""
    return wanted.select(column).distinct().join(known.select(column), column, "left_anti")


def assign_window(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Each row under every window that holds its year: windows(start_year, end_year, ...) give a row for each of their years,
    and the years are joined."""
    years = windows.withColumn("year", F.explode(F.sequence(F.col("start_year").cast("int"), F.col("end_year").cast("int"))))
    return rows.join(years, "year")


def window_available(scenario: Column, start_year: Column, end_year: Column) -> Column:
    """Extraction: historical data end in 2014 and projections begin in 2015; an overlap is enough."""
    return F.when(scenario == "historical", start_year <= HISTORICAL_END).otherwise(end_year > HISTORICAL_END)


def horizon_matches(scenario: Column, horizon: Column) -> Column:
    """Ensembles: historical goes with the window named baseline, and only with it."""
    return (scenario == "historical") == (horizon == "baseline")


def flood_window_valid(scenario: Column, end_year: Column) -> Column:
    """Floods: the whole window must end in the scenario's time."""
    return F.when(scenario == "historical", end_year <= HISTORICAL_END).otherwise(end_year > HISTORICAL_END)


def plan_matrix(variables: DataFrame, scenarios: DataFrame, windows: DataFrame, models: DataFrame) -> DataFrame:
    """variables(variable, available_scenarios), scenarios(scenario), windows(horizon, start_year, end_year),
    models(gcm, rcm) -> the request lattice. What can't be had has one row without a model: data_not_available or
    time_window_not_available; else each model has a row `planned`. All four are dimensions."""
    lattice = variables.crossJoin(scenarios).crossJoin(windows)
    status = F.when(~F.array_contains("available_scenarios", F.col("scenario")), "data_not_available").when(
        ~window_available(F.col("scenario"), F.col("start_year"), F.col("end_year")), "time_window_not_available"
    ).otherwise("planned")
    judged = lattice.withColumn("status", status).drop("available_scenarios")
    planned = judged.where("status = 'planned'").crossJoin(models)
    none = {"gcm": F.lit(None).cast("string"), "rcm": F.lit(None).cast("string")}
    refused = judged.where("status <> 'planned'")
    # a scenario that a variable lacks has one row, whatever the windows are
    lacking = refused.where("status = 'data_not_available'").dropDuplicates(["variable", "scenario"]).withColumns(
        {"horizon": F.lit(None).cast("string"), "start_year": F.lit(None).cast("int"), "end_year": F.lit(None).cast("int")}
    )
    return planned.unionByName(lacking.unionByName(refused.where("status <> 'data_not_available'")).withColumns(none))


def failure_status(error: Column) -> Column:
    """data_not_available where a catalogue's error says that something is missing, catalog_error for other errors."""
    missing = error.contains("404") | error.contains("No NetCDF files found") | F.lower(error).contains("not found")
    return F.when(error.isNotNull(), F.when(missing, "data_not_available").otherwise("catalog_error"))


def manifest(plan: DataFrame, found: DataFrame, done: DataFrame, keys: list[str], errors: DataFrame | None = None) -> DataFrame:
    """The plan's status after a run: skipped_existing where done has it, no_matching_files or empty_subset where
    found(keys, n_files, n_rows) lacks it, else saved; refused units keep their status.

    errors(keys, catalog_message, processing_message): what the catalogue said, and what went wrong later, null where nothing did;
    it comes before all but the refusals.
    """
    held = plan.join(found, keys, "left").join(done.select(*keys).distinct().withColumn("_done", F.lit(True)), keys, "left")
    failed = F.lit(None).cast("string")
    if errors is not None:
        held = held.join(errors.select(*keys, "catalog_message", "processing_message"), keys, "left")
        failed = F.coalesce(failure_status(F.col("catalog_message")), F.when(F.col("processing_message").isNotNull(), "processing_error"))
    status = (
        F.when(F.col("status") != "planned", F.col("status")).when(failed.isNotNull(), failed).when(F.col("_done"), "skipped_existing")
        .when(F.coalesce("n_files", F.lit(0)) == 0, "no_matching_files").when(F.coalesce("n_rows", F.lit(0)) == 0, "empty_subset").otherwise("saved")
    )
    return held.withColumn("status", status).drop("_done")


def ensemble_manifest(plan: DataFrame, members: DataFrame, statistics: DataFrame, changes: DataFrame) -> DataFrame:
    """Status rows of an ensemble run: a planned combination without members, each member's layer, each statistic, each change.

    plan(variable, scenario, horizon, status), members(variable, scenario, horizon, gcm, rcm, feature_id, message),
    statistics and changes(variable, scenario, horizon, feature_id, stat[, message]); a message that is not null tells an error.
    """
    keys = ["variable", "scenario", "horizon"]
    planned = plan.where("status = 'planned'").select(*keys).distinct()
    refused = plan.where("status <> 'planned'").select(*keys, "status")
    lacking = planned.join(members.select(*keys).distinct(), keys, "left_anti").withColumn("status", F.lit("no_input_files"))
    failed = F.col("message").isNotNull()
    layers = members.join(planned, keys, "left_semi").withColumn("status", F.when(failed, "model_layer_error").otherwise("model_layer_saved"))
    rasters = statistics.join(planned, keys, "left_semi").withColumn("status", F.when(failed, "ensemble_error").otherwise("ensemble_raster_saved"))
    changed = changes.join(planned, keys, "left_semi").withColumn("status", F.lit("ensemble_change_raster_saved"))
    done = layers
    for rows in (rasters, changed, refused, lacking):
        done = done.unionByName(rows, allowMissingColumns=True)
    return done


def series_manifest(wanted: DataFrame, made: DataFrame, done: DataFrame) -> DataFrame:
    """wanted(variable, scenario, horizon, frequency), made(the same, feature_id, n_rows) and done(the same, feature_id) -> a row
    for each feature's series: skipped_existing, saved, or no_data; a variable without any series has one row without feature."""
    keys = ["variable", "scenario", "horizon", "frequency"]
    found = made.join(done.select(*keys, "feature_id").distinct().withColumn("_done", F.lit(True)), [*keys, "feature_id"], "left")
    status = F.when(F.col("_done"), "skipped_existing").when(F.coalesce("n_rows", F.lit(0)) > 0, "saved").otherwise("no_data")
    return wanted.join(found, keys, "left").select(*keys, "feature_id", status.alias("status"))


def unfinished(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a resumed run still has to do."""
    return plan.join(done, keys, "left_anti")


def manifest_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def error_preview(rows: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first rows whose status tells an error."""
    return rows.where(F.col("status").rlike("error$")).orderBy(*order).limit(n)


#: Variables that are made of others, and so have no data of their own.
SOURCES = {"tasmeanAdjust": ("tasmaxAdjust", "tasminAdjust")}


def source_variables(variables: list[str]) -> list[str]:
    """The variables with data of their own that the wanted ones need, each once."""
    return [*dict.fromkeys(source for v in variables for source in SOURCES.get(v, (v,)))]


def _of_variables(obs: DataFrame, variables: list[str] | None) -> DataFrame:
    return obs if variables is None else obs.where(F.col("variable").isin(source_variables(variables)))


def discover_scenarios(obs: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """Scenarios of the wanted variables with their rank: historical first, then by name."""
    found = _of_variables(obs, variables).select("scenario").distinct()
    order = F.array_sort(F.collect_list(F.struct((F.col("scenario") != "historical").alias("later"), "scenario")))  # a few names
    return found.agg(order.alias("all")).select(F.posexplode("all.scenario").alias("position", "scenario")).select("scenario", (F.col("position") + 1).cast("long").alias("position"))


def discover_windows(obs: DataFrame, variables: list[str] | None = None) -> DataFrame:
    """Each horizon with its first and last year; years that differ between its scenarios or variables raise an error. Where obs has
    requested_start_year and requested_end_year, these count, else the years that there are. obs may be a store's catalogue of units."""
    first, last = ("first_year", "last_year") if "first_year" in obs.columns else ("year", "year")
    held = _of_variables(obs, variables)
    asked = [F.max(c).cast("int") if c in obs.columns else F.lit(None).cast("int") for c in ("requested_start_year", "requested_end_year")]
    by = ["horizon", "scenario", *(["variable"] if "variable" in obs.columns else [])]
    each = held.groupBy(*by).agg(F.coalesce(asked[0], F.min(first)).alias("start_year"), F.coalesce(asked[1], F.max(last)).alias("end_year"))
    found = each.groupBy("horizon").agg(F.min("start_year").alias("start_year"), F.max("end_year").alias("end_year"), F.count_distinct("start_year", "end_year").alias("_n"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("conflicting years of "), "horizon")).cast("int")).otherwise(F.col("start_year"))
    return found.withColumn("start_year", checked).drop("_n")
