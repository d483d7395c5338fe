"""Labels, units, calendars, completeness, alignment and change on small tables."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclim.functions import labels, units
from gridclim.operators import change, ensemble, temporal
from gridclim.plans import request
from gridclim.sources import files, store


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_labels(spark):
    lit = F.lit
    assert one(spark, labels.storm_index_name(lit(89.0)), labels.storm_index_name(lit(70.5))) == ("StormDaysGT89", "StormDaysGT70p5")
    assert one(spark, *(labels.representative_year(lit(a), lit(b)) for a, b in ((1985, 2014), (2041, 2060), (2081, 2100)))) == (2000, 2050, 2090)
    assert one(spark, labels.safe_name(lit(" a/b c. ")), labels.safe_name(lit("..")), labels.safe_name(lit("9 x-y"), "layer"), labels.safe_name(lit(""), "layer")) == ("a_b_c", "feature", "v_9_x_y", "layer")
    assert one(spark, labels.parse_event_rate(lit("10%")), labels.parse_event_rate(lit("1/200")), labels.parse_event_rate(lit("33%")), labels.parse_duration_hours(lit("90 min"))) == (0.11, 0.005, None, 1.5)
    hours = {"30 (min)": 0.5, "<1 hour": 1.0, "24hr": 24.0, "2 Days": 48.0, "1.5 h": None, "hours": None, "": None, "1 in 2": None, "50%": None}
    assert one(spark, *(labels.parse_duration_hours(lit(t)) for t in hours)) == tuple(hours.values())
    rates = {"12 EY": 12.0, "0.5ey": 0.5, "63.2% AEP": 1.0, "50%#": 0.5, "1 in  200 AEP": 0.005, "AEP 1/2000": 0.0005, "1 in 0": None, "30 min": None, "%": None, "": None}
    assert one(spark, *(labels.parse_event_rate(lit(t)) for t in rates)) == tuple(rates.values())
    names = (("a: b", "feature", "a__b"), ("  ._", "unnamed", "unnamed"), (None, "feature", None), ("__a--b__", "layer", "a_b"), ("1" * 80, "layer", "v_" + "1" * 58), (" a(b).c ", "file", "a_b_.c"), (" a/b:c d ", "series", "a-b-c_d"))
    assert one(spark, *(labels.safe_name(lit(t).cast("string"), style) for t, style, _ in names)) == tuple(n for *_, n in names)
    assert one(spark, labels.parse_number(lit("1,234.5 mm")), labels.parse_number(lit("none")), labels.scenario_label(lit("ssp245"))) == (1234.5, None, "SSP2-4.5")
    assert one(spark, labels.horizon_label(lit("mid_term"), lit(None).cast("int"), lit(2060)), labels.horizon_label(lit("mid_term"), lit(2041), lit(2060))) == ("mid_term", "mid_term (2050)")


def test_units(spark):
    lit = F.lit
    assert one(spark, units.precip_to_mm_day(lit(1.0), lit("kg m**-2 s**-1")), units.precip_to_mm_day(lit(2.0), lit("MM/day")), units.temp_to_celsius(lit(300.0), lit("K"))) == (86400.0, 2.0, 300.0 - 273.15)
    for wrong in (units.precip_to_mm_day(lit(1.0), lit("inch")), units.temp_to_celsius(lit(1.0), lit("F")), units.wind_threshold_ms(lit(0.0), lit("m/s")), units.wind_threshold_ms(lit(9.0), lit("knots"))):
        with pytest.raises(PySparkException):
            one(spark, wrong)


SCHEMA = "variable string, scenario string, horizon string, feature_id string, gcm string, rcm string, grid_row int, grid_col int, time date, year int, month int, value double"


def obs(spark, rows):
    base = ("pr", "historical", "baseline", "f")
    return spark.createDataFrame([(*base, g, "r", 0, c, dt.date(y, m, 1), y, m, v) for g, c, y, m, v in rows], SCHEMA)


def test_completeness_counts_timestamps_not_values(spark):
    full = [("a", 0, 2000, m, None if m == 3 else 1.0) for m in range(1, 13)]
    short = [("b", 0, 2000, m, 1.0) for m in range(1, 12)]
    done = temporal.aggregate(obs(spark, full + short), "Annual").collect()
    assert [(r.gcm, r.value) for r in done] == [("a", 11.0)]
    empty = temporal.aggregate(obs(spark, [("a", 0, 2000, 1, None)]), "Monthly").first()
    assert empty.value is None and empty.period == "2000-01" and empty.month_name == "Jan"


def test_summer_takes_december_of_the_year_before(spark):
    rows = [("a", 0, 1999, 12, 1.0), ("a", 0, 2000, 1, 2.0), ("a", 0, 2000, 2, 4.0), ("a", 0, 2000, 12, 8.0), ("a", 0, 2001, 2, 8.0)]
    done = temporal.aggregate(obs(spark, rows), "Seasonal").collect()
    assert [(r.period, r.value, r.time) for r in done] == [("2000-DJF", 7.0, dt.date(2000, 2, 15))]


def test_days_above_are_null_without_data_and_strict(spark):
    daily = obs(spark, [("a", 0, 2000, 1, 5.0), ("a", 0, 2000, 2, 6.0), ("a", 1, 2000, 1, None), ("a", 2, 2000, 1, 1.0)])
    assert {r.grid_col: r.value for r in temporal.exceedance_days(daily, 5.0).collect()} == {0: 1.0, 1: None, 2: 0.0}


def test_alignment_keeps_shared_periods_and_cells(spark):
    rows = [("a", 0, 2000, 1, 1.0), ("a", 1, 2000, 1, 2.0), ("a", 0, 2000, 2, 3.0), ("b", 0, 2000, 1, 5.0), ("b", 0, 2000, 3, 5.0)]
    monthly = temporal.aggregate(obs(spark, rows), "Monthly")
    kept = ensemble.align_members(monthly)
    assert {(r.gcm, r.period, r.grid_col) for r in kept.collect()} == {("a", "2000-01", 0), ("b", "2000-01", 0)}
    stats = ensemble.area_stats(kept).first()
    assert (stats.min, stats.mean, stats.max, stats.ensemble_members) == (1.0, 3.0, 5.0, 2)
    with pytest.raises(PySparkException):
        ensemble.horizon_stats(temporal.horizon_mean(obs(spark, rows))).collect()


def test_change_is_between_rounded_values_and_zero_on_the_baseline(spark):
    rows = [("pr", s, h, "f", 0, 0, v, v, v) for s, h, v in (("historical", "baseline", 1.04), ("ssp245", "mid_term", 2.06))] + [("pr", "ssp245", "mid_term", "f", 0, 1, 1.0, 1.0, 1.0)]
    stats = change.round_stats(spark.createDataFrame(rows, "variable string, scenario string, horizon string, feature_id string, grid_row int, grid_col int, min double, mean double, max double"))
    assert [round(r.change_mean, 3) for r in change.change_raster(stats).collect()] == [1.1]
    got = {(r.scenario, r.grid_col): r.change_mean for r in change.change_points(stats).collect()}
    assert got == {("historical", 0): 0.0, ("ssp245", 0): 1.1, ("ssp245", 1): None}


def test_unknown_choices_raise(spark):
    known = spark.createDataFrame([("pr",)], "variable string")
    assert request.validate_choices(known, known, "variable").count() == 1
    with pytest.raises(PySparkException, match="rain, snow"):
        request.validate_choices(spark.createDataFrame([("snow",), ("rain",)], "variable string"), known, "variable").collect()


def test_file_years(spark):
    names = spark.createDataFrame([("pr_19850101-19851231.nc",), ("pr_1985-2014.NC",), ("pr_198501-201412.nc",), ("pr.nc",)], "name string")
    assert [(r.start_year, r.end_year) for r in files.with_year_range(names).collect()] == [(1985, 1985), (1985, 2014), (None, None), (None, None)]
    keyed = files.with_year_range(names).withColumn("k", F.lit(1))
    assert files.select_for_window(keyed, 2000, 2001, ["k"]).count() == 1
    assert files.select_for_window(keyed, 1900, 1901, ["k"]).count() == 2


def test_store_is_pruned_and_idempotent(spark, tmp_path):
    rows = obs(spark, [("a", 0, 2000, m, float(m)) for m in range(1, 13)])
    path = str(tmp_path / "store")
    store.write_obs(rows, path)
    store.write_obs(rows.withColumn("value", F.lit(0.0)), path)  # there already: stays
    found = store.scan_obs(spark, path, scenarios=["historical"], gcms=["a"])
    assert found.agg(F.sum("value")).first()[0] == 78.0
    more = rows.withColumn("scenario", F.lit("ssp245"))
    store.write_obs(rows.withColumn("value", F.lit(0.0)).unionByName(more), path)  # one scenario is there, the other is new
    held = spark.read.schema(rows.schema).parquet(path)
    assert {r.scenario: (r.n, r.total) for r in held.groupBy("scenario").agg(F.count("value").alias("n"), F.sum("value").alias("total")).collect()} == {"historical": (12, 78.0), "ssp245": (12, 78.0)}
    read = store.scan_obs(spark, path, scenarios=["ssp245"]).inputFiles()
    plan = store.scan_obs(spark, path, scenarios=["ssp245"])._jdf.queryExecution().executedPlan().toString()
    assert read and "PartitionFilters: [isnotnull(scenario" in plan and "scenario#" in plan.split("PartitionFilters:")[1].split("]")[0]
    store.write_obs(rows.withColumn("value", F.lit(1.0)), path, overwrite=True)
    spark.catalog.clearCache()
    assert spark.read.parquet(path).where("scenario = 'historical'").agg(F.sum("value")).first()[0] == 12.0
    assert spark.read.parquet(path).where("scenario = 'ssp245'").agg(F.sum("value")).first()[0] == 78.0


def test_series_and_layers_gain_what_is_new(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0)], "variable string, scenario string, value double")
    for kind, path in (("series", str(tmp_path / "series")), ("layers", str(tmp_path / "layers"))):
        write = (lambda df, path=path: store.write_series(df, path, ["variable"])) if kind == "series" else (lambda df, path=path: store.write_layers(df, path))
        write(rows.where("variable = 'a'"))
        write(rows.withColumn("value", F.lit(9.0)))
        if kind == "series":
            found = spark.read.schema(rows.schema).option("header", True).csv(path)
        else:
            found = spark.read.schema(rows.schema).option("header", True).csv(f"{path}/all_variables_csv")
            assert spark.read.schema(rows.schema).parquet(f"{path}/by_variable").count() == 2
        assert {r.variable: r.value for r in found.collect()} == {"a": 1.0, "b": 9.0}


def test_summary_features_keep_all_rows_and_their_order(spark):
    n = 400_000
    wide = F.when(F.col("pos") % 1000 < 50, F.repeat(F.lit("x"), 300)).otherwise("y")  # rows of uneven width
    rows = spark.range(0, n, 1, 16).select(((F.col("id") * 7919) % n).alias("pos"), F.lit("Point").alias("geom_type")).withColumn("text", wide)
    found = store.summary_features(rows, "pos")
    got = found.agg(F.count("feature_id").alias("n"), F.count_distinct("feature_id").alias("ids"), F.min("feature_id").alias("low"), F.max("feature_id").alias("high"), F.sum((F.col("feature_id") != F.col("pos") + 1).cast("int")).alias("wrong")).first()
    assert tuple(got) == (n, n, 1, n, 0)


def test_files_of_a_member_share_their_cells(spark):
    rows = obs(spark, [("a", 0, 2000, 1, 1.0), ("a", 1, 2000, 1, 2.0), ("a", 0, 2001, 1, 3.0), ("a", 1, 2001, 1, 4.0)]).withColumn("file", F.col("year"))
    assert {r.grid_col: r.value for r in temporal.horizon_mean(rows, "file").collect()} == {0: 2.0, 1: 3.0}
    with pytest.raises(PySparkException, match="share their cells"):
        temporal.horizon_mean(rows.where("year = 2000 or grid_col = 0"), "file").collect()


def test_discovery_by_variable(spark):
    schema = "variable string, scenario string, horizon string, year int, requested_start_year int, requested_end_year int"
    rows = spark.createDataFrame([("tasmaxAdjust", "ssp245", "mid", 2045, 2041, 2060), ("tasminAdjust", "historical", "base", 1990, None, None), ("pr", "ssp370", "late", 2090, None, None), ("pr", "ssp370", "mid", 2050, None, None)], schema)
    assert request.source_variables(["tasmeanAdjust", "pr", "tasmaxAdjust"]) == ["tasmaxAdjust", "tasminAdjust", "pr"]
    assert [tuple(r) for r in request.discover_scenarios(rows, ["tasmeanAdjust"]).orderBy("position").collect()] == [("historical", 1), ("ssp245", 2)]
    assert {r.horizon: (r.start_year, r.end_year) for r in request.discover_windows(rows, ["tasmeanAdjust"]).collect()} == {"mid": (2041, 2060), "base": (1990, 1990)}
    with pytest.raises(PySparkException, match="conflicting years"):
        request.discover_windows(rows).collect()


def test_first_errors(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(["saved", "catalog_error", "processing_error", None] * 9)], "i int, status string")
    assert [r.i for r in request.error_preview(rows, ["i"]).collect()] == [i for i in range(36) if i % 4 in (1, 2)][:10]
    assert {r.status: r.n for r in request.manifest_summary(rows).collect()} == {"saved": 9, "catalog_error": 9, "processing_error": 9, None: 9}


def test_baseline_of_a_feature_with_a_null(spark):
    rows = [("v", s, h, "ID1", "f", a, b, c) for s, h, a, b, c in (("historical", "baseline", None, 2.0, 3.0), ("ssp245", "mid", 1.0, 5.0, 9.0))]
    summary = spark.createDataFrame(rows, "variable string, scenario string, horizon string, source_feature string, feature_id string, min double, mean double, max double")
    got = change.feature_change(summary).where("scenario = 'ssp245'").first()
    assert (got.baseline_min, got.change_min, got.change_mean, got.change_max) == (None, None, 3.0, 6.0)


def test_sites_are_checked(spark):
    schema = "pos int, name string, lon double, lat double, context string"
    good = store.flood_sites(spark.createDataFrame([(1, "A b", 150.0, -33.0, "Rural urban edge")], schema)).first()
    assert (good.point_id, good.context) == ("F1_A_b", "urban")
    for row in ((1, "a", 190.0, 0.0, "urban"), (1, "a", 0.0, 91.0, "urban"), (1, "a", 0.0, 0.0, "sea"), (1, "a", None, 0.0, "urban")):
        with pytest.raises(PySparkException):
            store.flood_sites(spark.createDataFrame([row], schema)).collect()


def test_what_is_rounded_to_zero_keeps_its_sign(spark):
    shown = lambda v, name="pr": labels.round_output(F.lit(v), F.lit(name)).cast("string")
    assert one(spark, shown(-0.03), shown(0.03), shown(-0.0), shown(-0.06), shown(-0.0004, "StormDaysGT89")) == ("-0.0", "0.0", "-0.0", "-0.1", "-0.0")


def test_doubles_next_to_a_half_are_rounded_as_in_the_sql(spark):
    import duckdb

    values = [3.3499999999999996, 3.6500000000000004, 12.850000000000001, 248.14999999999998, -2043.9499999999998, 0.25, 0.35, 1e17, 1e308, float("inf")]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", labels.round_output(F.col("v"), F.lit("pr")).alias("x"), labels.round_output(F.col("v"), F.lit("StormDaysGT89")).alias("y"))
    want = [duckdb.execute("SELECT round_even(?::DOUBLE, 1), round_even(?::DOUBLE, 3)", [v, v]).fetchall()[0] for v in values]
    assert [(r.x, r.y) for r in got.collect()] == want and want[:4] == [(3.4, 3.35), (3.6, 3.65), (12.8, 12.85), (248.2, 248.15)]
