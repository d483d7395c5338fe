"""The catalogue of units, keys that look like numbers, two domains in one store, and errors for what is empty."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclim.operators import change, ensemble, geometry, grid, temporal
from gridclim.operators.guards import some_rows
from gridclim.plans import request
from gridclim.sources import store

SCHEMA = "domain string, variable string, scenario string, horizon string, gcm string, rcm string, feature_id string, grid_row int, grid_col int, time date, year int, month int, value double"


def obs(spark, rows):
    """rows(domain, scenario, gcm, feature_id, col, year, month, value)."""
    made = spark.createDataFrame(rows, "domain string, scenario string, gcm string, feature_id string, grid_col int, year int, month int, value double")
    return made.select(
        "domain", F.lit("pr").alias("variable"), "scenario", F.when(F.col("scenario") == "historical", "baseline").otherwise("2050").alias("horizon"), "gcm", F.lit("r1").alias("rcm"),
        "feature_id", F.lit(0).alias("grid_row"), "grid_col", F.make_date("year", "month", F.lit(1)).alias("time"), "year", "month", "value").to(spark.createDataFrame([], SCHEMA).schema)


def test_keys_keep_their_meaning(spark, tmp_path):
    ids = {"007": 1.0, "7": 2.0, "7.0": 3.0, "2050-01-01": 4.0}
    rows = obs(spark, [("a", "ssp245", "g", i, 0, 2050, 1, v) for i, v in ids.items()])
    for name, write in (("units", store.write_obs), ("plain", lambda r, p: r.write.partitionBy(*store.LAYOUT).parquet(p))):
        path = str(tmp_path / name)
        write(rows, path)
        found = store.scan_obs(spark, path)
        assert dict(found.dtypes)["horizon"] == "string"
        means = temporal.horizon_mean(found).collect()
        assert {r.feature_id: (r.value, r.horizon) for r in means} == {i: (v, "2050") for i, v in ids.items()}
        assert store.scan_obs(spark, path, feature_ids=["7"]).first().value == 2.0


def test_empty_keys_are_written_once(spark, tmp_path):
    rows = obs(spark, [("a", "historical", g, "f", 0, 2000, 1, 1.0) for g in ("", None, "g")])
    path = str(tmp_path / "store")
    for _ in range(3):
        store.write_obs(rows, path)
        assert store.scan_obs(spark, path).groupBy("gcm").count().orderBy("gcm").collect() == [(None, 2), ("g", 1)]
    assert store.units(spark, path).count() == 2


def test_a_broken_run_is_repaired_by_the_next(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = obs(spark, [("a", s, g, "f", 0, y, m, 1.0) for s in ("historical", "ssp245") for g in ("g1", "g2") for y in (2000, 2001) for m in (1, 2)])
    store.write_obs(rows.where("scenario = 'historical' and gcm = 'g1'"), path)
    # a run that was killed between its files: half a unit, without an entry
    rows.where("scenario = 'ssp245' and month = 1").withColumn("value", F.lit(9.0)).write.mode("append").partitionBy(*store.LAYOUT).parquet(path)
    assert store.scan_obs(spark, path).where("scenario = 'ssp245'").count() == 0
    assert store.scan_obs(spark, path, complete_only=False).where("scenario = 'ssp245'").count() == 4
    store.write_obs(rows.withColumn("value", F.col("value") + F.when(F.col("gcm") == "g1", 0).otherwise(1)), path)
    found = store.scan_obs(spark, path)
    assert found.count() == 16 and found.where("value = 9").count() == 0 and found.agg(F.sum("value")).first()[0] == 24
    listed = store.units(spark, path)
    assert {(r.scenario, r.gcm, r.n_rows, r.first_year, r.last_year) for r in listed.collect()} == {(s, g, 4, 2000, 2001) for s in ("historical", "ssp245") for g in ("g1", "g2")}
    assert store.damaged_units(spark, path, rows.schema).count() == 0
    rows.where("month = 1 and gcm = 'g2'").write.mode("append").partitionBy(*store.LAYOUT).parquet(path)  # somebody else's rows
    spark.catalog.refreshByPath(path)
    assert {(r.scenario, r.n_rows, r.found) for r in store.damaged_units(spark, path, rows.schema).collect()} == {("historical", 4, 6), ("ssp245", 4, 6)}
    store.write_obs(rows.where("gcm = 'g2'"), path, overwrite=True)
    assert store.damaged_units(spark, path, rows.schema).count() == 0 and store.scan_obs(spark, path).count() == 16


def test_listing_reads_no_observation(spark, tmp_path):
    path = str(tmp_path / "store")
    store.write_obs(obs(spark, [("a", s, "g", "f", 0, y, 1, 1.0) for s, y in (("historical", 1990), ("historical", 1995), ("ssp245", 2050))]), path)
    listed = store.units(spark, path)
    windows, scenarios = request.discover_windows(listed), request.discover_scenarios(listed, ["pr"])
    assert {(r.horizon, r.start_year, r.end_year) for r in windows.collect()} == {("baseline", 1990, 1995), ("2050", 2050, 2050)}
    assert [r.scenario for r in scenarios.orderBy("position").collect()] == ["historical", "ssp245"]
    for found in (listed, windows, scenarios):
        assert all("store.units/" in f for f in found.inputFiles())
        assert f"{path}/" not in found._jdf.queryExecution().toString()


def test_a_store_from_before_the_catalogue_is_adopted(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = obs(spark, [("a", "historical", "g", "f", 0, 2000, 1, 1.0)])
    rows.write.partitionBy(*store.LAYOUT).parquet(path)
    store.write_obs(rows.withColumn("value", F.lit(5.0)).unionByName(rows.withColumn("gcm", F.lit("h"))), path)
    assert {(r.gcm, r.value) for r in store.scan_obs(spark, path).collect()} == {("g", 1.0), ("h", 1.0)}
    assert store.units(spark, path).count() == 2
    store.write_obs(rows.limit(0), path)  # nothing to write
    assert store.units(spark, path).count() == 2


def test_two_domains_give_what_two_stores_give(spark, tmp_path):
    rows = []
    for d, shift in (("coarse", 0.0), ("fine", 100.0)):
        for s, y in (("historical", 2000), ("ssp245", 2050)):
            for g in ("g1", "g2"):
                rows += [(d, s, g, "f", c, y, m, shift + c * 10 + m + len(s) + (g == "g2")) for c in range(3 if d == "fine" else 2) for m in range(1, 13) if not (d == "fine" and g == "g2" and c == 2)]
    both = obs(spark, rows)
    store.write_obs(both, str(tmp_path / "both"))
    scanned = store.scan_obs(spark, str(tmp_path / "both"))

    def stats(o):
        return change.round_stats(ensemble.horizon_stats(temporal.horizon_mean(o), exact=False))

    annual = lambda o: temporal.aggregate(o, "Annual")
    steps = {
        "dedup": lambda o: temporal.dedup_time(o, "value"), "monthly": lambda o: temporal.aggregate(o, "Monthly"), "annual": annual, "seasonal": lambda o: temporal.aggregate(o, "Seasonal"),
        "horizon": temporal.horizon_mean, "periods": temporal.period_metadata, "days": lambda o: temporal.exceedance_days(o, 20.0), "mean_temp": lambda o: temporal.derive_mean_temp(o, o),
        "align": lambda o: ensemble.align_members(annual(o)), "area": lambda o: ensemble.area_stats(ensemble.align_members(annual(o))), "by_time": lambda o: ensemble.stats_by_time(annual(o)),
        "envelope": lambda o: ensemble.envelope(annual(o)), "twice": lambda o: ensemble.duplicate_periods(annual(o.unionByName(o)).withColumn("period", F.lit("p"))), "stats": stats,
        "change": lambda o: change.change_raster(stats(o)), "points": lambda o: change.change_points(stats(o)),
    }
    for name, step in steps.items():
        whole = step(scanned)
        alone = [step(both.where(F.col("domain") == d)) for d in ("coarse", "fine")]
        rows_of = lambda df, cols=whole.columns: sorted(map(repr, df.select(*sorted(cols)).collect()))
        assert rows_of(whole) == rows_of(alone[0].unionByName(alone[1])), name


def test_cells_of_two_domains_do_not_mix(spark):
    cells = [("a", 0, 0, "f", "m"), ("b", 0, 0, "f", "m"), ("b", 0, 1, "f", "m")]
    chosen = spark.createDataFrame(cells, "domain string, grid_row int, grid_col int, feature_id string, method string")
    values = spark.createDataFrame([("a", 0, 0, 1.0), ("b", 0, 0, 2.0), ("b", 0, 1, 3.0), ("a", 0, 1, 4.0)], "domain string, grid_row int, grid_col int, value double")
    assert sorted((r.domain, r.value, r.n_cells) for r in geometry.extract(values, chosen).collect()) == [("a", 1.0, 1), ("b", 2.0, 2), ("b", 3.0, 2)]
    one = geometry.extract(values.where("domain = 'a'").drop("domain"), chosen.where("domain = 'a'"))
    assert [r.value for r in one.collect()] == [1.0]
    with pytest.raises(PySparkException, match="several domains"):
        geometry.extract(values.drop("domain"), chosen).collect()
    window = grid.crop_window(chosen).collect()
    assert sorted((r.domain, r.grid_col, r.selected) for r in window) == [("a", 0, True), ("b", 0, True), ("b", 1, True)]
    full = spark.createDataFrame([("a", 0, 0), ("b", 0, 0), ("b", 0, 1), ("b", 1, 1)], "domain string, grid_row int, grid_col int")
    assert {r.domain: (r.cells, r.grid_cells, r.status) for r in grid.full_grid_guard(chosen, full).collect()} == {"a": (1, 1, "processing_error"), "b": (2, 3, "ok")}


def test_each_domain_is_a_raster_of_its_own(spark):
    sides = [(d, r, c, *(x for k in range(4) for x in (off + c + (k in (1, 2)), r + (k in (0, 1))))) for d, off in (("a", 0.0), ("b", 10.0)) for r in (0, 1) for c in (0, 1)]
    quads = spark.createDataFrame([(d, r, c, *map(float, xy)) for d, r, c, *xy in sides], "domain string, grid_row int, grid_col int, " + ", ".join(f"x{k} double, y{k} double" for k in range(4)))
    cells = quads.select("domain", "grid_row", "grid_col", F.lit("pr").alias("variable"), F.lit(1.0).alias("value"))
    both = grid.rasterise(cells, quads, 1.0)
    for d in ("a", "b"):
        alone = grid.rasterise(cells.where(F.col("domain") == d), quads.where(F.col("domain") == d), 1.0)
        assert sorted(both.where(F.col("domain") == d).collect()) == sorted(alone.collect()) and alone.count() == 9


def test_empty_results_raise(spark):
    none = obs(spark, []).withColumn("stat", F.lit("min"))
    some = obs(spark, [("a", "ssp245", g, "f", 0, 2000 + 9 * (g == "h"), m, 1.0) for g in ("g", "h") for m in (1, 2)])
    cell = spark.createDataFrame([("a", r, c, 10.0 + c, 10.0 + r) for r in (0, 1) for c in (0, 1)], "domain string, grid_row int, grid_col int, lon double, lat double")
    box = spark.createDataFrame([("f", 50.0, 50.0, 51.0, 51.0)], "feature_id string, west double, south double, east double, north double")
    shape = spark.createDataFrame([(1, None)], "pos int, rings array<array<struct<x: double, y: double>>>")
    stats = some.select("variable", "scenario", "horizon", "feature_id", "grid_row", "grid_col", *(F.col("value").alias(s) for s in ("min", "mean", "max")))
    rasters = some.select("variable", "scenario", "horizon", F.lit("f").alias("source_feature"), F.lit("min").alias("stat"))
    wrong = {
        "no feature has a geometry": lambda: store.scan_features(shape), "no cell of the grid": lambda: grid.candidate_window(cell, box),
        "share no time step": lambda: temporal.derive_mean_temp(some, some.withColumn("year", F.col("year") + 1)),
        "g_r1 2000-01 to 2000-02, h_r1 2009-01 to 2009-02": lambda: ensemble.align_members(temporal.aggregate(some, "Monthly")),
        "no baseline": lambda: change.change_points(stats), "has all of max, mean, min": lambda: change.complete_groups(rasters, required=True),
        "they have no rows": lambda: ensemble.align_members(temporal.aggregate(none, "Monthly")),
    }
    silent = []
    for text, make in wrong.items():
        rows = make()  # nothing is raised before it is run
        first = F.col(rows.columns[0])
        # neither a pruned column nor a filter behind the guard hides it
        for frame in (rows.select(first), rows.where(first.isNotNull() & (first.cast("string") != "x"))):
            try:
                frame.collect()
                silent.append((text, len(frame.columns)))
            except PySparkException as e:
                assert text in str(e)
    assert not silent


def test_a_guard_makes_its_input_once(spark):
    spark.sparkContext.setJobGroup("guard", "guard")
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    made = spark.range(1000).mapInArrow(count, "id long").groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("s"))
    assert len(some_rows(made, "none").collect()) == 10 and calls.value == 1000
    assert some_rows(made.where("k > 3"), "none").count() == 6


def test_alignment_reads_the_series_once(spark):
    rows = obs(spark, [("a", "ssp245", g, "f", c, 2000, m, 1.0) for g in ("g", "h") for c in (0, 1) for m in (1, 2) if (g, c) != ("h", 1)])
    monthly = temporal.aggregate(rows, "Monthly")
    done = ensemble.align_members(monthly)
    assert {(r.gcm, r.grid_col, r.period) for r in done.collect()} == {(g, 0, p) for g in ("g", "h") for p in ("2000-01", "2000-02")}
    assert not {f for f in done.inputFiles() if "/series-" not in f and "/member-bits-" not in f}  # nothing but what was written once
