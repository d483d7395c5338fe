"""Queries on time, ensembles and change, with SQL for the same rows."""

from pyspark.sql import functions as F

from gridclim.functions import labels, units
from gridclim.operators import change, ensemble, temporal
from gridclim.plans import proxy
from gridclim.plans.proxy import LABELLED, OBS, TEMPERATURES, WIND

QUERIES, SQL = {}, {}
STATS = ("min", "mean", "max")
KEYS = "variable, scenario, horizon, feature_id"


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# --- time ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {OBS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEYS}, gcm, rcm, grid_row, grid_col, time ORDER BY source) AS n FROM obs)
  SELECT * EXCLUDE (n) REPLACE (value::DOUBLE AS value) FROM ranked WHERE n = 1""")
def t1_dedup_time(spark, sf):
    return _double(temporal.dedup_time(proxy.obs(spark, sf)), "value")


@query(f"""WITH {OBS} SELECT {KEYS}, gcm, rcm, grid_row, grid_col, year, month, CAST(sum(value) AS DOUBLE) AS value,
  strftime(make_date(2001, month, 1), '%b') AS month_name, format('{{}}-{{:02d}}', year, month) AS period, make_date(year, month, 1) AS time
  FROM obs GROUP BY ALL""")
def t2_monthly(spark, sf):
    return temporal.aggregate(proxy.obs(spark, sf), "Monthly")


ANNUAL = f"""full_years AS (SELECT {KEYS}, gcm, rcm, year FROM obs GROUP BY ALL HAVING count(DISTINCT month) = 12),
annual AS (SELECT {KEYS}, gcm, rcm, grid_row, grid_col, CAST(year AS VARCHAR) AS period, year, CAST(sum(value) AS DOUBLE) AS value,
  make_date(year, 7, 1) AS time FROM obs SEMI JOIN full_years USING ({KEYS}, gcm, rcm, year) GROUP BY ALL)"""


@query(f"WITH {OBS}, {ANNUAL} SELECT * FROM annual")
def t3_annual(spark, sf):
    return temporal.aggregate(proxy.obs(spark, sf), "annual")


@query(f"""WITH {OBS}, seasonal AS (SELECT *, CASE WHEN month IN (12, 1, 2) THEN 'DJF' WHEN month <= 5 THEN 'MAM' WHEN month <= 8 THEN 'JJA' ELSE 'SON' END AS season,
    CAST(year + CASE WHEN month = 12 THEN 1 ELSE 0 END AS INT) AS season_year FROM obs),
  complete AS (SELECT {KEYS}, gcm, rcm, season_year, season FROM seasonal GROUP BY ALL HAVING count(DISTINCT month) = 3)
  SELECT {KEYS}, gcm, rcm, grid_row, grid_col, season_year || '-' || season AS period, season_year, season, CAST(sum(value) AS DOUBLE) AS value,
    make_date(season_year, CASE season WHEN 'DJF' THEN 2 WHEN 'MAM' THEN 5 WHEN 'JJA' THEN 8 ELSE 11 END, 15) AS time
  FROM seasonal SEMI JOIN complete USING ({KEYS}, gcm, rcm, season_year, season) GROUP BY ALL""")
def t4_seasonal(spark, sf):
    return temporal.aggregate(proxy.obs(spark, sf), "Seasonal")


@query(f"""WITH {OBS}, {ANNUAL}, monthly AS (SELECT {KEYS}, gcm, rcm, grid_row, grid_col, year, month, sum(value) AS v FROM obs GROUP BY ALL)
  SELECT 'Monthly' AS frequency, count(*) AS n, round(sum(CAST(v AS DOUBLE)), 0) AS total FROM monthly
  UNION ALL SELECT 'Annual', count(*), round(sum(value), 0) FROM annual""")
def t5_aggregate(spark, sf):
    obs = proxy.obs(spark, sf)
    made = [temporal.aggregate(obs, f).select(F.lit(f).alias("frequency"), "value") for f in ("Monthly", "Annual")]
    return made[0].unionByName(made[1]).groupBy("frequency").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 0).alias("total"))


MEANS = f"means AS (SELECT {KEYS}, gcm, rcm, grid_row, grid_col, CAST(sum(value) AS DOUBLE) / count(value) AS value FROM obs GROUP BY ALL)"


@query(f"WITH {OBS}, {MEANS} SELECT * FROM means")
def t6_horizon_mean(spark, sf):
    return temporal.horizon_mean(proxy.obs(spark, sf))


@query(f"""WITH {OBS}, years AS (SELECT {KEYS}, min(year) AS start_year, max(year) AS end_year FROM obs GROUP BY ALL),
  mid AS (SELECT *, CAST(round_even((start_year + end_year) / 2.0, 0) AS INT) AS mid_year FROM years)
  SELECT *, horizon || ' (' || start_year || '-' || end_year || '; mid=' || mid_year || ')' AS horizon_label FROM mid""")
def t7_period_metadata(spark, sf):
    return temporal.period_metadata(proxy.obs(spark, sf))


@query(f"""WITH {WIND} SELECT variable, feature_id, grid_row, grid_col, year,
  CAST(CASE WHEN count(value) > 0 THEN sum(CASE WHEN value > 162.0 / 3.6 THEN 1 ELSE 0 END) END AS FLOAT) AS value, min(time) AS time FROM wind GROUP BY ALL""")
def t8_exceedance_days(spark, sf):
    limit = units.wind_threshold_ms(F.lit(162.0), F.lit("m s-1"))
    return temporal.exceedance_days(proxy.wind(spark, sf), limit)


@query(f"""WITH {OBS}, plan AS (SELECT scenario, gcm, rcm FROM (SELECT DISTINCT gcm, rcm FROM obs), (VALUES ('historical'), ('ssp245'), ('ssp370')) s(scenario))
  SELECT scenario, gcm, rcm, count(obs.value) AS n_rows, CASE WHEN count(obs.value) = 0 THEN 'empty_subset' ELSE 'processed' END AS status
  FROM plan LEFT JOIN obs USING (scenario, gcm, rcm) GROUP BY ALL""")
def t9_empty_subsets(spark, sf):
    obs = proxy.obs(spark, sf)
    scenarios = F.explode(F.array(*map(F.lit, ("historical", "ssp245", "ssp370")))).alias("scenario")
    return temporal.empty_subsets(obs.select("gcm", "rcm").distinct().select(scenarios, "gcm", "rcm"), obs, ["scenario", "gcm", "rcm"])


# --- ensembles ----------------------------------------------------------------------------------------------------

ALIGNED = f"""total AS (SELECT {KEYS}, count(DISTINCT (gcm, rcm)) AS members FROM annual GROUP BY ALL),
periods AS (SELECT {KEYS}, period FROM annual JOIN total USING ({KEYS}) GROUP BY {KEYS}, period, members HAVING count(DISTINCT (gcm, rcm)) = members),
cells AS (SELECT {KEYS}, grid_row, grid_col FROM annual JOIN total USING ({KEYS}) GROUP BY {KEYS}, grid_row, grid_col, members HAVING count(DISTINCT (gcm, rcm)) = members),
aligned AS (SELECT * FROM annual SEMI JOIN periods USING ({KEYS}, period) SEMI JOIN cells USING ({KEYS}, grid_row, grid_col))"""
AREA = f"area AS (SELECT {KEYS}, gcm, rcm, period, time, sum(CAST(value AS DECIMAL(24,2)))::DOUBLE / count(value) AS value FROM aligned GROUP BY ALL)"


def _aligned(spark, sf):
    annual = temporal.aggregate(proxy.obs(spark, sf), "Annual")
    return ensemble.align_members(annual.withColumn("value", F.col("value").cast("decimal(24,2)")))


@query(f"WITH {OBS}, {ANNUAL}, {ALIGNED} SELECT * FROM aligned")
def e1_align_members(spark, sf):
    return _double(_aligned(spark, sf), "value")


@query(f"WITH {OBS} SELECT {KEYS}, gcm, rcm, period, grid_row, grid_col, count(*) AS n FROM (SELECT *, strftime(time, '%Y-%m-%d') AS period FROM obs) GROUP BY ALL HAVING count(*) > 1")
def e2_duplicate_periods(spark, sf):
    return ensemble.duplicate_periods(proxy.obs(spark, sf).withColumn("period", F.date_format("time", "yyyy-MM-dd")))


@query(f"WITH {OBS}, {ANNUAL}, {ALIGNED} SELECT {KEYS}, period, time, grid_row, grid_col, min(value) AS min, sum(CAST(value AS DECIMAL(24,2)))::DOUBLE / count(value) AS mean, max(value) AS max FROM aligned GROUP BY ALL")
def e3_stats_by_time(spark, sf):
    return _double(ensemble.stats_by_time(_aligned(spark, sf)), "min", "max")


@query(f"WITH {OBS}, {ANNUAL}, {ALIGNED}, {AREA} SELECT * FROM area")
def e4_member_area_series(spark, sf):
    return ensemble.member_area_series(_aligned(spark, sf))


@query(f"WITH {OBS}, {ANNUAL}, {ALIGNED}, {AREA} SELECT {KEYS}, period, time, min(value) AS min, round(avg(value), 4) AS mean, max(value) AS max, count(DISTINCT (gcm, rcm)) AS ensemble_members FROM area GROUP BY ALL")
def e5_area_stats(spark, sf):
    return ensemble.area_stats(_aligned(spark, sf)).withColumn("mean", F.round("mean", 4))


HORIZON = f"""stats AS (SELECT {KEYS}, grid_row, grid_col, min(value) AS min, avg(value) AS mean, max(value) AS max,
  count(DISTINCT gcm || '_' || rcm) AS member_count FROM means GROUP BY ALL)"""
STORED = "stored AS (SELECT * REPLACE (round_even(min, 1) AS min, round_even(mean, 1) AS mean, round_even(max, 1) AS max) FROM stats)"


def _stats(spark, sf):
    return ensemble.horizon_stats(temporal.horizon_mean(proxy.obs(spark, sf)), exact=False)


@query(f"""WITH {OBS}, {MEANS}, {HORIZON} SELECT {KEYS}, grid_row, grid_col, min, round(mean, 6) AS mean, max, member_count,
  (SELECT string_agg(DISTINCT m.gcm || '_' || m.rcm, '|' ORDER BY m.gcm || '_' || m.rcm) FROM means m WHERE m.scenario = stats.scenario AND m.grid_row = stats.grid_row AND m.grid_col = stats.grid_col) AS members FROM stats""")
def e6_horizon_stats(spark, sf):
    return _stats(spark, sf).withColumns({"mean": F.round("mean", 6), "members": F.array_join("members", "|")})


@query(f"""WITH {OBS}, both_domains AS (SELECT *, 'aus_18' AS domain FROM obs UNION ALL SELECT * REPLACE (value + 1000 AS value), 'seaus_4km' FROM obs),
  means AS (SELECT domain, {KEYS}, gcm, rcm, grid_row, grid_col, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS value FROM both_domains GROUP BY ALL)
  SELECT domain, {KEYS}, grid_row, grid_col, min(value) AS min, round(avg(value), 6) AS mean, max(value) AS max, count(*) AS member_count FROM means GROUP BY ALL""")
def e6_horizon_stats_two_domains(spark, sf):
    domain = F.explode(F.array(F.struct(F.lit("aus_18").alias("domain"), F.lit(0).alias("more")), F.struct(F.lit("seaus_4km").alias("domain"), F.lit(1000).alias("more")))).alias("_d")
    both = proxy.obs(spark, sf).select("*", domain).withColumns({"domain": F.col("_d.domain"), "value": (F.col("value") + F.col("_d.more")).cast("decimal(18,2)")}).drop("_d")
    done = ensemble.horizon_stats(temporal.horizon_mean(both), exact=False)
    return done.withColumn("mean", F.round("mean", 6)).drop("members")


@query(f"""WITH {OBS}, filed AS (SELECT *, year(time) AS file FROM obs), members AS (SELECT {KEYS}, gcm, rcm, file, grid_row, grid_col FROM filed GROUP BY ALL),
  files AS (SELECT {KEYS}, gcm, rcm, count(DISTINCT file) AS files FROM members GROUP BY ALL),
  shared AS (SELECT {KEYS}, gcm, rcm, grid_row, grid_col FROM members JOIN files USING ({KEYS}, gcm, rcm) GROUP BY {KEYS}, gcm, rcm, grid_row, grid_col, files HAVING count(DISTINCT file) = files),
  total AS (SELECT {KEYS}, count(DISTINCT (gcm, rcm)) AS members FROM filed GROUP BY ALL),
  every AS (SELECT {KEYS}, grid_row, grid_col FROM shared JOIN total USING ({KEYS}) GROUP BY {KEYS}, grid_row, grid_col, members HAVING count(*) = members),
  kept AS (SELECT filed.* FROM filed SEMI JOIN every USING ({KEYS}, grid_row, grid_col)), {MEANS.replace("FROM obs", "FROM kept")}
  SELECT {KEYS}, grid_row, grid_col, min(value) AS min, round(avg(value), 6) AS mean, max(value) AS max, count(*) AS member_count FROM means GROUP BY ALL""")
def e6_horizon_stats_exact(spark, sf):
    """Both checks are on: a member's files, one for each year, share their cells, and so do the members. Cells that some file lacks
    are taken out first, so that the checks pass."""
    filed = proxy.obs(spark, sf).withColumn("file", F.year("time"))
    series = ["variable", "scenario", "horizon", "feature_id"]
    every = filed.groupBy(*series).agg(F.count_distinct("gcm", "rcm", "file").alias("files"))
    held = filed.groupBy(*series, "grid_row", "grid_col").agg(F.count_distinct("gcm", "rcm", "file").alias("held"))
    kept = filed.join(held.join(every, series).where("held = files").select(*series, "grid_row", "grid_col"), [*series, "grid_row", "grid_col"], "left_semi")
    done = ensemble.horizon_stats(temporal.horizon_mean(kept, file="file"), exact=True)
    return done.withColumn("mean", F.round("mean", 6)).drop("members")


@query(f"""WITH {OBS}, {MEANS}, {HORIZON}, {STORED} SELECT f.variable, f.scenario, f.horizon, f.feature_id, f.grid_row, f.grid_col,
  {", ".join(f"round_even(f.{n} - b.{n}, 1) AS change_{n}" for n in STATS)} FROM stored f JOIN stored b USING (variable, feature_id, grid_row, grid_col)
  WHERE b.scenario = 'historical' AND b.horizon = 'baseline' AND NOT (f.scenario = 'historical' AND f.horizon = 'baseline')""")
def e7_change_raster(spark, sf):
    return change.change_raster(change.round_stats(_stats(spark, sf)))


@query(f"""WITH {OBS}, {MEANS}, {HORIZON}, {STORED}, base AS (SELECT * FROM stored WHERE scenario = 'historical' AND horizon LIKE 'baseline%')
  SELECT s.{KEYS.replace(", ", ", s.")}, s.grid_row, s.grid_col, {", ".join(f"s.{n}" for n in STATS)}, s.member_count, {", ".join(f"b.{n} AS baseline_{n}" for n in STATS)},
  {", ".join(f"CASE WHEN s.scenario = 'historical' AND s.horizon LIKE 'baseline%' THEN 0.0::DOUBLE ELSE round_even(s.{n} - b.{n}, 1) END AS change_{n}" for n in STATS)}
  FROM stored s LEFT JOIN base b ON s.variable = b.variable AND s.feature_id = b.feature_id AND s.grid_row = b.grid_row AND s.grid_col = b.grid_col""")
def e8_change_points(spark, sf):
    return change.change_points(change.round_stats(_stats(spark, sf))).drop("members")


@query("""WITH rasters AS (SELECT p_brand AS variable, split_part(p_type, ' ', 1) AS scenario, CAST(p_size % 7 AS VARCHAR) AS horizon, 'ID1' AS source_feature,
    CASE p_partkey % 3 WHEN 0 THEN 'min' WHEN 1 THEN 'mean' ELSE 'max' END AS stat FROM part)
  SELECT variable, scenario, horizon, source_feature, 'max|mean|min' AS stats FROM rasters GROUP BY ALL HAVING count(DISTINCT stat) = 3""")
def e10_complete_groups(spark, sf):
    third = F.col("p_partkey") % 3
    rasters = proxy.table(spark, sf, "part").select(
        F.col("p_brand").alias("variable"), F.split("p_type", " ")[0].alias("scenario"), (F.col("p_size") % 7).cast("string").alias("horizon"),
        F.lit("ID1").alias("source_feature"), F.when(third == 0, "min").when(third == 1, "mean").otherwise("max").alias("stat"),
    )
    return change.complete_groups(rasters).withColumn("stats", F.array_join("stats", "|"))


def _feature_summary(spark, sf):
    """Each grid row as a feature: stored statistics averaged over its cells."""
    stored = change.round_stats(_stats(spark, sf))
    tenths = lambda n: (F.sum(F.col(n).cast("decimal(24,1)")).cast("double") / F.count(n)).alias(n)
    made = stored.groupBy("variable", "scenario", "horizon", F.col("feature_id").alias("source_feature"), F.concat(F.lit("row"), F.col("grid_row")).alias("feature_id")).agg(*map(tenths, STATS))
    return change.round_stats(made)


SUMMARY = f"""summary AS (SELECT variable, scenario, horizon, feature_id AS source_feature, 'row' || grid_row AS feature_id,
  {", ".join(f"round_even(sum(CAST({n} AS DECIMAL(24,1)))::DOUBLE / count({n}), 1) AS {n}" for n in STATS)} FROM stored GROUP BY ALL),
summary_base AS (SELECT variable, feature_id, source_feature, {", ".join(f"{n} AS baseline_{n}" for n in STATS)} FROM summary WHERE scenario = 'historical' AND horizon = 'baseline'),
feature_change AS (SELECT s.*, {", ".join(f"baseline_{n}" for n in STATS)}, {", ".join(f"round_even({n} - baseline_{n}, 1) AS change_{n}" for n in STATS)}
  FROM summary s LEFT JOIN summary_base USING (variable, feature_id, source_feature))"""


@query(f"WITH {OBS}, {MEANS}, {HORIZON}, {STORED}, {SUMMARY} SELECT * FROM feature_change")
def e11_feature_change(spark, sf):
    return change.feature_change(_feature_summary(spark, sf))


@query(f"""WITH {OBS}, {MEANS}, {HORIZON}, {STORED}, {SUMMARY} SELECT 'row' || r AS feature_id, first(change_mean) AS "prAdjust_ssp245_1999_ID1_change_mean"
  FROM range(6) t(r) LEFT JOIN (SELECT * FROM feature_change WHERE scenario = 'ssp245') c ON c.feature_id = 'row' || r GROUP BY ALL""")
def e12_wide_change_layer(spark, sf):
    changes = change.feature_change(_feature_summary(spark, sf)).withColumn("horizon_year", F.lit(1999))
    features = spark.range(6).select(F.concat(F.lit("row"), F.col("id")).alias("feature_id"))
    return change.wide_change_layer(changes, features, layers=["prAdjust_ssp245_1999_ID1_change_mean"])


@query(f"""WITH {OBS}, {WIND} SELECT variable, grid_row, grid_col, gcm, CAST(max(value) AS DOUBLE) AS value FROM obs GROUP BY ALL
  UNION ALL SELECT variable, grid_row, grid_col, NULL, max(value) FROM wind GROUP BY ALL""")
def e13_union_of_variables(spark, sf):
    rain = proxy.obs(spark, sf).groupBy("variable", "grid_row", "grid_col", "gcm").agg(F.max("value").cast("double").alias("value"))
    storm = proxy.wind(spark, sf).groupBy("variable", "grid_row", "grid_col").agg(F.max("value").alias("value"))
    return change.union_variables(rain, storm)


@query(f"""WITH {OBS}, {ANNUAL}, {ALIGNED}, {AREA}, stats AS (SELECT {KEYS}, period, time, min(value) AS min, round(avg(value), 4) AS mean, max(value) AS max, count(DISTINCT (gcm, rcm)) AS ensemble_members FROM area GROUP BY ALL)
  SELECT * FROM area JOIN stats USING ({KEYS}, period, time)""")
def e15_envelope(spark, sf):
    return ensemble.envelope(_aligned(spark, sf)).withColumn("mean", F.round("mean", 4))


# --- projections and labels ---------------------------------------------------------------------------------------


@query(f"WITH {OBS} SELECT * REPLACE (value::DOUBLE AS value) FROM obs WHERE year BETWEEN 1996 AND 1998")
def p2_subset_time(spark, sf):
    return _double(temporal.subset_time(proxy.obs(spark, sf), 1996, 1998), "value")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 86400 ELSE l_quantity END AS mm_day,
  CASE WHEN l_linenumber % 2 = 0 THEN l_quantity - 273.15 ELSE l_quantity END AS celsius, (l_quantity + 1) / 3.6 AS threshold_ms FROM lineitem""")
def p5_p6_p7_units(spark, sf):
    even = F.col("l_linenumber") % 2 == 0
    return proxy.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        units.precip_to_mm_day(F.col("l_quantity"), F.when(even, "kg m**-2 s**-1").otherwise("mm/day")).alias("mm_day"),
        units.temp_to_celsius(F.col("l_quantity"), F.when(even, "K").otherwise("degC")).alias("celsius"),
        units.wind_threshold_ms(F.col("l_quantity") + 1, F.lit("m s**-1")).alias("threshold_ms"),
    )


@query(f"""WITH {LABELLED} SELECT c_custkey, 'StormDaysGT' || replace(regexp_replace(regexp_replace(format('{{:.3f}}', threshold), '0+$', ''), '\\.$', ''), '.', 'p') AS index_name FROM labelled""")
def p8_storm_index_name(spark, sf):
    return proxy.labelled_periods(spark, sf).select("c_custkey", labels.storm_index_name(F.col("threshold")).alias("index_name"))


@query(r"""WITH t AS (SELECT p_partkey, ' ' || p_name || ' / ' || p_type || ':' || p_size || '. ' AS raw FROM part)
  SELECT p_partkey, trim(regexp_replace(regexp_replace(trim(raw), '[<>:"/\\|?*]+', '_', 'g'), '\s+', '_', 'g'), '._') AS feature,
    substr(trim(regexp_replace(regexp_replace(trim(raw), '[^0-9A-Za-z_]+', '_', 'g'), '_+', '_', 'g'), '_'), 1, 60) AS layer,
    translate(trim(raw), ' /\:', '_---') AS series, trim(regexp_replace(raw, '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS file FROM t""")
def p9_safe_names(spark, sf):
    raw = F.concat(F.lit(" "), "p_name", F.lit(" / "), "p_type", F.lit(":"), F.col("p_size").cast("string"), F.lit(". "))
    return proxy.table(spark, sf, "part").select("p_partkey", *(labels.safe_name(raw, s).alias(s) for s in ("feature", "layer", "series", "file")))


@query("""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber = 1 THEN 3 ELSE 1 END AS INT) AS decimals,
  CASE WHEN l_linenumber = 1 THEN round_even(floor(l_extendedprice) / 16, 3) ELSE round_even(floor(l_extendedprice) / 16, 1) END AS rounded FROM lineitem""")
def p10_round_output(spark, sf):
    variable = F.when(F.col("l_linenumber") == 1, "stormdaysgt70p5").otherwise("prAdjust")
    return proxy.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", labels.output_decimals(variable).alias("decimals"), labels.round_output(F.floor("l_extendedprice") / 16, variable).alias("rounded"))


@query(f"""WITH {LABELLED} SELECT c_custkey, CAST(round_even((start_year + end_year) / 2.0, 0) AS INT) AS mid_year, CAST((start_year + end_year) // 2 AS INT) AS floor_year,
  name || ' (' || CAST(round_even((start_year + end_year) / 2.0, 0) AS INT) || ')' AS label,
  name || ' (' || start_year || '-' || end_year || '; mid=' || CAST(round_even((start_year + end_year) / 2.0, 0) AS INT) || ')' AS long_label FROM labelled""")
def p11_p12_horizon_labels(spark, sf):
    start, end = F.col("start_year"), F.col("end_year")
    return proxy.labelled_periods(spark, sf).select(
        "c_custkey", labels.representative_year(start, end).alias("mid_year"), labels.representative_year_floor(start, end).alias("floor_year"),
        labels.horizon_label(F.col("name"), start, end).alias("label"), labels.horizon_label_long(F.col("name"), start, end).alias("long_label"),
    )


@query("""WITH t AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m FROM orders)
  SELECT o_orderkey, CASE WHEN m IN (12, 1, 2) THEN 'DJF' WHEN m <= 5 THEN 'MAM' WHEN m <= 8 THEN 'JJA' ELSE 'SON' END AS season,
    CAST(y + CASE WHEN m = 12 THEN 1 ELSE 0 END AS INT) AS season_year, format('{}-{:02d}', y, m) AS period, make_date(y, m, 1) AS period_time FROM t""")
def p13_p14_calendar(spark, sf):
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return proxy.table(spark, sf, "orders").select(
        "o_orderkey", labels.season(month).alias("season"), labels.season_year(year, month).alias("season_year"),
        labels.analysis_period("Monthly", year, month).alias("period"), labels.analysis_time("Monthly", year, month).alias("period_time"),
    )


@query(f"""WITH {OBS}, {ANNUAL}, {ALIGNED}, {AREA} SELECT period, year(time)::INT AS year, variable, 'mm' AS units, scenario, horizon, feature_id, min(value) AS min, max(value) AS max FROM area GROUP BY ALL""")
def p15_series_columns(spark, sf):
    return ensemble.area_stats(_aligned(spark, sf)).select("period", F.year("time").alias("year"), "variable", F.lit("mm").alias("units"), "scenario", "horizon", "feature_id", "min", "max")


@query(f"""WITH {OBS}, {TEMPERATURES} SELECT 'tasmeanAdjust' AS variable, scenario, horizon, gcm, rcm, feature_id, grid_row, grid_col, time, year, month,
  (CAST(high.value AS DOUBLE) + CAST(low.value AS DOUBLE)) / 2 AS value FROM high JOIN low USING (scenario, horizon, gcm, rcm, feature_id, grid_row, grid_col, time, year, month)""")
def p16_derive_mean_temp(spark, sf):
    high, low = (_double(x, "value") for x in proxy.temperatures(spark, sf))
    return temporal.derive_mean_temp(high, low)


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) / 60 AS minutes, CAST(p_size AS DOUBLE) AS hours, p_size * 24.0::DOUBLE AS days, CAST(p_size AS DOUBLE) AS ey,
  1.0::DOUBLE / p_size AS ari, CASE p_size WHEN 50 THEN 0.5 WHEN 20 THEN 0.2 WHEN 10 THEN 0.11 WHEN 5 THEN 0.05 WHEN 2 THEN 0.02 WHEN 1 THEN 0.01 END::DOUBLE AS aep,
  -round(p_retailprice, 2) AS number FROM part""")
def p17_parsers(spark, sf):
    size = F.col("p_size").cast("string")
    return proxy.table(spark, sf, "part").select(
        "p_partkey", *(labels.parse_duration_hours(F.concat(size, F.lit(u))).alias(n) for n, u in (("minutes", " min"), ("hours", " hr"), ("days", "  Days"))),
        labels.parse_event_rate(F.concat(size, F.lit(" EY"))).alias("ey"), labels.parse_event_rate(F.concat(F.lit("1 in "), size)).alias("ari"),
        labels.parse_event_rate(F.concat(size, F.lit("%"))).alias("aep"), labels.parse_number(F.format_string("about -%,.2f mm", F.col("p_retailprice"))).alias("number"),
    )


@query("SELECT p_partkey, round(-ln(1 - p_size / 100.0::DOUBLE), 10) AS rate FROM part")
def p17b_poisson_rate(spark, sf):
    return proxy.table(spark, sf, "part").select("p_partkey", F.round(labels.poisson_event_rate(F.col("p_size")), 10).alias("rate"))


@query("""SELECT s, 'SSP' || s[4] || '-' || s[5] || '.' || s[6] AS label, count(*) AS n FROM (SELECT 'ssp' || (100 + c_custkey % 500) AS s FROM customer) GROUP BY ALL""")
def p18_scenario_label(spark, sf):
    s = F.concat(F.lit("ssp"), (100 + F.col("c_custkey") % 500).cast("string"))
    return proxy.table(spark, sf, "customer").select(s.alias("s")).groupBy("s", labels.scenario_label(F.col("s")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, format('{:.6f}_{:.6f}', 140 + (s_suppkey * 37 % 90) / 100.0::DOUBLE, -35 + (s_suppkey * 53 % 90) / 100.0::DOUBLE) AS pixel_id FROM supplier")
def p19_pixel_id(spark, sf):
    lon, lat = 140 + (F.col("s_suppkey") * 37 % 90) / 100, -35 + (F.col("s_suppkey") * 53 % 90) / 100
    return proxy.table(spark, sf, "supplier").select("s_suppkey", labels.pixel_id(lon, lat).alias("pixel_id"))


@query(f"""WITH {LABELLED} SELECT c_custkey, 'TXge35 | ' || CASE WHEN c_custkey % 2 = 0 THEN 'Change in ' ELSE '' END || 'Mean | ' || CASE WHEN c_custkey % 3 = 0 THEN 'Historical' ELSE 'SSP245' END || ' | ' || start_year || '-' || end_year AS title,
  CASE WHEN start_year BETWEEN 2035 AND 2059 THEN '2050s' WHEN start_year >= 2070 THEN '2090s' ELSE start_year || '–' || end_year END AS period FROM labelled""")
def p20_map_labels(spark, sf):
    start, end, key = F.col("start_year"), F.col("end_year"), F.col("c_custkey")
    scenario = F.when(key % 3 == 0, "historical").otherwise("ssp245")
    return proxy.labelled_periods(spark, sf).select("c_custkey", labels.map_title(F.lit("TXge35"), F.lit("mean"), scenario, start, end, key % 2 == 0).alias("title"), labels.period_label(start, end).alias("period"))


@query(f"WITH {OBS}, {MEANS}, {HORIZON} SELECT {KEYS}, grid_row, grid_col, min, max FROM stats WHERE lower(variable) LIKE 'pr%' AND lower(scenario) = 'ssp245'")
def p21_ensemble_filters(spark, sf):
    wanted = ensemble.select_layers(_stats(spark, sf), variables=["PR"], scenarios=["SSP245"], stat_names=("min", "max"))
    return wanted.select(*KEYS.split(", "), "grid_row", "grid_col", "min", "max")
