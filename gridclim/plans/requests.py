"""Queries on sources, sinks, discovery and planning, with SQL for the same rows."""

from pyspark.sql import functions as F

from gridclim.plans import proxy, request
from gridclim.plans.proxy import OBS, WINDOWS
from gridclim.sources import files, store

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(f"""WITH {OBS} SELECT scenario, horizon, gcm, 'R' || rcm AS rcm, source, value::DOUBLE AS value FROM obs WHERE scenario = 'ssp245' AND gcm IN ('1-URGENT', '2-HIGH') AND rcm IN ('F', 'O')""")
def s1_scan_obs(spark, sf):
    """From a partitioned store: only the folders of the wanted keys are read."""
    path = store.scratch(spark, "store")
    store.write_obs(proxy.obs(spark, sf).withColumn("rcm", F.concat(F.lit("long-name-R"), "rcm")), path)
    found = store.scan_obs(spark, path, scenarios=["ssp245"], gcms=["1-URGENT", "2-HIGH"], rcms=["RF", "long-name-RO"], rcm_prefix="long-name-")
    return found.select("scenario", "horizon", "gcm", "rcm", "source", F.col("value").cast("double").alias("value"))


@query("""SELECT c_custkey AS pos, CASE WHEN c_custkey % 3 = 0 THEN 'ID' || c_custkey ELSE replace(c_name, '#', '#') END AS feature_id, 'Point' AS geom_type FROM customer WHERE c_acctbal > 0""")
def s2_scan_features(spark, sf):
    customer = proxy.table(spark, sf, "customer")
    features = customer.select(
        F.col("c_custkey").alias("pos"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise("  ").alias("name"), F.lit("Point").alias("geom_type"),
        F.when(F.col("c_acctbal") > 0, F.array(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))))).alias("rings"),
    )
    return store.scan_features(features, "name").select("pos", "feature_id", "geom_type")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS feature_id, o_orderkey, o_orderpriority FROM orders")
def s3_summary_features(spark, sf):
    rows = proxy.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.lit("Point").alias("geom_type"))
    return store.summary_features(rows, "o_orderkey").select(F.col("feature_id").cast("long").alias("feature_id"), "o_orderkey", "o_orderpriority")


@query("""SELECT 'F' || s_suppkey || '_' || trim(regexp_replace(s_name, '[^A-Za-z0-9._-]+', '_', 'g'), '_') AS point_id, s_name AS name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'urban' ELSE 'rural' END AS context, 140 + (s_suppkey * 37 % 90) / 100.0::DOUBLE AS lon, -35 + (s_suppkey * 53 % 90) / 100.0::DOUBLE AS lat FROM supplier""")
def s4_flood_sites(spark, sf):
    return proxy.sites(spark, sf).select("point_id", "name", "context", "lon", "lat")


@query(f"WITH {OBS} SELECT scenario, row_number() OVER (ORDER BY scenario <> 'historical', scenario) AS position FROM (SELECT DISTINCT scenario FROM obs)")
def s5_discover_scenarios(spark, sf):
    return request.discover_scenarios(proxy.obs(spark, sf))


@query(f"WITH {OBS} SELECT horizon, min(year) AS start_year, max(year) AS end_year FROM obs GROUP BY horizon")
def s5_discover_windows(spark, sf):
    return request.discover_windows(proxy.obs(spark, sf))


@query(f"""WITH {OBS}, {proxy.TEMPERATURES}, every AS (SELECT 'prAdjust' AS variable, scenario, horizon, year FROM obs UNION ALL SELECT 'tasmaxAdjust', scenario, horizon, year FROM high UNION ALL SELECT 'tasminAdjust', scenario, horizon, year FROM low)
  SELECT horizon, min(year) AS start_year, max(year) AS end_year, count(DISTINCT variable) AS variables FROM every WHERE variable IN ('tasmaxAdjust', 'tasminAdjust') GROUP BY horizon""")
def s5_discover_variables(spark, sf):
    """The mean temperature has no data of its own: its two sources are looked at."""
    high, low = proxy.temperatures(spark, sf)
    columns = ["variable", "scenario", "horizon", "year"]
    every = proxy.obs(spark, sf).select(*columns).unionByName(high.select(*columns)).unionByName(low.select(*columns))
    found = request.discover_windows(every, ["tasmeanAdjust"])
    variables = every.where(F.col("variable").isin(request.source_variables(["tasmeanAdjust"]))).groupBy("horizon").agg(F.count_distinct("variable").alias("variables"))
    return found.join(variables, "horizon")


NAMES = """names AS (SELECT c_custkey, c_custkey % 11 AS site,
  CASE c_custkey % 4 WHEN 0 THEN 'pr_' || (1951 + c_custkey % 100) || '0101-' || (1951 + c_custkey % 100) || '1231.NC'
    WHEN 1 THEN 'pr_' || (1951 + c_custkey % 100) || '-' || (1960 + c_custkey % 100) || '.nc'
    WHEN 2 THEN 'pr_' || (1951 + c_custkey % 100) || '01-' || (1960 + c_custkey % 100) || '12.nc' ELSE 'pr_undated.nc' END AS name FROM customer),
dated AS (SELECT *, CAST(nullif(regexp_extract(name, '(\\d{4})(\\d{4})?-(\\d{4})(\\d{4})?\\.[nN][cC]$', 1), '') AS INT) AS m1,
  CASE WHEN regexp_matches(name, '[^0-9](\\d{4})(\\d{4})?-(\\d{4})(\\d{4})?\\.[nN][cC]$') THEN CAST(nullif(regexp_extract(name, '[^0-9](\\d{4})(\\d{4})?-(\\d{4})(\\d{4})?\\.[nN][cC]$', 1), '') AS INT) END AS start_year,
  CASE WHEN regexp_matches(name, '[^0-9](\\d{4})(\\d{4})?-(\\d{4})(\\d{4})?\\.[nN][cC]$') THEN CAST(nullif(regexp_extract(name, '[^0-9](\\d{4})(\\d{4})?-(\\d{4})(\\d{4})?\\.[nN][cC]$', 3), '') AS INT) END AS end_year FROM names)"""


def _names(spark, sf):
    key = F.col("c_custkey")
    year = lambda base: (base + key % 100).cast("string")
    return proxy.table(spark, sf, "customer").select("c_custkey", (key % 11).alias("site"), F.concat(F.lit("pr_"), F.when(
        key % 4 == 0, F.concat(year(1951), F.lit("0101-"), year(1951), F.lit("1231.NC"))).when(
        key % 4 == 1, F.concat(year(1951), F.lit("-"), year(1960), F.lit(".nc"))).when(
        key % 4 == 2, F.concat(year(1951), F.lit("01-"), year(1960), F.lit("12.nc"))).otherwise("undated.nc")).alias("name"))


@query(f"WITH {NAMES} SELECT c_custkey, name, start_year, end_year FROM dated")
def s6_file_year_range(spark, sf):
    return files.with_year_range(_names(spark, sf)).select("c_custkey", "name", "start_year", "end_year")


@query(f"""WITH {NAMES}, judged AS (SELECT *, coalesce(start_year <= 1990 AND end_year >= 1985, false) AS hit FROM dated),
  marked AS (SELECT *, max(hit::INT) OVER (PARTITION BY site) AS any_hit FROM judged)
  SELECT c_custkey, site, name FROM marked WHERE hit OR (any_hit = 0 AND start_year IS NULL)""")
def s7_select_files(spark, sf):
    return files.select_for_window(files.with_year_range(_names(spark, sf)), 1985, 1990, ["site"]).select("c_custkey", "site", "name")


PLAN = f"""{WINDOWS}, vars AS (SELECT DISTINCT p_brand AS variable, p_brand <> 'Brand#11' AS full_set FROM part),
scen AS (SELECT * FROM (VALUES ('historical'), ('ssp245')) t(scenario)), models AS (SELECT DISTINCT o_orderpriority AS gcm, o_orderstatus AS rcm FROM orders),
lattice AS (SELECT *, CASE WHEN scenario = 'historical' AND NOT full_set THEN 'data_not_available'
  WHEN scenario <> 'historical' AND end_year + 20 <= 2014 THEN 'time_window_not_available' ELSE 'planned' END AS status FROM vars, scen, windows),
plan AS (SELECT variable, scenario, horizon, status, gcm, rcm FROM lattice, models WHERE status = 'planned'
  UNION ALL SELECT DISTINCT variable, scenario, NULL, status, NULL, NULL FROM lattice WHERE status = 'data_not_available'
  UNION ALL SELECT variable, scenario, horizon, status, NULL, NULL FROM lattice WHERE status = 'time_window_not_available')"""


def _plan(spark, sf):
    brand = F.col("p_brand")
    both, one = F.array(F.lit("historical"), F.lit("ssp245")), F.array(F.lit("ssp245"))
    variables = proxy.table(spark, sf, "part").select(brand.alias("variable")).distinct().withColumn("available_scenarios", F.when(F.col("variable") == "Brand#11", one).otherwise(both))
    scenarios = spark.createDataFrame([("historical",), ("ssp245",)], "scenario string")
    shifted = proxy.windows(spark).withColumns({"start_year": F.col("start_year") + 15, "end_year": F.col("end_year") + 20 - F.lit(0)})
    models = proxy.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("gcm"), F.col("o_orderstatus").alias("rcm")).distinct()
    return request.plan_matrix(variables, scenarios, shifted, models)


@query(f"WITH {PLAN} SELECT * FROM plan")
def s8_plan_matrix(spark, sf):
    return _plan(spark, sf).select("variable", "scenario", "horizon", "status", "gcm", "rcm")


FOUND = """found AS (SELECT p_brand AS variable, split_part(p_type, ' ', 1) AS t, count(*) AS n_files, sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS n_rows FROM part WHERE p_brand <> 'Brand#12' GROUP BY ALL),
files AS (SELECT variable, sum(n_files)::BIGINT AS n_files, sum(n_rows)::BIGINT AS n_rows FROM found GROUP BY ALL),
judged AS (SELECT plan.* EXCLUDE (status), CASE WHEN status <> 'planned' THEN status WHEN variable = 'Brand#13' THEN 'skipped_existing' WHEN coalesce(n_files, 0) = 0 THEN 'no_matching_files'
  WHEN coalesce(n_rows, 0) = 0 THEN 'empty_subset' ELSE 'saved' END AS status FROM plan LEFT JOIN files USING (variable))"""


def _manifest(spark, sf):
    found = proxy.table(spark, sf, "part").where("p_brand <> 'Brand#12'").groupBy(F.col("p_brand").alias("variable")).agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.when(F.col("p_size") > 25, 1).otherwise(0)).alias("n_rows"))
    done = proxy.table(spark, sf, "part").where("p_brand = 'Brand#13'").select(F.col("p_brand").alias("variable"))
    return request.manifest(_plan(spark, sf), found, done, ["variable"])


@query(f"WITH {PLAN}, {FOUND} SELECT variable, scenario, horizon, gcm, rcm, status FROM judged")
def s9_manifest_status(spark, sf):
    return _manifest(spark, sf).select("variable", "scenario", "horizon", "gcm", "rcm", "status")


@query(f"""WITH {PLAN}, {FOUND} SELECT variable, scenario, horizon, gcm, rcm, CASE WHEN status IN ('data_not_available', 'time_window_not_available') THEN status
  WHEN variable = 'Brand#21' THEN 'data_not_available' WHEN variable = 'Brand#22' THEN 'catalog_error' WHEN variable = 'Brand#23' THEN 'processing_error' ELSE status END AS status FROM judged""")
def s9_manifest_errors(spark, sf):
    part = proxy.table(spark, sf, "part")
    found = part.where("p_brand <> 'Brand#12'").groupBy(F.col("p_brand").alias("variable")).agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.when(F.col("p_size") > 25, 1).otherwise(0)).alias("n_rows"))
    brand = F.col("p_brand")
    said = F.when(brand == "Brand#21", "HTTP 404").when(brand == "Brand#22", "the connection broke")
    errors = part.where(brand.isin("Brand#21", "Brand#22", "Brand#23")).select(brand.alias("variable"), said.alias("catalog_message"), F.when(brand == "Brand#23", "no cells").alias("processing_message")).distinct()
    done = part.where("p_brand = 'Brand#13'").select(brand.alias("variable"))
    return request.manifest(_plan(spark, sf), found, done, ["variable"], errors).select("variable", "scenario", "horizon", "gcm", "rcm", "status")


MEMBERS = f"""{PLAN}, members AS (SELECT DISTINCT p_brand AS variable, scenario, horizon, 'g' || p_size % 3 AS gcm, 'r' || p_size % 2 AS rcm, 'ID1' AS feature_id, p_size % 3 = 1 AS failed
  FROM part, (SELECT DISTINCT scenario, horizon FROM plan WHERE horizon IS NOT NULL) WHERE p_brand <> 'Brand#12'),
stats AS (SELECT DISTINCT variable, scenario, horizon, feature_id, stat, variable = 'Brand#13' AND stat = 'max' AS failed FROM members, (VALUES ('min'), ('max')) s(stat)),
wanted AS (SELECT DISTINCT variable, scenario, horizon FROM plan WHERE status = 'planned')"""


@query(f"""WITH {MEMBERS} SELECT variable, scenario, horizon, gcm, rcm, feature_id, NULL::VARCHAR AS stat, CASE WHEN failed THEN 'model_layer_error' ELSE 'model_layer_saved' END AS status FROM members SEMI JOIN wanted USING (variable, scenario, horizon)
  UNION ALL SELECT variable, scenario, horizon, NULL, NULL, feature_id, stat, CASE WHEN failed THEN 'ensemble_error' ELSE 'ensemble_raster_saved' END FROM stats SEMI JOIN wanted USING (variable, scenario, horizon)
  UNION ALL SELECT variable, scenario, horizon, NULL, NULL, feature_id, stat, 'ensemble_change_raster_saved' FROM stats SEMI JOIN wanted USING (variable, scenario, horizon) WHERE scenario <> 'historical'
  UNION ALL SELECT variable, scenario, horizon, NULL, NULL, NULL, NULL, status FROM plan WHERE status <> 'planned'
  UNION ALL SELECT variable, scenario, horizon, NULL, NULL, NULL, NULL, 'no_input_files' FROM wanted ANTI JOIN members USING (variable, scenario, horizon)""")
def s9_ensemble_manifest(spark, sf):
    plan = _plan(spark, sf)
    size = F.col("p_size")
    parts = proxy.table(spark, sf, "part").where("p_brand <> 'Brand#12'").select(F.col("p_brand").alias("variable"), F.concat(F.lit("g"), size % 3).alias("gcm"), F.concat(F.lit("r"), size % 2).alias("rcm"), F.lit("ID1").alias("feature_id"), F.when(size % 3 == 1, "broken").alias("message")).distinct()
    windows = F.explode(F.array(*(F.struct(F.lit(s).alias("scenario"), F.lit(h).alias("horizon")) for s in ("historical", "ssp245") for h in ("baseline", "mid_term", "overlap"))))
    members = parts.withColumn("_w", windows).select("*", "_w.*").drop("_w")
    stats = members.drop("message", "gcm", "rcm").distinct().withColumn("stat", F.explode(F.array(F.lit("min"), F.lit("max"))))
    failed = F.when((F.col("variable") == "Brand#13") & (F.col("stat") == "max"), "broken")
    done = request.ensemble_manifest(plan, members, stats.withColumn("message", failed), stats.where("scenario <> 'historical'"))
    return done.select("variable", "scenario", "horizon", "gcm", "rcm", "feature_id", "stat", "status")


@query(f"""WITH {OBS}, wanted AS (SELECT DISTINCT v AS variable, scenario, horizon, f AS frequency FROM obs, (VALUES ('prAdjust'), ('tasmaxAdjust')) a(v), (VALUES ('Monthly'), ('Annual')) b(f)),
  made AS (SELECT variable, scenario, horizon, f AS frequency, gcm AS feature_id, sum(CASE WHEN f = 'Monthly' OR value > 400000 THEN 1 ELSE 0 END) AS n_rows FROM obs, (VALUES ('Monthly'), ('Annual')) b(f) GROUP BY ALL)
  SELECT variable, scenario, horizon, frequency, feature_id, CASE WHEN feature_id = '2-HIGH' THEN 'skipped_existing' WHEN n_rows > 0 THEN 'saved' ELSE 'no_data' END AS status FROM wanted LEFT JOIN made USING (variable, scenario, horizon, frequency)""")
def s9_series_manifest(spark, sf):
    rows = proxy.obs(spark, sf).withColumn("frequency", F.explode(F.array(F.lit("Monthly"), F.lit("Annual"))))
    wanted = rows.select(F.explode(F.array(F.lit("prAdjust"), F.lit("tasmaxAdjust"))).alias("variable"), "scenario", "horizon", "frequency").distinct()
    n = F.sum(F.when((F.col("frequency") == "Monthly") | (F.col("value") > 400000), 1).otherwise(0))
    made = rows.groupBy("variable", "scenario", "horizon", "frequency", F.col("gcm").alias("feature_id")).agg(n.alias("n_rows"))
    return request.series_manifest(wanted, made, made.where("feature_id = '2-HIGH'"))


@query(f"WITH {PLAN}, {FOUND} SELECT status, count(*) AS n FROM judged GROUP BY status")
def s10_manifest_summary(spark, sf):
    return request.manifest_summary(_manifest(spark, sf))


@query(f"WITH {OBS} SELECT variable, scenario, horizon, period, value FROM (SELECT variable, scenario, horizon, year::VARCHAR AS period, CAST(sum(value) AS DOUBLE) AS value FROM obs GROUP BY ALL)")
def s11_write_series(spark, sf):
    series = proxy.obs(spark, sf).groupBy("variable", "scenario", "horizon", F.col("year").cast("string").alias("period")).agg(F.sum("value").cast("double").alias("value"))
    path = store.scratch(spark, "series")
    store.write_series(series, path, ["scenario", "horizon"])
    return spark.read.schema("variable string, period string, value double, scenario string, horizon string").option("header", True).csv(path).select("variable", "scenario", "horizon", "period", "value")


@query(f"""WITH {OBS}, layers AS (SELECT 'pr_' || scenario AS variable, grid_row, grid_col, count(*) AS n FROM obs GROUP BY ALL)
  SELECT sink, layers.* FROM layers, (VALUES ('by_variable'), ('all_variables'), ('all_variables_csv')) s(sink)""")
def s12_write_layers(spark, sf):
    layers = proxy.obs(spark, sf).groupBy(F.concat(F.lit("pr_"), "scenario").alias("variable"), "grid_row", "grid_col").agg(F.count(F.lit(1)).alias("n"))
    path = store.scratch(spark, "layers")
    store.write_layers(layers, path)
    schema = spark.createDataFrame([], layers.schema).schema
    read = {"by_variable": spark.read.schema(schema).parquet(f"{path}/by_variable"), "all_variables": spark.read.schema(schema).parquet(f"{path}/all_variables"), "all_variables_csv": spark.read.schema(schema).option("header", True).csv(f"{path}/all_variables_csv")}
    done = [rows.select(F.lit(name).alias("sink"), "variable", "grid_row", "grid_col", "n") for name, rows in read.items()]
    return done[0].unionByName(done[1]).unionByName(done[2])


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 40)")
def s13_resume(spark, sf):
    done = proxy.table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return request.unfinished(proxy.table(spark, sf, "part").select("p_partkey", "p_brand"), done, ["p_partkey"])


@query(f"""WITH {OBS} SELECT scenario, gcm, rcm, count(*) AS n, sum(CASE WHEN scenario = 'historical' THEN value ELSE 1 END)::DOUBLE AS total FROM obs GROUP BY ALL""")
def s13_idempotent_write(spark, sf):
    """One scenario is written, then all of them with another value: the first stays as it was, the others are added."""
    path = store.scratch(spark, "store")
    rows = proxy.obs(spark, sf)
    store.write_obs(rows.where("scenario = 'historical'"), path)
    store.write_obs(rows.withColumn("value", F.lit(1).cast("decimal(18,2)")), path)
    found = spark.read.schema(rows.schema).parquet(path)
    return found.groupBy("scenario", "gcm", "rcm").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


@query(f"""WITH {OBS} SELECT scenario, nullif(CASE WHEN source % 5 = 0 THEN '' ELSE gcm END, '') AS gcm, rcm, count(*) AS n, sum(value)::DOUBLE AS total FROM obs GROUP BY ALL""")
def s13_broken_run(spark, sf):
    """A run that was killed between its files leaves half of each unit; the next one replaces them, and a third one changes nothing. Some
    units have an empty key."""
    path = store.scratch(spark, "store")
    rows = proxy.obs(spark, sf).withColumn("gcm", F.when(F.col("source") % 5 == 0, "").otherwise(F.col("gcm")))
    store.write_obs(rows.where("scenario = 'historical' and rcm = 'F'"), path)
    layout = [k for k in store.LAYOUT if k in rows.columns]
    half = rows.where("source % 2 = 0 and not (scenario = 'historical' and rcm = 'F')").withColumn("value", F.lit(-1).cast("decimal(18,2)"))
    half.write.mode("append").partitionBy(*layout).parquet(path)
    store.write_obs(rows, path)
    store.write_obs(rows.withColumn("value", F.lit(0).cast("decimal(18,2)")), path)
    found = store.scan_obs(spark, path)
    return found.groupBy("scenario", "gcm", "rcm").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


@query(f"""WITH {OBS} SELECT variable, scenario, horizon, gcm, rcm, count(*) AS n_rows, min(year) AS first_year, max(year) AS last_year FROM obs GROUP BY ALL""")
def s13_units(spark, sf):
    """The catalogue after the scenarios were written one after the other."""
    path = store.scratch(spark, "store")
    rows = proxy.obs(spark, sf)
    for scenario in ("historical", "ssp245"):
        store.write_obs(rows.where(F.col("scenario") == scenario), path)
    return store.units(spark, path).select("variable", "scenario", "horizon", "gcm", "rcm", "n_rows", "first_year", "last_year")


@query(f"WITH {OBS} SELECT horizon, min(year) AS start_year, max(year) AS end_year FROM obs GROUP BY horizon")
def s5_windows_of_units(spark, sf):
    """Windows from the catalogue alone."""
    path = store.scratch(spark, "store")
    store.write_obs(proxy.obs(spark, sf), path)
    return request.discover_windows(store.units(spark, path))


@query(f"""WITH {OBS}, named AS (SELECT * REPLACE (CASE source % 4 WHEN 0 THEN '007' WHEN 1 THEN '7' WHEN 2 THEN '7.0' ELSE '2050-01-01' END AS feature_id) FROM obs)
  SELECT feature_id, scenario, count(*) AS n, sum(value)::DOUBLE AS total FROM named GROUP BY ALL""")
def s1_keys_keep_their_meaning(spark, sf):
    """Features whose ids look like numbers and dates stay apart in a store."""
    path = store.scratch(spark, "store")
    k = F.col("source") % 4
    store.write_obs(proxy.obs(spark, sf).withColumn("feature_id", F.when(k == 0, "007").when(k == 1, "7").when(k == 2, "7.0").otherwise("2050-01-01")), path)
    return store.scan_obs(spark, path).groupBy("feature_id", "scenario").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))


RASTERS = """rasters AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'TXge35_Mean_ssp245_2040_20' || (50 + p_size % 40)
  WHEN 1 THEN 'R20mm_min_historical_1985_2014_ID' || p_size WHEN 2 THEN 'FFDI_ssp370_long_term_ID' || p_size || '_ensemble_max' ELSE 'TXge35_Change_Min_ssp245_2040_2059' END AS name FROM part)"""


@query(f"""WITH {RASTERS}, parsed AS (SELECT p_partkey, name, CASE p_partkey % 4 WHEN 0 THEN 'TXge35' WHEN 1 THEN 'R20mm' WHEN 2 THEN 'FFDI' END AS variable,
    CASE p_partkey % 4 WHEN 0 THEN 'ssp245' WHEN 1 THEN 'historical' WHEN 2 THEN 'ssp370' END AS scenario,
    CASE p_partkey % 4 WHEN 0 THEN '2040_' || split_part(name, '_', 5) WHEN 1 THEN '1985_2014' WHEN 2 THEN 'long_term' END AS horizon,
    CASE p_partkey % 4 WHEN 0 THEN 'ID1' WHEN 1 THEN split_part(name, '_', 6) WHEN 2 THEN split_part(name, '_', 5) END AS source_feature,
    CASE p_partkey % 4 WHEN 0 THEN 'mean' WHEN 1 THEN 'min' WHEN 2 THEN 'max' END AS stat FROM rasters)
  SELECT * FROM parsed WHERE variable IS NOT NULL""")
def s15_raster_inventory(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    name = F.when(key % 4 == 0, F.concat(F.lit("TXge35_Mean_ssp245_2040_20"), (50 + size % 40).cast("string"))).when(
        key % 4 == 1, F.concat(F.lit("R20mm_min_historical_1985_2014_ID"), size.cast("string"))).when(
        key % 4 == 2, F.concat(F.lit("FFDI_ssp370_long_term_ID"), size.cast("string"), F.lit("_ensemble_max"))).otherwise("TXge35_Change_Min_ssp245_2040_2059")
    return files.raster_inventory(proxy.table(spark, sf, "part").select("p_partkey", name.alias("name")))


@query(f"""WITH {proxy.WIND}, kept AS (SELECT 'sfcWindmax' AS variable, grid_row, grid_col, year::VARCHAR AS period, max(value) AS value FROM wind GROUP BY ALL),
  storms AS (SELECT 'StormDaysGT89' AS variable, grid_row, grid_col, year::VARCHAR AS period, sum(CASE WHEN value > 89.0 / 3.6 THEN 1 ELSE 0 END)::DOUBLE AS value FROM wind GROUP BY ALL)
  SELECT * FROM kept UNION ALL SELECT * FROM storms""")
def s16_retain_source(spark, sf):
    from gridclim.operators import temporal

    wind = proxy.wind(spark, sf)
    storms = temporal.exceedance_days(wind, 89.0 / 3.6).withColumn("variable", F.lit("StormDaysGT89"))
    kept = wind.groupBy("variable", "grid_row", "grid_col", "year").agg(F.max("value").alias("value"))
    columns = ("variable", "grid_row", "grid_col", F.col("year").cast("string").alias("period"), F.col("value").cast("double").alias("value"))
    return store.retain_source(storms.select(*columns), kept.select(*columns))


@query(f"""WITH {proxy.WIND} SELECT 'sfcWindmax' AS variable, grid_row, grid_col, count(*) AS n_rows, CASE WHEN grid_row = 0 THEN 'skipped_existing' ELSE 'saved' END AS status, 'daily source' AS message FROM wind GROUP BY ALL""")
def s16_retained_manifest(spark, sf):
    wind = proxy.wind(spark, sf)
    return store.retained_manifest(wind, ["variable", "grid_row", "grid_col"], wind.where("grid_row = 0"), "daily source")


@query("SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def p1_unknown_choices(spark, sf):
    wanted = proxy.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("name"))
    return request.unknown_choices(wanted, spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "name string"), "name")


@query(f"WITH {OBS}, {WINDOWS} SELECT source, year, windows.horizon AS time_window FROM obs JOIN windows ON year BETWEEN start_year AND end_year")
def p3_assign_window(spark, sf):
    found = request.assign_window(proxy.obs(spark, sf).drop("horizon"), proxy.windows(spark))
    return found.select("source", "year", F.col("horizon").alias("time_window"))


@query(f"""WITH {proxy.LABELLED} SELECT c_custkey, CASE WHEN s = 'historical' THEN start_year <= 2014 ELSE end_year > 2014 END AS extraction, (s = 'historical') = (name = 'BUILDING') AS ensemble,
  CASE WHEN s = 'historical' THEN end_year <= 2014 ELSE end_year > 2014 END AS flood FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'historical' ELSE 'ssp245' END AS s FROM labelled)""")
def p4_valid_windows(spark, sf):
    s = F.when(F.col("c_custkey") % 2 == 0, "historical").otherwise("ssp245")
    horizon = F.when(F.col("name") == "BUILDING", "baseline").otherwise(F.col("name"))
    return proxy.labelled_periods(spark, sf).select(
        "c_custkey", request.window_available(s, F.col("start_year"), F.col("end_year")).alias("extraction"),
        request.horizon_matches(s, horizon).alias("ensemble"), request.flood_window_valid(s, F.col("end_year")).alias("flood"),
    )


@query("SELECT c_custkey AS feature_id, c_name, c_mktsegment FROM customer")
def p22_keep_fields(spark, sf):
    rows = proxy.table(spark, sf, "customer").withColumnRenamed("c_custkey", "feature_id")
    return store.keep_fields(rows, "feature_id", ["c_name", "feature_id", "c_mktsegment", "c_name"])
