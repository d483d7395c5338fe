"""The given tables seen as climate data, in Spark and as SQL with the same rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.sources import store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as precipitation: priority is the GCM, status the RCM, the customer's nation the cell."""
    orders = table(spark, sf_dir, "orders").withColumn("time", F.col("o_orderdate").cast("date"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    year = F.year("time")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.lit("prAdjust").alias("variable"),
            F.when(year <= 1997, "historical").otherwise("ssp245").alias("scenario"),
            F.when(year <= 1997, "baseline").otherwise("mid_term").alias("horizon"),
            F.col("o_orderpriority").alias("gcm"), F.col("o_orderstatus").alias("rcm"), F.lit("ID1").alias("feature_id"),
            "time", year.alias("year"), F.month("time").alias("month"),
            F.floor(F.col("c_nationkey") / 5).cast("int").alias("grid_row"), (F.col("c_nationkey") % 5).alias("grid_col"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("value"), F.col("o_orderkey").alias("source"),
        )
    )


OBS = """obs AS (
  SELECT 'prAdjust' AS variable, CASE WHEN year(o_orderdate) <= 1997 THEN 'historical' ELSE 'ssp245' END AS scenario,
    CASE WHEN year(o_orderdate) <= 1997 THEN 'baseline' ELSE 'mid_term' END AS horizon,
    o_orderpriority AS gcm, o_orderstatus AS rcm, 'ID1' AS feature_id, CAST(o_orderdate AS DATE) AS time,
    CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
    CAST(c_nationkey // 5 AS INT) AS grid_row, CAST(c_nationkey % 5 AS INT) AS grid_col,
    CAST(o_totalprice AS DECIMAL(18,2)) AS value, o_orderkey AS source
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily maximum quantity per supplier nation and ship day as wind in m/s."""
    line = table(spark, sf_dir, "lineitem").withColumn("time", F.col("l_shipdate").cast("date"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    keyed = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.lit("sfcWindmax").alias("variable"), F.lit("ID1").alias("feature_id"),
        F.floor(F.col("s_nationkey") / 5).cast("int").alias("grid_row"), (F.col("s_nationkey") % 5).alias("grid_col"),
        "time", F.year("time").alias("year"), F.col("l_quantity").alias("value"),
    )
    return keyed.groupBy("variable", "feature_id", "grid_row", "grid_col", "time", "year").agg(F.max("value").alias("value"))


WIND = """wind AS (
  SELECT 'sfcWindmax' AS variable, 'ID1' AS feature_id, CAST(s_nationkey // 5 AS INT) AS grid_row,
    CAST(s_nationkey % 5 AS INT) AS grid_col, CAST(l_shipdate AS DATE) AS time, CAST(year(l_shipdate) AS INT) AS year,
    max(l_quantity) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""


def temperatures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Daily maximum and minimum of line prices of each cell and member; days without returned lines lack a minimum."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_returnflag")
    keyed = obs(spark, sf_dir).drop("value").join(line, F.col("source") == F.col("l_orderkey"))
    keys = ["scenario", "horizon", "gcm", "rcm", "feature_id", "grid_row", "grid_col", "time", "year", "month"]
    high = keyed.groupBy(*keys).agg(F.max("price").alias("value")).withColumn("variable", F.lit("tasmaxAdjust"))
    low = keyed.where("l_returnflag <> 'N'").groupBy(*keys).agg(F.min("price").alias("value")).withColumn("variable", F.lit("tasminAdjust"))
    return high, low


TEMPERATURES = """line AS (SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_returnflag FROM lineitem),
high AS (SELECT scenario, horizon, gcm, rcm, feature_id, grid_row, grid_col, time, year, month, max(price) AS value
  FROM obs JOIN line ON source = l_orderkey GROUP BY ALL),
low AS (SELECT scenario, horizon, gcm, rcm, feature_id, grid_row, grid_col, time, year, month, min(price) AS value
  FROM obs JOIN line ON source = l_orderkey WHERE l_returnflag <> 'N' GROUP BY ALL)"""


def windows(spark: SparkSession) -> DataFrame:
    """Time windows, two of them overlapping: a dimension table of fixed size."""
    rows = [("baseline", 1995, 1997), ("mid_term", 1998, 2000), ("overlap", 1997, 1999)]
    return spark.createDataFrame(rows, "horizon string, start_year int, end_year int")


WINDOWS = "windows AS (SELECT * FROM (VALUES ('baseline', 1995, 1997), ('mid_term', 1998, 2000), ('overlap', 1997, 1999)) t(horizon, start_year, end_year))"


def labelled_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as (name, start, end, threshold) rows, to try labels on."""
    start = F.lit(1985) + (F.col("c_custkey") % 90).cast("int")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("name"), start.alias("start_year"), (start + 5 + (F.col("c_custkey") % 31).cast("int")).alias("end_year"),
        ((F.col("c_custkey") % 500) / F.lit(4.0) + 0.25).alias("threshold"),
    )


LABELLED = """labelled AS (
  SELECT c_custkey, c_mktsegment AS name, CAST(1985 + c_custkey % 90 AS INT) AS start_year,
    CAST(1985 + c_custkey % 90 + 5 + c_custkey % 31 AS INT) AS end_year, (c_custkey % 500) / 4.0 + 0.25 AS threshold
  FROM customer)"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as flood sites: even keys urban, odd ones rural."""
    key = F.col("s_suppkey")
    return store.flood_sites(table(spark, sf_dir, "supplier").select(
        key.alias("pos"), F.col("s_name").alias("name"), (140 + (key * 37 % 90) / F.lit(100.0)).alias("lon"), (-35 + (key * 53 % 90) / F.lit(100.0)).alias("lat"),
        F.when(key % 2 == 0, "Urban area").otherwise("rural").alias("context"),
    ))
