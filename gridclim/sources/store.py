"""The partitioned store of observations, feature tables, sites, and the sinks."""

import atexit
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from gridclim.functions.labels import safe_name
from gridclim.operators.guards import some_rows

#: Partition columns of the store, outermost first; a store of one domain may do without it.
LAYOUT = ("domain", "variable", "scenario", "horizon", "gcm", "rcm", "feature_id")


def select_obs(obs: DataFrame, variables=None, scenarios=None, gcms=None, rcms=None, feature_ids=None, rcm_prefix: str = "", domains=None) -> DataFrame:
    """Rows of the wanted keys (None: all). rcm_prefix is what the long names of regional models begin with: long and short
    names are equal, and the result has the short ones. The filters are plain comparisons of partition columns, so that
    Spark reads only the matching partitions."""
    short = lambda names: [x.removeprefix(rcm_prefix) for x in names]
    for column, wanted in (("domain", domains), ("variable", variables), ("scenario", scenarios), ("gcm", gcms), ("feature_id", feature_ids)):
        if wanted is not None:
            obs = obs.where(F.col(column).isin(*wanted))
    if rcms is not None:
        obs = obs.where(F.col("rcm").isin(*short(rcms), *(rcm_prefix + x for x in short(rcms))))
    cut = F.substr("rcm", F.lit(len(rcm_prefix) + 1))
    return obs.withColumn("rcm", F.when(F.startswith("rcm", F.lit(rcm_prefix)), cut).otherwise(F.col("rcm")))


def scan_obs(spark: SparkSession, root: str, schema: StructType | None = None, complete_only: bool = True, **wanted) -> DataFrame:
    """The store below root, for the wanted keys, without what a broken run left. Partition keys have the type of the schema, which is
    the catalogue's if not given, else they are strings: "007", "7" and "7.0" are three features."""
    listed = units(spark, root)
    if schema is None and listed is not None:
        found = listed.select("schema").first()
        schema = StructType.fromJson(json.loads(found["schema"])) if found else None
    if schema is None:
        plain = spark.read.parquet(root).schema
        schema = StructType([StructField(f.name, StringType() if f.name in LAYOUT else f.dataType) for f in plain])
    obs = select_obs(spark.read.schema(schema).parquet(root), **wanted)
    if listed is None or not complete_only:
        return obs
    keys = [k for k in LAYOUT if k in listed.columns]
    if "rcm_prefix" in wanted:  # names are short by now
        keys.remove("rcm")
    return obs.join(*_same_units(obs, listed, keys), "left_semi")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _same_units(rows: DataFrame, listed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """Units under names of their own, and the condition that a row is of one; keys are compared as text, nulls are equal."""
    other = listed.select(*(F.col(k).alias(f"_unit_{k}") for k in keys)).distinct()
    return other, [rows[k].cast("string").eqNullSafe(other[f"_unit_{k}"]) for k in keys]


def units(spark: SparkSession, root: str) -> DataFrame | None:
    """The catalogue of a store: its complete units, with keys as text, n_rows, first_year, last_year (null without years) and the
    schema they were written with. It stands beside the store and is the last that a run writes, so listing units or years reads no
    observation. None where there is no catalogue."""
    path = f"{root.rstrip('/')}.units"
    if not _exists(spark, path):
        return None
    every = spark.read.parquet(path)
    keys = [c for c in every.columns if c not in UNIT_COLUMNS]
    last = F.max_by(F.struct("n_rows", "first_year", "last_year", "schema"), "written").alias("u")
    return every.groupBy(*keys).agg(last).select(*keys, "u.*")


#: Columns of the catalogue besides the keys.
UNIT_COLUMNS = ("n_rows", "first_year", "last_year", "schema", "written")


def _count_units(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    years = [f("year").cast("int") if "year" in rows.columns else F.lit(None).cast("int") for f in (F.min, F.max)]
    return rows.groupBy(*(F.col(k).cast("string").alias(k) for k in keys)).agg(F.count(F.lit(1)).alias("n_rows"), years[0].alias("first_year"), years[1].alias("last_year"))


def _enter(counted: DataFrame, root: str, schema: StructType) -> None:
    entry = counted.withColumns({"schema": F.lit(schema.json()), "written": F.current_timestamp()})
    entry.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}.units")


def damaged_units(spark: SparkSession, root: str, schema: StructType, form: str = "parquet", options: dict | None = None) -> DataFrame:
    """Units of the catalogue whose rows are not as many as it says: keys, n_rows, found. Of Parquet only footers are read."""
    listed = units(spark, root)
    keys = [c for c in listed.columns if c not in UNIT_COLUMNS]
    there = spark.read.schema(schema).format(form).options(**(options or {})).load(root)
    found = there.groupBy(*(F.col(k).cast("string").alias(f"_unit_{k}") for k in keys)).agg(F.count(F.lit(1)).alias("found"))
    held = listed.join(found, [listed[k].eqNullSafe(found[f"_unit_{k}"]) for k in keys], "left")
    return held.select(*keys, "n_rows", F.coalesce("found", F.lit(0)).alias("found")).where("n_rows <> found")


def written_units(spark: SparkSession, schema: StructType, root: str, keys: Sequence[str], form: str = "parquet", options: dict | None = None) -> DataFrame | None:
    """The complete units that root holds; None where there is no root yet. A store from before there was a catalogue is read once, and
    all it holds counts as complete."""
    listed = units(spark, root)
    if listed is None and _exists(spark, root):
        there = spark.read.schema(schema).format(form).options(**(options or {})).load(root)
        _enter(_count_units(there, keys), root, schema)
        listed = units(spark, root)
    return None if listed is None else listed.select(*keys)


def write_units(
    rows: DataFrame, root: str, keys: Sequence[str], overwrite: bool = False, form: str = "parquet", options: dict | None = None, deal: Sequence[str] = ()
) -> None:
    """Write rows, dealt out by the columns `deal`, below root, a folder for each combination of `keys`, which is the unit of output: a unit
    that is complete stays as it is, units that are new are added; with overwrite the units of rows are replaced, one by one, and others stay.

    Empty strings and nulls are one key. A unit is complete when the catalogue has it, which is written last: what a run left that broke
    off is not in it, and the next run that has the unit replaces it. One run at a time may write to a root.
    """
    spark, schema = rows.sparkSession, rows.schema
    rows = rows.withColumns({k: F.nullif(F.col(k), F.lit("")) for k in keys if isinstance(schema[k].dataType, StringType)})
    there = written_units(spark, schema, root, keys, form, options)
    if there is None:
        _enter(_count_units(spark.createDataFrame([], schema), keys), root, schema)  # from now on folders without an entry are no units
    elif not overwrite:
        rows = rows.join(*_same_units(rows, there, keys), "left_anti")
    seen = Observation()
    watched = rows.observe(seen, F.collect_set(F.struct(*(F.col(k).cast("string").alias(k) for k in keys))).alias("units"))
    dealt = watched.repartition(*deal) if deal else watched
    dealt.write.format(form).partitionBy(*keys).options(**(options or {})).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(root)
    made = seen.get["units"] if seen._jo.getRow().length() else []  # of no rows at all nothing is observed
    if made:
        listed = spark.createDataFrame([tuple(u) for u in made], StructType([StructField(k, StringType()) for k in keys]))
        written = spark.read.schema(schema).format(form).options(**(options or {})).load(root)
        for k in keys:  # so that only folders of these units are read
            values = {u[k] for u in made}
            written = written.where(F.col(k).cast("string").isin(*(v for v in values if v is not None)) | (F.col(k).isNull() if None in values else F.lit(False)))
        _enter(_count_units(written.join(*_same_units(written, listed, keys), "left_semi"), keys), root, schema)


def write_obs(obs: DataFrame, root: str, overwrite: bool = False) -> None:
    """Write the store; existing units stay as they are and new ones are added, or are replaced one by one with overwrite."""
    layout = [k for k in LAYOUT if k in obs.columns]
    write_units(obs, root, layout, overwrite, deal=(*layout, "year"))


def scan_features(features: DataFrame, id_field: str | None = None) -> DataFrame:
    """features(pos, rings, ...) with a geometry, and feature_id: the field, or ID and the position where it is blank. None is an error."""
    own = F.nullif(F.trim(F.col(id_field).cast("string")), F.lit("")) if id_field else F.lit(None).cast("string")
    shaped = some_rows(features.where(F.col("rings").isNotNull() & (F.size("rings") > 0)), "no feature has a geometry")
    return shaped.withColumn("feature_id", safe_name(F.coalesce(own, F.concat(F.lit("ID"), F.col("pos").cast("string")))))


def summary_features(features: DataFrame, pos: str, id_field: str | None = None) -> DataFrame:
    """Features of one geometry family, points or polygons; ids must not be null, or are numbered by position.

    Numbers are made without one ordered partition: each range partition counts on from those before it. The ranges are
    written with their numbers first, as a second evaluation could cut them elsewhere.
    """
    family = F.when(F.col("geom_type").isin("Point", "MultiPoint"), "point").otherwise("polygon")
    families = features.agg(F.count_distinct(family).alias("n")).first()["n"]
    if families > 1:
        raise ValueError("points and polygons cannot be summarised together")
    if id_field:
        checked = F.coalesce(F.col(id_field), F.raise_error(F.lit("feature ids must not be null")).cast(features.schema[id_field].dataType))
        return features.withColumn("feature_id", checked)
    ranged = settle(features.repartitionByRange(pos).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # as many rows as partitions
    before = counts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    numbered = ranged.withColumn("_k", F.row_number().over(W.partitionBy("_part").orderBy(pos)))
    name = "feature_id"
    while name in features.columns:
        name = "feature_id_1" if name == "feature_id" else f"feature_id_{int(name.rsplit('_', 1)[1]) + 1}"
    return numbered.join(before, "_part").withColumn(name, F.col("_before") + F.col("_k")).drop("_part", "_before", "_k")


def flood_sites(rows: DataFrame) -> DataFrame:
    """rows(pos, name, lon, lat, context) -> point_id, name, context (urban before rural), lon, lat; bad rows raise."""
    low = F.lower("context")
    wrong = lambda text: F.raise_error(F.concat(F.lit(text), F.lit(" of site "), F.coalesce(F.col("name"), F.lit("?"))))
    return rows.select(
        F.concat(F.lit("F"), F.col("pos").cast("string"), F.lit("_"), safe_name(F.col("name"), "file")).alias("point_id"),
        "name", F.when(low.contains("urban"), "urban").when(low.contains("rural"), "rural").otherwise(wrong("unknown context").cast("string")).alias("context"),
        F.when(F.col("lon").between(-180, 180), F.col("lon")).otherwise(wrong("wrong longitude").cast("double")).alias("lon"),
        F.when(F.col("lat").between(-90, 90), F.col("lat")).otherwise(wrong("wrong latitude").cast("double")).alias("lat"),
    )


def keep_fields(rows: DataFrame, id_field: str, fields: Sequence[str] | None = None) -> DataFrame:
    """The id first, then the wanted fields once each; None keeps all; unknown ones raise."""
    if fields is None:
        fields = rows.columns
    if unknown := sorted(set(fields) - set(rows.columns)):
        raise ValueError(f"unknown fields: {unknown}")
    return rows.select(*dict.fromkeys([id_field, *fields]))


def retain_source(derived: DataFrame, source: DataFrame) -> DataFrame:
    """A derived index with the data it was derived from, as one more variable."""
    return source.unionByName(derived)


def retained_manifest(rows: DataFrame, keys: Sequence[str], there: DataFrame | None = None, message: str = "") -> DataFrame:
    """A manifest row for each unit of retained source rows: skipped_existing where `there` has it, else saved."""
    units = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    if there is None:
        return units.withColumns({"status": F.lit("saved"), "message": F.lit(message)})
    held = units.join(there.select(*keys).distinct().withColumn("_there", F.lit(True)), list(keys), "left")
    return held.withColumns({"status": F.when(F.col("_there"), "skipped_existing").otherwise("saved"), "message": F.lit(message)}).drop("_there")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share: below spark.checkpoint.dir. On one machine, where that may be unset, the
    warehouse takes its place; on a cluster it must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


def settle(rows: DataFrame, name: str) -> DataFrame:
    """rows, written once and read again: for what several later steps use. The folder goes when the program ends."""
    spark = rows.sparkSession
    path = scratch(spark, name)
    rows.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(rows.schema).parquet(path)


def write_series(series: DataFrame, path: str, keys: Sequence[str], overwrite: bool = False) -> None:
    """CSV files, a folder for each combination of the keys."""
    write_units(series, path, keys, overwrite, "csv", {"header": True}, deal=keys)


def write_layers(layers: DataFrame, path: str, overwrite: bool = False) -> None:
    """One layer for each variable below by_variable, all of them in all_variables, and as a table of plain columns in
    all_variables_csv. The layers of a variable are the unit of output; the other two follow from what is written."""
    spark = layers.sparkSession
    write_units(layers, f"{path}/by_variable", ["variable"], overwrite)
    whole = spark.read.schema(layers.schema).parquet(f"{path}/by_variable").select(*layers.columns)
    whole.write.mode("overwrite").parquet(f"{path}/all_variables")
    plain = [f.name for f in layers.schema if not isinstance(f.dataType, ArrayType | MapType | StructType)]
    spark.read.schema(layers.schema).parquet(f"{path}/all_variables").select(*plain).write.mode("overwrite").option("header", True).csv(f"{path}/all_variables_csv")


#: The units of the flood tables.
FLOOD_UNITS = ("scenario", "horizon")


def write_flood(hazard: DataFrame, curves: DataFrame, root: str, overwrite: bool = False) -> None:
    """The hazard table as Parquet and CSV, and the runoff curves, by scenario and horizon; the CSV comes from the Parquet,
    not from a second run."""
    write_units(hazard, f"{root}/hazard", FLOOD_UNITS, overwrite)
    written = hazard.sparkSession.read.schema(hazard.schema).parquet(f"{root}/hazard")
    write_units(written, f"{root}/hazard_csv", FLOOD_UNITS, overwrite, "csv", {"header": True})
    write_units(curves, f"{root}/curves", FLOOD_UNITS, overwrite)
