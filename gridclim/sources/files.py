"""Tables of file names: years, selection by window, and ensemble raster names."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed patterns. Years or full dates at the end of a name; months of six digits are not read.
YEARS = r"(?i)(?<!\d)(\d{4})(?:\d{4})?-(\d{4})(?:\d{4})?\.nc$"
RASTER = r"(?i)^(.+?)_(Min|Mean|Max)_(historical|ssp[0-9]+)_([0-9]{4})_([0-9]{4})(?:_(.+))?$"
OLD_RASTER = r"(?i)^(.+?)_(historical|ssp[0-9]+)_(.+)_(ID[0-9]+)_ensemble_(min|mean|max)$"


def with_year_range(names: DataFrame) -> DataFrame:
    """names(name, ...) with start_year and end_year, null where the name has none."""
    part = lambda k: F.regexp_extract("name", YEARS, k).try_cast("int")
    return names.withColumns({"start_year": part(1), "end_year": part(2)})


def select_for_window(files: DataFrame, start_year: int, end_year: int, keys: list[str]) -> DataFrame:
    """Files that overlap the years; where a key has none, its undated files."""
    hit = F.coalesce((F.col("start_year") <= end_year) & (F.col("end_year") >= start_year), F.lit(False))
    any_hit = F.max(hit).over(W.partitionBy(*keys))
    marked = files.withColumns({"_hit": hit, "_any": any_hit})
    return marked.where(F.col("_hit") | (~F.col("_any") & F.col("start_year").isNull())).drop("_hit", "_any")


def raster_inventory(names: DataFrame) -> DataFrame:
    """names(name, ...) of ensemble rasters with variable, scenario, horizon, source_feature and stat; the newer
    pattern before the older one. Names of change rasters and other names go."""
    new, old = (lambda k: F.regexp_extract("name", RASTER, k)), (lambda k: F.regexp_extract("name", OLD_RASTER, k))
    is_new = F.col("name").rlike(RASTER)
    pick = lambda a, b: F.when(is_new, a).otherwise(b)
    done = names.where(is_new | F.col("name").rlike(OLD_RASTER)).withColumns({
        "variable": pick(new(1), old(1)), "scenario": pick(new(3), old(2)), "horizon": pick(F.concat_ws("_", new(4), new(5)), old(3)),
        "source_feature": pick(F.coalesce(F.nullif(new(6), F.lit("")), F.lit("ID1")), old(4)), "stat": F.lower(pick(new(2), old(5))),
    })
    return done.where(~F.lower("variable").endswith("_change"))
