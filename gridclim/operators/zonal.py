"""Zonal and point statistics of pixels, and feature summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.functions.labels import round_even, round_output
from gridclim.operators.geometry import holding, tile_of, touching
from gridclim.operators.grid import GRID, PIXEL, keys_of
from gridclim.operators.temporal import mean


def pixel_quads(pixels: DataFrame) -> DataFrame:
    """Each place of a pixel once, as a quad. A place is known by its grid as well: px and py of two grids don't meet."""
    west, north, res = F.col("west") + F.col("px") * F.col("res"), F.col("north") - F.col("py") * F.col("res"), F.col("res")
    made = {"x0": west, "y0": north, "x1": west + res, "y1": north, "x2": west + res, "y2": north - res, "x3": west, "y3": north - res}
    return pixels.select(*PIXEL).distinct().withColumns(made)


def pixels_of(pixels: DataFrame, polygons: DataFrame, all_touched: bool = True) -> DataFrame:
    """feature_id, px, py and the pixel's grid: pixels that a polygon touches, or whose centre it holds. Tiles follow the finest of the
    rasters' resolutions, so that a pixel meets the edges near it alone, whatever the resolution is."""
    quads = pixel_quads(pixels)
    tile = tile_of(pixels.agg(F.min("res").alias("res")).first()["res"])
    if all_touched:
        return touching(quads, polygons, list(PIXEL), tile)
    return holding(quads.select(*PIXEL, ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y3")) / 2).alias("y")), polygons, list(PIXEL), tile)


def _finite(pixels: DataFrame) -> DataFrame:
    return pixels.where("value is not null and not isnan(value)")


def zonal_mean(pixels: DataFrame, polygons: DataFrame, all_touched: bool = True) -> DataFrame:
    """The unweighted mean of each polygon's pixels with a value, and their number; null and 0 where there are none. The rasters
    may lie on grids of their own."""
    keys = keys_of(pixels, "stat")
    held = pixels_of(pixels, polygons, all_touched).join(_finite(pixels).hint("merge"), list(PIXEL)).groupBy(*keys, "feature_id").agg(mean("value").alias("value"), F.count(F.lit(1)).alias("n_pixels"))
    every = pixels.select(*keys).distinct().crossJoin(polygons.select("feature_id"))  # groups x features: the result's own rows
    return every.join(held, [*keys, "feature_id"], "left").withColumn("n_pixels", F.coalesce("n_pixels", F.lit(0)))


def zonal_stats(pixels: DataFrame, polygons: DataFrame) -> DataFrame:
    """Mean, smallest and largest value and number of cells of each polygon, to one decimal."""
    valid = pixels_of(pixels, polygons).join(_finite(pixels).hint("merge"), list(PIXEL))
    return valid.groupBy("feature_id").agg(round_even(mean("value"), 1).alias("mean"), round_even(F.min("value"), 1).alias("min"), round_even(F.max("value"), 1).alias("max"), F.count(F.lit(1)).alias("valid_cells"))


def first_points(features: DataFrame) -> DataFrame:
    """features(feature_id, rings) of points -> feature_id, lon, lat; of several points the first counts."""
    first = F.get(F.get("rings", F.lit(0)), F.lit(0))
    return features.select("feature_id", first["x"].alias("lon"), first["y"].alias("lat"))


def sample_point(pixels: DataFrame, points: DataFrame) -> DataFrame:
    """points(feature_id, lon, lat) with the pixel's value at each point in every raster, null outside or without a value.

    A raster is a group of keys and statistic; its pixels bring their grid along, so that rasters may lie on different grids."""
    keys = keys_of(pixels, "stat")
    rasters = F.broadcast(pixels.select(*keys, *GRID).distinct())  # few, and points may be many
    placed = points.crossJoin(rasters).withColumns({  # rasters x points: the result's own rows
        "px": F.floor((F.col("lon") - F.col("west")) / F.col("res")).cast("int"), "py": F.floor((F.col("north") - F.col("lat")) / F.col("res")).cast("int"),
    })
    own = {c: f"_at_{c}" for c in (*keys, *PIXEL)}  # names of their own, as both sides come from one table
    values = pixels.select(*keys, *PIXEL, F.when(~F.isnan("value"), F.col("value")).alias("value")).withColumnsRenamed(own)
    same = [F.col(k).eqNullSafe(F.col(own[k])) for k in keys] + [F.col(k) == F.col(own[k]) for k in PIXEL]
    # pixels made of few columns seem small to the planner, which would bring all of them to the driver to broadcast them
    return placed.join(values.hint("merge"), same, "left").select(*points.columns, *keys, "value")


def feature_summary(values: DataFrame, variable: str = "variable") -> DataFrame:
    """values(keys, feature_id, stat, value[, n_pixels]) -> min, mean, max of each feature, rounded, and n_pixels: the largest
    number of pixels, or for points 1 if any value was found."""
    pick = lambda s: F.max(F.when(F.col("stat") == s, F.col("value")))
    count = F.max("n_pixels") if "n_pixels" in values.columns else F.max(F.col("value").isNotNull().cast("int"))
    made = values.groupBy(*keys_of(values), "feature_id").agg(*(pick(s).alias(s) for s in ("min", "mean", "max")), F.coalesce(count, F.lit(0)).cast("long").alias("n_pixels"))
    return made.withColumns({s: round_output(F.col(s), F.col(variable)) for s in ("min", "mean", "max")})
