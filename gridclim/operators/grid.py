"""Grids and pixels: corners, windows, axes, rasters and their points."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.functions.labels import round_even
from gridclim.operators.guards import some_rows
from gridclim.sources.store import settle

KEYS = ("variable", "scenario", "horizon", "domain", "source_feature")
#: What makes a raster's grid, and what makes a pixel: its place is nothing without the grid.
GRID = ("west", "north", "res")
PIXEL = ("px", "py", *GRID)


def keys_of(pixels: DataFrame, *more: str) -> list[str]:
    """The keys of rasters that the table has."""
    return [k for k in (*KEYS, *more) if k in pixels.columns]


def cell_corners(grid: DataFrame) -> DataFrame:
    """grid(domain, grid_row, grid_col, lon, lat), rows and columns from 0 and two of each at least -> domain, corner_row,
    corner_col, lon, lat: inner corners are means of four centres, outer ones go on in a straight line."""
    step = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
    each = grid.select("domain", "grid_row", "grid_col", "lon", "lat", step.alias("s"))
    mid = each.groupBy("domain", (F.col("grid_row") + F.col("s.i")).alias("r"), (F.col("grid_col") + F.col("s.j")).alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))
    size = grid.groupBy("domain").agg(F.max("grid_row").alias("rows"), F.max("grid_col").alias("cols"))
    held = mid.join(size, "domain").withColumns({"ir": F.greatest(F.lit(1), F.least("r", "rows")), "ic": F.greatest(F.lit(1), F.least("c", "cols"))})
    inner = mid.where("n = 4").select("domain", F.col("r").alias("ir"), F.col("c").alias("ic"), F.col("lon").alias("ilon"), F.col("lat").alias("ilat"))
    flat = held.where("n < 4").join(inner, ["domain", "ir", "ic"])
    edges = flat.where("n = 2").select("domain", "r", "c", *((2 * F.col(x) - F.col(f"i{x}")).alias(x) for x in ("lon", "lat")))
    beside = edges.select("domain", F.col("r").alias("er"), F.col("c").alias("ec"), F.col("lon").alias("elon"), F.col("lat").alias("elat"))
    two = F.explode(F.array(F.struct(F.col("r").alias("er"), F.col("ic").alias("ec")), F.struct(F.col("ir").alias("er"), F.col("c").alias("ec"))))
    ends = flat.where("n = 1").withColumn("_e", two).select("*", "_e.er", "_e.ec").join(beside, ["domain", "er", "ec"])
    outer = ends.groupBy("domain", "r", "c").agg(*((F.sum(f"e{x}") - F.first(f"i{x}")).alias(x) for x in ("lon", "lat")))
    done = mid.where("n = 4").drop("n").unionByName(edges).unionByName(outer)
    return done.withColumnsRenamed({"r": "corner_row", "c": "corner_col"})


def quads(corners: DataFrame) -> DataFrame:
    """domain, grid_row, grid_col, x0..x3, y0..y3 around each cell."""
    places = ((0, 0), (0, 1), (1, 1), (1, 0))
    around = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), F.lit(j).alias("j")) for k, (i, j) in enumerate(places))))
    each = corners.select("domain", "corner_row", "corner_col", "lon", "lat", around.alias("p"))
    at = lambda x, k: F.max(F.when(F.col("p.k") == k, F.col(x)))
    return each.groupBy("domain", (F.col("corner_row") - F.col("p.i")).alias("grid_row"), (F.col("corner_col") - F.col("p.j")).alias("grid_col")).agg(
        F.count(F.lit(1)).alias("_n"), *(at("lon", k).alias(f"x{k}") for k in range(4)), *(at("lat", k).alias(f"y{k}") for k in range(4))).where("_n = 4").drop("_n")


#: Side of the tiles by which cells and boxes are matched, in degrees, so that the join has an equality.
TILE = 0.5


def tiles(low: Column, high: Column, side: float) -> Column:
    """The numbers of all tiles that an interval meets."""
    return F.sequence(F.floor(low / side), F.floor(high / side))


def dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """rows in as many partitions as shuffles have. For joins and explosions that make many rows of each: adaptive execution would merge
    what is small before it grows, and leave the growth to one task."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(n, *columns)


def candidate_window(grid: DataFrame, boxes: DataFrame, tile: float = TILE) -> DataFrame:
    """boxes(feature_id, west, south, east, north) -> domain, feature_id, first and last row and column of the cells within the
    box and a margin of two cell spacings (0.05 at least), one more cell on each side; no cell at all is an error. Cells stand in the tiles that their own margin
    meets, boxes in all of theirs; only what shares a tile is compared."""
    across, down = W.partitionBy("domain", "grid_row").orderBy("grid_col"), W.partitionBy("domain", "grid_col").orderBy("grid_row")
    steps = grid.select("domain", F.abs(F.col("lon") - F.lag("lon").over(across)).alias("dx"), F.abs(F.col("lat") - F.lag("lat").over(down)).alias("dy"))
    pads = steps.groupBy("domain").agg(*(F.greatest(2 * F.median(s), F.lit(0.05)).alias(p) for s, p in (("dx", "pad_x"), ("dy", "pad_y"))))
    lon, lat, pad_x, pad_y = map(F.col, ("lon", "lat", "pad_x", "pad_y"))
    cells = grid.join(pads, "domain").withColumn("_tx", F.explode(tiles(lon - pad_x, lon + pad_x, tile))).withColumn("_ty", F.explode(tiles(lat - pad_y, lat + pad_y, tile)))
    placed = boxes.select("feature_id", "west", "south", "east", "north").withColumn("_tx", F.explode(tiles(F.col("west"), F.col("east"), tile))).withColumn("_ty", F.explode(tiles(F.col("south"), F.col("north"), tile)))
    near = cells.join(placed, ["_tx", "_ty"]).where(lon.between(F.col("west") - pad_x, F.col("east") + pad_x) & lat.between(F.col("south") - pad_y, F.col("north") + pad_y))
    found = near.groupBy("domain", "feature_id").agg(*(f(c).alias(n) for f, c, n in ((F.min, "grid_row", "row0"), (F.max, "grid_row", "row1"), (F.min, "grid_col", "col0"), (F.max, "grid_col", "col1"))))
    ends = grid.groupBy("domain").agg(F.max("grid_row").alias("rows"), F.max("grid_col").alias("cols"))
    zero = F.lit(0)
    done = found.join(ends, "domain").select("domain", "feature_id", F.greatest(zero, F.col("row0") - 1).alias("row0"), F.least("rows", F.col("row1") + 1).alias("row1"), F.greatest(zero, F.col("col0") - 1).alias("col0"), F.least("cols", F.col("col1") + 1).alias("col1"))
    return some_rows(done, "no cell of the grid is near any of the boxes; does its domain hold the study area?")


def _domain(table: DataFrame, *more: str) -> list[str]:
    """The domain, where the table has one, and more columns."""
    return [c for c in ("domain", *more) if c == "feature_id" or c in table.columns]


def crop_window(cells: DataFrame) -> DataFrame:
    """The rectangle of each feature's cells in each domain, every cell of it, and whether the cell itself was selected."""
    keys = _domain(cells, "feature_id")
    box = cells.groupBy(*keys).agg(F.min("grid_row").alias("r0"), F.max("grid_row").alias("r1"), F.min("grid_col").alias("c0"), F.max("grid_col").alias("c1"))
    full = box.select(*keys, F.explode(F.sequence("r0", "r1")).alias("grid_row"), "c0", "c1").select(*keys, "grid_row", F.explode(F.sequence("c0", "c1")).alias("grid_col"))
    chosen = cells.select(*keys, "grid_row", "grid_col").distinct().withColumn("selected", F.lit(True))
    return full.join(chosen, [*keys, "grid_row", "grid_col"], "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def full_grid_guard(cells: DataFrame, grid: DataFrame) -> DataFrame:
    """feature_id, cells, grid_cells and a status that tells features which wrongly take the whole grid; by domain where both tables
    have it."""
    shared = _domain(cells) if "domain" in grid.columns else []
    held = cells.groupBy(*shared, "feature_id").agg(F.count_distinct("grid_row", "grid_col").alias("cells"))
    total = grid.groupBy(*shared).agg(F.count(F.lit(1)).alias("grid_cells"))
    both = held.join(total, shared) if shared else held.crossJoin(total)  # one row
    return both.withColumn("status", F.when(F.col("cells") >= F.col("grid_cells"), "processing_error").otherwise("ok"))  # one row


def native_resolution(grid: DataFrame, fine_domain: str = "seaus_4km") -> DataFrame:
    """0.04 for the fine domain, else the absolute slope of each axis along its index, to two decimals."""
    slope = grid.groupBy("domain").agg(F.regr_slope("rlon", "grid_col").alias("x"), F.regr_slope("rlat", "grid_row").alias("y"))
    pick = lambda c: F.when(F.col("domain") == fine_domain, 0.04).otherwise(round_even(F.abs(c), 2))
    return slope.select("domain", pick(F.col("x")).alias("res_x"), pick(F.col("y")).alias("res_y"))


def regular_axis(axis: DataFrame) -> DataFrame:
    """axis(name, idx, coord) -> name, origin, step, and whether it is strictly monotonic and within a quarter step of a line."""
    w = W.partitionBy("name").orderBy("idx")
    fit = axis.groupBy("name").agg(F.regr_slope("coord", "idx").alias("step"), F.regr_intercept("coord", "idx").alias("origin"))
    seen = axis.withColumn("d", F.col("coord") - F.lag("coord").over(w)).join(fit, "name")
    off = F.max(F.abs(F.col("coord") - F.col("origin") - F.col("step") * F.col("idx"))) <= 0.25 * F.abs(F.first("step"))
    rising, falling = F.min("d") > 0, F.max("d") < 0
    return seen.groupBy("name").agg(F.first("origin").alias("origin"), F.first("step").alias("step"), ((rising | falling) & off).alias("regular"))


def rasterise(cells: DataFrame, quad: DataFrame, res: float, keys: tuple[str, ...] = ("variable",)) -> DataFrame:
    """cells(keys, [domain,] grid_row, grid_col, value) on curved quads -> keys, px, py, value, west, north, res: every pixel that a quad
    touches takes the value of the last touching cell in row order. The extent snaps outwards to the resolution. Where both tables have
    a domain, it is one of the keys, and each domain is a raster of its own."""
    xs, ys = [F.col(f"x{k}") for k in range(4)], [F.col(f"y{k}") for k in range(4)]
    shared = _domain(cells) if "domain" in quad.columns else []
    keys = tuple(dict.fromkeys((*keys, *shared)))
    held = settle(cells.where("value is not null").join(quad if shared else quad.drop("domain"), [*shared, "grid_row", "grid_col"]), "cells")
    extent = held.groupBy(*keys).agg((F.floor(F.min(F.least(*xs)) / res) * res).alias("west"), (F.ceil(F.max(F.greatest(*ys)) / res) * res).alias("north"))
    box = dealt(held, *keys, "grid_row", "grid_col").join(extent, list(keys)).withColumns({
        "px": F.explode(F.sequence(F.floor((F.least(*xs) - F.col("west")) / res), F.floor((F.greatest(*xs) - F.col("west")) / res))),
    }).withColumn("py", F.explode(F.sequence(F.floor((F.col("north") - F.greatest(*ys)) / res), F.floor((F.col("north") - F.least(*ys)) / res))))
    left, top = F.col("west") + F.col("px") * res, F.col("north") - F.col("py") * res
    touched = box.where(quad_touches_box(left, top - res, left + res, top))
    return touched.groupBy(*keys, "px", "py", "west", "north").agg(F.max_by("value", F.struct("grid_row", "grid_col")).alias("value")).withColumn("res", F.lit(res))


def quad_touches_box(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether the convex quad x0..x3, y0..y3 and a box meet: no axis of either separates them."""
    xs, ys = [F.col(f"x{k}") for k in range(4)], [F.col(f"y{k}") for k in range(4)]
    meets = (F.least(*xs) <= east) & (F.greatest(*xs) >= west) & (F.least(*ys) <= north) & (F.greatest(*ys) >= south)
    corners = ((west, south), (east, south), (east, north), (west, north))
    for k in range(4):
        nx, ny = ys[(k + 1) % 4] - ys[k], xs[k] - xs[(k + 1) % 4]
        quad = [nx * x + ny * y for x, y in zip(xs, ys)]
        box = [nx * x + ny * y for x, y in corners]
        meets = meets & (F.least(*quad) <= F.greatest(*box)) & (F.greatest(*quad) >= F.least(*box))
    return meets


def pixels_to_points(pixels: DataFrame) -> DataFrame:
    """Centres of the pixels that have a value."""
    half = F.lit(0.5)
    return pixels.where("value is not null and not isnan(value)").withColumns({
        "longitude": F.col("west") + (F.col("px") + half) * F.col("res"), "latitude": F.col("north") - (F.col("py") + half) * F.col("res"),
    })


def stats_to_points(pixels: DataFrame, stats: tuple[str, ...] = ("min", "mean", "max")) -> DataFrame:
    """One row for each pixel where any statistic has a value, a column for each statistic."""
    each = [F.max(F.when(F.col("stat") == s, F.col("value"))).alias(s) for s in stats]
    return pixels.groupBy(*keys_of(pixels), "px", "py").agg(*each).where(F.coalesce(*stats).isNotNull())


def alignment(rasters: DataFrame) -> DataFrame:
    """Per group, whether all rasters have one origin, resolution and size."""
    return rasters.groupBy(*keys_of(rasters)).agg((F.count_distinct("west", "north", "res", "width", "height") == 1).alias("aligned"))


def value_range(pixels: DataFrame, change: bool = False) -> DataFrame:
    """Smallest and largest value by variable; for change the same limit on both sides of zero."""
    found = pixels.groupBy("variable").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    limit = F.greatest(F.abs("low"), F.abs("high"))
    return found.select("variable", (-limit).alias("low"), limit.alias("high")) if change else found


def bilinear(source: DataFrame, target: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Values of source(keys, px, py, value, west, north, res) at the centres of target([keys,] px, py, west, north, res), weighed
    over the four pixels around; missing ones are left out of the weights, and without any the value is null.

    A source raster is known by its keys and its grid. Where the target has the keys too, only rasters of the same keys meet, else
    every raster is brought to every target pixel. The result has the keys, the target's pixel, and the source's grid as source_west,
    source_north and source_res.
    """
    own = {"west": "source_west", "north": "source_north", "res": "source_res"}
    rasters = source.select(*keys, *GRID).distinct().withColumnsRenamed(own)
    shared = [k for k in keys if k in target.columns]
    places = target.select(*shared, *PIXEL).distinct()
    placed = places.join(rasters, shared) if shared else places.crossJoin(rasters)  # rasters x target pixels: the result's own rows
    x = (F.col("west") + (F.col("px") + 0.5) * F.col("res") - F.col("source_west")) / F.col("source_res") - 0.5
    y = (F.col("source_north") - F.col("north") + (F.col("py") + 0.5) * F.col("res")) / F.col("source_res") - 0.5
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
    near = placed.withColumns({"_x": x, "_y": y}).withColumn("_s", around).withColumns({"_px": F.floor("_x") + F.col("_s.i"), "_py": F.floor("_y") + F.col("_s.j")})
    weight = (1 - F.abs(F.col("_x") - F.col("_px"))) * (1 - F.abs(F.col("_y") - F.col("_py")))
    values = source.where("value is not null and not isnan(value)").withColumnsRenamed(own | {"px": "_px", "py": "_py", "value": "_v"})
    joined = near.withColumn("_w", weight).join(values.select(*keys, *own.values(), "_px", "_py", "_v"), [*keys, *own.values(), "_px", "_py"], "left")
    weights = F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")))
    return joined.groupBy(*keys, *PIXEL, *own.values()).agg((F.sum(F.col("_w") * F.col("_v")) / F.nullif(weights, F.lit(0.0))).alias("value"))
