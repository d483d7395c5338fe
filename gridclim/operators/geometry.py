"""Polygons, points and cells: which meet, which is nearest, which domain covers what. Polygons are rings of edges.

Shapes meet edges by tiles in both directions, an equality join: a cell is compared with the edges in its own tiles alone. Whether a
polygon holds a point is known at the corners of tiles from the polygon's crossings of the tiles' lower lines, row by row, and
from there on by the edges of the point's tile.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.operators.grid import dealt, tiles
from gridclim.operators.guards import unless
from gridclim.sources.store import settle

#: Side of the tiles by which shapes and edges are matched, in degrees, where nothing is known of the shapes.
TILE = 0.25
#: What floor() may be wrong by where an edge runs along a tile's border; such an edge stands in both tiles.
SLACK = 1e-9
#: Sides of the tiles in which cells are searched for the nearest, each eight times the next; all numbers are exact in binary.
SEARCH = (64.0, 8.0, 1.0, 0.125)


def tile_of(size: float | None) -> float:
    """The side of tiles for shapes of such a size: the next power of two, which is exact, at twice the size. With larger tiles each
    shape would meet the edges of many that lie far off; with smaller ones it would stand in many tiles."""
    return 2.0 ** math.ceil(math.log2(2 * size)) if size else TILE


def edges(features: DataFrame) -> DataFrame:
    """features(feature_id, rings array<array<struct<x, y>>>) -> feature_id, ax, ay, bx, by; open rings are closed."""
    rings = features.select("feature_id", F.explode("rings").alias("ring"))
    ring = F.col("ring")
    pairs = F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    return rings.select("feature_id", F.explode(pairs).alias("e")).select("feature_id", "e.*").where("ax <> bx or ay <> by")


def boxes(features: DataFrame) -> DataFrame:
    """feature_id, west, south, east, north."""
    points = F.flatten("rings")
    side = lambda f, axis: f(F.transform(points, lambda p: p[axis]))
    return features.select("feature_id", side(F.array_min, "x").alias("west"), side(F.array_min, "y").alias("south"), side(F.array_max, "x").alias("east"), side(F.array_max, "y").alias("north"))


def _turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segments_meet(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether two closed segments (x1, y1, x2, y2) share a point."""
    d1, d2 = _turn(*a, b[0], b[1]), _turn(*a, b[2], b[3])
    d3, d4 = _turn(*b, a[0], a[1]), _turn(*b, a[2], a[3])
    boxes_meet = (F.least(a[0], a[2]) <= F.greatest(b[0], b[2])) & (F.least(b[0], b[2]) <= F.greatest(a[0], a[2])) & (F.least(a[1], a[3]) <= F.greatest(b[1], b[3])) & (F.least(b[1], b[3]) <= F.greatest(a[1], a[3]))
    return boxes_meet & (d1 * d2 <= 0) & (d3 * d4 <= 0)


def ray_crosses(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether a ray from the point to the east crosses the edge."""
    spans = (y1 > py) != (y2 > py)
    return spans & (px < x1 + (py - y1) * (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0)))


def point_in_quad(px: Column, py: Column) -> Column:
    """Whether a point lies in the convex quad x0..x3, y0..y3, its border included."""
    turns = [_turn(F.col(f"x{k}"), F.col(f"y{k}"), F.col(f"x{(k + 1) % 4}"), F.col(f"y{(k + 1) % 4}"), px, py) for k in range(4)]
    return (F.least(*turns) >= 0) | (F.greatest(*turns) <= 0)


def edge_tiles(edge: DataFrame, tile: float = TILE) -> DataFrame:
    """edge(..., ax, ay, bx, by) with tx, ty: a row for each tile that the edge runs through, found row by row of tiles."""
    ax, ay, bx, by = map(F.col, ("ax", "ay", "bx", "by"))
    rows = edge.withColumn("ty", F.explode(tiles(F.least(ay, by) - SLACK, F.greatest(ay, by) + SLACK, tile)))
    low, high = F.col("ty") * tile, (F.col("ty") + 1) * tile
    at = lambda y: F.when(by == ay, ax).otherwise(ax + (F.least(F.greatest(y, F.least(ay, by)), F.greatest(ay, by)) - ay) / F.nullif(by - ay, F.lit(0.0)) * (bx - ax))
    flat = by == ay
    x0, x1 = F.when(flat, ax).otherwise(at(low)), F.when(flat, bx).otherwise(at(high))
    return rows.withColumn("tx", F.explode(tiles(F.least(x0, x1) - SLACK, F.greatest(x0, x1) + SLACK, tile)))


def inner_corners(edge: DataFrame, tile: float = TILE) -> DataFrame:
    """edge(feature_id, ...) -> feature_id, tx, ty of the tiles whose lower left corner the feature holds. A line along the lower
    side of a row of tiles crosses the feature's edges; a corner with an odd number of crossings to the east is inside."""
    ax, ay, bx, by = map(F.col, ("ax", "ay", "bx", "by"))
    line = edge.withColumn("ty", F.explode(tiles(F.least(ay, by), F.greatest(ay, by), tile))).withColumn("_y", F.col("ty") * tile)
    crossed = line.where((ay > F.col("_y")) != (by > F.col("_y"))).withColumn("_x", ax + (F.col("_y") - ay) * (bx - ax) / (by - ay))
    # the last corner that the crossing lies to the east of
    counts = crossed.groupBy("feature_id", "ty", (F.ceil(F.col("_x") / tile) - 1).alias("last")).agg(F.count(F.lit(1)).alias("n"))
    row = W.partitionBy("feature_id", "ty").orderBy("last")
    runs = counts.withColumns({
        "before": F.lag("last").over(row), "east": F.sum("n").over(W.partitionBy("feature_id", "ty").orderBy(F.desc("last"))),
    }).where("before is not null and east % 2 = 1")
    return runs.select("feature_id", F.explode(F.sequence(F.col("before") + 1, F.col("last"))).alias("tx"), "ty")


def holding(points: DataFrame, features: DataFrame, keys: list[str], tile: float = TILE) -> DataFrame:
    """points(keys, x, y) x polygons -> keys, feature_id of the polygons that hold each point, by even and odd crossings.

    From the corner of its tile, whose side is known, the way to a point runs along the tile's lower side, then upwards; every
    edge that it crosses lies in the tile."""
    edge = edges(features)
    x, y, tx, ty = map(F.col, ("x", "y", "tx", "ty"))
    placed = points.select(*dict.fromkeys([*keys, "x", "y"]), F.floor(x / tile).alias("tx"), F.floor(y / tile).alias("ty"))
    left, low = tx * tile, ty * tile
    ax, ay, bx, by = map(F.col, ("ax", "ay", "bx", "by"))
    cross_x = ax + (low - ay) * (bx - ax) / F.nullif(by - ay, F.lit(0.0))
    along = ((ay > low) != (by > low)) & (cross_x > left) & (cross_x <= x)
    cross_y = ay + (x - ax) * (by - ay) / F.nullif(bx - ax, F.lit(0.0))
    # whether the edge passes x above the tile's lower side is told from where it crosses that side, as for the corner: a place on the edge
    # itself must be on one side of it for both legs
    spans, rising = (ay > low) != (by > low), (by - ay) * (bx - ax) > 0
    above = F.when(spans, F.when(rising, cross_x <= x).otherwise(cross_x > x)).otherwise(ay > low)
    upwards = ((ax > x) != (bx > x)) & above & (cross_y <= y)
    # merged, and with the points on the right: they may seem small to the planner, which would broadcast them through the driver, and of one
    # tile they are few, while features lie upon one another in any number
    placed = dealt(placed, "tx", "ty").hint("merge")
    near = dealt(edge_tiles(edge, tile), "tx", "ty").join(placed, ["tx", "ty"]).where(along != upwards)  # crossed on both legs: twice, or not at all
    inner = dealt(inner_corners(edge, tile), "tx", "ty").join(placed, ["tx", "ty"])
    return near.select(*keys, "feature_id").unionByName(inner.select(*keys, "feature_id")).groupBy(*keys, "feature_id").agg(F.count(F.lit(1)).alias("_n")).where("_n % 2 = 1").drop("_n")


def touching(shapes: DataFrame, features: DataFrame, keys: list[str], tile: float = TILE) -> DataFrame:
    """shapes(keys, x0..x3, y0..y3: convex quads) x polygons -> keys, feature_id of those that meet or touch.

    A shape meets if an edge of its own tiles meets a side or begins in it, or if the polygon holds its corner.
    """
    xs, ys = [F.col(f"x{k}") for k in range(4)], [F.col(f"y{k}") for k in range(4)]
    known = ~F.isnan(sum(xs + ys[1:], ys[0]))  # a shape without all its corners is left out
    shapes = shapes.where(known)
    placed = shapes.select(*keys, *xs, *ys).withColumn("tx", F.explode(tiles(F.least(*xs) - SLACK, F.greatest(*xs) + SLACK, tile))).withColumn("ty", F.explode(tiles(F.least(*ys) - SLACK, F.greatest(*ys) + SLACK, tile)))
    edge = tuple(map(F.col, ("ax", "ay", "bx", "by")))
    meets = point_in_quad(edge[0], edge[1])
    for k in range(4):
        j = (k + 1) % 4
        meets = meets | segments_meet(edge, (xs[k], ys[k], xs[j], ys[j]))
    met = dealt(edge_tiles(edges(features), tile), "tx", "ty").join(dealt(placed, "tx", "ty").hint("merge"), ["tx", "ty"]).where(meets).select(*keys, "feature_id")
    held = holding(shapes.select(*keys, xs[0].alias("x"), ys[0].alias("y")), features, keys, tile)
    return met.unionByName(held).distinct()


def cells_intersecting(quads: DataFrame, features: DataFrame) -> DataFrame:
    """Cells of the grid that each polygon meets or touches: domain, grid_row, grid_col, feature_id. Tiles are made for the cells' size."""
    quads = settle(quads, "quads")
    xs = [F.col(f"x{k}") for k in range(4)]
    size = quads.where(~F.isnan(sum(xs[1:], xs[0]))).agg(F.avg(F.greatest(*xs) - F.least(*xs)).alias("size")).first()["size"]
    return touching(quads, features, ["domain", "grid_row", "grid_col"], tile_of(size))


def inner_points(features: DataFrame) -> DataFrame:
    """feature_id, lon, lat of a point of each feature: a point itself, and for polygons the middle of the widest stretch inside them
    on the line halfway up."""
    line = boxes(features).select("feature_id", ((F.col("south") + F.col("north")) / 2).alias("_y"))
    ax, ay, bx, by, y = map(F.col, ("ax", "ay", "bx", "by", "_y"))
    crossed = edges(features).join(line, "feature_id").where((ay > y) != (by > y)).select("feature_id", "_y", (ax + (y - ay) * (bx - ax) / (by - ay)).alias("_x"))
    order = W.partitionBy("feature_id").orderBy("_x")
    # every second crossing leads inside
    stretch = crossed.withColumns({"_k": F.row_number().over(order), "_end": F.lead("_x").over(order)}).where("_k % 2 = 1")
    middle = stretch.groupBy("feature_id").agg(F.max_by(F.struct(((F.col("_x") + F.col("_end")) / 2).alias("lon"), F.col("_y").alias("lat")), F.struct(F.col("_end") - F.col("_x"), -F.col("_x"))).alias("_m"))
    first = F.get(F.get("rings", F.lit(0)), F.lit(0))
    return features.join(middle, "feature_id", "left").select("feature_id", F.coalesce("_m.lon", first["x"]).alias("lon"), F.coalesce("_m.lat", first["y"]).alias("lat"))


def nearest_cell(grid: DataFrame, points: DataFrame) -> DataFrame:
    """points(feature_id, lon, lat) -> feature_id, domain, grid_row, grid_col of the nearest centre in each domain; ties go to the
    first row, then column.

    Cells stand in tiles within larger tiles, each with the box of its cells. From the largest tiles down, a point goes on with
    those whose box can be nearer than the farthest corner of the best one: few tiles, wherever the point lies.
    """
    p = points.select("feature_id", F.col("lon").alias("plon"), F.col("lat").alias("plat"))
    cells = grid.where("lon is not null and lat is not null and not isnan(lon) and not isnan(lat)").select("domain", "grid_row", "grid_col", "lon", "lat")
    number = lambda side: [F.floor(F.col(c) / side).alias(t) for c, t in (("lon", "tx"), ("lat", "ty"))]
    box = [f(c).alias(n) for f, c, n in ((F.min, "lon", "w"), (F.max, "lon", "e"), (F.min, "lat", "s"), (F.max, "lat", "n"))]
    scale = F.cos(F.radians("plat"))

    def squared(dx: Column, dy: Column) -> Column:
        return (dx * scale) * (dx * scale) + dy * dy

    far = squared(F.greatest(F.abs(F.col("plon") - F.col("w")), F.abs(F.col("plon") - F.col("e"))), F.greatest(F.abs(F.col("plat") - F.col("s")), F.abs(F.col("plat") - F.col("n"))))
    outside = lambda at, low, high: F.greatest(F.lit(0.0), F.col(low) - F.col(at), F.col(at) - F.col(high))
    near = squared(outside("plon", "w", "e"), outside("plat", "s", "n"))
    # the largest tiles of the globe are few, and the same whatever the grid is
    held = p.withColumn("tx", F.explode(F.sequence(F.lit(-3), F.lit(5)))).withColumn("ty", F.explode(F.sequence(F.lit(-2), F.lit(1))))
    keys = ["tx", "ty"]
    for side, below in zip(SEARCH, (*SEARCH[1:], None)):
        level = cells.groupBy("domain", *number(side)).agg(*box)
        met = held.join(level, keys).withColumns({"_near": near, "_far": far})
        best = met.withColumn("_best", F.min("_far").over(W.partitionBy("feature_id", "domain"))).where("_near <= _best")
        held = best.select("feature_id", "plon", "plat", "domain", "tx", "ty")
        keys = ["domain", "tx", "ty"]
        if below is not None:  # on to the tiles within
            inner = [F.explode(F.sequence(F.col(t) * 8, F.col(t) * 8 + 7)).alias(t) for t in ("tx", "ty")]
            held = held.select("feature_id", "plon", "plat", "domain", inner[0], "ty").select("feature_id", "plon", "plat", "domain", "tx", inner[1])
    dx, dy = F.col("lon") - F.col("plon"), F.col("lat") - F.col("plat")
    found = held.join(cells.select("*", *number(SEARCH[-1])), keys)
    cell = F.min_by(F.struct("grid_row", "grid_col"), F.struct(squared(dx, dy).alias("d"), "grid_row", "grid_col"))
    return found.groupBy("feature_id", "domain").agg(cell.alias("cell")).select("feature_id", "domain", "cell.grid_row", "cell.grid_col")


def extract(obs: DataFrame, cell_feature: DataFrame) -> DataFrame:
    """obs rows of each feature's cells, with how the cells were found and how many there are in the domain. A row and a column are
    nothing without their domain; a table that has none is of the one domain that the other has."""
    domain = ["domain"] if "domain" in cell_feature.columns else []
    counts = cell_feature.groupBy(*domain, "feature_id").agg(F.count(F.lit(1)).alias("n_cells"))
    chosen = cell_feature.join(counts, [*domain, "feature_id"])
    shared = [c for c in domain if c in obs.columns]
    found = obs.drop("feature_id").join(chosen.select(*shared, "feature_id", "grid_row", "grid_col", "method", "n_cells"), [*shared, "grid_row", "grid_col"])
    if domain and not shared:  # obs are of one domain
        ends = cell_feature.agg(F.min("domain").alias("first"), F.max("domain").alias("last"))
        found = unless(found, ends, F.col("first") != F.col("last"), "cells of several domains meet observations without a domain")
    return found


def extract_totals(obs: DataFrame, cell_feature: DataFrame, *by: str) -> DataFrame:
    """The rows of extract() by the columns `by`: n_rows, how many there are, and total, the sum of their values, null without any.
    Observations are counted by cell before they meet features, so that the work is one look at them and one at the features, not
    at their product."""
    place = [c for c in ("domain", "grid_row", "grid_col") if c in obs.columns]
    own = [c for c in by if c in obs.columns and c not in {*place, "feature_id"}]
    counted = obs.groupBy(*place, *own).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"))
    return extract(counted, cell_feature).groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total"))


def select_domain(features: DataFrame, footprints: DataFrame, key: str = "auto", fine: str = "seaus_4km", coarse: str = "aus_18") -> DataFrame:
    """features x footprints(domain, rings) -> domain, reason. An explicit key is taken; auto takes the fine domain only if
    its footprint covers all vertices of all features, its border included, and none of its edges cuts one of theirs."""
    if key != "auto":
        return features.sparkSession.createDataFrame([(key, "requested")], "domain string, reason string")
    outline = footprints.where(F.col("domain") == fine).select(F.col("domain").alias("feature_id"), "rings")
    lines = edges(features)
    sides = edges(outline).drop("feature_id").toDF("ox1", "oy1", "ox2", "oy2")
    vertices = lines.select("feature_id", F.col("ax").alias("x"), F.col("ay").alias("y")).distinct()
    inside = holding(vertices.withColumnRenamed("feature_id", "_id"), outline, ["_id", "x", "y"]).select(F.col("_id").alias("feature_id"), "x", "y")
    # by tiles: which edges the outline cuts, and which vertices lie on it
    of_sides = edge_tiles(sides.toDF("ax", "ay", "bx", "by")).toDF("ox1", "oy1", "ox2", "oy2", "ty", "tx")
    met = edge_tiles(lines).join(of_sides, ["tx", "ty"])
    px, py = F.col("ax"), F.col("ay")
    a, o = tuple(map(F.col, ("ax", "ay", "bx", "by"))), tuple(map(F.col, ("ox1", "oy1", "ox2", "oy2")))
    on_border = (_turn(*o, px, py) == 0) & px.between(F.least("ox1", "ox2"), F.greatest("ox1", "ox2")) & py.between(F.least("oy1", "oy2"), F.greatest("oy1", "oy2"))
    cuts = (_turn(*a, o[0], o[1]) * _turn(*a, o[2], o[3]) < 0) & (_turn(*o, a[0], a[1]) * _turn(*o, a[2], a[3]) < 0)
    border = met.where(on_border).select("feature_id", px.alias("x"), py.alias("y"))
    held = inside.unionByName(border).distinct().withColumn("_in", F.lit(True))
    seen = vertices.join(held, ["feature_id", "x", "y"], "left").select("feature_id", F.coalesce("_in", F.lit(False)).alias("ok"))
    covered = seen.unionByName(met.where(cuts).select("feature_id", F.lit(False).alias("ok"))).groupBy("feature_id").agg(F.min("ok").alias("covered"))
    # the first ten ids, those outside before the others, tell both whether all are covered and which ones to name
    first = covered.orderBy("covered", "feature_id").limit(10)
    done = first.agg(F.min("covered").alias("all_in"), F.array_join(F.array_sort(F.collect_list(F.when(~F.col("covered"), F.col("feature_id")))), ", ").alias("ids"))
    return done.select(
        F.when(F.col("all_in"), fine).otherwise(coarse).alias("domain"),
        F.when(F.col("all_in"), "all features are covered").otherwise(F.concat(F.lit("outside: "), "ids")).alias("reason"))
