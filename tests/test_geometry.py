"""Polygon, cell and raster operators against dense sampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridclim.operators import change, geometry, grid, zonal
from gridclim.plans import spatial
from gridclim.plans.workflows import w1_extraction


def rotated(spark, n=8):
    rows = [("d", r, c, 0.2 * c + 0.05 * r, 0.2 * r - 0.04 * c) for r in range(n) for c in range(n)]
    return spark.createDataFrame(rows, "domain string, grid_row int, grid_col int, lon double, lat double")


def polygon(spark, **rings):
    rows = [(k, [[{"x": x, "y": y} for x, y in r] for r in v]) for k, v in rings.items()]
    return spark.createDataFrame(rows, "feature_id string, rings array<array<struct<x: double, y: double>>>")


def inside(x, y, ring):
    hit = np.zeros(np.shape(x), bool)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if y1 != y2:
            hit ^= ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
    return hit


CONCAVE = [(0.1, 0.1), (1.2, 0.15), (1.1, 1.0), (0.7, 0.3), (0.2, 1.1)]
TINY = [(0.61, 0.4), (0.63, 0.4), (0.62, 0.42)]
FAR = [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0)]


def test_cells_that_a_polygon_meets(spark):
    cells = grid.quads(grid.cell_corners(rotated(spark)))
    got = {(r.feature_id, r.grid_row, r.grid_col) for r in geometry.cells_intersecting(cells, polygon(spark, concave=[CONCAVE], tiny=[TINY], far=[FAR])).collect()}
    want = set()
    u, v = np.meshgrid(np.linspace(0, 1, 60), np.linspace(0, 1, 60))
    for q in cells.collect():
        x = (1 - u) * (1 - v) * q.x0 + u * (1 - v) * q.x1 + u * v * q.x2 + (1 - u) * v * q.x3
        y = (1 - u) * (1 - v) * q.y0 + u * (1 - v) * q.y1 + u * v * q.y2 + (1 - u) * v * q.y3
        for name, ring in (("concave", CONCAVE), ("tiny", TINY)):
            if inside(x, y, ring).any():
                want.add((name, q.grid_row, q.grid_col))
    assert want <= got and not any(f == "far" for f, _, _ in got)
    assert len(got - want) <= 2  # what only touches may slip through the sample
    assert any(f == "tiny" for f, _, _ in got)


def test_corners_of_a_bent_grid(spark):
    n, m = 4, 5
    lon = np.array([[c + 0.1 * r * r for c in range(m)] for r in range(n)])
    lat = np.array([[r + 0.05 * c * c for c in range(m)] for r in range(n)])
    rows = [("d", r, c, float(lon[r, c]), float(lat[r, c])) for r in range(n) for c in range(m)]
    got = {(r.corner_row, r.corner_col): (r.lon, r.lat) for r in grid.cell_corners(spark.createDataFrame(rows, "domain string, grid_row int, grid_col int, lon double, lat double")).collect()}
    assert len(got) == (n + 1) * (m + 1)
    for k, a in enumerate((lon, lat)):
        mid = (a[1:, 1:] + a[1:, :-1] + a[:-1, 1:] + a[:-1, :-1]) / 4
        assert got[2, 2][k] == np.float64(mid[1, 1]) or abs(got[2, 2][k] - mid[1, 1]) < 1e-12
        top = a[0, 1] + a[0, 2] - mid[0, 1]
        assert abs(got[0, 2][k] - top) < 1e-12
        left, up = a[0, 0] + a[1, 0] - mid[0, 0], a[0, 0] + a[0, 1] - mid[0, 0]
        assert abs(got[0, 0][k] - (left + up - mid[0, 0])) < 1e-12


def test_raster_takes_every_touched_pixel_and_the_last_cell(spark):
    g = rotated(spark, 4)
    cells = g.select(F.lit("v").alias("variable"), "grid_row", "grid_col", (F.col("grid_row") * 10 + F.col("grid_col")).cast("double").alias("value"))
    quad = grid.quads(grid.cell_corners(g))
    res = 0.1
    got = {(r.px, r.py): r.value for r in grid.rasterise(cells, quad, res).collect()}
    west = min(min(q.x0, q.x1, q.x2, q.x3) for q in quad.collect())
    north = max(max(q.y0, q.y1, q.y2, q.y3) for q in quad.collect())
    west, north = np.floor(west / res) * res, np.ceil(north / res) * res
    want = {}
    u, v = np.meshgrid(np.linspace(0, 1, 400), np.linspace(0, 1, 400))
    for q in sorted(quad.collect(), key=lambda q: (q.grid_row, q.grid_col)):
        x = (1 - u) * (1 - v) * q.x0 + u * (1 - v) * q.x1 + u * v * q.x2 + (1 - u) * v * q.x3
        y = (1 - u) * (1 - v) * q.y0 + u * (1 - v) * q.y1 + u * v * q.y2 + (1 - u) * v * q.y3
        for p in set(zip(np.floor((x - west) / res).astype(int).ravel().tolist(), np.floor((north - y) / res).astype(int).ravel().tolist())):
            want[p] = float(q.grid_row * 10 + q.grid_col)
    assert set(want) <= set(got) and len(set(got) - set(want)) <= 6
    assert sum(got[p] != v for p, v in want.items()) <= 6


def test_domain_is_coarse_if_a_feature_reaches_out(spark):
    outline = polygon(spark, seaus_4km=[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]]).withColumnRenamed("feature_id", "domain")
    within = polygon(spark, a=[CONCAVE], edge=[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]])
    assert geometry.select_domain(within, outline).first().domain == "seaus_4km"
    both = within.unionByName(polygon(spark, far=[FAR]))
    assert tuple(geometry.select_domain(both, outline).first()) == ("aus_18", "outside: far")
    assert geometry.select_domain(both, outline, key="aus_18").first().reason == "requested"


def test_no_pixels_give_null_and_zero(spark):
    pixels = spark.createDataFrame([(0, 0, 1.0, 0.0, 1.0, 1.0), (1, 0, None, 0.0, 1.0, 1.0)], "px int, py int, value double, west double, north double, res double")
    got = {r.feature_id: (r.value, r.n_pixels) for r in zonal.zonal_mean(pixels.withColumn("variable", F.lit("v")), polygon(spark, far=[FAR], near=[[(0.2, 0.2), (1.5, 0.2), (1.5, 0.8)]])).collect()}
    assert got == {"far": (None, 0), "near": (1.0, 1)}


PIXEL_SCHEMA = "variable string, px int, py int, value double, west double, north double, res double"


def two_rasters(spark):
    """Two rasters of four pixels by four whose places agree and whose grids lie 100 degrees apart."""
    rows = [(v, x, y, value, west, 4.0, 1.0) for v, value, west in (("a", 1.0, 0.0), ("b", 50.0, 100.0)) for x in range(4) for y in range(4)]
    return spark.createDataFrame(rows, PIXEL_SCHEMA)


def test_rasters_of_two_grids_do_not_mix(spark):
    pixels = two_rasters(spark)
    whole = polygon(spark, one=[[(-0.5, -0.5), (4.5, -0.5), (4.5, 4.5), (-0.5, 4.5)]])
    for all_touched in (True, False):
        got = {(r.variable, r.feature_id): (r.value, r.n_pixels) for r in zonal.zonal_mean(pixels, whole, all_touched).collect()}
        assert got == {("a", "one"): (1.0, 16), ("b", "one"): (None, 0)}
    stats = zonal.zonal_stats(pixels, whole).first()
    assert (stats["mean"], stats["max"], stats.valid_cells) == (1.0, 1.0, 16)
    points = spark.createDataFrame([("p", 0.5, 3.5), ("q", 101.5, 0.5), ("r", 50.0, 50.0)], "feature_id string, lon double, lat double")
    got = {(r.feature_id, r.variable): r.value for r in zonal.sample_point(pixels, points).collect()}
    assert got == {("p", "a"): 1.0, ("p", "b"): None, ("q", "a"): None, ("q", "b"): 50.0, ("r", "a"): None, ("r", "b"): None}
    target = spark.createDataFrame([(0, 0, 1.2, 3.2, 0.5), (0, 0, 300.0, 3.0, 0.5)], "px int, py int, west double, north double, res double")
    for keys in ((), ("variable",)):
        got = {(r.west, r.source_west): r.value for r in grid.bilinear(pixels, target, keys).collect()}
        assert got == {(1.2, 0.0): pytest.approx(1.0), (1.2, 100.0): None, (300.0, 0.0): None, (300.0, 100.0): None}


def test_points_in_polygons_by_tiles(spark):
    rng = np.random.default_rng(3)
    shapes = {f"s{k}": [[(float(cx + r * np.cos(t)), float(cy + r * np.sin(t))) for t, r in zip(np.sort(rng.uniform(0, 2 * np.pi, 12)), rng.uniform(0.1, 1.5, 12))]] for k, (cx, cy) in enumerate(rng.uniform(-2, 2, (6, 2)))}
    shapes["s0"].append([(x * 0.3, y * 0.3) for x, y in shapes["s0"][0]])  # a second ring: a hole where they overlap
    shapes["square"] = [[(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]]  # its corners are corners of tiles
    xy = rng.uniform(-4, 4, (4000, 2))
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "i int, x double, y double")
    got = {(r.feature_id, r.i) for r in geometry.holding(points, polygon(spark, **shapes), ["i"]).collect()}
    want = {(name, i) for name, rings in shapes.items() for i in np.flatnonzero(np.logical_xor.reduce([inside(xy[:, 0], xy[:, 1], list(r)) for r in rings])).tolist()}
    assert got == want and len(want) > 500


def test_nearest_cells_near_and_far(spark):
    rng = np.random.default_rng(4)
    cells = [(d, r, c, float(base + 0.1 * c + 0.02 * r), float(-30 + 0.1 * r - 0.01 * c)) for d, base in (("a", 140.0), ("b", 150.0)) for r in range(20) for c in range(20)]
    cells.append(("a", 99, 99, float("nan"), -30.0))
    g = spark.createDataFrame(cells, "domain string, grid_row int, grid_col int, lon double, lat double")
    xy = np.concatenate([rng.uniform((139, -31), (153, -27), (150, 2)), rng.uniform((-170, -80), (179, 80), (60, 2)), [(140.05, -30.0)]])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "feature_id int, lon double, lat double")
    got = {(r.feature_id, r.domain): (r.grid_row, r.grid_col) for r in geometry.nearest_cell(g, points).collect()}
    for d in "ab":
        own = [c for c in cells if c[0] == d and c[3] == c[3]]
        lon, lat = np.array([c[3] for c in own]), np.array([c[4] for c in own])
        for i, (x, y) in enumerate(xy):
            dist = ((lon - x) * np.cos(np.radians(y))) ** 2 + (lat - y) ** 2
            assert dist[[c[1:3] for c in own].index(got[i, d])] <= dist.min() * (1 + 1e-12)
    assert len(got) == 2 * len(xy)


def test_points_inside_shapes(spark):
    rows = polygon(spark, concave=[CONCAVE], ring=[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (2.5, 1.0), (2.5, 3.0), (1.0, 3.0)]], point=[[(7.0, 8.0)]])
    got = {r.feature_id: (r.lon, r.lat) for r in geometry.inner_points(rows).collect()}
    assert got["point"] == (7.0, 8.0) and got["ring"] == (3.25, 2.0)
    assert inside(*got["concave"], CONCAVE)


def test_baseline_on_another_grid(spark):
    rows = [("SPI12", s, h, f, stat, x, y, value + x + 10 * y, west, 4.0, 1.0) for s, h, f, stat, value, west in (
        ("historical", "baseline", "ID1", "mean", 0.0, 0.25), ("ssp245", "mid", "ID1", "mean", 5.0, 0.0), ("ssp245", "mid", "ID1", "max", 5.0, 0.0), ("ssp245", "mid", "ID2", "mean", 5.0, 0.0)) for x in range(4) for y in range(4)]
    pixels = spark.createDataFrame(rows, "variable string, scenario string, horizon string, source_feature string, stat string, px int, py int, value double, west double, north double, res double")
    got = change.spi_change(pixels).collect()
    assert {(r.source_feature, r.stat) for r in got} == {("ID1", "mean")} and len(got) == 16
    assert {r.value for r in got if r.px > 0} == {5.25} and {r.value for r in got if r.px == 0} == {5.0}  # at the rim the baseline has one neighbour


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_spatial_joins_have_equalities(spark):
    """With broadcasting off no spatial join becomes a nested loop or a cartesian product."""
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = spatial.pixels(spark, sf)
        frames = [spatial.QUERIES[n](spark, sf) for n in ("g2_candidate_window", "g3_cells_intersecting", "g4_nearest_cell", "g5_extract", "g8_select_domain")]
        frames += [zonal.pixels_of(own, spatial.polygons(spark, sf), x) for x in (True, False)]
        for frame in frames:
            assert "NestedLoop" not in plan_of(frame) and "Cartesian" not in plan_of(frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_whole_raster_is_regridded(spark):
    sf = "/root/testdata/sf0.001"
    source = spatial.pixels(spark, sf).where("stat = 'mean' and scenario = 'ssp245'").toPandas()
    have = {(r.px, r.py): r.value for r in source.itertuples() if not np.isnan(r.value)}
    want = {}
    for px, py in {(2 * r.px + i, 2 * r.py + j) for r in source.itertuples() for i in (0, 1) for j in (0, 1)}:
        x, y = (0.003 + (px + 0.5) * 0.01) / 0.02 - 0.5, (0.003 + (py + 0.5) * 0.01) / 0.02 - 0.5
        x0, y0 = int(np.floor(x)), int(np.floor(y))
        near = [((1 - abs(x - a)) * (1 - abs(y - b)), have[a, b]) for a in (x0, x0 + 1) for b in (y0, y0 + 1) if (a, b) in have]
        want[px, py] = sum(w * v for w, v in near) / sum(w for w, _ in near) if near else None
    got = {(r.px, r.py): r.value for r in spatial.g18_bilinear_regrid(spark, sf).where("scenario = 'ssp245'").collect()}
    assert got.keys() == want.keys() and max(py for _, py in got) >= 2 * source.py.max()
    assert all(got[k] == (want[k] if want[k] is None else pytest.approx(want[k], abs=1e-6)) for k in want)


@pytest.mark.parametrize("res", [0.02, 0.002])
def test_pairs_grow_with_the_outline(spark, res):
    """Of a polygon a hundred pixels wide, about as many pixels meet an edge of their tile at any resolution."""
    side = 100 * res
    corners = [(0.0011, 0.0013), (side, 0.0013), (side * 0.7, side * 0.4), (side, side), (0.0011, side)]
    shape = spark.createDataFrame([("f", [[{"x": 140 + x, "y": -35 + y} for x, y in corners]])], "feature_id string, rings array<array<struct<x: double, y: double>>>")
    pixels = spark.range(120 * 120).select((F.col("id") % 120).cast("int").alias("px"), F.floor(F.col("id") / 120).cast("int").alias("py"), F.lit(140.0).alias("west"), F.lit(-35 + 120 * res).alias("north"), F.lit(res).alias("res"))
    tile = geometry.tile_of(res)
    quads = zonal.pixel_quads(pixels)
    placed = quads.select(F.explode(grid.tiles(F.col("x0"), F.col("x1"), tile)).alias("tx"), "y0", "y3").select("tx", F.explode(grid.tiles(F.col("y3"), F.col("y0"), tile)).alias("ty"))
    pairs = placed.join(geometry.edge_tiles(geometry.edges(shape), tile), ["tx", "ty"]).count()
    assert pairs < 100 * 5 * 30  # the outline is about five sides of a hundred pixels
    assert sorted(zonal.pixels_of(pixels, shape).select("px", "py").collect()) == sorted(geometry.touching(quads, shape, ["px", "py"], 0.25).select("px", "py").collect())
    assert sorted(zonal.pixels_of(pixels, shape, False).select("px", "py").collect()) == sorted(geometry.holding(quads.select("px", "py", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y3")) / 2).alias("y")), shape, ["px", "py"], 0.25).select("px", "py").collect())


def test_sampled_pixels_are_not_broadcast(spark):
    """Small as the customers' file is, its pixels don't go through the driver."""
    frame = spatial.g17_sample_point(spark, "/root/testdata/sf0.001")
    joins = [line for line in plan_of(frame).splitlines() if "Join" in line]
    assert any("SortMergeJoin" in line for line in joins) and not any("BroadcastHashJoin" in line for line in joins)


def test_observations_are_counted_before_they_meet_features(spark):
    values = spark.createDataFrame([(0, k % 2, 1990 + k % 2, float(k)) for k in range(1000)], "grid_row int, grid_col int, year int, value double")
    chosen = spark.createDataFrame([(0, k % 2, f"f{k}", "nearest") for k in range(100)], "grid_row int, grid_col int, feature_id string, method string")
    done = geometry.extract_totals(values, chosen, "feature_id", "year", "n_cells")
    want = geometry.extract(values, chosen).groupBy("feature_id", "year", "n_cells").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"))
    assert sorted(done.collect()) == sorted(want.collect()) and done.count() == 100
    by_cell = "HashAggregate(keys=[grid_row"
    assert by_cell in plan_of(done) and by_cell not in plan_of(want)


def test_registered_extractions_count_first(spark):
    sf = "/root/testdata/sf0.001"
    for name, query in (("g5_extract", spatial.g5_extract), ("g5_extract_two_domains", spatial.g5_extract_two_domains), ("w1_extraction", w1_extraction)):
        lines = plan_of(query(spark, sf)).splitlines()
        cells = [line for line in lines if "HashAggregate" in line and "grid_row" in line and "feature_id" not in line and "sum(value" in line]
        assert cells, name


def test_pixels_meet_polygons_without_a_broadcast(spark):
    own = spatial.pixels(spark, "/root/testdata/sf0.001")
    for all_touched in (True, False):
        assert "BroadcastHashJoin" not in plan_of(zonal.pixels_of(own, spatial.polygons(spark, "/root/testdata/sf0.001"), all_touched))
