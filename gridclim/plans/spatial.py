"""Queries on grids, polygons, pixels and feature summaries, with SQL for the same rows."""

from pyspark.sql import functions as F

from gridclim.operators import change, geometry, grid, zonal
from gridclim.plans import proxy
from gridclim.plans.proxy import OBS

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def cells(spark, sf):
    """Nations as a slightly skewed grid of five by five."""
    row, col = F.floor(F.col("n_nationkey") / 5).cast("int"), (F.col("n_nationkey") % 5).cast("int")
    made = proxy.table(spark, sf, "nation").select(F.when(F.col("n_nationkey").isNotNull(), "aus_18").alias("domain"), row.alias("grid_row"), col.alias("grid_col"))
    r, c = F.col("grid_row"), F.col("grid_col")
    return made.withColumns({"lon": 140 + 0.18 * c + 0.01 * r, "lat": -35 + 0.18 * r - 0.01 * c, "rlon": 0.1825 * c - 1.0, "rlat": 0.1775 * r + 2.0})


GRID = """grid AS (SELECT 'aus_18' AS domain, CAST(n_nationkey // 5 AS INT) AS grid_row, CAST(n_nationkey % 5 AS INT) AS grid_col,
  140 + 0.18::DOUBLE * (n_nationkey % 5) + 0.01::DOUBLE * (n_nationkey // 5) AS lon, -35 + 0.18::DOUBLE * (n_nationkey // 5) - 0.01::DOUBLE * (n_nationkey % 5) AS lat FROM nation)"""


#: Columns of the curved grid: the customers fill its rows.
COLS = 50


def curved(spark, sf):
    """Customers as the cells of a slightly skewed grid, 50 to a row; it grows with the table."""
    key = F.col("c_custkey")
    # a column of the table, not a literal, which would turn joins by domain into products
    domain = F.when(key.isNotNull(), "aus_18").alias("domain")
    made = proxy.table(spark, sf, "customer").select(domain, F.floor(key / COLS).cast("int").alias("grid_row"), (key % COLS).cast("int").alias("grid_col"), F.col("c_acctbal").alias("value"))
    r, c = F.col("grid_row"), F.col("grid_col")
    return made.withColumns({"lon": 140 + 0.02 * c + 0.001 * r, "lat": -35 + 0.02 * r - 0.001 * c, "rlon": 0.1825 * c - 1.0, "rlat": 0.1775 * r + 2.0})


CURVED = f"""grid AS (SELECT *, 140 + 0.02::DOUBLE * grid_col + 0.001::DOUBLE * grid_row AS lon, -35 + 0.02::DOUBLE * grid_row - 0.001::DOUBLE * grid_col AS lat,
  0.1825::DOUBLE * grid_col - 1.0 AS rlon, 0.1775::DOUBLE * grid_row + 2.0 AS rlat FROM (SELECT 'aus_18' AS domain, CAST(c_custkey // {COLS} AS INT) AS grid_row, CAST(c_custkey % {COLS} AS INT) AS grid_col, c_acctbal AS value FROM customer))"""


def _corner(name, dr, dc):
    """SQL of a corner of a curved cell."""
    return f"140 + 0.02::DOUBLE * (grid_col + {dc}) + 0.001::DOUBLE * (grid_row + {dr}) AS x{name}, -35 + 0.02::DOUBLE * (grid_row + {dr}) - 0.001::DOUBLE * (grid_col + {dc}) AS y{name}"


QUADS = f"quads AS (SELECT domain, grid_row, grid_col, value, {', '.join(_corner(k, r, c) for k, (r, c) in enumerate(((-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5), (0.5, -0.5))))} FROM grid)"


def points(spark, sf):
    key = F.col("s_suppkey")
    return proxy.table(spark, sf, "supplier").select(F.concat(F.lit("P"), key).alias("feature_id"), (140 + (key * 37 % 90) / F.lit(100.0)).alias("lon"), (-35 + (key * 53 % 90) / F.lit(100.0)).alias("lat"))


POINTS = "points AS (SELECT 'P' || s_suppkey AS feature_id, 140 + (s_suppkey * 37 % 90) / 100.0::DOUBLE AS lon, -35 + (s_suppkey * 53 % 90) / 100.0::DOUBLE AS lat FROM supplier)"


def polygons(spark, sf):
    """Suppliers as rectangles that lie across the pixels' borders."""
    k = F.col("s_suppkey")
    w, n = 140.0053 + (k * 37 % 60) / F.lit(100.0), -34.0251 - (k * 53 % 50) / F.lit(100.0)
    e, s = w + 0.21, n - 0.17
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return proxy.table(spark, sf, "supplier").select(F.concat(F.lit("P"), k).alias("feature_id"), F.array(F.array(corner(w, s), corner(e, s), corner(e, n), corner(w, n))).alias("rings"))


POLYGONS = """polygons AS (SELECT *, w + 0.21::DOUBLE AS e, n - 0.17::DOUBLE AS s FROM (
  SELECT 'P' || s_suppkey AS feature_id, 140.0053::DOUBLE + (s_suppkey * 37 % 60) / 100.0::DOUBLE AS w, -34.0251::DOUBLE - (s_suppkey * 53 % 50) / 100.0::DOUBLE AS n FROM supplier))"""
WEST, NORTH, RES = 140.0, -34.0, 0.02


def pixels(spark, sf):
    """Customers as pixels of three statistics, 40 to a row, in two rasters on grids that are shifted against each other."""
    key = F.col("c_custkey")
    made = proxy.table(spark, sf, "customer").select((key % 40).cast("int").alias("px"), F.floor(key / 40).cast("int").alias("py"), F.col("c_acctbal").cast("decimal(12,2)").alias("bal"), (key % 17 == 0).alias("empty"))
    stat = F.explode(F.array(F.lit("min"), F.lit("mean"), F.lit("max"))).alias("stat")
    shift = F.when(F.col("stat") == "min", -10).when(F.col("stat") == "mean", 0).otherwise(10)
    made = made.select("px", "py", "bal", "empty", stat).withColumn("scenario", F.explode(F.array(F.lit("ssp245"), F.lit("ssp370"))))
    other = F.col("scenario") == "ssp370"
    made = made.withColumn("value", F.when(~F.col("empty"), (F.col("bal") + shift + F.when(other, 100).otherwise(0)).cast("double")))
    grid_of = {"west": F.lit(WEST) + F.when(other, 0.013).otherwise(0.0), "north": F.lit(NORTH) - F.when(other, 0.007).otherwise(0.0), "res": F.lit(RES)}
    return made.drop("bal", "empty").withColumns({"variable": F.lit("TXge35"), "horizon": F.lit("mid_term"), "source_feature": F.lit("ID1"), **grid_of})


PIXELS = """pixels AS (SELECT CAST(c_custkey % 40 AS INT) AS px, CAST(c_custkey // 40 AS INT) AS py, stat, CASE WHEN c_custkey % 17 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) + shift + more AS DOUBLE) END AS value,
  'TXge35' AS variable, scenario, 'mid_term' AS horizon, 'ID1' AS source_feature, 140.0::DOUBLE + dx AS west, -34.0::DOUBLE - dy AS north, 0.02::DOUBLE AS res
  FROM customer, (VALUES ('min', -10), ('mean', 0), ('max', 10)) s(stat, shift), (VALUES ('ssp245', 0, 0.0::DOUBLE, 0.0::DOUBLE), ('ssp370', 100, 0.013::DOUBLE, 0.007::DOUBLE)) r(scenario, more, dx, dy))"""
K = "variable, scenario, horizon, source_feature"


@query(f"""SELECT 'aus_18' AS domain, CAST(r AS INT) AS corner_row, CAST(c AS INT) AS corner_col, round(140 + 0.02::DOUBLE * (c - 0.5) + 0.001::DOUBLE * (r - 0.5), 9) AS lon, round(-35 + 0.02::DOUBLE * (r - 0.5) - 0.001::DOUBLE * (c - 0.5), 9) AS lat
  FROM (SELECT unnest(range(count(*) // {COLS} + 1)) AS r FROM customer), range({COLS} + 1) b(c)""")
def g1_cell_corners(spark, sf):
    return grid.cell_corners(curved(spark, sf)).select("domain", F.col("corner_row").cast("int"), F.col("corner_col").cast("int"), F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


@query(f"""WITH {CURVED}, {POINTS}, near AS (SELECT feature_id, grid_row, grid_col FROM points p JOIN grid g ON g.lon BETWEEN p.lon - 0.05 AND p.lon + 0.05 AND g.lat BETWEEN p.lat - 0.05 AND p.lat + 0.05)
  SELECT feature_id, greatest(0, min(grid_row) - 1)::INT AS row0, least((SELECT max(grid_row) FROM grid), max(grid_row) + 1)::INT AS row1, greatest(0, min(grid_col) - 1)::INT AS col0, least({COLS} - 1, max(grid_col) + 1)::INT AS col1 FROM near GROUP BY feature_id""")
def g2_candidate_window(spark, sf):
    box = points(spark, sf).select("feature_id", F.col("lon").alias("west"), F.col("lat").alias("south"), F.col("lon").alias("east"), F.col("lat").alias("north"))
    return grid.candidate_window(curved(spark, sf), box).drop("domain")


def _quads(spark, sf):
    return grid.quads(grid.cell_corners(curved(spark, sf)))


def _shapes(spark, sf):
    """Suppliers as concave shapes of five corners, with a triangle as a hole."""
    k = F.col("s_suppkey")
    w, s = 140.0037 + (k * 37 % 90) / F.lit(100.0), -35.0041 + (k * 53 % 90) / F.lit(100.0)
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(*(corner(w + x, s + y) for x, y in SHAPE))
    hole = F.array(*(corner(w + x, s + y) for x, y in HOLE))
    return proxy.table(spark, sf, "supplier").select(F.concat(F.lit("P"), k).alias("feature_id"), F.array(ring, hole).alias("rings"))


SHAPE = ((0.0, 0.0), (0.151, 0.0), (0.151, 0.123), (0.077, 0.031), (0.0, 0.123))
HOLE = ((0.0021, 0.0022), (0.0823, 0.0025), (0.0024, 0.0717))
SHAPES = f"""shapes AS (SELECT 'P' || s_suppkey AS feature_id, 140.0037::DOUBLE + (s_suppkey * 37 % 90) / 100.0::DOUBLE AS w, -35.0041::DOUBLE + (s_suppkey * 53 % 90) / 100.0::DOUBLE AS s FROM supplier),
sides AS (SELECT feature_id, w + x1 AS ax, s + y1 AS ay, w + x2 AS ex, s + y2 AS ey FROM shapes, (VALUES {", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for ring in (SHAPE, HOLE) for a, b in zip(ring, ring[1:] + ring[:1]))}) t(x1, y1, x2, y2))"""


def _turn(a, b, c):
    """SQL: on which side of the line from a to b the point c lies."""
    return f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"


def _meets():
    """SQL: a side from ax, ay to ex, ey begins in the quad x0..y3, or cuts one of its sides."""
    quad, a, b = [(f"x{k}", f"y{k}") for k in range(4)], ("ax", "ay"), ("ex", "ey")
    turns = ", ".join(_turn(quad[k], quad[(k + 1) % 4], a) for k in range(4))
    cuts = [f"({_turn(a, b, p)} * {_turn(a, b, q)} <= 0 AND {_turn(p, q, a)} * {_turn(p, q, b)} <= 0)" for p, q in zip(quad, quad[1:] + quad[:1])]
    return f"(least({turns}) >= 0 OR greatest({turns}) <= 0 OR {' OR '.join(cuts)})"


@query(f"""WITH {CURVED}, {QUADS}, {SHAPES}, boxed AS (SELECT feature_id, min(ax) AS w, max(ax) AS e, min(ay) AS s, max(ay) AS n FROM sides GROUP BY feature_id),
  near AS (SELECT * FROM quads JOIN boxed ON least(x0, x1, x2, x3) <= e AND greatest(x0, x1, x2, x3) >= w AND least(y0, y1, y2, y3) <= n AND greatest(y0, y1, y2, y3) >= s)
  SELECT domain, grid_row, grid_col, feature_id FROM near JOIN sides USING (feature_id) GROUP BY ALL
  HAVING bool_or({_meets()}) OR count(*) FILTER (WHERE (ay > y0) <> (ey > y0) AND x0 < ax + (y0 - ay) * (ex - ax) / nullif(ey - ay, 0)) % 2 = 1""")
def g3_cells_intersecting(spark, sf):
    return geometry.cells_intersecting(_quads(spark, sf), _shapes(spark, sf))


def _nearest(name):
    return f"""near AS (SELECT feature_id, grid_row, grid_col, row_number() OVER (PARTITION BY feature_id ORDER BY
  ((g.lon - p.lon) * cos(radians(p.lat))) * ((g.lon - p.lon) * cos(radians(p.lat))) + (g.lat - p.lat) * (g.lat - p.lat), grid_row, grid_col) AS n FROM points p, {name} g),
nearest AS (SELECT feature_id, grid_row, grid_col FROM near WHERE n = 1)"""


NEAREST = f"{GRID}, {POINTS}, {_nearest('grid')}"


@query(f"WITH {CURVED}, {POINTS}, {_nearest('grid')} SELECT feature_id, 'aus_18' AS domain, grid_row, grid_col FROM nearest")
def g4_nearest_cell(spark, sf):
    return geometry.nearest_cell(curved(spark, sf), points(spark, sf))


@query(f"WITH {OBS}, {NEAREST} SELECT n.feature_id, n.grid_row, n.grid_col, count(*) AS n_rows, sum(value)::DOUBLE AS total, 'nearest' AS method, 1::BIGINT AS n_cells FROM obs JOIN nearest n ON obs.grid_row = n.grid_row AND obs.grid_col = n.grid_col GROUP BY ALL")
def g5_extract(spark, sf):
    chosen = geometry.nearest_cell(cells(spark, sf), points(spark, sf)).withColumn("method", F.lit("nearest"))
    found = geometry.extract_totals(proxy.obs(spark, sf), chosen, "feature_id", "grid_row", "grid_col", "method", "n_cells")
    return found.withColumn("total", F.col("total").cast("double"))


def _two_domains(spark, sf):
    """Observations of two domains in one store: the second has values of its own on the same rows and columns."""
    domain = F.explode(F.array(F.struct(F.lit("aus_18").alias("domain"), F.lit(0).alias("more")), F.struct(F.lit("seaus_4km").alias("domain"), F.lit(1000).alias("more")))).alias("_d")
    made = proxy.obs(spark, sf).select("*", domain).withColumns({"domain": F.col("_d.domain"), "value": (F.col("value") + F.col("_d.more")).cast("decimal(18,2)")})
    return made.drop("_d")


def _two_grids(spark, sf):
    """The grid of nations, and in the second domain the same turned by a half, so that rows and columns name other places."""
    own = cells(spark, sf)
    return own.unionByName(own.withColumns({"domain": F.when(F.col("domain").isNotNull(), "seaus_4km"), "grid_row": 4 - F.col("grid_row"), "grid_col": (4 - F.col("grid_col")).cast("int")}))


@query(f"""WITH {OBS}, {NEAREST}, found AS (SELECT 'aus_18' AS domain, feature_id, grid_row, grid_col, 0 AS more FROM nearest UNION ALL SELECT 'seaus_4km', feature_id, 4 - grid_row, 4 - grid_col, 1000 FROM nearest)
  SELECT domain, f.feature_id, f.grid_row, f.grid_col, count(*) AS n_rows, sum(CAST(value + more AS DECIMAL(18,2)))::DOUBLE AS total, 1::BIGINT AS n_cells
  FROM obs JOIN found f ON obs.grid_row = f.grid_row AND obs.grid_col = f.grid_col GROUP BY ALL""")
def g5_extract_two_domains(spark, sf):
    chosen = geometry.nearest_cell(_two_grids(spark, sf), points(spark, sf)).withColumn("method", F.lit("nearest"))
    found = geometry.extract_totals(_two_domains(spark, sf), chosen, "domain", "feature_id", "grid_row", "grid_col", "n_cells")
    return found.withColumn("total", F.col("total").cast("double"))


PICKED = "picked AS (SELECT DISTINCT 'F' || (s_suppkey % 7) AS feature_id, CAST(s_nationkey // 5 AS INT) AS grid_row, CAST(s_nationkey % 5 AS INT) AS grid_col FROM supplier)"


def _picked(spark, sf):
    return proxy.table(spark, sf, "supplier").select(F.concat(F.lit("F"), F.col("s_suppkey") % 7).alias("feature_id"), F.floor(F.col("s_nationkey") / 5).cast("int").alias("grid_row"), (F.col("s_nationkey") % 5).cast("int").alias("grid_col")).distinct()


@query(f"""WITH {PICKED}, box AS (SELECT feature_id, min(grid_row) r0, max(grid_row) r1, min(grid_col) c0, max(grid_col) c1 FROM picked GROUP BY feature_id)
  SELECT box.feature_id, r::INT AS grid_row, c::INT AS grid_col, p.feature_id IS NOT NULL AS selected FROM box JOIN range(5) a(r) ON r BETWEEN r0 AND r1 JOIN range(5) b(c) ON c BETWEEN c0 AND c1
  LEFT JOIN picked p ON p.feature_id = box.feature_id AND p.grid_row = r AND p.grid_col = c""")
def g6_crop_window(spark, sf):
    return grid.crop_window(_picked(spark, sf))


@query(f"WITH {PICKED} SELECT feature_id, count(*) AS cells, 25::BIGINT AS grid_cells, CASE WHEN count(*) >= 25 THEN 'processing_error' ELSE 'ok' END AS status FROM picked GROUP BY feature_id")
def g7_full_grid_guard(spark, sf):
    return grid.full_grid_guard(_picked(spark, sf), cells(spark, sf))


@query(f"""WITH {SHAPES}, {CURVED}, ends AS (SELECT min(lon) - 0.0113 AS w, max(lon) + 0.0113 AS e, min(lat) - 0.0113 AS s, max(lat) + 0.0113 AS n FROM grid),
  beyond AS (SELECT DISTINCT feature_id FROM sides, ends WHERE ax NOT BETWEEN ends.w AND ends.e OR ay NOT BETWEEN ends.s AND ends.n ORDER BY feature_id LIMIT 10)
  SELECT 'aus_18' AS domain, 'outside: ' || string_agg(feature_id, ', ' ORDER BY feature_id) AS reason FROM beyond""")
def g8_select_domain(spark, sf):
    ends = curved(spark, sf).agg(*((f(c) + by).alias(n) for f, c, by, n in ((F.min, "lon", -0.0113, "w"), (F.max, "lon", 0.0113, "e"), (F.min, "lat", -0.0113, "s"), (F.max, "lat", 0.0113, "n"))))
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("w", "s"), corner("e", "s"), corner("e", "n"), corner("w", "n"))
    return geometry.select_domain(_shapes(spark, sf), ends.select(F.lit("seaus_4km").alias("domain"), F.array(ring).alias("rings")))


@query(f"WITH {CURVED} SELECT domain, round_even(abs(regr_slope(rlon, grid_col)), 2) AS res_x, round_even(abs(regr_slope(rlat, grid_row)), 2) AS res_y FROM grid GROUP BY domain")
def g9_native_resolution(spark, sf):
    return grid.native_resolution(curved(spark, sf))


@query("""WITH axis AS (SELECT c_nationkey AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS idx, c_custkey AS k FROM customer),
  line AS (SELECT name, idx, 0.5::DOUBLE * idx + CASE WHEN name % 2 = 0 THEN 0 ELSE (k % 11) / 10.0::DOUBLE END AS coord FROM axis),
  fit AS (SELECT name, regr_slope(coord, idx) AS step, regr_intercept(coord, idx) AS origin FROM line GROUP BY name),
  seen AS (SELECT line.*, coord - lag(coord) OVER (PARTITION BY name ORDER BY idx) AS d FROM line)
  SELECT name, round(origin, 6) AS origin, round(step, 6) AS step, (min(d) > 0 OR max(d) < 0) AND max(abs(coord - origin - step * idx)) <= 0.25 * abs(step) AS regular FROM seen JOIN fit USING (name) GROUP BY name, origin, step""")
def g10_regular_axis(spark, sf):
    from pyspark.sql import Window as W

    key = F.col("c_custkey")
    axis = proxy.table(spark, sf, "customer").select(F.col("c_nationkey").alias("name"), F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")).cast("long").alias("idx"), key)
    line = axis.withColumn("coord", 0.5 * F.col("idx") + F.when(F.col("name") % 2 == 0, 0.0).otherwise((key % 11) / F.lit(10.0)))
    return grid.regular_axis(line).select("name", F.round("origin", 6).alias("origin"), F.round("step", 6).alias("step"), "regular")


#: No pixel border of this resolution meets a cell corner, so that touching is never decided by rounding.
FINE = 0.0073137


def _apart():
    """SQL: an axis of the quad x0..y3 separates it from the box l, b, r, t."""
    tests = []
    for k in range(4):
        j = (k + 1) % 4
        along = lambda x, y: f"(y{j} - y{k}) * {x} + (x{k} - x{j}) * {y}"  # noqa: E731, B023
        quad, box = ", ".join(along(f"x{i}", f"y{i}") for i in range(4)), ", ".join(along(x, y) for x in "lr" for y in "bt")
        tests.append(f"least({quad}) > greatest({box}) OR greatest({quad}) < least({box})")
    return " OR ".join(tests)


@query(f"""WITH {CURVED}, {QUADS}, ends AS (SELECT floor(min(least(x0, x1, x2, x3)) / {FINE}::DOUBLE) * {FINE}::DOUBLE AS west, ceil(max(greatest(y0, y1, y2, y3)) / {FINE}::DOUBLE) * {FINE}::DOUBLE AS north FROM quads),
  wide AS (SELECT *, unnest(range(floor((least(x0, x1, x2, x3) - west) / {FINE}::DOUBLE)::BIGINT, floor((greatest(x0, x1, x2, x3) - west) / {FINE}::DOUBLE)::BIGINT + 1)) AS px FROM quads, ends),
  boxed AS (SELECT *, unnest(range(floor((north - greatest(y0, y1, y2, y3)) / {FINE}::DOUBLE)::BIGINT, floor((north - least(y0, y1, y2, y3)) / {FINE}::DOUBLE)::BIGINT + 1)) AS py FROM wide),
  placed AS (SELECT *, west + px * {FINE}::DOUBLE AS l, west + px * {FINE}::DOUBLE + {FINE}::DOUBLE AS r, north - py * {FINE}::DOUBLE AS t, north - py * {FINE}::DOUBLE - {FINE}::DOUBLE AS b FROM boxed)
  SELECT 'balance' AS variable, px, py, west, north, {FINE}::DOUBLE AS res, arg_max(value, grid_row * {COLS} + grid_col) AS value FROM placed WHERE NOT ({_apart()}) GROUP BY ALL""")
def g11_rasterise(spark, sf):
    values = curved(spark, sf).select(F.lit("balance").alias("variable"), "grid_row", "grid_col", "value")
    return grid.rasterise(values, _quads(spark, sf), FINE)


@query(f"WITH {PIXELS} SELECT px, py, stat, value, scenario, round(west + (px + 0.5) * 0.02::DOUBLE, 9) AS longitude, round(north - (py + 0.5) * 0.02::DOUBLE, 9) AS latitude FROM pixels WHERE value IS NOT NULL")
def g12_pixels_to_points(spark, sf):
    return grid.pixels_to_points(pixels(spark, sf)).select("px", "py", "stat", "value", "scenario", F.round("longitude", 9).alias("longitude"), F.round("latitude", 9).alias("latitude"))


@query(f"WITH {PIXELS} SELECT {K}, px, py, max(value) FILTER (WHERE stat = 'min') AS min, max(value) FILTER (WHERE stat = 'mean') AS mean, max(value) FILTER (WHERE stat = 'max') AS max FROM pixels GROUP BY ALL HAVING count(value) > 0")
def g13_stats_to_points(spark, sf):
    return grid.stats_to_points(pixels(spark, sf))


@query("SELECT p_brand AS variable, 's' AS scenario, 'h' AS horizon, 'ID1' AS source_feature, count(DISTINCT p_size % 2) = 1 AS aligned FROM part WHERE p_brand <> 'Brand#11' OR p_size % 2 = 0 GROUP BY ALL")
def g14_alignment(spark, sf):
    part = proxy.table(spark, sf, "part").where("p_brand <> 'Brand#11' or p_size % 2 = 0")
    lit = F.lit
    return grid.alignment(part.select(F.col("p_brand").alias("variable"), lit("s").alias("scenario"), lit("h").alias("horizon"), lit("ID1").alias("source_feature"), (F.col("p_size") % 2).alias("west"), lit(0).alias("north"), lit(1).alias("res"), lit(1).alias("width"), lit(1).alias("height")))


TOUCHED = """touched AS (SELECT feature_id, pixels.* FROM pixels JOIN polygons ON west + px * 0.02::DOUBLE <= e AND west + px * 0.02::DOUBLE + 0.02 >= w AND north - py * 0.02::DOUBLE - 0.02 <= n AND north - py * 0.02::DOUBLE >= s WHERE value IS NOT NULL)"""
ZONAL = f"""zonal AS (SELECT {K}, stat, feature_id, round(sum(CAST(value AS DECIMAL(14,2)))::DOUBLE / count(value), 9) AS value, count(value) AS n_pixels
  FROM (SELECT * FROM (SELECT DISTINCT {K}, stat FROM pixels), (SELECT feature_id FROM polygons)) LEFT JOIN touched USING ({K}, stat, feature_id) GROUP BY ALL)"""


@query(f"WITH {PIXELS}, {POLYGONS}, {TOUCHED}, {ZONAL} SELECT * FROM zonal")
def g15_zonal_mean(spark, sf):
    # a mean of 64 numbers of two decimals has eight at most: nothing is halfway at the ninth
    return zonal.zonal_mean(pixels(spark, sf), polygons(spark, sf)).withColumn("value", F.round("value", 9))


@query(f"""WITH {PIXELS}, {POLYGONS} SELECT feature_id, scenario, count(*) AS n FROM pixels JOIN polygons ON west + (px + 0.5) * 0.02::DOUBLE BETWEEN w AND e AND north - (py + 0.5) * 0.02::DOUBLE BETWEEN s AND n WHERE stat = 'mean' GROUP BY ALL""")
def g15_centre_in_polygon(spark, sf):
    own = pixels(spark, sf).where("stat = 'mean'")
    found = zonal.pixels_of(own, polygons(spark, sf), all_touched=False)
    return found.join(own.hint("merge"), list(grid.PIXEL)).groupBy("feature_id", "scenario").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {PIXELS}, {POLYGONS}, {TOUCHED} SELECT feature_id, round_even(sum(CAST(value AS DECIMAL(14,2)))::DOUBLE / count(*), 1) AS mean, round_even(min(value), 1) AS min, round_even(max(value), 1) AS max, count(*) AS valid_cells FROM touched WHERE stat = 'mean' GROUP BY feature_id")
def g16_zonal_stats(spark, sf):
    return zonal.zonal_stats(pixels(spark, sf).where("stat = 'mean'"), polygons(spark, sf))


SAMPLED = f"""{PIXELS}, sites AS (SELECT 'P' || s_suppkey AS feature_id, 140 + (s_suppkey * 37 % 90) / 100.0::DOUBLE + 0.0033 AS lon, -34.0031 - (s_suppkey * 53 % 70) / 100.0::DOUBLE AS lat FROM supplier),
placed AS (SELECT feature_id, lon, lat, {K}, stat, CAST(floor((lon - west) / 0.02) AS INT) AS px, CAST(floor((north - lat) / 0.02) AS INT) AS py FROM sites, (SELECT DISTINCT {K}, stat, west, north FROM pixels)),
sampled AS (SELECT feature_id, lon, lat, {K}, stat, value FROM placed LEFT JOIN pixels USING ({K}, stat, px, py))"""


def sample_sites(spark, sf):
    key = F.col("s_suppkey")
    return proxy.table(spark, sf, "supplier").select(F.concat(F.lit("P"), key).alias("feature_id"), (140 + (key * 37 % 90) / F.lit(100.0) + 0.0033).alias("lon"), (-34.0031 - (key * 53 % 70) / F.lit(100.0)).alias("lat"))


def _sampled(spark, sf):
    return zonal.sample_point(pixels(spark, sf), sample_sites(spark, sf))


@query(f"WITH {SAMPLED} SELECT * FROM sampled")
def g17_sample_point(spark, sf):
    return _sampled(spark, sf)


def _regridded(name, source, target, keys):
    """SQL of CTEs that bring the rasters of `source` to the pixels of `target` bilinearly: `name` has the keys, the target's pixel, the source's grid and the value."""
    shared = [k for k in keys if k != "scenario"]
    return f"""{name}_placed AS (SELECT {"".join(f"r.{k}, " for k in keys)}t.px, t.py, t.west, t.north, t.res, r.west AS source_west, r.north AS source_north, r.res AS source_res,
  (t.west + (t.px + 0.5) * t.res - r.west) / r.res - 0.5 AS x, (r.north - t.north + (t.py + 0.5) * t.res) / r.res - 0.5 AS y
  FROM (SELECT DISTINCT {"".join(f"{k}, " for k in shared)}px, py, west, north, res FROM {target}) t JOIN (SELECT DISTINCT {"".join(f"{k}, " for k in keys)}west, north, res FROM {source}) r ON {" AND ".join([f"t.{k} = r.{k}" for k in shared] or ["true"])}),
{name}_near AS (SELECT p.*, CAST(floor(x) + i AS INT) AS nx, CAST(floor(y) + j AS INT) AS ny FROM {name}_placed p, range(2) a(i), range(2) b(j)),
{name} AS (SELECT {"".join(f"n.{k}, " for k in keys)}n.px, n.py, n.west, n.north, n.res, source_west, source_north, source_res,
  sum((1 - abs(x - nx)) * (1 - abs(y - ny)) * s.value) / nullif(sum((1 - abs(x - nx)) * (1 - abs(y - ny))) FILTER (WHERE s.value IS NOT NULL), 0) AS value
  FROM {name}_near n LEFT JOIN {source} s ON s.px = nx AND s.py = ny AND s.west = source_west AND s.north = source_north{"".join(f" AND s.{k} = n.{k}" for k in keys)} GROUP BY ALL)"""


@query(f"""WITH {PIXELS}, source AS (SELECT * FROM pixels WHERE stat = 'mean'),
  target AS (SELECT 2 * px + i AS px, 2 * py + j AS py, west + 0.003 AS west, north - 0.003 AS north, res / 2 AS res FROM source, range(2) a(i), range(2) b(j) WHERE scenario = 'ssp245'), {_regridded("regridded", "source", "target", ["scenario"])}
  SELECT * REPLACE (round(value, 6) AS value) FROM regridded""")
def g18_bilinear_regrid(spark, sf):
    source = pixels(spark, sf).where("stat = 'mean'")
    fine = F.explode(F.sequence(F.lit(0), F.lit(1)))
    # a finer grid over the whole of the source: four pixels, shifted, for each of its own
    target = source.where("scenario = 'ssp245'").select("px", "py", "west", "north", "res").withColumn("_i", fine).withColumn("_j", fine).select(
        (2 * F.col("px") + F.col("_i")).alias("px"), (2 * F.col("py") + F.col("_j")).alias("py"), (F.col("west") + 0.003).alias("west"), (F.col("north") - 0.003).alias("north"), (F.col("res") / 2).alias("res"))
    return grid.bilinear(source, target, ("scenario",)).withColumn("value", F.round("value", 6))


@query(f"WITH {PIXELS} SELECT variable, -greatest(abs(min(value)), abs(max(value))) AS low, greatest(abs(min(value)), abs(max(value))) AS high FROM pixels GROUP BY variable")
def g19_value_range(spark, sf):
    return grid.value_range(pixels(spark, sf), change=True)


@query(f"""WITH {SAMPLED} SELECT {K}, feature_id, round_even(max(value) FILTER (WHERE stat = 'min'), 1) AS min, round_even(max(value) FILTER (WHERE stat = 'mean'), 1) AS mean, round_even(max(value) FILTER (WHERE stat = 'max'), 1) AS max,
  CAST(count(value) > 0 AS BIGINT) AS n_pixels FROM sampled GROUP BY ALL""")
def e9_feature_summary(spark, sf):
    return zonal.feature_summary(_sampled(spark, sf))


@query(f"""WITH {PIXELS}, past AS (SELECT * REPLACE (west + 0.004 AS west, value - 5 AS value, 'historical' AS scenario, 'baseline' AS horizon) FROM pixels WHERE scenario = 'ssp245' AND stat <> 'max'),
  {_regridded("moved", "past", "pixels", ["variable", "source_feature", "stat"])}
  SELECT pixels.* REPLACE (round(pixels.value - moved.value, 6) AS value) FROM pixels JOIN moved USING (variable, source_feature, stat, px, py, west, north, res)""")
def e14_spi_change(spark, sf):
    """The baseline lies on another grid and is brought to the grids of both futures; for the maximum there is none."""
    future = pixels(spark, sf)
    past = future.where("scenario = 'ssp245' and stat <> 'max'").withColumns({"west": F.col("west") + 0.004, "value": F.col("value") - 5, "scenario": F.lit("historical"), "horizon": F.lit("baseline")})
    return change.spi_change(future.unionByName(past)).withColumn("value", F.round("value", 6))
