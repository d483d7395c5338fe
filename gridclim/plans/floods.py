"""Queries on flood-frequency screening, with SQL for the same rows. Design tables are derived from the suppliers."""

from pyspark.sql import functions as F

from gridclim.operators import flood
from gridclim.plans import proxy
from gridclim.sources import store

QUERIES, SQL = {}, {}
RATES = (12.0, 6.0, 4.0, 3.0, 2.0, 1.0, 0.5, 0.2, 0.11, 0.05, 0.02, 0.01, 0.005, 0.002)
LABELS = ("12 EY", "6EY", "4 EY", "3EY", "2 ey", "1 EY", "50%", "20%", "10%", "5%", "2%", "1%", "1 in 200", "1 in 500")


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that gives its rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def wide_ifd(spark, sf):
    """Two durations of each supplier, a column for each probability; depths rise with rarity."""
    key = F.col("s_suppkey")
    base, step = 5 + key % 7, (2 + (key % 5)) / F.lit(2.0)
    made = proxy.table(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(F.struct(F.lit("60 min").alias("duration"), F.lit(1).alias("times")), F.struct(F.lit("1 day").alias("duration"), F.lit(3).alias("times")))).alias("d"))
    depths = [F.format_string("%,.2f", (base + k * step) * F.col("d.times")).alias(name) for k, name in enumerate(LABELS)]
    return made.select(F.concat(F.lit("P"), key).alias("point_id"), F.col("d.duration").alias("duration"), *depths, F.lit("n/a").alias("remark"))


def ifd(spark, sf):
    return flood.ifd_unpivot(wide_ifd(spark, sf), ["point_id"])


IFD = f"""labels AS (SELECT unnest([{", ".join(f"'{x}'" for x in LABELS)}]) AS probability_label, unnest([{", ".join(map(str, RATES))}]::DOUBLE[]) AS event_rate_per_year, unnest(range({len(RATES)})) AS k),
ifd AS (SELECT 'P' || s_suppkey AS point_id, d.h AS duration_hours, event_rate_per_year, ((5 + s_suppkey % 7) + k * ((2 + s_suppkey % 5) / 2.0::DOUBLE)) * d.times AS rainfall_depth_mm, probability_label
  FROM supplier, labels, (VALUES (1.0::DOUBLE, 1), (24.0::DOUBLE, 3)) d(h, times))"""


def sites(spark, sf):
    return proxy.sites(spark, sf).withColumn("point_id", F.regexp_replace(F.regexp_extract("point_id", "^F([0-9]+)_", 1), "^", "P"))


#: Keeps results away from halves of the last decimal, which the two engines might round apart.
ODD = 0.0137331


def losses(spark, sf):
    key = F.col("s_suppkey")
    return proxy.table(spark, sf, "supplier").select(F.concat(F.lit("P"), key).alias("point_id"), (key % 30).cast("double").alias("initial_loss_mm"), ((key % 9) / F.lit(2.0) + ODD).alias("continuing_loss_mm_per_hr"))


def factors(spark, sf):
    """Ten-yearly temperature and loss factors of each supplier."""
    key, year = F.col("s_suppkey"), F.col("year")
    made = proxy.table(spark, sf, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(2030), F.lit(2100), F.lit(10))).alias("year"))
    made = made.withColumn("scenario", F.explode(F.array(F.lit("ssp245"), F.lit("ssp370"))))
    warm = (year - 2000) * F.when(F.col("scenario") == "ssp245", 0.02).otherwise(0.035)
    kinds = {"delta_t": warm, "il": 1.0 + (key % 5) / F.lit(100.0), "cl": 1.0 + (key % 4) / F.lit(100.0)}
    rows = [made.select(F.concat(F.lit("P"), key).alias("point_id"), F.lit(k).alias("kind"), "scenario", "year", v.cast("double").alias("value")) for k, v in kinds.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


WINDOWS = (("baseline", 1985, 2014), ("mid_term", 2041, 2060), ("long_term", 2081, 2100))
SCENARIOS = (("historical",), ("ssp245",), ("ssp370",))
DURATIONS = (("urban", 1.0), ("rural", 24.0))
ARIS = ((1.0,), (10.0,), (100.0,), (50.0,))


def _dimensions(spark):
    return (
        spark.createDataFrame(WINDOWS, "horizon string, start_year int, end_year int"), spark.createDataFrame(SCENARIOS, "scenario string"),
        spark.createDataFrame(DURATIONS, "context string, duration_hr double"), spark.createDataFrame(ARIS, "current_ari_year double"),
    )


def _hazard(spark, sf):
    return flood.flood_hazard(sites(spark, sf), ifd(spark, sf), factors(spark, sf), losses(spark, sf), *_dimensions(spark))


def _curve(spark, sf):
    """The curves of all regimes that the hazard table has."""
    windows, scenarios, durations, aris = _dimensions(spark)
    table = ifd(spark, sf)
    events = flood.current_events(sites(spark, sf), table, losses(spark, sf), durations, aris)
    return flood.future_runoff_curve(flood.future_regimes(events, factors(spark, sf), windows, scenarios), table)


def _values(*rows):
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v) for v in row) + ")" for row in rows) + ")"


def _step_sum(depth, hours, il, cl):
    """SQL: runoff, step by step."""
    rain = f"({depth} / 60)"
    taken = f"(least(k * {rain}, {il}) - least((k - 1) * {rain}, {il}))"
    lost = f"least(CASE WHEN k * {rain} >= {il} THEN {cl} * {hours} / 60 ELSE 0 END, {rain} - {taken})"
    return f"list_sum(list_transform(range(1, 61), lambda k: CASE WHEN {rain} - {taken} - {lost} < 1e-12 THEN 0 ELSE {rain} - {taken} - {lost} END))"


def _least_depth(rows, keys, hours, il, cl):
    """SQL: keys and the least depth with runoff 0.1 for each of `rows`: of the two straight pieces of each step, the least depth that is enough."""
    c = f"({cl} * {hours} / 60)"
    total = f"CASE WHEN {il} <= 0 THEN 60 * greatest(0, r - {c}) WHEN ceil({il} / r) > 60 THEN 0 ELSE greatest(0, ceil({il} / r) * r - {il} - {c}) + (60 - ceil({il} / r)) * greatest(0, r - {c}) END"
    tried = f"SELECT *, unnest([{c} + 0.1::DOUBLE / nullif(60 - k, 0), (0.1::DOUBLE + greatest({il}, 0) + {c} * (61 - k)) / 60, {c} + 0.1::DOUBLE / 60]) AS r FROM {rows}, range(1, 61) t(k)"
    return f"SELECT {keys}, 60 * min(r) AS least_depth FROM ({tried}) WHERE r > 0 AND {total} >= 0.1 - 1e-9 GROUP BY ALL"


def _log_at(name, events, at, measure):
    """SQL: `name` has the keys, how many points the curve has, and the logarithm of the rate where the curve's `measure` is `at`."""
    keys = "point_id, duration_hr, scenario, horizon"
    return f"""{name}_curve AS (SELECT {keys}, log10({measure}) AS x, min(log10(event_rate_per_year)) AS y FROM curve WHERE event_rate_per_year > 0 AND {measure} > 0 GROUP BY ALL),
{name}_ends AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1, count(*) OVER (PARTITION BY {keys}) AS n FROM {name}_curve WINDOW w AS (PARTITION BY {keys} ORDER BY x)),
{name} AS (SELECT {keys}, current_ari_year, max(n) AS {name}_n, max(CASE WHEN {at} >= x AND {at} < x1 THEN y + ({at} - x) / (x1 - x) * (y1 - y) WHEN {at} = x AND x1 IS NULL THEN y END) AS {name}_log FROM {events} JOIN {name}_ends USING ({keys}) GROUP BY ALL)"""


HAZARD = f"""{IFD}, sites AS (SELECT 'P' || s_suppkey AS point_id, s_suppkey, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'urban' ELSE 'rural' END AS context,
  140 + (s_suppkey * 37 % 90) / 100.0::DOUBLE AS lon, -35 + (s_suppkey * 53 % 90) / 100.0::DOUBLE AS lat FROM supplier),
asked AS (SELECT sites.*, duration_hr, current_ari_year, CASE current_ari_year WHEN 10 THEN 0.11 ELSE 1.0::DOUBLE / current_ari_year END::DOUBLE AS current_event_rate_per_year,
  CASE context WHEN 'urban' THEN 2.0 ELSE s_suppkey % 30 END::DOUBLE AS il, CASE context WHEN 'urban' THEN 0.0 ELSE (s_suppkey % 9) / 2.0 + {ODD} END::DOUBLE AS cl
  FROM sites JOIN {_values(*DURATIONS)} d(context, duration_hr) USING (context), {_values(*ARIS)} a(current_ari_year)),
ends AS (SELECT point_id, duration_hours AS duration_hr, event_rate_per_year AS r0, rainfall_depth_mm AS d0, lead(event_rate_per_year) OVER w AS r1, lead(rainfall_depth_mm) OVER w AS d1
  FROM ifd WINDOW w AS (PARTITION BY point_id, duration_hours ORDER BY event_rate_per_year)),
rained AS (SELECT asked.*, CASE WHEN current_event_rate_per_year = r0 THEN d0 ELSE d0 + (ln(current_event_rate_per_year) - ln(r0)) / (ln(r1) - ln(r0)) * (d1 - d0) END AS depth
  FROM asked JOIN ends USING (point_id, duration_hr) WHERE current_event_rate_per_year >= r0 AND (current_event_rate_per_year < r1)),
event_least AS ({_least_depth("(SELECT DISTINCT point_id, duration_hr, il, cl FROM asked)", "point_id, duration_hr", "duration_hr", "il", "cl")}),
events AS (SELECT rained.*, {_step_sum("depth", "duration_hr", "il", "cl")} AS runoff, least_depth, greatest(0, least_depth - depth) AS shortfall FROM rained JOIN event_least USING (point_id, duration_hr)),
warmed AS (SELECT DISTINCT point_id, s_suppkey, context, duration_hr, il, cl, scenario, horizon, start_year, end_year, CAST(round_even((start_year + end_year) / 2.0, 0) AS INT) AS horizon_year, slope
  FROM asked, {_values(*WINDOWS)} w(horizon, start_year, end_year), {_values(("ssp245", 0.02), ("ssp370", 0.035))} s(scenario, slope) WHERE end_year > 2014),
heated AS (SELECT *, (horizon_year - 2000) * slope AS dt, 15 - 7 * (duration_hr - 1) / 23 AS alpha, CASE context WHEN 'urban' THEN 1 ELSE 1 + (s_suppkey % 5) / 100.0 END::DOUBLE AS il_factor,
  CASE context WHEN 'urban' THEN 1 ELSE 1 + (s_suppkey % 4) / 100.0 END::DOUBLE AS cl_factor FROM warmed),
lossy AS (SELECT *, pow(1 + alpha / 100, dt) AS rain_factor, il * pow(il_factor, dt) AS future_il, cl * pow(cl_factor, dt) AS future_cl FROM heated),
regime_least AS ({_least_depth("lossy", "point_id, duration_hr, scenario, horizon", "duration_hr", "future_il", "future_cl")}),
regimes AS (SELECT lossy.*, least_depth AS future_least FROM lossy JOIN regime_least USING (point_id, duration_hr, scenario, horizon)),
wet AS (SELECT regimes.*, event_rate_per_year, rainfall_depth_mm, rainfall_depth_mm * rain_factor AS future_depth FROM regimes JOIN ifd ON ifd.point_id = regimes.point_id AND duration_hours = duration_hr),
curve AS (SELECT *, {_step_sum("future_depth", "duration_hr", "future_il", "future_cl")} AS future_runoff, greatest(0, future_least - future_depth) AS future_shortfall FROM wet),
pairs AS (SELECT e.* EXCLUDE (s_suppkey), r.* EXCLUDE (point_id, s_suppkey, context, duration_hr, il, cl) FROM events e JOIN regimes r ON e.point_id = r.point_id AND e.duration_hr = r.duration_hr),
{_log_at("by_runoff", "(SELECT * FROM pairs WHERE runoff >= 0.1)", "log10(runoff)", "future_runoff")},
{_log_at("by_shortfall", "(SELECT * FROM pairs WHERE runoff < 0.1 AND shortfall > 0)", "log10(shortfall)", "future_shortfall")},
joined AS (SELECT * FROM pairs LEFT JOIN by_runoff USING (point_id, duration_hr, scenario, horizon, current_ari_year) LEFT JOIN by_shortfall USING (point_id, duration_hr, scenario, horizon, current_ari_year)),
matched AS (SELECT *, pow(10, coalesce(by_runoff_log, by_shortfall_log)) AS future_rate, CASE
  WHEN runoff >= 0.1 AND coalesce(by_runoff_n, 0) < 2 THEN 'insufficient_positive_future_runoff_curve' WHEN runoff >= 0.1 AND by_runoff_log IS NULL THEN 'current_runoff_outside_future_curve'
  WHEN runoff >= 0.1 THEN 'matched_loglog_runoff' WHEN shortfall <= 0 THEN 'invalid_current_rainfall_shortfall' WHEN coalesce(by_shortfall_n, 0) < 2 THEN 'insufficient_positive_future_shortfall_curve'
  WHEN by_shortfall_log IS NULL THEN 'current_shortfall_outside_future_curve' ELSE 'matched_loglog_shortfall' END AS match_status FROM joined),
changed AS (SELECT *, 1 / future_rate AS future_ari, future_rate / current_event_rate_per_year AS ratio FROM matched),
hazard AS (SELECT point_id, duration_hr, scenario, horizon, context, name, lon, lat, current_ari_year, current_event_rate_per_year, il, cl, depth, runoff, least_depth, shortfall, start_year, end_year, horizon_year,
  dt, alpha, rain_factor, il_factor, cl_factor, future_il, future_cl, pow(il_factor, dt) AS il_change, pow(cl_factor, dt) AS cl_change, future_least, match_status, future_rate, future_ari, ratio, (ratio - 1) * 100 AS change_pct FROM changed
  UNION ALL SELECT point_id, duration_hr, 'historical', horizon, context, name, lon, lat, current_ari_year, current_event_rate_per_year, il, cl, depth, runoff, least_depth, shortfall, start_year, end_year,
  CAST(round_even((start_year + end_year) / 2.0, 0) AS INT), 0, 15 - 7 * (duration_hr - 1) / 23, 1, 1, 1, il, cl, 1, 1, least_depth, 'historical_reference', current_event_rate_per_year, current_ari_year, 1, 0
  FROM events, {_values(*WINDOWS)} w(horizon, start_year, end_year) WHERE end_year <= 2014),
rounded AS (SELECT point_id, round_even(duration_hr, 2) AS duration_hr, scenario, horizon, context, name, lon, lat, round_even(current_ari_year, 3) AS current_ari_year, round_even(current_event_rate_per_year, 6) AS current_event_rate_per_year,
  round_even(il, 2) AS current_initial_loss_mm, round_even(cl, 3) AS current_continuing_loss_mm_per_hr, round_even(depth, 2) AS current_rainfall_depth_mm, round_even(runoff, 2) AS current_runoff_mm,
  round(least_depth, 6) AS current_runoff_threshold_depth_mm, 0.1::DOUBLE AS current_runoff_threshold_mm, round(shortfall, 6) AS current_rainfall_shortfall_mm, CAST(start_year AS INT) AS start_year, CAST(end_year AS INT) AS end_year, horizon_year,
  round_even(dt, 3) AS delta_t_degC, round_even(alpha, 3) AS rainfall_alpha_pct_per_degC, round_even(rain_factor, 6) AS rainfall_factor, round_even(il_factor, 6) AS initial_loss_per_degree_factor,
  round_even(cl_factor, 6) AS continuing_loss_per_degree_factor, round_even(future_il, 2) AS future_initial_loss_mm, round_even(future_cl, 3) AS future_continuing_loss_mm_per_hr, round_even(il_change, 3) AS initial_loss_factor,
  round_even(cl_change, 3) AS continuing_loss_factor, round(future_least, 6) AS future_runoff_threshold_depth_mm, match_status, round_even(future_rate, 6) AS future_event_rate_per_year, round_even(future_ari, 3) AS future_ari_year,
  round_even(ratio, 3) AS frequency_ratio, round_even(change_pct, 1) AS frequency_change_pct FROM hazard)"""
#: Columns of the hazard table that have no decimals of their own; rounded so that both engines give the same digits.
PLAIN = ("current_runoff_threshold_depth_mm", "current_rainfall_shortfall_mm", "future_runoff_threshold_depth_mm")


def _plain(table, *names):
    return table.withColumns({c: F.round(c, 6) for c in names})


@query(f"WITH {IFD} SELECT * FROM ifd")
def h1_ifd_unpivot(spark, sf):
    return ifd(spark, sf)


@query(f"""WITH {IFD}, ranged AS (SELECT *, unnest(['very_frequent', 'ifds', 'rare']) AS design_range FROM ifd),
  kept AS (SELECT * FROM ranged WHERE NOT (design_range = 'very_frequent' AND event_rate_per_year < 1) AND NOT (design_range = 'ifds' AND event_rate_per_year < 0.01))
  SELECT point_id, duration_hours, event_rate_per_year, rainfall_depth_mm, design_range FROM kept
  QUALIFY row_number() OVER (PARTITION BY point_id, duration_hours, event_rate_per_year ORDER BY list_position(['very_frequent', 'ifds', 'rare'], design_range)) = 1""")
def h2_ifd_combine(spark, sf):
    table = ifd(spark, sf).drop("probability_label").withColumn("design_range", F.explode(F.array(*map(F.lit, flood.RANGES))))
    rate, kind = F.col("event_rate_per_year"), F.col("design_range")
    return flood.ifd_combine(table.where(~((kind == "very_frequent") & (rate < 1)) & ~((kind == "ifds") & (rate < 0.01))), ["point_id"])


@query(f"WITH {IFD} SELECT * FROM ifd WHERE duration_hours = 24")
def h3_ifd_for_duration(spark, sf):
    return flood.ifd_for_duration(ifd(spark, sf), 24.0000001)


@query(f"""WITH {IFD}, points AS (SELECT 'P' || s_suppkey AS point_id, 1.0::DOUBLE / (1 + s_suppkey % 90) AS rate FROM supplier),
  curve AS (SELECT point_id, event_rate_per_year AS r0, rainfall_depth_mm AS d0, lead(event_rate_per_year) OVER w AS r1, lead(rainfall_depth_mm) OVER w AS d1
    FROM ifd WHERE duration_hours = 24 WINDOW w AS (PARTITION BY point_id ORDER BY event_rate_per_year DESC))
  SELECT point_id, rate, round(d0 + (d1 - d0) * (ln(rate) - ln(r0)) / (ln(r1) - ln(r0)), 6) AS depth FROM points JOIN curve USING (point_id) WHERE rate <= r0 AND rate > r1""")
def h4_depth_at_rate(spark, sf):
    points = proxy.table(spark, sf, "supplier").select(F.concat(F.lit("P"), F.col("s_suppkey")).alias("point_id"), (1.0 / (1 + F.col("s_suppkey") % 90)).alias("rate"))
    done = flood.depth_at_rate(points, flood.ifd_for_duration(ifd(spark, sf), 24.0), ["point_id"], "rate", "depth")
    return done.withColumn("depth", F.round("depth", 6))


@query("""SELECT 'P' || s_suppkey AS point_id, CAST(2030 + s_suppkey % 71 AS INT) AS year, s.scenario, round((s_suppkey % 71 + 30) * s.slope, 6) AS delta_t
  FROM supplier, (VALUES ('ssp245', 0.02::DOUBLE), ('ssp370', 0.035::DOUBLE)) s(scenario, slope)""")
def h5_factor_at_year(spark, sf):
    points = proxy.table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), F.col("s_suppkey")).alias("point_id"), (2030 + F.col("s_suppkey") % 71).cast("int").alias("year"), F.explode(F.array(F.lit("ssp245"), F.lit("ssp370"))).alias("scenario"))
    return flood.factor_at_year(points, factors(spark, sf), "delta_t", "year", "delta_t").withColumn("delta_t", F.round("delta_t", 6))


@query("""SELECT 'P' || s_suppkey AS point_id, (2030 + s_suppkey % 71)::DOUBLE AS year, (s_suppkey % 40 / 1.0)::DOUBLE AS hours,
  round((2030 + s_suppkey % 71 - 2000) / 100.0::DOUBLE * greatest(1, least(24, s_suppkey % 40)), 6) AS factor FROM supplier""")
def h5b_table_rainfall_factor(spark, sf):
    key = F.col("s_suppkey")
    supplier = proxy.table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("P"), key).alias("point_id"))
    table = supplier.select("point_id", F.explode(F.array(F.lit(1.0), F.lit(6.0), F.lit(24.0))).alias("duration_hours")).withColumn("year", F.explode(F.sequence(F.lit(2030), F.lit(2100), F.lit(10))))
    table = table.withColumn("value", (F.col("year") - 2000) / 100.0 * F.col("duration_hours"))
    points = supplier.select("point_id", (2030 + key % 71).cast("double").alias("year"), (key % 40).cast("double").alias("hours"))
    return flood.table_rainfall_factor(points, table, ["point_id"], "year", "hours", "factor").withColumn("factor", F.round("factor", 6))


@query("""SELECT l_orderkey, l_linenumber, round(pow(1 + (15 - 7 * (greatest(1, least(24, l_quantity)) - 1) / 23) / 100, l_tax * 50), 8) AS factor FROM lineitem""")
def h6_rainfall_factor(spark, sf):
    return proxy.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(flood.rainfall_factor(F.col("l_quantity"), F.col("l_tax") * 50), 8).alias("factor"))


@query("SELECT p_partkey, CASE p_size WHEN 10 THEN 0.11 ELSE 1.0::DOUBLE / p_size END::DOUBLE AS rate FROM part")
def h7_reference_rate(spark, sf):
    return proxy.table(spark, sf, "part").select("p_partkey", flood.reference_rate(F.col("p_size").cast("double")).alias("rate"))


@query(f"""SELECT 'P' || s_suppkey AS point_id, CASE WHEN s_suppkey % 2 = 0 THEN 2.0 ELSE s_suppkey % 30 END::DOUBLE AS il, CASE WHEN s_suppkey % 2 = 0 THEN 0.0 ELSE (s_suppkey % 9) / 2.0 + {ODD} END::DOUBLE AS cl,
  round(CASE WHEN s_suppkey % 2 = 0 THEN 2.0 ELSE (s_suppkey % 30) * pow(1.05, 2) END::DOUBLE, 8) AS future_il FROM supplier""")
def h8_h9_losses(spark, sf):
    il, cl = flood.current_losses(F.col("context"), F.col("initial_loss_mm"), F.col("continuing_loss_mm_per_hr"))
    done = sites(spark, sf).join(losses(spark, sf).hint("merge"), "point_id").select("point_id", "context", il.alias("il"), cl.alias("cl"))
    return done.select("point_id", "il", "cl", F.round(flood.future_loss(F.col("context"), F.col("il"), F.lit(1.05), F.lit(2.0)), 8).alias("future_il"))


EVENTS = """events AS (SELECT p_partkey, p_retailprice / 20 AS depth, (1 + p_size % 24)::DOUBLE AS hours, (p_partkey % 40)::DOUBLE AS il, (p_partkey % 7) / 2.0::DOUBLE AS cl FROM part),
steps AS (SELECT *, unnest(range(1, 61))::INT AS timestep FROM events),
filled AS (SELECT *, depth / 60 AS rain, least(timestep * (depth / 60), il) - least((timestep - 1) * (depth / 60), il) AS taken, timestep * (depth / 60) >= il AS is_full FROM steps),
excess AS (SELECT *, least(CASE WHEN is_full THEN cl * hours / 60 ELSE 0 END, rain - taken) AS lost FROM filled)"""


def _events(spark, sf):
    key = F.col("p_partkey")
    return proxy.table(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") / 20).alias("depth"), (1 + F.col("p_size") % 24).cast("double").alias("hours"),
        (key % 40).cast("double").alias("initial_loss"), ((key % 7) / F.lit(2.0)).alias("continuing_loss"))


@query(f"WITH {EVENTS} SELECT p_partkey, timestep, round(taken, 6) AS initial_loss_mm, round(lost, 6) AS continuing_loss_mm, round(rain - taken - lost, 6) AS runoff_mm, is_full AS initial_loss_full FROM excess")
def h10_rainfall_excess(spark, sf):
    done = flood.rainfall_excess(_events(spark, sf))
    return done.select("p_partkey", "timestep", *(F.round(c, 6).alias(c) for c in ("initial_loss_mm", "continuing_loss_mm", "runoff_mm")), "initial_loss_full")


@query(f"WITH {EVENTS} SELECT p_partkey, abs(round(sum(rain - taken - lost), 5)) AS runoff FROM excess GROUP BY p_partkey")
def h11_total_runoff(spark, sf):
    c = [F.col(x) for x in ("depth", "hours", "initial_loss", "continuing_loss")]
    return _events(spark, sf).select("p_partkey", F.abs(F.round(flood.total_runoff(*c), 5)).alias("runoff"))


@query(f"WITH {EVENTS}, least AS ({_least_depth('events', 'p_partkey', 'hours', 'il', 'cl')}) SELECT p_partkey, round(least_depth, 6) AS least_depth, true AS reaches, true AS least FROM least")
def h12_min_depth(spark, sf):
    hours, il, cl = (F.col(x) for x in ("hours", "initial_loss", "continuing_loss"))
    depth = F.col("least_depth")
    done = _events(spark, sf).withColumn("least_depth", flood.min_depth_for_runoff(hours, il, cl))
    return done.select("p_partkey", F.round(depth, 6).alias("least_depth"), (flood.total_runoff(depth, hours, il, cl) >= 0.1 - 1e-9).alias("reaches"), (flood.total_runoff(depth - 1e-6, hours, il, cl) < 0.1).alias("least"))


@query(f"""WITH {HAZARD} SELECT point_id, duration_hr, scenario, horizon, horizon_year, event_rate_per_year, round(rainfall_depth_mm, 6) AS current_ifd_depth_mm, round(future_least, 6) AS future_runoff_threshold_depth_mm,
  round(future_depth, 6) AS future_rainfall_depth_mm, round(future_runoff, 6) AS future_runoff_mm, round(future_shortfall, 6) AS future_rainfall_shortfall_mm FROM curve""")
def h13_h14_future_runoff_curve(spark, sf):
    measures = ("current_ifd_depth_mm", "future_runoff_threshold_depth_mm", "future_rainfall_depth_mm", "future_runoff_mm", "future_rainfall_shortfall_mm")
    return _plain(_curve(spark, sf), *measures).select("point_id", "duration_hr", "scenario", "horizon", "horizon_year", "event_rate_per_year", *(F.abs(c).alias(c) for c in measures))


@query(f"WITH {HAZARD} SELECT point_id, duration_hr, current_ari_year, scenario, horizon, future_event_rate_per_year, match_status FROM rounded WHERE scenario <> 'historical'")
def h15_match_event_rate(spark, sf):
    return _hazard(spark, sf).where("scenario <> 'historical'").select("point_id", "duration_hr", "current_ari_year", "scenario", "horizon", "future_event_rate_per_year", "match_status")


@query("""SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount > 0 THEN 1 / l_discount END, 6) AS future_ari_year, round(CASE WHEN l_discount > 0 THEN l_discount / (l_tax + 0.01) END, 6) AS frequency_ratio,
  round(CASE WHEN l_discount > 0 THEN (l_discount / (l_tax + 0.01) - 1) * 100 END, 5) AS frequency_change_pct FROM lineitem""")
def h16_frequency_change(spark, sf):
    line = proxy.table(spark, sf, "lineitem").withColumns({"future_event_rate_per_year": F.col("l_discount"), "current_event_rate_per_year": F.col("l_tax") + 0.01}).withColumns(flood.frequency_change())
    return line.select("l_orderkey", "l_linenumber", F.round("future_ari_year", 6).alias("future_ari_year"), F.round("frequency_ratio", 6).alias("frequency_ratio"), F.round("frequency_change_pct", 5).alias("frequency_change_pct"))


@query("""SELECT 'P' || s_suppkey AS point_id, a.ari AS current_ari_year, a.ari AS future_ari_year, 1.0::DOUBLE AS frequency_ratio, 0.0::DOUBLE AS frequency_change_pct, CAST(2000 AS INT) AS horizon_year, 'baseline' AS horizon
  FROM supplier, (VALUES (1.0::DOUBLE), (10.0::DOUBLE), (50.0::DOUBLE), (100.0::DOUBLE)) a(ari)""")
def h17_historical_reference(spark, sf):
    return _hazard(spark, sf).where("scenario = 'historical'").select("point_id", "current_ari_year", "future_ari_year", "frequency_ratio", "frequency_change_pct", "horizon_year", "horizon")


@query(f"WITH {HAZARD} SELECT * FROM rounded")
def h18_flood_hazard(spark, sf):
    return _plain(_hazard(spark, sf), *PLAIN)


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity / 64, 2) AS duration_hr, round_even(l_quantity / 64, 1) AS frequency_change_pct FROM lineitem")
def h19_round_map(spark, sf):
    value = F.col("l_quantity") / 64
    return flood.round_hazard(proxy.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", value.alias("duration_hr"), value.alias("frequency_change_pct")))


@query(f"""WITH {HAZARD}, shown AS (SELECT * FROM rounded WHERE scenario <> 'historical' AND current_event_rate_per_year IS NOT NULL AND future_event_rate_per_year IS NOT NULL),
  several AS (SELECT context, count(DISTINCT point_id) > 1 AS many FROM shown GROUP BY context)
  SELECT shown.*, round((SELECT max(current_event_rate_per_year) * 1.05 FROM shown), 6) AS x_max, round((SELECT max(future_event_rate_per_year) * 1.05 FROM shown), 6) AS y_max,
    CASE context WHEN 'urban' THEN 'Urban' ELSE 'Rural' END || CASE WHEN many THEN ' (' || name || ')' ELSE '' END AS label FROM shown JOIN several USING (context)""")
def h20_flood_comparison(spark, sf):
    return _plain(flood.flood_comparison(_hazard(spark, sf)), *PLAIN, "x_max", "y_max")


@query(f"""WITH {HAZARD} SELECT 'hazard' AS sink, scenario, horizon, count(*) AS n, count(DISTINCT point_id) AS points, round(sum(future_event_rate_per_year), 4) AS total FROM rounded GROUP BY ALL
  UNION ALL SELECT 'hazard_csv', scenario, horizon, count(*), count(DISTINCT point_id), round(sum(future_event_rate_per_year), 4) FROM rounded GROUP BY ALL
  UNION ALL SELECT 'curves', scenario, horizon, count(*), count(DISTINCT point_id), round(sum(future_runoff), 4) FROM curve GROUP BY ALL""")
def s14_flood_sinks(spark, sf):
    """The three sinks as they are read back. Writing them again with other values changes nothing."""
    path = store.scratch(spark, "flood")
    hazard, curves = store.settle(_hazard(spark, sf), "hazard"), store.settle(_curve(spark, sf), "curves")
    store.write_flood(hazard, curves, path)
    store.write_flood(hazard.withColumn("future_event_rate_per_year", F.lit(0.0)), curves.withColumn("future_runoff_mm", F.lit(0.0)), path)
    read = {"hazard": spark.read.schema(hazard.schema).parquet(f"{path}/hazard"), "hazard_csv": spark.read.schema(hazard.schema).option("header", True).csv(f"{path}/hazard_csv"), "curves": spark.read.schema(curves.schema).parquet(f"{path}/curves")}
    done = [
        rows.groupBy(F.lit(name).alias("sink"), "scenario", "horizon").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("point_id").alias("points"), F.round(F.sum("future_runoff_mm" if name == "curves" else "future_event_rate_per_year"), 4).alias("total"))
        for name, rows in read.items()
    ]
    return done[0].unionByName(done[1]).unionByName(done[2])
