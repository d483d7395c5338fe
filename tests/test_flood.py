"""Flood operators against step loops, bisection and numpy's interpolation."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclim.operators import flood


def loop(depth, hours, il, cl, n=60):
    """Steps of uniform rain one by one."""
    left, total = max(0.0, il), 0.0
    for _ in range(n):
        rain = depth / n
        taken = min(left, rain)
        left -= taken
        full = left <= 1e-12
        total += max(0.0, rain - taken - (cl * hours / n if full else 0.0)) if full else rain - taken
    return total


def cases(n, seed):
    r = random.Random(seed)
    return [(i, r.choice([0.0, r.uniform(0, 120)]), r.choice([1.0, 24.0, 0.5]), r.choice([0.0, r.uniform(0.1, 60)]), r.choice([0.0, r.uniform(0, 5)])) for i in range(n)]


SCHEMA = "i int, depth double, hours double, initial_loss double, continuing_loss double"
NAMES = ("depth", "hours", "initial_loss", "continuing_loss")


def columns():
    return [F.col(c) for c in NAMES]


def test_closed_form_and_steps_give_the_same_runoff(spark):
    rows = cases(500, 1)
    events = spark.createDataFrame(rows, SCHEMA)
    closed = {r.i: r.x for r in events.select("i", flood.total_runoff(*columns()).alias("x")).collect()}
    steps = flood.rainfall_excess(events)
    balance = steps.groupBy("i").agg(F.sum("rainfall_mm").alias("rain"), F.sum(F.col("initial_loss_mm") + F.col("continuing_loss_mm") + F.col("runoff_mm")).alias("parts"), F.sum("runoff_mm").alias("runoff"))
    for r in balance.collect():
        assert r.rain == pytest.approx(r.parts, abs=1e-8)
        assert r.runoff == pytest.approx(closed[r.i], abs=1e-8)
    for i, *c in rows:
        assert closed[i] == pytest.approx(loop(*c), abs=1e-6)


def test_runoff_rises_with_depth_and_falls_with_losses(spark):
    rows = spark.createDataFrame(cases(300, 2), SCHEMA)
    d, h, il, cl = columns()
    got = rows.select(flood.total_runoff(d, h, il, cl).alias("x"), flood.total_runoff(d + 5, h, il, cl).alias("deep"), flood.total_runoff(d, h, il + 3, cl).alias("lost")).collect()
    assert all(r.deep >= r.x - 1e-9 and r.lost <= r.x + 1e-9 for r in got)


def test_least_depth(spark):
    rows = spark.createDataFrame(cases(100, 3), SCHEMA)
    for r in rows.select("*", flood.min_depth_for_runoff(*columns()[1:]).alias("x")).collect():
        assert loop(r.x + 1e-9, r.hours, r.initial_loss, r.continuing_loss) >= 0.1 - 1e-6
        assert loop(r.x - 1e-6, r.hours, r.initial_loss, r.continuing_loss) < 0.1


def test_durations_match_within_the_tolerance(spark):
    sites = spark.createDataFrame([("P", "rural")], "point_id string, context string")
    losses = spark.createDataFrame([("P", 5.0, 1.0)], "point_id string, initial_loss_mm double, continuing_loss_mm_per_hr double")
    ifd = spark.createDataFrame([("P", h, r, d) for h in (1.0, 24.0000001) for r, d in ((1.0, 20.0 * h), (0.1, 40.0 * h), (0.01, 60.0 * h))], "point_id string, duration_hours double, event_rate_per_year double, rainfall_depth_mm double")
    durations = spark.createDataFrame([("rural", 24.0)], "context string, duration_hr double")
    event = flood.current_events(sites, ifd, losses, durations, spark.createDataFrame([(1.0,)], "current_ari_year double")).first()
    assert event.duration_hr == 24.0 and event.current_rainfall_depth_mm == pytest.approx(480.0, abs=1e-4)
    with pytest.raises(PySparkException, match="outside the design table"):
        far = durations.withColumn("duration_hr", F.lit(24.01))
        flood.current_events(sites, ifd, losses, far, spark.createDataFrame([(1.0,)], "current_ari_year double")).collect()


def test_headers_are_parsed_once(spark):
    wide = spark.createDataFrame([("P", "1 hr", "1,000.5", "-3", "x", "7", 1), ("P", "60 min", "5", "4", "2", "7", 0)], "point_id string, duration string, `1 EY` string, `10%` string, `1 in 200` string, remark string, rank int")
    got = {(r.duration_hours, r.event_rate_per_year): (r.rainfall_depth_mm, r.probability_label) for r in flood.ifd_unpivot(wide, ["point_id"], rank="rank").collect()}
    assert got == {(1.0, 1.0): (5.0, "1 EY"), (1.0, 0.11): (4.0, "10%"), (1.0, 0.005): (2.0, "1 in 200")}
    with pytest.raises(ValueError):
        flood.ifd_unpivot(wide.select("point_id", "duration", "remark"), ["point_id"])


def test_factors_and_rates(spark):
    row = spark.range(1).select(
        flood.rainfall_alpha(F.lit(1.0)).alias("a1"), flood.rainfall_alpha(F.lit(24.0)).alias("a24"), flood.rainfall_alpha(F.lit(0.2)).alias("low"),
        flood.reference_rate(F.lit(10.0)).alias("r10"), flood.reference_rate(F.lit(50.0)).alias("r50")).first()
    assert (row.a1, row.a24, row.low, row.r10, row.r50) == (15.0, 8.0, 15.0, 0.11, 0.02)
    with pytest.raises(PySparkException):
        spark.range(1).select(flood.reference_rate(F.lit(0.0))).collect()


def test_match_by_runoff_and_by_shortfall(spark):
    keys = ["k"]
    curve = [("a", 10.0 ** -i, 0.5 * 3.0**i, 40.0 / (i + 1)) for i in range(4)] + [("b", 1.0, 2.0, 3.0)]
    events = [("a", 5.0, 1.0), ("a", 0.01, 15.0), ("a", 99.0, 1.0), ("a", 0.01, 900.0), ("a", 0.0, 0.0), ("b", 1.0, 1.0), ("b", 0.0, 1.0), ("a", None, 1.0), ("a", 13.5, 0.0)]
    c = spark.createDataFrame(curve, "k string, event_rate_per_year double, future_runoff_mm double, future_rainfall_shortfall_mm double")
    e = spark.createDataFrame([(i, *x) for i, x in enumerate(events)], "i int, k string, current_runoff_mm double, current_rainfall_shortfall_mm double")
    got = {r.i: r for r in flood.match_event_rate(e, c, keys).collect()}
    assert [got[i].match_status for i in range(9)] == [
        "matched_loglog_runoff", "matched_loglog_shortfall", "current_runoff_outside_future_curve", "current_shortfall_outside_future_curve",
        "invalid_current_rainfall_shortfall", "insufficient_positive_future_runoff_curve", "insufficient_positive_future_shortfall_curve", "invalid_current_runoff", "matched_loglog_runoff"]
    a = sorted((x, r) for k, r, x, _ in curve if k == "a")
    want = 10 ** np.interp(math.log10(5), np.log10([x for x, _ in a]), np.log10([r for _, r in a]))
    assert got[0].future_event_rate_per_year == pytest.approx(want)
    s = sorted((x, r) for k, r, _, x in curve if k == "a")
    want = 10 ** np.interp(math.log10(15), np.log10([x for x, _ in s]), np.log10([r for _, r in s]))
    assert got[1].future_event_rate_per_year == pytest.approx(want)
    assert got[8].future_event_rate_per_year == pytest.approx(1e-3)  # the last knot itself


def test_hazard_rows_follow_from_each_other(spark):
    from gridclim.plans import floods

    rows = floods.h18_flood_hazard(spark, "/root/testdata/sf0.001").toPandas()
    past, future = rows[rows.scenario == "historical"], rows[rows.scenario != "historical"]
    assert (past.frequency_ratio == 1).all() and (past.frequency_change_pct == 0).all() and set(past.horizon) == {"baseline"}
    assert set(future.horizon) == {"mid_term", "long_term"}
    assert (future[future.context == "urban"].initial_loss_factor == 1).all()
    hit = future[future.match_status.str.startswith("matched")]
    assert len(hit) and (abs(hit.frequency_ratio - hit.future_event_rate_per_year / hit.current_event_rate_per_year) < 2e-3 + 1e-4 * hit.frequency_ratio).all()


def test_the_column_of_durations_is_found(spark):
    rows = [(i, f"site {i}", "x" if i < 3 else f"{i} hr", f"{i + 1} hr", str(10.0 - i)) for i in range(6)]
    wide = spark.createDataFrame(rows, "pos int, name string, note string, `Storm length` string, `1 EY` string")
    assert flood.duration_column(wide.drop("note"), ["pos"]) == "Storm length"
    assert flood.duration_column(wide, [], "pos") == "note"  # the first column with two durations
    plain = flood.ifd_unpivot(wide.drop("note", "name"), ["pos"]).collect()
    moved = flood.ifd_unpivot(wide.select("pos", "1 EY", "Storm length"), ["pos"]).collect()
    assert sorted(plain) == sorted(moved) and {r.duration_hours for r in plain} == {1.0, 2.0, 3.0, 4.0, 5.0, 6.0}
    late = spark.createDataFrame([(i, "-" if i < 19 else f"{i} hr") for i in range(40)], "pos int, v string")
    with pytest.raises(ValueError, match="no column of durations"):
        flood.duration_column(late, ["pos"], "pos")  # one among the first twenty


def test_what_is_not_there_is_an_error_if_asked_for(spark):
    ifd = spark.createDataFrame([("P", 1.0, 0.1, 5.0), ("P", 24.0, 0.1, 9.0)], "point_id string, duration_hours double, event_rate_per_year double, rainfall_depth_mm double")
    assert flood.ifd_for_duration(ifd, 24.0).count() == 1
    with pytest.raises(PySparkException, match="a duration of 2 hours is not in the design table, which has 1.0, 24.0"):
        flood.ifd_for_duration(ifd, 2.0).collect()
    factors = spark.createDataFrame([("P", "delta_t", "ssp245", y, y / 1000.0) for y in (2030, 2050)], "point_id string, kind string, scenario string, year int, value double")
    points = spark.createDataFrame([("P", "ssp245", y) for y in (2040.0, 2060.0)], "point_id string, scenario string, year double")
    assert [r.v is None for r in flood.factor_at_year(points, factors, "delta_t", "year", "v").orderBy("year").collect()] == [False, True]
    with pytest.raises(PySparkException, match="outside the table of factors: 2060"):
        flood.factor_at_year(points, factors, "delta_t", "year", "v", strict=True).collect()


def test_a_curve_without_shortfalls(spark):
    curve = spark.createDataFrame([("a", 10.0**-i, 0.5 * 3.0**i) for i in range(4)], "k string, event_rate_per_year double, future_runoff_mm double")
    events = spark.createDataFrame([(0, "a", 5.0, 1.0), (1, "a", 0.0, 1.0), (2, "a", 0.0, 0.0)], "i int, k string, current_runoff_mm double, current_rainfall_shortfall_mm double")
    got = {r.i: r.match_status for r in flood.match_event_rate(events, curve, ["k"]).collect()}
    assert got == {0: "matched_loglog_runoff", 1: "missing_future_rainfall_shortfall", 2: "invalid_current_rainfall_shortfall"}


def test_few_events_are_dealt_out_before_they_become_many_rows(spark):
    events = spark.range(64).coalesce(1).selectExpr("id", "30.0D depth", "1.0D hours", "2.0D initial_loss", "0.5D continuing_loss")
    assert flood.rainfall_excess(events).select(F.spark_partition_id().alias("p")).distinct().count() > 1
    wide = spark.range(64).coalesce(1).selectExpr("id", "'60 min' duration", "'5.0' `50%`", "'9.0' `10%`")
    long = flood.ifd_unpivot(wide, ["id"], "duration")
    assert "RoundRobin" in long._jdf.queryExecution().executedPlan().toString() and long.count() == 128


def test_tables_by_site_are_not_broadcast(spark):
    from gridclim.plans import floods

    sf = "/root/testdata/sf0.001"
    for name in ("_curve", "h4_depth_at_rate", "h5_factor_at_year", "h5b_table_rainfall_factor", "_hazard"):
        plan = getattr(floods, name)(spark, sf)._jdf.queryExecution().executedPlan().toString()
        hashed = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
        assert "SortMergeJoin" in plan and all("context#" in line for line in hashed), name  # the durations of a context alone
        assert name != "_curve" or "BroadcastNestedLoopJoin BuildLeft" not in plan


def test_what_the_sinks_are_made_of_is_not_broadcast(spark):
    from gridclim.plans import floods

    sf = "/root/testdata/sf0.001"
    windows, scenarios, durations, aris = floods._dimensions(spark)
    events = flood.current_events(floods.sites(spark, sf), floods.ifd(spark, sf), floods.losses(spark, sf), durations, aris)
    regimes = flood.future_regimes(events, floods.factors(spark, sf), windows, scenarios)
    made = {"events": events, "regimes": regimes, "curve": flood.future_runoff_curve(regimes, floods.ifd(spark, sf)), "historical": flood.historical_rows(events, windows)}
    for name, rows in made.items():
        lines = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Broadcast" in line and "Join" in line]
        assert lines and not [line for line in lines if "BuildLeft" in line or "HashJoin [point_id" in line], name
