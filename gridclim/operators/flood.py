"""Flood-frequency screening: design rainfall, losses, runoff, and the future rate of a present event.

Sites, regimes and events take little room for the work they make, so that Spark reads them in a few tasks: they are dealt out before
they are multiplied or matched. For the same reason the planner takes tables made of few columns for small, and would bring them to the
driver: tables by site are merged, and the tables of windows, scenarios, durations and recurrence intervals, whose size it doesn't know, are
broadcast."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridclim.functions import labels
from gridclim.operators.grid import dealt
from gridclim.operators.guards import some_rows
from gridclim.operators.interp import curves, interpolate, value_at
from gridclim.plans.request import flood_window_valid
from gridclim.sources import store

RUNOFF_MATCH_MM = 0.1
STEPS = 60
RANGES = ("very_frequent", "ifds", "rare")
# Decimals of the hazard table.
DECIMALS = {
    "duration_hr": 2, "current_ari_year": 3, "current_event_rate_per_year": 6, "current_rainfall_depth_mm": 2, "current_initial_loss_mm": 2,
    "current_continuing_loss_mm_per_hr": 3, "current_runoff_mm": 2, "delta_t_degC": 3, "rainfall_alpha_pct_per_degC": 3, "rainfall_factor": 6,
    "initial_loss_per_degree_factor": 6, "continuing_loss_per_degree_factor": 6, "initial_loss_factor": 3, "continuing_loss_factor": 3,
    "future_initial_loss_mm": 2, "future_continuing_loss_mm_per_hr": 3, "future_event_rate_per_year": 6, "future_ari_year": 3, "frequency_ratio": 3, "frequency_change_pct": 1,
}


#: Values that are looked at to find the column of durations, and how many of them must be durations.
SNIFFED, LEAST_DURATIONS = 20, 2


def duration_column(wide: DataFrame, keys: list[str], order: str | None = None) -> str:
    """The first column, besides the keys, with two durations or more among its first 20 values that are not null. One aggregate looks at
    all columns; `order` is the column that tells what comes first, else rows count as they are read."""
    found = [c for c in wide.columns if c not in {*keys, order}]
    pos = F.col(f"`{order}`") if order else F.monotonically_increasing_id()
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(found)))) if found else F.lit(None)
    values = wide.select(pos.alias("_pos"), each.alias("_e")).select("_pos", "_e.i", "_e.v").where("v is not null")
    first = values.withColumn("_n", F.row_number().over(W.partitionBy("i").orderBy("_pos", "v"))).where(F.col("_n") <= SNIFFED)
    durations = first.groupBy("i").agg(F.count(labels.parse_duration_hours(F.col("v"))).alias("n")).where(F.col("n") >= LEAST_DURATIONS)
    place = durations.agg(F.min("i").alias("i")).first()["i"]
    if place is None:
        raise ValueError(f"no column of durations among {found}")
    return found[place]


def ifd_unpivot(wide: DataFrame, keys: list[str], duration: str | None = None, rank: str | None = None) -> DataFrame:
    """A wide design table -> keys, duration_hours, event_rate_per_year, rainfall_depth_mm, probability_label. Columns whose
    names are no probability go, and so do values that are no number or negative; of equal durations and rates the one of the lowest rank
    stays. The column of durations is found by its values if it is not named."""
    duration = duration or duration_column(wide, keys, rank)
    held = [c for c in wide.columns if c not in {*keys, duration, rank}]
    spark = wide.sparkSession
    # the headers are parsed once, not in every row: as many as the table has columns
    named = spark.createDataFrame([(c,) for c in held], "name string").select("name", labels.parse_event_rate(F.col("name")).alias("rate"))
    rates = {r["name"]: r["rate"] for r in named.collect() if r["rate"] is not None}
    extra = [rank] if rank else []
    if not rates:
        raise ValueError("no column's name is a probability")
    each = F.explode(F.array(*(F.struct(F.lit(rate).alias("rate"), F.lit(c).alias("label"), F.col(f"`{c}`").cast("string").alias("depth")) for c, rate in rates.items())))
    long = dealt(wide).select(*keys, duration, *extra, each.alias("_e"))
    made = long.select(
        *keys, labels.parse_duration_hours(F.col(duration)).alias("duration_hours"), F.col("_e.rate").alias("event_rate_per_year"),
        labels.parse_number(F.col("_e.depth")).alias("rainfall_depth_mm"), F.col("_e.label").alias("probability_label"), *extra,
    ).where("duration_hours is not null and rainfall_depth_mm >= 0")
    w = W.partitionBy(*keys, "duration_hours", "event_rate_per_year").orderBy(*([rank] if rank else []), "probability_label")
    return made.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", *([rank] if rank else []))


def ifd_combine(ifd: DataFrame, keys: list[str]) -> DataFrame:
    """ifd(design_range, ...) with each duration and rate once: very frequent before ordinary before rare."""
    order = F.array_position(F.array(*map(F.lit, RANGES)), F.col("design_range"))
    w = W.partitionBy(*keys, "duration_hours", "event_rate_per_year").orderBy(order)
    return ifd.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def ifd_for_duration(ifd: DataFrame, hours: Column | float) -> DataFrame:
    """Rows of a duration, to a millionth of an hour; where there are none, an error tells which durations there are."""
    there = F.array_join(F.transform(F.array_sort(F.collect_set("duration_hours")), lambda h: h.cast("string")), ", ")
    asked = "the duration" if isinstance(hours, Column) else f"a duration of {hours:g} hours"
    message = F.concat(F.lit(f"{asked} is not in the design table, which has "), F.coalesce(F.nullif("there", F.lit("")), F.lit("none")))
    return some_rows(ifd.where(F.abs(F.col("duration_hours") - hours) < 1e-6), message, ifd.agg(there.alias("there")))


def depth_at_rate(points: DataFrame, ifd: DataFrame, keys: list[str], rate: str, name: str, strict: bool = True) -> DataFrame:
    """Depth at a rate, linear in the logarithm of the rate; outside the table an error, or null if not strict."""
    curve = ifd.where("event_rate_per_year > 0").select(*keys, F.log("event_rate_per_year").alias("_x"), F.col("rainfall_depth_mm").alias("_y"))
    done = interpolate(points.withColumn("_at", F.log(rate)), curve, keys, "_at", "_x", "_y", name).drop("_at")
    if strict:
        done = done.withColumn(name, F.coalesce(name, F.raise_error(F.lit("the event rate is outside the design table")).cast("double")))
    return done


def _within(rows: DataFrame, name: str, year: str, strict: bool) -> DataFrame:
    """rows; with strict a year without a value is an error."""
    wrong = F.raise_error(F.concat(F.lit("the year is outside the table of factors: "), F.col(year).cast("string"))).cast("double")
    return rows.withColumn(name, F.when(F.col(name).isNull() & F.col(year).isNotNull(), wrong).otherwise(F.col(name))) if strict else rows


def factor_at_year(points: DataFrame, factors: DataFrame, kind: str, year: str, name: str, strict: bool = False) -> DataFrame:
    """factors(point_id, kind, scenario, year, value) at a year, linear between years; outside null, or an error if strict."""
    curve = factors.where(F.col("kind") == kind).select("point_id", "scenario", F.col("year").cast("double").alias("_x"), F.col("value").alias("_y"))
    return _within(interpolate(points, curve, ["point_id", "scenario"], year, "_x", "_y", name), name, year, strict)


def table_rainfall_factor(points: DataFrame, table: DataFrame, keys: list[str], year: str, hours: str, name: str, strict: bool = False) -> DataFrame:
    """table(keys, duration_hours, year, value): along the years of each duration first, then along the durations,
    whose ends hold beyond them. Outside the years null, or an error if strict."""
    durations = table.select(*keys, "duration_hours").distinct()
    each = points.select(*keys, year).distinct().join(durations.hint("merge"), keys)
    by_year = interpolate(each, table, [*keys, "duration_hours"], year, "year", "value", "_v")
    ends = durations.groupBy(*keys).agg(F.min("duration_hours").alias("_lo"), F.max("duration_hours").alias("_hi"))
    held = points.join(ends.hint("merge"), keys, "left").withColumn("_h", F.greatest("_lo", F.least("_hi", hours)))
    return _within(interpolate(held, by_year, [*keys, year], "_h", "duration_hours", "_v", name), name, year, strict).drop("_lo", "_hi", "_h")


def rainfall_alpha(hours: Column) -> Column:
    """Percent a degree: 15 at 1 hour, 8 at 24 hours, linear between and held beyond."""
    return 15.0 - 7.0 * (F.greatest(F.lit(1.0), F.least(F.lit(24.0), hours)) - 1.0) / 23.0


def rainfall_factor(hours: Column, delta_t: Column) -> Column:
    return F.pow(1.0 + rainfall_alpha(hours) / 100.0, delta_t)


def reference_rate(ari: Column) -> Column:
    """Events a year for a recurrence interval; the 10-year event has 0.11, as in the design tables."""
    near = lambda y: F.abs(ari - y) <= 1e-9
    rate = F.when(near(1.0), 1.0).when(near(10.0), 0.11).when(near(100.0), 0.01).otherwise(1.0 / ari)
    return F.when(ari > 0, rate).otherwise(F.raise_error(F.lit("a recurrence interval must be greater than zero")).cast("double"))


def current_losses(context: Column, initial: Column, continuing: Column, urban_initial: float = 2.0, urban_continuing: float = 0.0) -> tuple[Column, Column]:
    urban = context == "urban"
    return F.when(urban, F.lit(urban_initial)).otherwise(initial), F.when(urban, F.lit(urban_continuing)).otherwise(continuing)


def future_loss(context: Column, loss: Column, per_degree: Column, delta_t: Column) -> Column:
    """Urban losses stay; rural ones compound by the degree."""
    return F.when(context == "urban", loss).otherwise(loss * F.pow(per_degree, delta_t))


def rainfall_excess(events: DataFrame, steps: int = STEPS) -> DataFrame:
    """events(depth, hours, initial_loss, continuing_loss, ...) -> a row per step of uniform rain: the initial loss fills
    first; from the step that fills it on, a step loses the whole continuing loss of its length."""
    rain, il = F.col("depth") / steps, F.greatest(F.col("initial_loss"), F.lit(0.0))
    k = F.col("timestep")
    filled = lambda n: F.least(n * rain, il)
    taken = filled(k) - filled(k - 1)
    full = k * rain >= il
    capacity = F.when(full, F.col("continuing_loss") * F.col("hours") / steps).otherwise(0.0)
    lost = F.least(capacity, rain - taken)
    made = dealt(events).withColumn("timestep", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    return made.withColumns({
        "time_start_hr": (k - 1) * F.col("hours") / steps, "time_end_hr": k * F.col("hours") / steps, "rainfall_mm": rain, "initial_loss_mm": taken,
        "continuing_loss_mm": lost, "runoff_mm": rain - taken - lost, "remaining_initial_loss_mm": il - filled(k),
        "continuing_loss_capacity_mm": capacity, "initial_loss_full": full,
    })


def total_runoff(depth: Column, hours: Column, initial: Column, continuing: Column, steps: int = STEPS) -> Column:
    """The sum of rainfall_excess(), in closed form."""
    rain, cut = depth / steps, continuing * hours / steps
    later = F.greatest(F.lit(0.0), rain - cut)
    k = F.ceil(initial / F.nullif(rain, F.lit(0.0)))
    after = F.when(k > steps, 0.0).otherwise(F.greatest(F.lit(0.0), k * rain - initial - cut) + (steps - k) * later)
    return F.when(depth <= 0, 0.0).when(initial <= 0, steps * later).otherwise(after)


def min_depth_for_runoff(hours: Column, initial: Column, continuing: Column, target: float = RUNOFF_MATCH_MM, steps: int = STEPS) -> Column:
    """The least depth with that runoff: total_runoff() solved for the depth.

    With r the rain of a step, c its continuing loss and I the initial loss, runoff grows with r without jumps; where step k fills
    the initial loss, it is max(0, k r - I - c) + (n - k) (r - c). At r = I / k it is (n - k) (I / k - c), which falls as k
    rises; solving that for the target gives k, a quadratic's lesser root, and then one of the two straight pieces gives r.
    """
    n, t = float(steps), float(target)
    il, c = F.when(initial < 0, 0.0).otherwise(initial), continuing * hours / n
    b = il + n * c + t
    # the lesser root in the form that holds for c = 0 too
    root = 2 * n * il / (b + F.sqrt(F.greatest(F.lit(0.0), b * b - 4 * n * c * il)))
    k = F.least(F.lit(n), F.greatest(F.lit(1.0), F.ceil(root - 1e-9)))
    corner = (il + c) / k  # from here on the filling step itself runs off
    late = (t + il + c * (n + 1 - k)) / n
    early = c + t / F.nullif(n - k, F.lit(0.0))
    rain = F.when(early <= corner, early).otherwise(late)
    return n * F.when(il <= 0, c + t / n).otherwise(rain)


def shortfall(threshold: Column, depth: Column) -> Column:
    """The depth that an event lacks to reach the runoff threshold."""
    return F.greatest(F.lit(0.0), threshold - depth)


KINDS = {"delta_t": "delta_t_degC", "il": "_il", "cl": "_cl"}
REGIME = ["point_id", "duration_hr", "scenario", "horizon"]


def future_runoff_curve(regimes: DataFrame, ifd: DataFrame, steps: int = STEPS) -> DataFrame:
    """A row per design rate of each regime (site, duration, scenario, horizon): made once, whatever the events are."""
    table = ifd.select(F.col("point_id").alias("_p"), "duration_hours", "event_rate_per_year", F.col("rainfall_depth_mm").alias("current_ifd_depth_mm"))
    joined = dealt(regimes, "point_id").join(table.hint("merge"), (F.col("point_id") == F.col("_p")) & (F.abs(F.col("duration_hr") - F.col("duration_hours")) < 1e-6))
    depth = F.col("current_ifd_depth_mm") * F.col("rainfall_factor")
    runoff = total_runoff(F.col("future_rainfall_depth_mm"), F.col("duration_hr"), F.col("future_initial_loss_mm"), F.col("future_continuing_loss_mm_per_hr"), steps)
    return joined.drop("_p", "duration_hours").withColumn("future_rainfall_depth_mm", depth).withColumns({
        "future_runoff_mm": runoff, "future_rainfall_shortfall_mm": shortfall(F.col("future_runoff_threshold_depth_mm"), F.col("future_rainfall_depth_mm")),
    })


def match_event_rate(events: DataFrame, curve: DataFrame, keys: list[str] = REGIME) -> DataFrame:
    """events with future_event_rate_per_year and match_status: on runoff where it reaches the threshold, else on shortfall,
    both as straight lines between logarithms. A curve may lack the column of shortfalls, which is a status of its own."""
    on_runoff = F.col("current_runoff_mm") >= RUNOFF_MATCH_MM

    def side(measure: str, name: str) -> DataFrame:
        logs = curve.where((F.col("event_rate_per_year") > 0) & (F.col(measure) > 0))
        return curves(logs.withColumns({"_x": F.log10(measure), "_y": F.log10("event_rate_per_year")}), keys, "_x", "_y", name)

    short = "future_rainfall_shortfall_mm"
    told = short in curve.columns
    held = dealt(events, *keys).join(side("future_runoff_mm", "_r").hint("merge"), keys, "left")
    held = held.join(side(short, "_s").hint("merge"), keys, "left") if told else held.withColumn("_s", F.lit(None).cast("array<struct<x: double, y: double>>"))
    found = held.withColumns({
        "_at_s": F.when(~on_runoff & (F.col("current_rainfall_shortfall_mm") > 0), F.log10("current_rainfall_shortfall_mm")),
    })
    found = found.withColumns({
        "_log_r": F.when(on_runoff, value_at(F.col("_r"), F.log10("current_runoff_mm"))), "_log_s": value_at(F.col("_s"), F.col("_at_s")),
    })
    few = lambda c: c.isNull() | (F.size(c) < 2)
    status = (
        F.when(F.col("current_runoff_mm").isNull() | F.isnan("current_runoff_mm"), "invalid_current_runoff")
        .when(on_runoff & few(F.col("_r")), "insufficient_positive_future_runoff_curve")
        .when(on_runoff & F.col("_log_r").isNull(), "current_runoff_outside_future_curve")
        .when(on_runoff, "matched_loglog_runoff")
        .when(F.col("_at_s").isNull(), "invalid_current_rainfall_shortfall")
        .when(F.lit(not told), "missing_future_rainfall_shortfall")
        .when(few(F.col("_s")), "insufficient_positive_future_shortfall_curve")
        .when(F.col("_log_s").isNull(), "current_shortfall_outside_future_curve").otherwise("matched_loglog_shortfall")
    )
    rate = F.pow(F.lit(10.0), F.coalesce("_log_r", "_log_s"))
    return found.withColumns({"match_status": status, "future_event_rate_per_year": rate}).drop("_at_s", "_log_r", "_log_s", "_r", "_s")


def frequency_change(rate: str = "future_event_rate_per_year", current: str = "current_event_rate_per_year") -> dict[str, Column]:
    """Recurrence interval, ratio and percentage, null where the future rate is no positive number."""
    ok = F.col(rate).isNotNull() & (F.col(rate) > 0) & (F.col(rate) < float("inf"))
    ratio = F.when(ok, F.col(rate) / F.col(current))
    return {"future_ari_year": F.when(ok, 1.0 / F.col(rate)), "frequency_ratio": ratio, "frequency_change_pct": (ratio - 1.0) * 100.0}


def round_hazard(table: DataFrame) -> DataFrame:
    return table.withColumns({c: labels.round_even(F.col(c), n) for c, n in DECIMALS.items() if c in table.columns})


def current_events(sites: DataFrame, ifd: DataFrame, losses: DataFrame, durations: DataFrame, aris: DataFrame, steps: int = STEPS) -> DataFrame:
    """sites x durations(context, duration_hr) x aris(current_ari_year) with present rate, depth, losses, runoff and shortfall."""
    il, cl = current_losses(F.col("context"), F.col("initial_loss_mm"), F.col("continuing_loss_mm_per_hr"))
    held = sites.join(F.broadcast(durations), "context").join(losses.hint("merge"), "point_id", "left")
    made = dealt(held, "point_id", "duration_hr").crossJoin(F.broadcast(aris))
    made = made.withColumns({"current_event_rate_per_year": reference_rate(F.col("current_ari_year")), "current_initial_loss_mm": il, "current_continuing_loss_mm_per_hr": cl})
    # a table's duration and an event's are matched once, within the tolerance; the event's is the key from here on
    asked = made.select(F.col("point_id").alias("_p"), "duration_hr").distinct()
    tables = ifd.join(asked.hint("merge"), (F.col("point_id") == F.col("_p")) & (F.abs(F.col("duration_hours") - F.col("duration_hr")) < 1e-6)).drop("_p")
    made = depth_at_rate(made, tables, ["point_id", "duration_hr"], "current_event_rate_per_year", "current_rainfall_depth_mm")
    hours, il, cl = F.col("duration_hr"), F.col("current_initial_loss_mm"), F.col("current_continuing_loss_mm_per_hr")
    return made.drop("initial_loss_mm", "continuing_loss_mm_per_hr").withColumns({
        "current_runoff_mm": total_runoff(F.col("current_rainfall_depth_mm"), hours, il, cl, steps),
        "current_runoff_threshold_depth_mm": min_depth_for_runoff(hours, il, cl, steps=steps), "current_runoff_threshold_mm": F.lit(RUNOFF_MATCH_MM),
    }).withColumn("current_rainfall_shortfall_mm", shortfall(F.col("current_runoff_threshold_depth_mm"), F.col("current_rainfall_depth_mm")))


def future_regimes(events: DataFrame, factors: DataFrame, windows: DataFrame, scenarios: DataFrame, steps: int = STEPS) -> DataFrame:
    """Site, duration, scenario and horizon with temperature, rainfall and loss factors and the future runoff threshold."""
    sites = events.select("point_id", "context", "duration_hr", "current_initial_loss_mm", "current_continuing_loss_mm_per_hr").distinct()
    made = sites.crossJoin(F.broadcast(windows)).crossJoin(F.broadcast(scenarios.where("scenario <> 'historical'"))).where(flood_window_valid(F.col("scenario"), F.col("end_year")))
    made = dealt(made, "point_id", "scenario")
    made = made.withColumn("horizon_year", labels.representative_year(F.col("start_year"), F.col("end_year")))
    found = curves(factors, ["point_id", "scenario", "kind"], "year", "value", "_curve").groupBy("point_id", "scenario").agg(
        *(F.max_by("_curve", F.when(F.col("kind") == kind, 1)).alias(f"_{kind}_curve") for kind in KINDS))
    made = made.join(found.hint("merge"), ["point_id", "scenario"], "left").withColumns({
        name: value_at(F.col(f"_{kind}_curve"), F.col("horizon_year")) for kind, name in KINDS.items()
    }).drop(*(f"_{kind}_curve" for kind in KINDS))
    urban, dt, hours = F.col("context") == "urban", F.col("delta_t_degC"), F.col("duration_hr")
    made = made.withColumns({
        "rainfall_alpha_pct_per_degC": rainfall_alpha(hours), "rainfall_factor": rainfall_factor(hours, dt),
        "initial_loss_per_degree_factor": F.when(urban, 1.0).otherwise(F.col("_il")), "continuing_loss_per_degree_factor": F.when(urban, 1.0).otherwise(F.col("_cl")),
        "future_initial_loss_mm": future_loss(F.col("context"), F.col("current_initial_loss_mm"), F.col("_il"), dt),
        "future_continuing_loss_mm_per_hr": future_loss(F.col("context"), F.col("current_continuing_loss_mm_per_hr"), F.col("_cl"), dt),
    }).drop("_il", "_cl")
    made = made.withColumns({"initial_loss_factor": F.pow("initial_loss_per_degree_factor", dt), "continuing_loss_factor": F.pow("continuing_loss_per_degree_factor", dt)})
    depth = min_depth_for_runoff(hours, F.col("future_initial_loss_mm"), F.col("future_continuing_loss_mm_per_hr"), steps=steps)
    return made.withColumn("future_runoff_threshold_depth_mm", depth)


def historical_rows(events: DataFrame, windows: DataFrame) -> DataFrame:
    """Present events under historical windows: nothing changes, so all factors are one and the change is zero."""
    made = events.crossJoin(F.broadcast(windows.where(flood_window_valid(F.lit("historical"), F.col("end_year")))))
    one = dict.fromkeys(("rainfall_factor", "initial_loss_per_degree_factor", "continuing_loss_per_degree_factor", "initial_loss_factor", "continuing_loss_factor", "frequency_ratio"), F.lit(1.0))
    return made.withColumns({
        "scenario": F.lit("historical"), "horizon_year": labels.representative_year(F.col("start_year"), F.col("end_year")), "delta_t_degC": F.lit(0.0),
        "rainfall_alpha_pct_per_degC": rainfall_alpha(F.col("duration_hr")), **one, "future_initial_loss_mm": F.col("current_initial_loss_mm"),
        "future_continuing_loss_mm_per_hr": F.col("current_continuing_loss_mm_per_hr"), "future_runoff_threshold_depth_mm": F.col("current_runoff_threshold_depth_mm"),
        "future_event_rate_per_year": F.col("current_event_rate_per_year"), "future_ari_year": F.col("current_ari_year"), "frequency_change_pct": F.lit(0.0),
        "match_status": F.lit("historical_reference"),
    })


def flood_hazard(sites: DataFrame, ifd: DataFrame, factors: DataFrame, losses: DataFrame, windows: DataFrame, scenarios: DataFrame, durations: DataFrame, aris: DataFrame, steps: int = STEPS) -> DataFrame:
    """The whole screening: a row per site, duration, event, scenario and horizon, rounded. Design tables, events and regimes
    are used more than once, so they are written in between."""
    ifd = store.settle(ifd, "ifd")
    events = store.settle(current_events(sites, ifd, losses, durations, aris, steps), "events")
    regimes = store.settle(future_regimes(events, factors, windows, scenarios, steps), "regimes")
    curve = store.settle(future_runoff_curve(regimes, ifd, steps), "curve")
    shared = [c for c in ("context", "current_initial_loss_mm", "current_continuing_loss_mm_per_hr") if c in regimes.columns]
    asked = events.join(regimes.drop(*shared).hint("merge"), ["point_id", "duration_hr"])
    future = match_event_rate(asked, curve).withColumns(frequency_change())
    made = round_hazard(future.unionByName(historical_rows(events, windows), allowMissingColumns=True))
    return some_rows(made, "no flood results: no site has a design table, losses and factors for the events asked for")


def flood_comparison(hazard: DataFrame, padding: float = 0.05) -> DataFrame:
    """What a comparison chart shows: future rows with finite rates, shared axis ends, and labels that name the site
    where its context has several."""
    future = hazard.where((F.col("scenario") != "historical") & F.col("current_event_rate_per_year").isNotNull() & F.col("future_event_rate_per_year").isNotNull())
    ends = future.agg(*(F.coalesce(F.max(c) * (1 + padding), F.lit(1.0)).alias(n) for c, n in (("current_event_rate_per_year", "x_max"), ("future_event_rate_per_year", "y_max"))))
    several = future.groupBy("context").agg((F.count_distinct("point_id") > 1).alias("_several"))
    label = F.when(F.col("_several"), F.concat_ws(" ", F.initcap("context"), F.concat(F.lit("("), "name", F.lit(")")))).otherwise(F.initcap("context"))
    # one row of ends, and a row for each context
    return future.join(F.broadcast(several), "context").crossJoin(F.broadcast(ends)).withColumn("label", label).drop("_several")
