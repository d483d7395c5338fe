"""The summary workflow: what is chosen, what is complete, and the baseline beside it."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridclim.plans.workflows import spatial_summary

RASTER = "variable string, scenario string, horizon string, source_feature string, stat string, px int, py int, value double, west double, north double, res double"
BASE, MID, LATE = ("historical", "baseline"), ("ssp245", "mid_term"), ("ssp370", "long_term")
SHIFT = {BASE: 0.0, MID: 2.0, LATE: 5.0}


def rasters(spark, kinds=(BASE, MID, LATE), variables=("pr", "tas"), stats=("min", "mean", "max"), sources=("ID1", "ID2")):
    rows = [
        (v, *k, s, t, px, 0, 10.0 * px + SHIFT[k] + ("min", "mean", "max").index(t), 0.0, 1.0, 1.0)
        for v in variables for k in kinds for s in sources for t in stats for px in range(3)
    ]
    return spark.createDataFrame(rows, RASTER)


def points(spark):
    return spark.createDataFrame([("a", 0.5, 0.5, "left", 1), ("b", 2.5, 0.5, "right", 2)], "feature_id string, lon double, lat double, name string, scenario int")


def squares(spark):
    ring = lambda w: [[(w, 0.1), (w + 0.5, 0.1), (w + 0.5, 0.9), (w, 0.9)]]
    return spark.createDataFrame([("a", ring(0.2), "left"), ("b", ring(2.2), "right")], "feature_id string, rings array<array<struct<x double, y double>>>, name string")


@pytest.mark.parametrize("mode", ["point", "polygon"])
def test_choosing_a_future_leaves_its_changes(spark, mode):
    places = points(spark) if mode == "point" else squares(spark)
    done = spatial_summary(rasters(spark), places, mode, scenarios=["ssp245"], variables=["pr"], source_feature_ids=["ID2"], keep_fields=["name"])
    got = sorted((r.variable, r.scenario, r.horizon, r.source_feature, r.feature_id, r.name, r.min, r.baseline_mean, r.change_max, r.n_pixels) for r in done.collect())
    assert got == [("pr", *MID, "ID2", "a", "left", 2.0, 1.0, 2.0, 1), ("pr", *MID, "ID2", "b", "right", 22.0, 21.0, 2.0, 1)]


def test_all_is_chosen_by_default_and_horizons_choose(spark):
    every = spatial_summary(rasters(spark), points(spark), "point").collect()
    assert len(every) == 2 * 3 * 2 * 2 and {r.change_min for r in every if r.scenario == "historical"} == {0.0}
    late = spatial_summary(rasters(spark), points(spark), "point", horizons=["long_term"])
    assert {(r.scenario, r.change_mean) for r in late.collect()} == {("ssp370", 5.0)}


def test_combinations_that_lack_a_statistic_are_left_out(spark):
    lame = rasters(spark).where("not (scenario = 'ssp370' and variable = 'tas' and stat = 'mean')").unionByName(rasters(spark, variables=("pr_Change",)))
    whole = spatial_summary(lame, points(spark), "point")
    assert {(r.variable, r.scenario) for r in whole.collect()} == {(v, s) for v in ("pr", "tas") for s in ("historical", "ssp245", "ssp370")} - {("tas", "ssp370")}
    few = spatial_summary(lame, points(spark), "point", include_mean=False)
    assert ("tas", "ssp370") in {(r.variable, r.scenario) for r in few.collect()} and not {"mean", "baseline_mean", "change_mean"} & set(few.columns)


def test_a_variable_without_a_baseline_has_no_change(spark):
    some = rasters(spark).where("not (scenario = 'historical' and variable = 'tas')")
    done = spatial_summary(some, points(spark), "point", scenarios=["ssp245"]).collect()
    assert {(r.variable, r.change_mean) for r in done} == {("pr", 2.0), ("tas", None)}


def test_nothing_left_is_an_error(spark):
    futures = rasters(spark, kinds=(MID, LATE))
    with pytest.raises(PySparkException, match="for the baseline, historical baseline"):
        spatial_summary(futures, points(spark), "point").collect()
    assert spatial_summary(futures, points(spark), "point", calculate_change=False).count() == 2 * 2 * 2 * 2
    for choice in ({"scenarios": ["ssp585"]}, {"variables": ["hail"]}, {"source_feature_ids": []}):
        with pytest.raises(PySparkException, match="no combination of variable"):
            spatial_summary(rasters(spark), points(spark), "point", **choice).agg(F.sum("min")).collect()
    with pytest.raises(PySparkException, match="has all of max, mean, min"):
        spatial_summary(rasters(spark, stats=("min", "max")), squares(spark)).collect()


def test_baseline_and_futures_come_from_one_run(spark):
    done = spatial_summary(rasters(spark), squares(spark))
    assert "Generate" not in done._jdf.queryExecution().executedPlan().toString()  # pixels have met the features before
    assert done.count() == 2 * 3 * 2 * 2
