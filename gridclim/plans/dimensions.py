"""The small tables that requests are planned with."""

from pyspark.sql import DataFrame, SparkSession

# Variables, their frequency, how months are made of them, the scenarios that have them, and the threshold in km/h of a derived index.
ALL = ("historical", "ssp126", "ssp245", "ssp370")
VARIABLES = (
    ("prAdjust", "day", "sum", ALL, None), ("tasmaxAdjust", "day", "mean", ALL, None), ("tasminAdjust", "day", "mean", ALL, None), ("TXge35", "yr", "mean", ALL, None),
    ("TNlt2", "yr", "mean", ALL, None), ("FFDIgt50", "yr", "mean", ALL, None), ("R20mm", "yr", "mean", ALL, None), ("R99p", "yr", "mean", ALL, None),
    ("SPI12", "mon", "mean", ALL[1:], None), ("sfcWindmax", "day", "mean", ALL, 89.0),
)
GCMS = ("ACCESS-ESM1-5", "EC-Earth3-Veg", "MPI-ESM1-2-HR", "NorESM2-MM", "UKESM1-0-LL")
RCMS = ("R3", "R5")


def variable_spec(spark: SparkSession) -> DataFrame:
    rows = [(n, f, h, list(s), t) for n, f, h, s, t in VARIABLES]
    return spark.createDataFrame(rows, "variable string, frequency string, how string, available_scenarios array<string>, threshold_kmh double")


def models(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g, r) for g in GCMS for r in RCMS], "gcm string, rcm string")


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s,) for s in ALL], "scenario string")
