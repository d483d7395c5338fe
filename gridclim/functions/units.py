"""Unit conversions as column expressions; an unknown unit raises when its row is read."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, lower case, with ** written as ^.
KELVIN = ("k", "kelvin", "degrees_k", "degree_k")
CELSIUS = ("c", "°c", "degc", "degree_celsius", "degrees_celsius", "degree celsius", "degrees celsius")
PRECIP_FLUX = ("kg m-2 s-1", "kg m^-2 s^-1", "kg/m2/s", "mm s-1", "mm s^-1", "mm/s")
PRECIP_DAILY = ("mm", "mm d-1", "mm day-1", "mm/day", "mm d^-1", "mm day^-1", "kg m-2 d-1", "kg m^-2 d^-1")
WIND = ("m s-1", "m s^-1", "m/s")
SECONDS_A_DAY = 86400


def _unit(units: Column) -> Column:
    return F.replace(F.lower(F.trim(units)), F.lit("**"), F.lit("^"))


def _unknown(what: str, units: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"unsupported {what} units: "), F.coalesce(units, F.lit("null")))).cast("double")


def precip_to_mm_day(value: Column, units: Column) -> Column:
    """Fluxes become daily amounts; daily amounts stay."""
    u, v = _unit(units), value.cast("double")
    return F.when(u.isin(*PRECIP_FLUX), v * SECONDS_A_DAY).when(u.isin(*PRECIP_DAILY), v).otherwise(_unknown("precipitation", units))


def temp_to_celsius(value: Column, units: Column) -> Column:
    u, v = _unit(units), value.cast("double")
    return F.when(u.isin(*KELVIN), v - 273.15).when(u.isin(*CELSIUS), v).otherwise(_unknown("temperature", units))


def wind_threshold_ms(threshold_kmh: Column, units: Column) -> Column:
    """A threshold in km/h as metres a second, the unit of the wind data; it must be positive."""
    checked = F.when(threshold_kmh > 0, threshold_kmh.cast("double") / 3.6).otherwise(
        F.raise_error(F.lit("the threshold must be greater than zero")).cast("double")
    )
    return F.when(_unit(units).isin(*WIND), checked).otherwise(_unknown("wind", units))
