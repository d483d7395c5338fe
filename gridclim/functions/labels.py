"""Names, labels and calendar parts as column expressions, and parsers of the labels that tables come with."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASONS = ("DJF", "MAM", "JJA", "SON")
STORM_DAYS = r"(?i)^StormDaysGT\d+(p\d+)?$"


#: Fixed values, as names of outputs depend on them: by style the signs of which a run becomes `_`, what is stripped from both ends, and
#: the name where nothing is left.
NAME_RULES = {
    "feature": (r'[<>:"/\\|?*]+|\s+', "._", "feature"),
    "unnamed": (r'[<>:"/\\|?*]+|\s+', "._", "unnamed"),
    "layer": ("[^0-9A-Za-z]+", "_", "layer"),
    "file": ("[^A-Za-z0-9._-]+", "_", ""),
}
LONGEST_LAYER = 60


def safe_name(value: Column, style: str = "feature") -> Column:
    """A name that is safe in paths and columns, by NAME_RULES.

    feature, unnamed: reserved signs and blanks become `_`; file: anything but letters, digits and `._-` does; layer: anything but
    letters and digits, at most 60 signs, never a digit first; series: blanks, slashes and colons replaced one by one.
    """
    if style == "series":
        return F.translate(F.trim(value.cast("string")), " /\\:", "_---")
    if style not in NAME_RULES:
        raise ValueError(f"unknown style {style!r}")
    runs, ends, empty = NAME_RULES[style]
    name = F.regexp_replace(F.regexp_replace(value.cast("string"), runs, "_"), f"^[{ends}]+|[{ends}]+$", "")
    name = F.when(name != "", name).when(name == "", F.lit(empty))
    if style == "layer":
        name = F.left(F.concat(F.when(name.rlike("^[0-9]"), "v_").otherwise(""), name), F.lit(LONGEST_LAYER))
    return name


def storm_index_name(threshold_kmh: Column) -> Column:
    """StormDaysGT89; a fraction of up to three digits is written with p: StormDaysGT70p5."""
    text = F.format_string("%.3f", threshold_kmh.cast("double"))
    text = F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")
    return F.concat(F.lit("StormDaysGT"), F.replace(text, F.lit("."), F.lit("p")))


def round_even(value: Column, places: int) -> Column:
    """value rounded half to even as numpy and the SQL do: what is rounded is the product with the power of ten, so that a double next to a
    half counts as one where the product is. What is rounded to zero keeps its sign."""
    scale = F.lit(10.0**places)
    near = F.rint(value * scale) / scale
    return F.when(F.abs(near) == float("inf"), value.cast("double")).otherwise(near)  # the product of a very large value has no place


def round_output(value: Column, variable: Column) -> Column:
    """Three decimals for storm days and one for all else, half to even; what is rounded to zero keeps its sign."""
    return F.when(variable.rlike(STORM_DAYS), round_even(value, 3)).otherwise(round_even(value, 1))


def output_decimals(variable: Column) -> Column:
    return F.when(variable.rlike(STORM_DAYS), F.lit(3)).otherwise(F.lit(1))


def representative_year(start_year: Column, end_year: Column) -> Column:
    """The middle year, half to even: 1985-2014 gives 2000."""
    return F.bround((start_year + end_year) / F.lit(2.0), 0).cast("int")


def representative_year_floor(start_year: Column, end_year: Column) -> Column:
    return F.floor((start_year + end_year) / F.lit(2)).cast("int")


def horizon_label(name: Column, start_year: Column, end_year: Column) -> Column:
    """name (year); the name alone where the years are unknown."""
    year = representative_year(start_year, end_year)
    return F.when(year.isNotNull(), F.format_string("%s (%d)", name, year)).otherwise(name)


def horizon_label_long(name: Column, start_year: Column, end_year: Column) -> Column:
    """name (start-end; mid=year)."""
    return F.format_string("%s (%d-%d; mid=%d)", name, start_year, end_year, representative_year(start_year, end_year))


def season(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SEASONS)), (F.floor((month % 12) / 3) + 1).cast("int"))


def season_year(year: Column, month: Column) -> Column:
    """December belongs to the summer of the next year."""
    return (year + (month == 12).cast("int")).cast("int")


def analysis_period(frequency: str, year: Column, month: Column | None = None, season_name: Column | None = None) -> Column:
    """2001-07, 2001-DJF or 2001."""
    if frequency == "Monthly":
        return F.format_string("%d-%02d", year, month)
    if frequency == "Seasonal":
        return F.format_string("%d-%s", year, season_name)
    return F.format_string("%d", year)


def analysis_time(frequency: str, year: Column, month: Column | None = None, season_name: Column | None = None) -> Column:
    """The first of a month, the 15th of a season's middle month, or the first of July."""
    if frequency == "Monthly":
        return F.make_date(year, month, F.lit(1))
    if frequency == "Seasonal":
        middle = sum((F.when(season_name == s, 3 * i + 2).otherwise(0) for i, s in enumerate(SEASONS)), F.lit(0))
        return F.make_date(year, middle, F.lit(15))
    return F.make_date(year, F.lit(7), F.lit(1))


def parse_number(text: Column) -> Column:
    """The first signed number, commas aside."""
    return _try_double(F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"(-?\d+(?:\.\d+)?)", 1))


def _try_double(text: Column) -> Column:
    return text.try_cast("double")


#: A quantity in a label, `1 in 200` or a number with a unit after it: groups 1 and 4 are the unit, 2 and 3 the number.
QUANTITY = r"1\s*(in|/)\s*(\d+(?:\.\d+)?)|(\d+(?:\.\d+)?)[^0-9a-z%]*(min|hour|hr|day|ey|%)"

# A unit of time in hours, as a factor and a divisor; percent chance in a year -> events a year, as the design tables use them.
HOURS_OF = {"min": (1.0, 60.0), "hour": (1.0, 1.0), "hr": (1.0, 1.0), "day": (24.0, 1.0)}
RATE_OF_PERCENT = {63.2: 1.0, 50.0: 0.5, 20.0: 0.2, 10.0: 0.11, 5.0: 0.05, 2.0: 0.02, 1.0: 0.01}


def quantity(label: Column) -> tuple[Column, Column]:
    """Number and unit of the first quantity in a label, whatever stands around it; nulls where there is none."""
    part = lambda group: F.nullif(F.regexp_extract(F.lower(label), QUANTITY, group), F.lit(""))
    return _try_double(F.coalesce(part(2), part(3))), F.coalesce(part(1), part(4))


def _by_unit(unit: Column, made: dict[str, Column]) -> Column:
    return F.coalesce(*(F.when(unit == name, value) for name, value in made.items()))


def parse_duration_hours(text: Column) -> Column:
    """`30 min`, `1 hour`, `3 hr`, `2 days` in hours; null where no unit is found. Of several durations the first counts."""
    number, unit = quantity(text)
    return _by_unit(unit, {name: number * times / parts for name, (times, parts) in HOURS_OF.items()})


def parse_event_rate(label: Column) -> Column:
    """`12EY` is a rate, `1 in 200` its inverse, percentages go by the table of RATE_OF_PERCENT; else null. Of several the first counts."""
    number, unit = quantity(label)
    inverse = 1.0 / F.nullif(number, F.lit(0.0))
    percent = F.try_element_at(F.create_map(*(F.lit(x) for pair in RATE_OF_PERCENT.items() for x in pair)), F.round(number, 6))
    return _by_unit(unit, {"ey": number, "in": inverse, "/": inverse, "%": percent})


def poisson_event_rate(percent: Column) -> Column:
    """Events a year for a chance of at least one, in percent."""
    return -F.log1p(-percent / 100.0)


def scenario_label(scenario: Column) -> Column:
    """ssp245 -> SSP2-4.5; other names stay."""
    return F.when(scenario.rlike("^ssp[0-9]{3}$"), F.concat(F.lit("SSP"), F.substring(scenario, 4, 1), F.lit("-"), F.substring(scenario, 5, 1), F.lit("."), F.substring(scenario, 6, 1))).otherwise(scenario)


def pixel_id(lon: Column, lat: Column) -> Column:
    return F.format_string("%.6f_%.6f", lon, lat)


def map_title(variable: Column, stat: Column, scenario: Column, start_year: Column, end_year: Column, change: Column) -> Column:
    """TXge35 | Change in Mean | SSP245 | 2040-2059."""
    shown = F.when(F.lower(scenario).startswith("ssp"), F.upper(scenario)).otherwise(F.initcap(scenario))
    said = F.concat(F.when(change, "Change in ").otherwise(""), F.initcap(stat))
    return F.concat_ws(" | ", variable, said, shown, F.format_string("%d-%d", start_year, end_year))


def period_label(start_year: Column, end_year: Column) -> Column:
    """2050s and 2090s for the usual horizons, else the years."""
    return F.when(start_year.between(2035, 2059), "2050s").when(start_year >= 2070, "2090s").otherwise(
        F.when(start_year.isNotNull() & end_year.isNotNull(), F.format_string("%d–%d", start_year, end_year)).otherwise("future projection")
    )
