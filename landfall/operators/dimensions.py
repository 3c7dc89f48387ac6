"""The four dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import lenient as L
from landfall.functions.codes import RACE_COLUMNS
from landfall.operators.lookups import CodeList, decode, keep_listed

CITY_MEASURES = [
    "median_age", "percent_male_population", "percent_female_population",
    "percent_veterans", "percent_foreign_born",
]


def city_shares(cities: DataFrame) -> DataFrame:
    """City rows with counts turned into percentages of the city's total."""
    total = "Total Population"
    return cities.select(
        "State",
        F.col("`State Code`").alias("state_code"),
        L.as_float32("Median Age").alias("median_age"),
        L.percent_of("Male Population", total).alias("percent_male_population"),
        L.percent_of("Female Population", total).alias("percent_female_population"),
        L.percent_of("Number of Veterans", total).alias("percent_veterans"),
        L.percent_of("Foreign-born", total).alias("percent_foreign_born"),
        "Race",
        L.percent_of("Count", total).alias("percent_race"),
    )


def pivot_races(shares: DataFrame) -> DataFrame:
    """One row per state and set of city measures, one column per race.

    The city is no key: cities of a state with equal measures merge. Listing the
    races spares the extra job that would look them up.
    """
    wide = (
        shares.groupBy("State", "state_code", *CITY_MEASURES)
        .pivot("Race", list(RACE_COLUMNS))
        .agg(F.avg("percent_race"))
    )
    return wide.withColumnsRenamed(RACE_COLUMNS)


def average_by_state(wide: DataFrame) -> DataFrame:
    """Unweighted mean over the cities of a state, at one decimal."""
    measures = CITY_MEASURES + list(RACE_COLUMNS.values())
    return wide.groupBy("State", "state_code").agg(
        *[L.round1(F.avg(name)).alias(name) for name in measures]
    )


def dim_demographics(cities: DataFrame) -> DataFrame:
    return average_by_state(pivot_races(city_shares(cities)))


def dim_temperature(
    temperatures: DataFrame, states: CodeList, year=2013, country="United States", aliases=None
) -> DataFrame:
    """Monthly state temperatures of one year, for states whose upper-case name is listed.

    ``states`` is keyed by label (``reverse_labels``). ``aliases`` is an optional
    second list of other spellings, also (name, code).
    """
    chosen = temperatures.where(F.col("Country") == country).where(
        L.in_year(temperatures, "dt", year)
    )
    name = F.upper("State")
    if aliases is None:
        coded = decode(chosen, name, states, "state_abbreviations", on_unknown="drop")
    else:
        coded = decode(chosen, name, states, "_listed")
        coded = decode(coded, name, aliases, "_alias")
        coded = coded.withColumn("state_abbreviations", F.coalesce("_listed", "_alias")).where(
            "state_abbreviations IS NOT NULL"
        )
    day = L.as_date("dt")
    return coded.select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        L.round1(L.as_double("AverageTemperature")).alias("avg_temp_celcius"),
        L.round1(L.fahrenheit("AverageTemperature")).alias("avg_temp_fahrenheit"),
        "state_abbreviations",
        "State",
        "Country",
    ).dropDuplicates()


def average_elevation(airports: DataFrame, code_length=2) -> DataFrame:
    """Mean elevation by country and region, unrounded."""
    return airports.groupBy(
        F.col("iso_country").alias("country"),
        L.region_suffix("iso_region", code_length).alias("state"),
    ).agg(F.avg(L.as_float32("elevation_ft")).alias("avg_elevation_ft"))


def dim_airport(
    airports: DataFrame, kind="small_airport", country="US", code_length=2
) -> DataFrame:
    chosen = airports.where(F.col("type") == kind).where(F.col("iso_country") == country)
    return average_elevation(chosen, code_length).withColumn(
        "avg_elevation_ft", L.round1("avg_elevation_ft")
    )


def listed_admissions(
    i94: DataFrame, states: CodeList, cities: CodeList, trim_keys=True
) -> DataFrame:
    """Admissions whose state and port are listed; needs only these two columns.

    A frame that still has to be joined should pass here first, so that dropped
    rows never reach the shuffle.
    """
    kept = i94.where(F.col("i94addr").isNotNull())
    kept = keep_listed(kept, lookup_key("i94addr", trim_keys), states)
    return keep_listed(kept, lookup_key("i94port", trim_keys), cities)


def known_admissions(
    i94: DataFrame, states: CodeList, cities: CodeList, trim_keys=True
) -> DataFrame:
    """Admissions with a residence whose state and port are listed."""
    return listed_admissions(i94.where(F.col("i94res").isNotNull()), states, cities, trim_keys)


def dim_immigration(
    i94: DataFrame,
    states: CodeList,
    cities: CodeList,
    countries: CodeList,
    on_unknown="null",
    trim_keys=True,
) -> DataFrame:
    """One row per kept admission with its codes spelled out."""
    given = i94.where("i94addr IS NOT NULL AND i94res IS NOT NULL")
    # the decode joins drop what is not listed: three list joins, not five
    return spell_out(given, states, cities, countries, on_unknown, trim_keys, unlisted="drop")


def spell_out(
    known: DataFrame,
    states: CodeList,
    cities: CodeList,
    countries: CodeList,
    on_unknown="null",
    trim_keys=True,
    unlisted="null",
) -> DataFrame:
    """The immigration dimension from admissions that passed ``known_admissions``.

    ``unlisted="drop"`` takes others too and leaves out those with an unlisted state or port.
    """
    rows = decode(known, lookup_key("i94addr", trim_keys), states, "dest_state_name", unlisted)
    rows = decode(rows, lookup_key("i94port", trim_keys), cities, "city_port_name", unlisted)
    rows = decode(rows, L.code_key("i94res"), countries, "origin_country", on_unknown)
    return rows.select(
        "cicid",
        L.as_int("i94yr").alias("year"),
        L.as_int("i94mon").alias("month"),
        "origin_country",
        "i94port",
        "city_port_name",
        lookup_key("i94addr", trim_keys).alias("state_code"),
        "dest_state_name",
    )


def lookup_key(column, trim_keys):
    return F.trim(column) if trim_keys else F.col(column)
