"""Arrival counts and the fact.

Counting comes first: admissions shrink to one row per (year, month, origin,
state), with partial sums on the map side, before any label or dimension is
joined. The sums are taken again over the final columns, so the result equals
joining first and counting after, also when two codes share a label or a
dimension repeats a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import lenient as L
from landfall.operators.dimensions import known_admissions, lookup_key
from landfall.operators.lookups import CodeList, decode, keep_listed
from landfall.session import settle

CODE_KEYS = ["year", "month", "origin_code", "state_code"]
COUNT_KEYS = ["year", "month", "origin_country", "dest_state_name", "state_code"]
CONTEXT = [
    "avg_temp_fahrenheit", "avg_elevation_ft", "percent_foreign_born", "native_american",
    "asian", "hispanic_or_latino", "black", "white",
]


def counts_by_code(
    i94: DataFrame, states: CodeList, cities: CodeList, trim_keys=True
) -> DataFrame:
    """Kept admissions per (year, month, origin code, state code) as ``arrivals``."""
    if states.is_small and cities.is_small:
        return count_codes(known_admissions(i94, states, cities, trim_keys), trim_keys)
    # Lists too big to broadcast meet the counted rows, never the raw ones.
    port = lookup_key("i94port", trim_keys).alias("port_code")
    return listed_counts(count_codes(addressed(i94), trim_keys, port), states, cities, trim_keys)


def addressed(i94: DataFrame) -> DataFrame:
    """Admissions that could count under some code lists: with an address and a residence."""
    return i94.where("i94addr IS NOT NULL AND i94res IS NOT NULL")


def listed_counts(
    counted: DataFrame, states: CodeList, cities: CodeList, trim_keys=True
) -> DataFrame:
    """Counts by code and port, restricted to listed states and ports, without the port."""
    counted = counted.withColumns(
        {name: lookup_key(name, trim_keys) for name in ("state_code", "port_code")}
    )
    counted = keep_listed(counted, F.col("state_code"), states)
    return add_up(keep_listed(counted, F.col("port_code"), cities), CODE_KEYS)


def count_codes(known: DataFrame, trim_keys=True, *more) -> DataFrame:
    """Arrivals per set of codes, for admissions that passed ``known_admissions``."""
    return known.groupBy(
        L.as_int("i94yr").alias("year"),
        L.as_int("i94mon").alias("month"),
        L.code_key("i94res").alias("origin_code"),
        lookup_key("i94addr", trim_keys).alias("state_code"),
        *more,
    ).agg(F.count(F.lit(1)).alias("arrivals"))


def name_counts(
    counts: DataFrame, states: CodeList, countries: CodeList, on_unknown="null"
) -> DataFrame:
    """Labels for the codes of ``counts_by_code``."""
    named = decode(counts, F.col("origin_code"), countries, "origin_country", on_unknown)
    named = decode(named, F.col("state_code"), states, "dest_state_name")
    return named.select(*COUNT_KEYS, "arrivals")


def arrival_counts(
    i94: DataFrame,
    states: CodeList,
    cities: CodeList,
    countries: CodeList,
    on_unknown="null",
    trim_keys=True,
) -> DataFrame:
    counts = counts_by_code(i94, states, cities, trim_keys)
    return name_counts(counts, states, countries, on_unknown)


def count_dimension(immigration: DataFrame) -> DataFrame:
    """The same counts from the row-level immigration dimension."""
    return immigration.groupBy(*COUNT_KEYS).agg(F.count("state_code").alias("arrivals"))


def add_up(counts: DataFrame, keys) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("arrivals").alias("arrivals"))


def merge_counts(*counts: DataFrame) -> DataFrame:
    """One set of counts from those of several extracts or earlier runs."""
    every = reduce(DataFrame.unionByName, counts)
    return add_up(every, [name for name in every.columns if name != "arrivals"])


def join_temperature(rows: DataFrame, temperature: DataFrame) -> DataFrame:
    """By state and calendar month; the temperature's own year plays no part."""
    side = temperature.select(
        F.col("state_abbreviations").alias("state_code"), "month", "avg_temp_fahrenheit"
    )
    return rows.join(side, ["state_code", "month"])


def join_demographics(rows: DataFrame, demographics: DataFrame) -> DataFrame:
    return rows.join(demographics.select("state_code", *CONTEXT[2:]), "state_code")


def join_airport(rows: DataFrame, airport: DataFrame) -> DataFrame:
    side = airport.select(F.col("state").alias("state_code"), "avg_elevation_ft")
    return rows.join(side, "state_code")


def star_join(
    rows: DataFrame, temperature: DataFrame, demographics: DataFrame, airport: DataFrame
) -> DataFrame:
    joined = join_temperature(rows, temperature)
    return join_airport(join_demographics(joined, demographics), airport)


def fact_arrivals(
    counts: DataFrame, temperature: DataFrame, demographics: DataFrame, airport: DataFrame
) -> DataFrame:
    """The fact from arrival counts and the dimensions."""
    joined = star_join(counts, temperature, demographics, airport)
    return fact_columns(add_up(joined, COUNT_KEYS + CONTEXT))


def fact_joined_first(
    immigration: DataFrame, temperature: DataFrame, demographics: DataFrame, airport: DataFrame
) -> DataFrame:
    """The fact as plain join and count over the row-level dimension, to compare with."""
    joined = star_join(immigration, temperature, demographics, airport)
    counted = joined.groupBy(*COUNT_KEYS, *CONTEXT).agg(F.count("state_code").alias("arrivals"))
    return fact_columns(counted)


def order_fact(counts: DataFrame, temperature, demographics, airport) -> DataFrame:
    """The fact sorted by origin and state code, the code itself not shown."""
    joined = star_join(counts, temperature, demographics, airport)
    summed = add_up(joined, COUNT_KEYS + CONTEXT)
    return fact_columns(summed.orderBy("origin_country", "state_code"))


def rank_fact(summed: DataFrame) -> DataFrame:
    """Rows in order, with ``position``: the place by origin, state code, year, month, measures.

    One range shuffle sorts the rows; the settled partitions are then counted, and a row's
    place is its number within its partition after the rows of the partitions before.
    Only one count per partition reaches the driver.
    """
    order = ["origin_country", "state_code", "year", "month", "dest_state_name", *CONTEXT]
    place = F.monotonically_increasing_id()  # partition << 33 | row within it
    ranged = settle(
        summed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    )
    part = F.shiftright("_place", 33)
    sizes = sorted(tuple(r) for r in ranged.groupBy(part).agg(F.count(F.lit(1))).collect())
    before, offsets = 0, []
    for number, n in sizes:
        offsets.append((number, before))
        before += n
    offsets = summed.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn("position", F.col("_before") + inside + 1)
        .select(*summed.columns, "position")
    )


def fact_columns(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "year",
        F.col("month").alias("immigration_month"),
        F.col("origin_country").alias("immigration_origin"),
        F.col("dest_state_name").alias("to_immigration_state"),
        F.col("arrivals").alias("to_immigration_state_count"),
        *CONTEXT,
        *more,
    )
