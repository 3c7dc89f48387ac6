"""Queries on joins, aggregations, the dimensions, the fact and its checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import lenient as L
from landfall.operators import dimensions, facts, lookups, quality
from landfall.operators.sizes import small_side
from landfall.plans import shapes
from landfall.plans.catalog import query
from landfall.session import scratch_path, settle
from landfall.sources import readers, tables
from landfall.streaming.increments import add_increment, saved_counts

# The first day of the second extract in the incremental queries.
SPLIT_DAY = "2000-01-01"


@query(
    "count_by_group",
    ["counts"],
    "SELECT year, month, origin_country, state_code, arrivals FROM counts",
)
def count_by_group(spark, sf):
    return shapes.counts(spark, sf).drop("dest_state_name")


@query(
    "join_state_month",
    ["counts", "temperature_d"],
    """SELECT c.year, c.month, origin_country, state_code, arrivals, avg_temp_fahrenheit
       FROM counts c JOIN temperature_d t
         ON t.state_abbreviations = state_code AND t.month = c.month""",
)
def join_state_month(spark, sf):
    joined = facts.join_temperature(shapes.counts(spark, sf), shapes.temperature(spark, sf))
    return joined.select(
        "year", "month", "origin_country", "state_code", "arrivals", "avg_temp_fahrenheit"
    )


@query(
    "join_demographics",
    ["counts", "demographics_d"],
    """SELECT year, month, origin_country, c.state_code, arrivals, percent_foreign_born,
              native_american, asian, hispanic_or_latino, black, white
       FROM counts c JOIN demographics_d d ON d.state_code = c.state_code""",
)
def join_demographics(spark, sf):
    joined = facts.join_demographics(shapes.counts(spark, sf), shapes.demographics(spark, sf))
    return joined.drop("dest_state_name")


@query(
    "join_airport",
    ["counts", "airport_d"],
    """SELECT year, month, origin_country, state_code, arrivals, avg_elevation_ft
       FROM counts JOIN airport_d a ON a.state = state_code""",
)
def join_airport(spark, sf):
    joined = facts.join_airport(shapes.counts(spark, sf), shapes.airport(spark, sf))
    return joined.drop("dest_state_name")


@query(
    "star_join",
    ["star"],
    "SELECT * FROM star",
)
def star_join(spark, sf):
    rows = shapes.immigration(spark, sf)
    joined = facts.star_join(rows, *shapes.dimensions_of_rows(spark, sf))
    return joined.select(*facts.COUNT_KEYS, "cicid", *facts.CONTEXT)


@query(
    "lookup_decode",
    ["src_i94", "state_codes", "city_codes", "country_codes"],
    """SELECT cicid, n.label AS origin_country, s.label AS dest_state_name,
              p.label AS city_port_name
       FROM src_i94
       LEFT JOIN country_codes n ON n.code = CAST(CAST(i94res AS INTEGER) AS VARCHAR)
       LEFT JOIN state_codes s ON s.code = i94addr
       LEFT JOIN city_codes p ON p.code = i94port""",
)
def lookup_decode(spark, sf):
    states, cities, countries = shapes.code_lists(spark, sf)
    rows = tables.admissions(spark, sf)
    rows = lookups.decode(rows, L.code_key("i94res"), countries, "origin_country")
    rows = lookups.decode(rows, F.col("i94addr"), states, "dest_state_name")
    rows = lookups.decode(rows, F.col("i94port"), cities, "city_port_name")
    return rows.select("cicid", "origin_country", "dest_state_name", "city_port_name")


@query(
    "join_strategy_equivalence",
    ["counts", "temperature_d"],
    """SELECT strategy, state_code, c.month, CAST(sum(arrivals) AS BIGINT) AS arrivals,
              max(avg_temp_fahrenheit) AS avg_temp_fahrenheit
       FROM counts c JOIN temperature_d t
         ON t.state_abbreviations = state_code AND t.month = c.month
       CROSS JOIN (VALUES ('broadcast'), ('merge')) AS s(strategy)
       GROUP BY 1, 2, 3""",
)
def join_strategy_equivalence(spark, sf):
    """The same join planned both ways; each side of the result is one strategy."""
    by_state = facts.add_up(shapes.counts(spark, sf), ["state_code", "month"])
    counted, temperature = settle(by_state), small_side(shapes.temperature(spark, sf))
    sides = {"broadcast": temperature, "merge": temperature.hint("merge")}

    def joined(strategy):
        rows = facts.join_temperature(counted, sides[strategy])
        summed = rows.groupBy("state_code", "month").agg(
            F.sum("arrivals").alias("arrivals"),
            F.max("avg_temp_fahrenheit").alias("avg_temp_fahrenheit"),
        )
        return summed.select(F.lit(strategy).alias("strategy"), "*")

    return joined("broadcast").unionByName(joined("merge"))


@query("pivot_race_share", ["wide"], "SELECT * FROM wide")
def pivot_race_share(spark, sf):
    shares = dimensions.city_shares(tables.demographics(spark, sf))
    return dimensions.pivot_races(shares).withColumnRenamed("State", "state")


@query("avg_by_state", ["demographics_d"], "SELECT * FROM demographics_d")
def avg_by_state(spark, sf):
    shares = dimensions.city_shares(tables.demographics(spark, sf))
    averaged = dimensions.average_by_state(dimensions.pivot_races(shares))
    return averaged.withColumnRenamed("State", "state")


@query(
    "avg_elevation",
    ["src_air"],
    """SELECT iso_country AS country, substring(iso_region, 4, 3) AS state,
              round(avg(CAST(CAST(elevation_ft AS FLOAT) AS DOUBLE)), 1) AS avg_elevation_ft
       FROM src_air GROUP BY 1, 2""",
)
def avg_elevation(spark, sf):
    averaged = dimensions.average_elevation(tables.airports(spark, sf), tables.STATE_CODE_LENGTH)
    return averaged.withColumn("avg_elevation_ft", L.round1("avg_elevation_ft"))


@query("dim_demographics", ["demographics_d"], "SELECT * FROM demographics_d")
def dim_demographics(spark, sf):
    return shapes.demographics(spark, sf).withColumnRenamed("State", "state")


@query("dim_temperature", ["temperature_d"], "SELECT * FROM temperature_d")
def dim_temperature(spark, sf):
    renamed = {"State": "state", "Country": "country"}
    return shapes.temperature(spark, sf).withColumnsRenamed(renamed)


@query("dim_airport", ["airport_d"], "SELECT * FROM airport_d")
def dim_airport(spark, sf):
    return shapes.airport(spark, sf)


@query("dim_immigration", ["immigration_d"], "SELECT * FROM immigration_d")
def dim_immigration(spark, sf):
    return shapes.immigration(spark, sf)


@query("fact_arrivals", ["fact"], "SELECT * FROM fact")
def fact_arrivals(spark, sf):
    return shapes.fact(spark, sf)


@query(
    "dq_total_count",
    ["fact"],
    """SELECT CAST(sum(to_immigration_state_count) AS BIGINT) AS fact_table_count FROM fact""",
)
def dq_total_count(spark, sf):
    return quality.total_arrivals(shapes.fact(spark, sf))


@query(
    "dq_null_flags",
    ["fact"],
    """SELECT DISTINCT year IS NULL AS year, immigration_month IS NULL AS month,
              immigration_origin IS NULL AS country, to_immigration_state IS NULL AS state
       FROM fact""",
)
def dq_null_flags(spark, sf):
    return quality.null_flags(shapes.fact(spark, sf))


@query(
    "dq_report",
    ["fact", "temperature_d", "demographics_d", "airport_d"],
    """SELECT 'total arrivals' AS check, sum(to_immigration_state_count) > 0 AS passed,
              CAST(sum(to_immigration_state_count) AS BIGINT) AS observed FROM fact
       UNION ALL
       SELECT 'rows with a missing key', count(*) = 0, count(*) FROM fact
       WHERE year IS NULL OR immigration_month IS NULL OR immigration_origin IS NULL
          OR to_immigration_state IS NULL
       UNION ALL
       SELECT 'temperature keys', count(*) = 0, count(*) FROM
         (SELECT 1 FROM temperature_d GROUP BY state_abbreviations, month HAVING count(*) > 1)
       UNION ALL
       SELECT 'demographics keys', count(*) = 0, count(*) FROM
         (SELECT 1 FROM demographics_d GROUP BY state_code HAVING count(*) > 1)
       UNION ALL
       SELECT 'airport keys', count(*) = 0, count(*) FROM
         (SELECT 1 FROM airport_d GROUP BY state HAVING count(*) > 1)""",
)
def dq_report(spark, sf):
    temperature, demographics, airport = shapes.dimensions_of_rows(spark, sf)
    counted = shapes.counts(spark, sf)
    return quality.quality_report(
        facts.fact_arrivals(counted, temperature, demographics, airport),
        {
            "temperature keys": (temperature, ["state_abbreviations", "month"]),
            "demographics keys": (demographics, ["state_code"]),
            "airport keys": (airport, ["state"]),
        },
    )


def landed(frame, path):
    """Write admissions as monthly folders of parquet, as extracts arrive."""
    month = F.format_string("%d-%02d", F.col("i94yr").cast("int"), F.col("i94mon").cast("int"))
    given = frame.withColumns({"month": month, "cicid": F.col("cicid").cast("double")})
    # the folder names hold no column of the extract; a month too large for a task is split
    given.hint("rebalance", F.col("month")).write.mode("append").partitionBy("month").parquet(path)


@query("scan_i94", ["src_i94"], "SELECT * FROM src_i94")
def scan_i94(spark, sf):
    """The production reader over monthly folders of extracts."""
    rows = tables.admissions(spark, sf)
    path = scratch_path(spark, "extracts")
    landed(rows, path)
    read = readers.read_admissions(spark, path).select(*rows.columns)
    return read.withColumn("cicid", F.col("cicid").cast("bigint"))


@query("incremental_append", ["fact"], "SELECT * FROM fact")
def incremental_append(spark, sf):
    """Extracts up to a day are counted, then those that land later; the fact is of both."""
    landing, counts = scratch_path(spark, "landing"), scratch_path(spark, "counts")
    for days in ({"end_day": SPLIT_DAY}, {"first_day": SPLIT_DAY}):
        landed(tables.admissions(spark, sf, **days), landing)
        add_increment(spark, landing, counts)
    states, cities, countries = shapes.code_lists(spark, sf)
    counted = saved_counts(spark, counts, states, cities)
    return shapes.fact_of(spark, sf, facts.name_counts(counted, states, countries))


@query("fact_by_year", ["fact"], "SELECT * FROM fact")
def fact_by_year(spark, sf):
    """The whole fact with a wrong extra month in one year; that year is then replaced."""
    year = tables.TEMPERATURE_YEAR
    path = scratch_path(spark, "fact")
    context = shapes.dimensions_of_rows(spark, sf)
    whole = facts.fact_arrivals(shapes.counts(spark, sf), *context)
    extra = whole.where(F.col("year") == year).withColumn("immigration_month", F.lit(13))
    readers.write_fact(whole.unionByName(extra), path)
    one_year = shapes.counts(spark, sf, f"{year}-01-01", f"{year + 1}-01-01")
    readers.write_fact_year(facts.fact_arrivals(one_year, *context), path, year)
    return readers.read_fact(spark, path)
