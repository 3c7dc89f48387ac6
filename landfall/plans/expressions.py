"""Queries on projections, scalar expressions, filters, sorts and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import lenient as L
from landfall.operators import dimensions, facts, lookups
from landfall.plans import shapes
from landfall.plans.catalog import query
from landfall.sources import tables


@query(
    "project_rename",
    ["src_lines"],
    """SELECT cicid, i94yr AS year, i94mon AS month, i94port AS port, i94addr AS state_code
       FROM src_lines""",
)
def project_rename(spark, sf):
    return tables.admission_lines(spark, sf).select(
        "cicid",
        F.col("i94yr").alias("year"),
        F.col("i94mon").alias("month"),
        F.col("i94port").alias("port"),
        F.col("i94addr").alias("state_code"),
    )


@query(
    "with_columns",
    [],
    """SELECT p_partkey,
              CASE WHEN p_size % 10 = 0 THEN 'CA' ELSE 'US' END AS iso_country,
              'S' || lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0') AS iso_region,
              CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS elevation_ft
       FROM part""",
)
def with_columns(spark, sf):
    part = tables.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    country = F.when(F.col("p_size") % 10 == 0, "CA").otherwise("US")
    region = F.concat(country, F.lit("-"), tables.code_of("S", F.col("p_partkey"), 25))
    added = part.withColumns({"iso_country": country, "iso_region": region})
    # the second step replaces a column by its own suffix
    replaced = added.withColumns(
        {
            "iso_region": L.region_suffix("iso_region", 3),
            "elevation_ft": L.as_float32("p_retailprice"),
        }
    )
    return replaced.drop("p_size", "p_retailprice")


@query(
    "cast_lenient",
    [],
    """WITH t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'n/a'
                       ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS text,
                       CAST(p_size AS DOUBLE) + 0.75 AS number FROM part)
       SELECT p_partkey, text, CAST(TRY_CAST(text AS FLOAT) AS DOUBLE) AS as_float,
              TRY_CAST(text AS DOUBLE) AS as_double, CAST(trunc(number) AS INTEGER) AS as_int
       FROM t""",
)
def cast_lenient(spark, sf):
    kind = F.col("p_partkey") % 5
    text = F.when(kind == 0, "").when(kind == 1, "n/a").otherwise(
        tables.money("p_retailprice").cast("string")
    )
    return (
        tables.table(spark, sf, "part")
        .select("p_partkey", text.alias("text"), (F.col("p_size").cast("double") + 0.75).alias("n"))
        .select(
            "p_partkey",
            "text",
            L.as_float32("text").alias("as_float"),
            L.as_double("text").alias("as_double"),
            L.as_int("n").alias("as_int"),
        )
    )


@query(
    "code_key_from_double",
    [],
    """SELECT c_custkey, CAST(CAST(c_nationkey AS INTEGER) AS VARCHAR) AS origin_code
       FROM customer""",
)
def code_key_from_double(spark, sf):
    number = F.col("c_nationkey").cast("double")
    return tables.table(spark, sf, "customer").select(
        "c_custkey", L.code_key(number).alias("origin_code")
    )


@query("percent_of_total", ["shares"], "SELECT * FROM shares")
def percent_of_total(spark, sf):
    shares = dimensions.city_shares(tables.demographics(spark, sf))
    return shares.withColumnsRenamed({"State": "state", "Race": "race"})


@query(
    "celsius_to_fahrenheit",
    ["src_temp"],
    "SELECT state, dt, avgt, avgt * 9 / 5 + 32 AS fahrenheit FROM src_temp",
)
def celsius_to_fahrenheit(spark, sf):
    return tables.temperatures(spark, sf).select(
        F.col("State").alias("state"),
        "dt",
        F.col("AverageTemperature").alias("avgt"),
        L.fahrenheit("AverageTemperature").alias("fahrenheit"),
    )


@query(
    "date_parts",
    [],
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 19 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
              CASE WHEN o_orderkey % 19 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS month
       FROM orders""",
)
def date_parts(spark, sf):
    day = F.col("o_orderdate").cast("date").cast("string")
    text = F.when(F.col("o_orderkey") % 19 == 0, "no date").otherwise(day)
    parsed = L.as_date(text)
    return tables.table(spark, sf, "orders").select(
        "o_orderkey", F.year(parsed).alias("year"), F.month(parsed).alias("month")
    )


@query(
    "upper_name_match",
    [],
    """SELECT c_custkey, lower(n_name) AS state,
              'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_abbreviations
       FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def upper_name_match(spark, sf):
    nations = tables.table(spark, sf, "nation")
    rows = tables.table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = rows.select("c_custkey", F.lower("n_name").alias("state"))
    names = tables.state_names(spark, sf)
    return lookups.decode(rows, F.upper("state"), names, "state_abbreviations", "drop")


@query(
    "region_suffix",
    ["src_air"],
    """SELECT iso_region, substring(iso_region, 4, 2) AS two, substring(iso_region, 4, 3) AS three
       FROM src_air""",
)
def region_suffix(spark, sf):
    return tables.airports(spark, sf).select(
        "iso_region",
        L.region_suffix("iso_region").alias("two"),
        L.region_suffix("iso_region", 3).alias("three"),
    )


@query(
    "round_half_up",
    [],
    "SELECT c_custkey, c_acctbal, round(c_acctbal, 1) AS rounded FROM customer",
)
def round_half_up(spark, sf):
    return tables.table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal", L.round1("c_acctbal").alias("rounded")
    )


@query(
    "filter_equals",
    ["src_air"],
    """SELECT type, iso_country, iso_region, CAST(elevation_ft AS DOUBLE) AS elevation_ft
       FROM src_air WHERE type = 'small_airport' AND iso_country = 'US'""",
)
def filter_equals(spark, sf):
    rows = tables.airports(spark, sf).where("type = 'small_airport' AND iso_country = 'US'")
    return rows.withColumn("elevation_ft", F.col("elevation_ft").cast("double"))


@query(
    "filter_year",
    [],
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
       WHERE year(o_orderdate) = 2000""",
)
def filter_year(spark, sf):
    orders = tables.table(spark, sf, "orders")
    chosen = orders.where(L.in_year(orders, "o_orderdate", tables.TEMPERATURE_YEAR))
    return chosen.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@query(
    "filter_not_null",
    ["src_i94"],
    "SELECT * FROM src_i94 WHERE i94addr IS NOT NULL AND i94res IS NOT NULL",
)
def filter_not_null(spark, sf):
    """Both tests run on the lines, below their shuffle; only a home without a nation is left."""

    def keep(lines):
        return lines.where("i94addr IS NOT NULL AND has_residence")

    return tables.admissions(spark, sf, keep=keep).where(F.col("i94res").isNotNull())


@query(
    "semi_join_lookup",
    ["src_lines", "state_codes", "city_codes"],
    """SELECT cicid, i94port, i94addr FROM src_lines
       WHERE i94addr IN (SELECT code FROM state_codes)
         AND i94port IN (SELECT code FROM city_codes)""",
)
def semi_join_lookup(spark, sf):
    rows = tables.admission_lines(spark, sf).select("cicid", "i94port", "i94addr")
    rows = lookups.keep_listed(rows, F.col("i94addr"), tables.states(spark, sf))
    return lookups.keep_listed(rows, F.col("i94port"), tables.cities(spark, sf))


@query(
    "filter_chain",
    ["src_i94", "state_codes", "city_codes"],
    """SELECT * FROM src_i94
       WHERE i94addr IS NOT NULL AND i94res IS NOT NULL
         AND i94addr IN (SELECT code FROM state_codes)
         AND i94port IN (SELECT code FROM city_codes)""",
)
def filter_chain(spark, sf):
    return shapes.known(spark, sf)


@query(
    "drop_duplicates",
    [],
    """SELECT DISTINCT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month,
              round(o_totalprice / 100000, 1) AS price
       FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def drop_duplicates(spark, sf):
    orders = tables.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = tables.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return rows.select(
        "c_nationkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        L.round1(F.col("o_totalprice") / 100000).alias("price"),
    ).dropDuplicates()


@query(
    "sort_state",
    ["demographics_d"],
    "SELECT state, state_code, median_age, white FROM demographics_d ORDER BY state",
)
def sort_state(spark, sf):
    rows = shapes.demographics(spark, sf).orderBy("State")
    return rows.select(F.col("State").alias("state"), "state_code", "median_age", "white")


@query(
    "sort_hidden_column",
    ["airport_d"],
    "SELECT country, avg_elevation_ft FROM airport_d ORDER BY state",
)
def sort_hidden_column(spark, sf):
    return shapes.airport(spark, sf).orderBy("state").select("country", "avg_elevation_ft")


@query(
    "fact_ordered",
    ["coded_fact"],
    """SELECT * EXCLUDE (state_code), row_number() OVER (
           ORDER BY immigration_origin NULLS FIRST, state_code NULLS FIRST, year, immigration_month,
             to_immigration_state NULLS FIRST, avg_temp_fahrenheit NULLS FIRST,
             avg_elevation_ft NULLS FIRST, percent_foreign_born NULLS FIRST,
             native_american NULLS FIRST, asian NULLS FIRST, hispanic_or_latino NULLS FIRST,
             black NULLS FIRST, white NULLS FIRST) AS position
       FROM coded_fact""",
)
def fact_ordered(spark, sf):
    joined = facts.star_join(
        shapes.counts(spark, sf),
        shapes.temperature(spark, sf),
        shapes.demographics(spark, sf),
        shapes.airport(spark, sf),
    )
    summed = facts.add_up(joined, facts.COUNT_KEYS + facts.CONTEXT)
    return facts.fact_columns(facts.rank_fact(summed), "position")
