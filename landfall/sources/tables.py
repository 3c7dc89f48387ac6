"""The shared test tables reshaped like the four sources and their code lists.

Every frame is a plain expression over whole tables. Admissions take one shuffle
of ``lineitem``: orders are matched with customers first, and the admission codes
are computed before the join, so that filters on them run at the scan. A hot
order or customer key is left to AQE, which splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landfall.operators.lookups import CodeList, code_list
from landfall.session import settle
from landfall.sources.labels import reverse_labels

TEMPERATURE_YEAR = 2000
STATE_CODE_LENGTH = 3
RACE_OF_SEGMENT = {
    "AUTOMOBILE": "American Indian and Alaska Native",
    "BUILDING": "Asian",
    "FURNITURE": "Black or African-American",
    "HOUSEHOLD": "Hispanic or Latino",
    "MACHINERY": "White",
}
_lists: dict[tuple[str, str, str], CodeList] = {}
_schemas: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; its schema is read from the files once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def numbered(prefix, number) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 2, "0"))


def code_of(prefix, number, kinds) -> Column:
    """``numbered(prefix, number % kinds)``, picked from a constant list instead of built per row."""
    codes = F.split(F.lit(",".join(f"{prefix}{i:02d}" for i in range(kinds))), ",")
    return F.element_at(codes, (number % kinds + 1).cast("int"))


def money(column) -> Column:
    return F.col(column).cast("decimal(18,2)")


def admission_lines(spark, sf_dir) -> DataFrame:
    """Admissions without the residence, which needs the customer.

    Some addresses and residences are NULL and states S25 to S29 are unlisted, because
    the tables themselves hold no such values for the filters to meet.
    """
    line = table(spark, sf_dir, "lineitem")
    part, ship = F.col("l_partkey"), F.col("l_shipdate")
    address = code_of("S", F.col("l_suppkey"), 30)
    return line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cicid"),
        F.year(ship).cast("double").alias("i94yr"),
        F.month(ship).cast("double").alias("i94mon"),
        code_of("P", part, 40).alias("i94port"),
        F.when(part % 13 != 0, address).alias("i94addr"),
        (F.col("l_linenumber") % 4).cast("double").alias("i94mode"),
        (F.col("l_linenumber") % 3 + 1).cast("double").alias("i94visa"),
        F.datediff(ship.cast("date"), F.lit("1960-01-01").cast("date"))
        .cast("double")
        .alias("arrdate"),
        "l_orderkey",
        (part % 17 != 0).alias("has_residence"),
        "l_shipdate",
    )


def admissions(spark, sf_dir, first_day=None, end_day=None, keep=None) -> DataFrame:
    """Admissions in the shape of the extract, optionally of a range of days.

    ``keep`` filters the lines before they are shuffled to their orders.
    """
    lines = admission_lines(spark, sf_dir)
    if first_day is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(first_day).cast("timestamp_ntz"))
    if end_day is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(end_day).cast("timestamp_ntz"))
    if keep is not None:
        lines = keep(lines)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    homes = orders.join(customers, orders.o_custkey == customers.c_custkey)
    homes = homes.select("o_orderkey", "c_nationkey")
    joined = lines.join(homes, lines.l_orderkey == homes.o_orderkey)
    return joined.select(
        "cicid",
        "i94yr",
        "i94mon",
        F.when(F.col("has_residence"), F.col("c_nationkey").cast("double")).alias("i94res"),
        "i94port",
        "i94addr",
    )


def states(spark, sf_dir) -> CodeList:
    return _list(spark, sf_dir, "states", _state_labels)


def state_names(spark, sf_dir) -> CodeList:
    return _list(spark, sf_dir, "names", lambda s, d: reverse_labels(_state_labels(s, d)))


def countries(spark, sf_dir) -> CodeList:
    return _list(spark, sf_dir, "countries", _country_labels)


def cities(spark, sf_dir) -> CodeList:
    return _list(spark, sf_dir, "cities", _city_labels)


def temperatures(spark, sf_dir, year=None) -> DataFrame:
    """Monthly means by nation; ``year`` restricts the orders that are read."""
    orders = table(spark, sf_dir, "orders")
    if year is not None:
        first, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
        orders = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < end))
    orders = orders.select(
        "o_custkey",
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("dt"),
        money("o_totalprice").alias("price"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    monthly = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .groupBy("c_nationkey", "dt")
        .agg((F.sum("price").cast("double") / F.count(F.lit(1)) / 10000).alias("avgt"))
    )
    named = monthly.join(nations, monthly.c_nationkey == nations.n_nationkey)
    return named.select(
        "dt",
        F.col("avgt").alias("AverageTemperature"),
        F.col("n_name").alias("State"),
        F.when(F.col("c_nationkey") == 24, "Canada").otherwise("United States").alias("Country"),
    )


def airports(spark, sf_dir) -> DataFrame:
    country = F.when(F.col("p_size") % 10 == 0, "CA").otherwise("US")
    kind = (
        F.when(F.col("p_type") == "SMALL", "small_airport")
        .when(F.col("p_type") == "MEDIUM", "medium_airport")
        .otherwise("heliport")
    )
    region = F.concat(country, F.lit("-"), code_of("S", F.col("p_partkey"), 25))
    return table(spark, sf_dir, "part").select(
        kind.alias("type"),
        country.alias("iso_country"),
        region.alias("iso_region"),
        money("p_retailprice").alias("elevation_ft"),
    )


def demographics(spark, sf_dir) -> DataFrame:
    """City counts from one pass over customers; city totals add up its few race rows."""
    customers = table(spark, sf_dir, "customer")
    by_race = customers.groupBy(
        "c_nationkey", (F.col("c_custkey") % 4).alias("city"), "c_mktsegment"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("c_custkey") % 8 < 4).alias("male"),
        F.count_if(F.col("c_acctbal") < 0).alias("veterans"),
        F.count_if(F.col("c_acctbal") > 5000).alias("foreign_born"),
        F.sum(money("c_acctbal")).alias("balance"),
    )
    city = Window.partitionBy("c_nationkey", "city")
    total = F.sum("n").over(city)
    male = F.sum("male").over(city)
    race = F.create_map(*[F.lit(x) for pair in RACE_OF_SEGMENT.items() for x in pair])
    counted = by_race.select(
        "c_nationkey",
        (F.sum("balance").over(city).cast("double") / total / 100).alias("Median Age"),
        male.alias("Male Population"),
        (total - male).alias("Female Population"),
        total.alias("Total Population"),
        F.sum("veterans").over(city).alias("Number of Veterans"),
        F.sum("foreign_born").over(city).alias("Foreign-born"),
        F.coalesce(race[F.col("c_mktsegment")], F.col("c_mktsegment")).alias("Race"),
        F.col("n").alias("Count"),
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    named = counted.join(nations, counted.c_nationkey == nations.n_nationkey)
    return named.select(
        F.col("n_name").alias("State"),
        numbered("S", F.col("c_nationkey")).alias("State Code"),
        *[F.col(f"`{name}`") for name in counted.columns if name != "c_nationkey"],
    )


def _state_labels(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        numbered("S", F.col("n_nationkey")).alias("code"), F.col("n_name").alias("label")
    )


def _country_labels(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )


def _city_labels(spark, sf_dir):
    """Ports P00 to P29; the other ten stay unlisted, so that the port filter has rows to drop."""
    number = F.col("p_partkey") % 40
    part = table(spark, sf_dir, "part").where(number < 30)
    labels = part.select(
        numbered("P", number).alias("code"),
        F.concat(F.lit("PORT "), number.cast("string")).alias("label"),
    )
    return settle(labels.distinct())


def _list(spark, sf_dir, name, build) -> CodeList:
    """Each list is derived and checked once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _lists:
        _lists[key] = code_list(build(spark, sf_dir))
    return _lists[key]
