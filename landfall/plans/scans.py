"""Queries on sources, sinks and label lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import lenient as L
from landfall.operators import lookups, ports
from landfall.plans import shapes, views
from landfall.plans.catalog import query
from landfall.session import scratch_path
from landfall.sources import readers, tables
from landfall.sources.labels import parse_labels, reverse_labels


def _through_csv(spark, frame, sep, reader):
    """Write delimited text with a header and read it back."""
    path = scratch_path(spark, "text")
    frame.write.option("header", True).option("sep", sep).csv(path)
    return reader(spark, path)


@query(
    "scan_demographics",
    ["src_demo"],
    """SELECT state, state_code, median_age, male, female, total, veterans, foreign_born, race,
              race_count FROM src_demo""",
)
def scan_demographics(spark, sf):
    read = _through_csv(spark, tables.demographics(spark, sf), ";", readers.read_demographics)

    def whole(column):
        return F.col(f"`{column}`").try_cast("bigint")

    return read.select(
        F.col("State").alias("state"),
        F.col("`State Code`").alias("state_code"),
        L.as_double("Median Age").alias("median_age"),
        whole("Male Population").alias("male"),
        whole("Female Population").alias("female"),
        whole("Total Population").alias("total"),
        whole("Number of Veterans").alias("veterans"),
        whole("Foreign-born").alias("foreign_born"),
        F.col("Race").alias("race"),
        whole("Count").alias("race_count"),
    )


@query(
    "scan_airports",
    ["src_air"],
    """SELECT type, iso_country, iso_region, CAST(elevation_ft AS DOUBLE) AS elevation_ft
       FROM src_air""",
)
def scan_airports(spark, sf):
    read = _through_csv(spark, tables.airports(spark, sf), ",", readers.read_airports)
    return read.withColumn("elevation_ft", L.as_double("elevation_ft"))


@query("scan_temperature", ["src_temp"], "SELECT dt, avgt, state, country FROM src_temp")
def scan_temperature(spark, sf):
    read = _through_csv(spark, tables.temperatures(spark, sf), ",", readers.read_temperatures)
    return read.select(
        L.as_date("dt").alias("dt"),
        L.as_double("AverageTemperature").alias("avgt"),
        F.col("State").alias("state"),
        F.col("Country").alias("country"),
    )


@query(
    "label_lookup_load",
    ["ports"],
    "SELECT code, label FROM ports",
)
def label_lookup_load(spark, sf):
    return parse_labels(shapes.port_lines(spark, sf))


@query(
    "label_reverse_lookup",
    ["ports"],
    "SELECT upper(city) || ' ' || code AS label, code FROM ports",
)
def label_reverse_lookup(spark, sf):
    named = shapes.ports(spark, sf).select(
        "code", F.concat("city", F.lit(" "), "code").alias("label")
    )
    reverse = lookups.code_list(reverse_labels(named))
    asked = named.select(F.initcap("label").alias("name"))
    found = lookups.decode(asked, F.upper("name"), reverse, "code")
    return found.select(F.upper("name").alias("label"), "code")


@query("sink_parquet_roundtrip", ["fact"], "SELECT * FROM fact")
def sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "fact")
    readers.write_fact(shapes.fact(spark, sf), path)
    return readers.read_fact(spark, path)


@query("sql_over_views", ["fact"], "SELECT * FROM fact")
def sql_over_views(spark, sf):
    views.register_views(shapes.immigration(spark, sf), *shapes.dimensions_of_rows(spark, sf))
    return views.fact_from_views(spark)


@query(
    "port_decode",
    ["src_lines", "city_codes"],
    """SELECT i94port, label AS port_name, count(*) AS arrivals
       FROM src_lines LEFT JOIN city_codes ON code = i94port GROUP BY 1, 2""",
)
def port_decode(spark, sf):
    counted = tables.admission_lines(spark, sf).groupBy("i94port").agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    return lookups.decode(counted, F.col("i94port"), tables.cities(spark, sf), "port_name")


@query(
    "decode_mode",
    ["src_lines"],
    """SELECT i94mode, CASE i94mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
              WHEN 9 THEN 'Not reported' END AS arrival_mode, count(*) AS arrivals
       FROM src_lines GROUP BY 1, 2""",
)
def decode_mode(spark, sf):
    return shapes.count_by_label(spark, sf, "i94mode", lookups.arrival_modes(spark), "arrival_mode")


@query(
    "decode_visa",
    ["src_lines"],
    """SELECT i94visa, CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure'
              WHEN 3 THEN 'Student' END AS visa_category, count(*) AS arrivals
       FROM src_lines GROUP BY 1, 2""",
)
def decode_visa(spark, sf):
    return shapes.count_by_label(spark, sf, "i94visa", lookups.visa_categories(spark), "visa_category")


@query(
    "sas_day_to_date",
    ["src_lines"],
    "SELECT cicid, arrdate, CAST(l_shipdate AS DATE) AS arrival_date FROM src_lines",
)
def sas_day_to_date(spark, sf):
    return tables.admission_lines(spark, sf).select(
        "cicid", "arrdate", L.sas_date("arrdate").alias("arrival_date")
    )


@query(
    "address_other_bucket",
    ["src_lines", "state_codes"],
    """SELECT i94addr, coalesce(code, '99') AS address_code, count(*) AS arrivals
       FROM src_lines LEFT JOIN state_codes ON code = i94addr GROUP BY 1, 2""",
)
def address_other_bucket(spark, sf):
    counted = tables.admission_lines(spark, sf).groupBy("i94addr").agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    return lookups.bucket_other(
        counted, F.col("i94addr"), tables.states(spark, sf), "address_code"
    )


@query(
    "label_validity",
    ["ports"],
    """SELECT code, label,
              CASE WHEN p_partkey % 10 IN (4, 5) THEN 'collapsed'
                   WHEN p_partkey % 10 = 6 THEN 'no code'
                   WHEN p_partkey % 10 = 7 THEN 'invalid' ELSE 'valid' END AS validity
       FROM ports""",
)
def label_validity(spark, sf):
    labels = parse_labels(shapes.port_lines(spark, sf))
    return labels.withColumn("validity", ports.validity("label"))


@query(
    "port_city_state",
    ["ports"],
    """SELECT code, label,
              CASE WHEN p_partkey % 20 = 10 THEN city || ', ST JOHN'
                   WHEN p_partkey % 10 < 4 THEN city END AS city,
              CASE WHEN p_partkey % 10 < 4 THEN state END AS state
       FROM ports""",
)
def port_city_state(spark, sf):
    labels = parse_labels(shapes.port_lines(spark, sf))
    return ports.split_city_state(labels, lookups.us_states(spark))


@query(
    "port_collapse",
    ["ports"],
    """SELECT p.code, q.code AS into_code, q.label AS into_label
       FROM ports p JOIN ports q
         ON q.p_partkey = p.p_partkey - CASE p.p_partkey % 10 WHEN 4 THEN 1 ELSE 3 END
       WHERE p.p_partkey % 10 IN (4, 5)""",
)
def port_collapse(spark, sf):
    return ports.collapsed_into(parse_labels(shapes.port_lines(spark, sf)))
