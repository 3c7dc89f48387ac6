"""The dimensions as temp views, and the fact as SQL over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FACT_SQL = """
WITH arrivals AS (
  SELECT year, month, origin_country, dest_state_name, state_code, count(*) AS arrivals
  FROM immigration
  GROUP BY year, month, origin_country, dest_state_name, state_code
)
SELECT
  i.year,
  i.month AS immigration_month,
  i.origin_country AS immigration_origin,
  i.dest_state_name AS to_immigration_state,
  sum(i.arrivals) AS to_immigration_state_count,
  w.avg_temp_fahrenheit,
  p.avg_elevation_ft,
  c.percent_foreign_born, c.native_american, c.asian, c.hispanic_or_latino, c.black, c.white
FROM arrivals i
INNER JOIN temperature w ON w.state_abbreviations = i.state_code AND w.month = i.month
INNER JOIN demographics c ON c.state_code = i.state_code
INNER JOIN airport p ON p.state = i.state_code
GROUP BY
  i.year, i.month, i.origin_country, i.dest_state_name, i.state_code,
  w.avg_temp_fahrenheit, p.avg_elevation_ft,
  c.percent_foreign_born, c.native_american, c.asian, c.hispanic_or_latino, c.black, c.white
ORDER BY immigration_origin, i.state_code
"""


def register_views(
    immigration: DataFrame, temperature: DataFrame, demographics: DataFrame, airport: DataFrame
) -> None:
    immigration.createOrReplaceTempView("immigration")
    temperature.createOrReplaceTempView("temperature")
    demographics.createOrReplaceTempView("demographics")
    airport.createOrReplaceTempView("airport")


def fact_from_views(spark: SparkSession) -> DataFrame:
    return spark.sql(FACT_SQL)
