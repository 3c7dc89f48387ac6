"""Registry of the checked queries: a Spark function and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landfall.functions.codes import OTHER_STATE, STATE_LABELS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The source shapes of landfall.sources.tables, once more as SQL.
_SHAPES = {
    "src_lines": """
        SELECT l_orderkey * 10 + l_linenumber AS cicid,
               CAST(year(l_shipdate) AS DOUBLE) AS i94yr,
               CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
               'P' || lpad(CAST(l_partkey % 40 AS VARCHAR), 2, '0') AS i94port,
               CASE WHEN l_partkey % 13 = 0 THEN NULL
                    ELSE 'S' || lpad(CAST(l_suppkey % 30 AS VARCHAR), 2, '0') END AS i94addr,
               CAST(l_linenumber % 4 AS DOUBLE) AS i94mode,
               CAST(l_linenumber % 3 + 1 AS DOUBLE) AS i94visa,
               CAST(datediff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS arrdate,
               l_orderkey, l_partkey, l_shipdate
        FROM lineitem""",
    "src_i94": """
        SELECT s.cicid, s.i94yr, s.i94mon,
               CASE WHEN s.l_partkey % 17 = 0 THEN NULL
                    ELSE CAST(c_nationkey AS DOUBLE) END AS i94res,
               s.i94port, s.i94addr
        FROM src_lines s
        JOIN orders ON o_orderkey = s.l_orderkey
        JOIN customer ON c_custkey = o_custkey""",
    "state_codes": """
        SELECT 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS label
        FROM nation""",
    "country_codes": """
        SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation""",
    "city_codes": """
        SELECT DISTINCT 'P' || lpad(CAST(p_partkey % 40 AS VARCHAR), 2, '0') AS code,
               'PORT ' || CAST(p_partkey % 40 AS VARCHAR) AS label
        FROM part WHERE p_partkey % 40 < 30""",
    "src_temp": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS dt,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 10000 AS avgt,
               n_name AS state,
               CASE WHEN n_nationkey = 24 THEN 'Canada' ELSE 'United States' END AS country
        FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        GROUP BY 1, n_name, n_nationkey""",
    "src_air": """
        SELECT CASE p_type WHEN 'SMALL' THEN 'small_airport' WHEN 'MEDIUM' THEN 'medium_airport'
                    ELSE 'heliport' END AS type,
               CASE WHEN p_size % 10 = 0 THEN 'CA' ELSE 'US' END AS iso_country,
               CASE WHEN p_size % 10 = 0 THEN 'CA' ELSE 'US' END
                    || '-S' || lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0') AS iso_region,
               CAST(p_retailprice AS DECIMAL(18,2)) AS elevation_ft
        FROM part""",
    "city_totals": """
        SELECT c_nationkey, c_custkey % 4 AS city, count(*) AS total,
               count(*) FILTER (WHERE c_custkey % 8 < 4) AS male,
               count(*) FILTER (WHERE c_acctbal < 0) AS veterans,
               count(*) FILTER (WHERE c_acctbal > 5000) AS foreign_born,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 100 AS median_age
        FROM customer GROUP BY 1, 2""",
    "src_demo": """
        SELECT n_name AS state, 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_code,
               t.median_age, t.male, t.total - t.male AS female, t.total, t.veterans, t.foreign_born,
               CASE r.c_mktsegment WHEN 'AUTOMOBILE' THEN 'American Indian and Alaska Native'
                    WHEN 'BUILDING' THEN 'Asian' WHEN 'FURNITURE' THEN 'Black or African-American'
                    WHEN 'HOUSEHOLD' THEN 'Hispanic or Latino' WHEN 'MACHINERY' THEN 'White'
                    ELSE r.c_mktsegment END AS race,
               r.n AS race_count
        FROM (SELECT c_nationkey, c_custkey % 4 AS city, c_mktsegment, count(*) AS n
              FROM customer GROUP BY 1, 2, 3) r
        JOIN city_totals t ON t.c_nationkey = r.c_nationkey AND t.city = r.city
        JOIN nation ON n_nationkey = r.c_nationkey""",
    "shares": """
        SELECT state, state_code, CAST(CAST(median_age AS FLOAT) AS DOUBLE) AS median_age,
               CAST(male AS DOUBLE) / total * 100 AS percent_male_population,
               CAST(female AS DOUBLE) / total * 100 AS percent_female_population,
               CAST(veterans AS DOUBLE) / total * 100 AS percent_veterans,
               CAST(foreign_born AS DOUBLE) / total * 100 AS percent_foreign_born,
               race, CAST(race_count AS DOUBLE) / total * 100 AS percent_race
        FROM src_demo""",
    "wide": """
        SELECT state, state_code, median_age, percent_male_population, percent_female_population,
               percent_veterans, percent_foreign_born,
               avg(percent_race) FILTER (WHERE race = 'American Indian and Alaska Native')
                 AS native_american,
               avg(percent_race) FILTER (WHERE race = 'Asian') AS asian,
               avg(percent_race) FILTER (WHERE race = 'Hispanic or Latino') AS hispanic_or_latino,
               avg(percent_race) FILTER (WHERE race = 'Black or African-American') AS black,
               avg(percent_race) FILTER (WHERE race = 'White') AS white
        FROM shares GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "demographics_d": """
        SELECT state, state_code, round(avg(median_age), 1) AS median_age,
               round(avg(percent_male_population), 1) AS percent_male_population,
               round(avg(percent_female_population), 1) AS percent_female_population,
               round(avg(percent_veterans), 1) AS percent_veterans,
               round(avg(percent_foreign_born), 1) AS percent_foreign_born,
               round(avg(native_american), 1) AS native_american, round(avg(asian), 1) AS asian,
               round(avg(hispanic_or_latino), 1) AS hispanic_or_latino,
               round(avg(black), 1) AS black, round(avg(white), 1) AS white
        FROM wide GROUP BY 1, 2""",
    "temperature_d": """
        SELECT DISTINCT CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month,
               round(avgt, 1) AS avg_temp_celcius, round(avgt * 9 / 5 + 32, 1) AS avg_temp_fahrenheit,
               code AS state_abbreviations, state, country
        FROM src_temp JOIN state_codes ON label = upper(state)
        WHERE country = 'United States' AND year(dt) = 2000""",
    "airport_d": """
        SELECT iso_country AS country, substring(iso_region, 4, 3) AS state,
               round(avg(CAST(CAST(elevation_ft AS FLOAT) AS DOUBLE)), 1) AS avg_elevation_ft
        FROM src_air WHERE type = 'small_airport' AND iso_country = 'US' GROUP BY 1, 2""",
    "immigration_d": """
        SELECT i.cicid, CAST(i.i94yr AS INTEGER) AS year, CAST(i.i94mon AS INTEGER) AS month,
               n.label AS origin_country, i.i94port, p.label AS city_port_name,
               i.i94addr AS state_code, s.label AS dest_state_name
        FROM src_i94 i
        JOIN state_codes s ON s.code = i.i94addr
        JOIN city_codes p ON p.code = i.i94port
        LEFT JOIN country_codes n ON n.code = CAST(CAST(i.i94res AS INTEGER) AS VARCHAR)
        WHERE i.i94addr IS NOT NULL AND i.i94res IS NOT NULL""",
    "counts": """
        SELECT year, month, origin_country, dest_state_name, state_code, count(*) AS arrivals
        FROM immigration_d GROUP BY 1, 2, 3, 4, 5""",
    "star": """
        SELECT m.year, m.month, m.origin_country, m.dest_state_name, m.state_code, m.cicid,
               t.avg_temp_fahrenheit, a.avg_elevation_ft, d.percent_foreign_born,
               d.native_american, d.asian, d.hispanic_or_latino, d.black, d.white
        FROM immigration_d m
        JOIN temperature_d t ON t.state_abbreviations = m.state_code AND t.month = m.month
        JOIN demographics_d d ON d.state_code = m.state_code
        JOIN airport_d a ON a.state = m.state_code""",
    "coded_fact": """
        SELECT year, month AS immigration_month, origin_country AS immigration_origin,
               dest_state_name AS to_immigration_state, state_code,
               count(state_code) AS to_immigration_state_count,
               avg_temp_fahrenheit, avg_elevation_ft, percent_foreign_born, native_american,
               asian, hispanic_or_latino, black, white
        FROM star
        GROUP BY year, month, origin_country, dest_state_name, state_code, avg_temp_fahrenheit,
                 avg_elevation_ft, percent_foreign_born, native_american, asian,
                 hispanic_or_latino, black, white""",
    "fact": "SELECT * EXCLUDE (state_code) FROM coded_fact",
    "port_labels": f"""
        SELECT 'P' || CAST(p_partkey AS VARCHAR) AS code, p_partkey,
               upper(p_name) AS city,
               list_value({", ".join(f"'{code}'" for code, _ in STATE_LABELS if code != OTHER_STATE)})[
                   CAST(p_partkey % 54 AS INTEGER) + 1] AS state
        FROM part""",
    "ports": """
        SELECT code, city, state, p_partkey,
               CASE p_partkey % 10
                 WHEN 0 THEN city || CASE p_partkey % 20 WHEN 10 THEN ', ST JOHN' ELSE '' END || ', ' || state
                 WHEN 1 THEN city || ',' || state
                 WHEN 2 THEN city || ', ' || state || ' (BPS)'
                 WHEN 3 THEN city || ', ' || state || ' #ARPT'
                 WHEN 4 THEN 'Collapsed (P' || CAST(p_partkey - 1 AS VARCHAR) || ') 06/15'
                 WHEN 5 THEN 'Collapsed into P' || CAST(p_partkey - 3 AS VARCHAR) || ', MN'
                 WHEN 6 THEN 'No PORT Code (P' || CAST(p_partkey AS VARCHAR) || ')'
                 WHEN 7 THEN 'INVALID - ' || city || ', JAPAN'
                 WHEN 8 THEN city || ', MX'
                 ELSE city || ' INT''L ' || state END AS label
        FROM port_labels""",
}
# Which shapes each shape reads, in an order that can be defined top down.
_NEEDS = {
    "src_i94": ["src_lines"],
    "src_demo": ["city_totals"],
    "shares": ["src_demo"],
    "wide": ["shares"],
    "demographics_d": ["wide"],
    "temperature_d": ["src_temp", "state_codes"],
    "airport_d": ["src_air"],
    "immigration_d": ["src_i94", "state_codes", "city_codes", "country_codes"],
    "counts": ["immigration_d"],
    "star": ["immigration_d", "temperature_d", "demographics_d", "airport_d"],
    "coded_fact": ["star"],
    "fact": ["coded_fact"],
    "ports": ["port_labels"],
}


def with_shapes(names, select) -> str:
    """``select`` behind the WITH clause for the shapes it reads."""
    ordered: list[str] = []

    def add(name):
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return select
    clauses = ",\n".join(f"{name} AS ({_SHAPES[name]})" for name in ordered)
    return f"WITH {clauses}\n{select}"


def query(name, shapes=(), sql=None):
    """Register a Spark query and, where SQL can say the same, its SQL."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_shapes(shapes, sql)
        return function

    return register
