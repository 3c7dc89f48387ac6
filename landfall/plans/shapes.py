"""The dimensions, counts and fact over the shared test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.functions import lenient as L
from landfall.functions.codes import OTHER_STATE, STATE_LABELS
from landfall.operators import dimensions, facts, lookups
from landfall.operators.sizes import small_sides
from landfall.sources import tables


def demographics(spark, sf):
    return dimensions.dim_demographics(tables.demographics(spark, sf))


def temperature(spark, sf):
    year = tables.TEMPERATURE_YEAR
    rows = tables.temperatures(spark, sf, year)
    return dimensions.dim_temperature(rows, tables.state_names(spark, sf), year)


def airport(spark, sf):
    return dimensions.dim_airport(
        tables.airports(spark, sf), code_length=tables.STATE_CODE_LENGTH
    )


def dimensions_of_rows(spark, sf):
    """Temperature, demographics and airport, ready to meet row-level data."""
    return small_sides(temperature(spark, sf), demographics(spark, sf), airport(spark, sf))


def code_lists(spark, sf):
    return tables.states(spark, sf), tables.cities(spark, sf), tables.countries(spark, sf)


def known(spark, sf, first_day=None, end_day=None):
    """Admissions that pass the filters, which run on the lines before their shuffle."""
    states, cities, _ = code_lists(spark, sf)

    def keep(lines):
        return dimensions.listed_admissions(lines.where("has_residence"), states, cities)

    rows = tables.admissions(spark, sf, first_day, end_day, keep)
    return rows.where("i94res IS NOT NULL")


def immigration(spark, sf):
    return dimensions.spell_out(known(spark, sf), *code_lists(spark, sf))


def counts(spark, sf, first_day=None, end_day=None):
    states, _, countries = code_lists(spark, sf)
    counted = facts.count_codes(known(spark, sf, first_day, end_day))
    return facts.name_counts(counted, states, countries)


def fact_of(spark, sf, counted):
    return facts.fact_arrivals(
        counted, temperature(spark, sf), demographics(spark, sf), airport(spark, sf)
    )


def fact(spark, sf):
    return fact_of(spark, sf, counts(spark, sf))


def count_by_label(spark, sf, column, codes, into):
    """Admissions per code of ``column``, with the code's label."""
    counted = tables.admission_lines(spark, sf).groupBy(column).agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    return lookups.decode(counted, L.code_key(column), codes, into)


def ports(spark, sf):
    """Port codes with the parts their labels are made of."""
    state_codes = [F.lit(code) for code, _ in STATE_LABELS if code != OTHER_STATE]
    number = F.col("p_partkey")
    return tables.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("P"), number.cast("string")).alias("code"),
        F.upper("p_name").alias("city"),
        F.element_at(F.array(*state_codes), (number % 54 + 1).cast("int")).alias("state"),
    )


def port_lines(spark, sf):
    """Label-file lines for the ports, in all the shapes that label files show."""
    number, city, state, code = (F.col(c) for c in ("p_partkey", "city", "state", "code"))

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def earlier(step):
        return (number - step).cast("string")

    kind = number % 10
    label = (
        F.when(number % 20 == 10, text(city, ", ST JOHN, ", state))
        .when(kind == 0, text(city, ", ", state))
        .when(kind == 1, text(city, ",", state))
        .when(kind == 2, text(city, ", ", state, " (BPS)"))
        .when(kind == 3, text(city, ", ", state, " #ARPT"))
        .when(kind == 4, text("Collapsed (P", earlier(1), ") 06/15"))
        .when(kind == 5, text("Collapsed into P", earlier(3), ", MN"))
        .when(kind == 6, text("No PORT Code (", code, ")"))
        .when(kind == 7, text("INVALID - ", city, ", JAPAN"))
        .when(kind == 8, text(city, ", MX"))
        .otherwise(text(city, " INT''L ", state))
    )
    style = number % 7
    before = F.when(style == 0, "   ").when(style.isin(4, 5), "\t'").otherwise("   '")
    between = (
        F.when(style == 0, " =  '")
        .when(style.isin(1, 2), "'\t=\t'")
        .when(style == 3, " '\t\t=\t'")
        .when(style.isin(4, 5), "'='")
        .otherwise("' \t=\t'")
    )
    after = (
        F.when(style == 1, "        '")
        .when(style == 2, "' ")
        .when(style == 5, "' ;")
        .otherwise("'")
    )
    line = text(before, code, between, label, after)
    return ports(spark, sf).select(line.alias("value"))
