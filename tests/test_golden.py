"""Dimensions, fact and checks on the hand-worked fixture."""

import pytest
from conftest import Golden, rows_of
from pyspark.sql import functions as F

from landfall.functions.codes import STATE_ALIASES
from landfall.operators import dimensions, facts, lookups, quality
from landfall.plans import views


@pytest.fixture(scope="module")
def dims(golden):
    return (
        dimensions.dim_temperature(golden.temperatures, golden.state_names),
        dimensions.dim_demographics(golden.demographics),
        dimensions.dim_airport(golden.airports),
    )


def lists(golden):
    return golden.states, golden.cities, golden.countries


def test_temperature(dims):
    shown = dims[0].select(
        "year", "month", "avg_temp_celcius", "avg_temp_fahrenheit", "state_abbreviations"
    )
    assert rows_of(shown) == [
        (2013, 6, 12.3, 54.2, "AK"),
        (2013, 6, 20.1, 68.1, "CA"),
        (2013, 7, None, None, "AK"),
    ]
    assert dims[0].columns[-2:] == ["State", "Country"]


def test_temperature_with_aliases(spark, golden):
    aliases = lookups.fixed_list(spark, STATE_ALIASES)
    found = dimensions.dim_temperature(golden.temperatures, golden.state_names, aliases=aliases)
    assert {row.state_abbreviations for row in found.collect()} == {"AK", "CA", "NC"}


def test_airport(dims):
    assert rows_of(dims[2]) == [("US", "AK", 200.5), ("US", "CA", 50.0)]
    assert [row.state for row in dims[2].orderBy("state").collect()] == ["AK", "CA"]
    hidden = dims[2].orderBy("state").select("avg_elevation_ft").collect()
    assert [row[0] for row in hidden] == [200.5, 50.0]


def test_demographics(dims):
    assert rows_of(dims[1]) == [
        ("Alaska", "AK", 32.2, 60.0, 40.0, 10.0, 20.0, 8.0, 10.0, 7.0, 5.0, 50.0),
        ("California", "CA", 32.8, 47.5, 52.5, 7.5, 25.0, None, 30.0, None, 30.0, 35.0),
    ]
    assert dims[1].columns == [
        "State", "state_code", "median_age", "percent_male_population",
        "percent_female_population", "percent_veterans", "percent_foreign_born",
        "native_american", "asian", "hispanic_or_latino", "black", "white",
    ]


def test_missing_race_is_a_null_column(golden):
    whites = golden.demographics.where("Race = 'White'")
    assert [row.asian for row in dimensions.dim_demographics(whites).collect()] == [None, None]


def test_immigration(golden):
    found = dimensions.dim_immigration(golden.admissions, *lists(golden))
    assert [row.cicid for row in found.orderBy("cicid").collect()] == [1, 2, 3, 8, 9, 10]
    first = found.where("cicid = 3").first()
    assert tuple(first) == (
        3.0, 2016, 6, "MEXICO", "LOS", "LOS ANGELES", "CA", "CALIFORNIA",
    )


def test_fact(golden, dims):
    counts = facts.arrival_counts(golden.admissions, *lists(golden))
    fact = facts.fact_arrivals(counts, *dims)
    assert rows_of(fact) == Golden.fact
    assert [row[0] for row in quality.total_arrivals(fact).collect()] == [3]
    assert rows_of(quality.null_flags(fact)) == [(False, False, False, False)]


def test_fact_forms_agree(spark, golden, dims):
    immigration = dimensions.dim_immigration(golden.admissions, *lists(golden))
    assert rows_of(facts.fact_joined_first(immigration, *dims)) == Golden.fact
    counted = facts.count_dimension(immigration)
    assert rows_of(facts.fact_arrivals(counted, *dims)) == Golden.fact
    views.register_views(immigration, *dims)
    ordered = [tuple(row) for row in views.fact_from_views(spark).collect()]
    assert ordered == Golden.fact
    assert [tuple(row) for row in facts.order_fact(counted, *dims).collect()] == Golden.fact


def test_unknown_country(golden, dims):
    rows = golden.admit([*Golden.admissions, Golden.unknown_country])
    counts = facts.arrival_counts(rows, *lists(golden))
    fact = facts.fact_arrivals(counts, *dims)
    assert rows_of(fact) == sorted([*Golden.fact, Golden.unknown_fact], key=repr)
    assert quality.total_arrivals(fact).first()[0] == 4
    assert rows_of(quality.null_flags(fact)) == [
        (False, False, False, False),
        (False, False, True, False),
    ]
    dropped = facts.arrival_counts(rows, *lists(golden), on_unknown="drop")
    assert rows_of(facts.fact_arrivals(dropped, *dims)) == Golden.fact
    with pytest.raises(Exception, match="no origin_country for code 998"):
        facts.arrival_counts(rows, *lists(golden), on_unknown="fail").collect()


def test_dimension_that_repeats_a_key(golden, dims):
    """Counting first equals joining first even where a key occurs twice."""
    temperature, demographics, airport = dims
    doubled = temperature.withColumn("avg_temp_celcius", F.lit(0.0)).unionByName(temperature)
    other = temperature.withColumn("avg_temp_fahrenheit", F.lit(1.0)).unionByName(doubled)
    immigration = dimensions.dim_immigration(golden.admissions, *lists(golden))
    counts = facts.arrival_counts(golden.admissions, *lists(golden))
    expected = rows_of(facts.fact_joined_first(immigration, other, demographics, airport))
    assert rows_of(facts.fact_arrivals(counts, other, demographics, airport)) == expected
    report = quality.quality_report(
        facts.fact_arrivals(counts, other, demographics, airport),
        {"temperature keys": (other, ["state_abbreviations", "month"])},
    )
    assert ("temperature keys", False, 3) in rows_of(report)
    with pytest.raises(RuntimeError, match="temperature keys"):
        quality.enforce(report)


def test_codes_that_share_a_label_merge(spark, golden, dims):
    pairs = [(code, "SAME") for code, _ in Golden.countries]
    same = lookups.code_list(spark.createDataFrame(pairs, "code string, label string"))
    counts = facts.arrival_counts(golden.admissions, golden.states, golden.cities, same)
    immigration = dimensions.dim_immigration(golden.admissions, golden.states, golden.cities, same)
    expected = rows_of(facts.fact_joined_first(immigration, *dims))
    assert rows_of(facts.fact_arrivals(counts, *dims)) == expected


def test_lists_too_big_to_broadcast(golden):
    small = facts.counts_by_code(golden.admissions, golden.states, golden.cities)
    big_states = golden.states._replace(bytes=1 << 40)
    big_cities = golden.cities._replace(bytes=1 << 40)
    counted = facts.counts_by_code(golden.admissions, big_states, big_cities)
    assert rows_of(counted) == rows_of(small)
    immigration = dimensions.dim_immigration(
        golden.admissions, big_states, big_cities, golden.countries
    )
    expected = dimensions.dim_immigration(golden.admissions, *lists(golden))
    assert rows_of(immigration) == rows_of(expected)


def test_padded_port_keys(spark, golden):
    pairs = "code string, label string"
    padded = lookups.code_list(spark.createDataFrame([("CP ", "CAPE")], pairs))
    trimmed = lookups.code_list(spark.createDataFrame([("CP", "CAPE")], pairs))
    rows = golden.admit([(1, 6, 209, "CP ", "AK"), (2, 6, 209, "CP", "AK")])

    def kept(cities, trim_keys):
        found = dimensions.known_admissions(rows, golden.states, cities, trim_keys)
        return sorted(row.cicid for row in found.collect())

    assert kept(trimmed, True) == [1, 2]
    assert kept(padded, False) == [1]
