"""Random inputs against plain Python."""

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from conftest import rows_of

from landfall.functions import lenient as L
from landfall.operators import dimensions, facts
from landfall.sources.labels import parse_labels


def half_up(number):
    return float(Decimal(repr(number)).quantize(Decimal("0.1"), ROUND_HALF_UP))


def test_label_lines_round_trip(spark):
    rng = random.Random(5)
    signs = "ABC '=;,#()x."
    pairs = {}
    for number in range(400):
        label = "".join(rng.choice(signs) for _ in range(rng.randint(1, 12))).strip()
        pairs[f"C{number}"] = label or "-"

    def line(code, label):
        key = rng.choice([code, f"'{code}'", f"'{code} '"])
        pad, end = " " * rng.randint(0, 3), rng.choice(["", " ", " ;", ";"])
        sign = rng.choice(["=", " = ", "\t=\t", "\t\t=\t"])
        doubled = label.replace("'", "''")
        return f"{pad}{key}{sign}'{doubled}{pad}'{end}"

    lines = spark.createDataFrame([(line(*p),) for p in pairs.items()], "value string")
    assert dict(tuple(row) for row in parse_labels(lines).collect()) == pairs


def test_fact_against_plain_python(spark, golden):
    rng = random.Random(11)
    rows = [
        (
            number,
            rng.randint(5, 8),
            rng.choice([209, 582, 135, 998, None]),
            rng.choice(["ANC", "LOS", "ZZZ", None]),
            # a third of all rows on one state
            "CA" if number % 3 == 0 else rng.choice(["AK", "NC", "99", "XX", None]),
        )
        for number in range(3000)
    ]
    temperature = dimensions.dim_temperature(golden.temperatures, golden.state_names)
    demographics = dimensions.dim_demographics(golden.demographics)
    airport = dimensions.dim_airport(golden.airports)

    states, cities, countries = (
        {row.code: row.label for row in codes.frame.collect()}
        for codes in (golden.states, golden.cities, golden.countries)
    )
    warm = [(r.state_abbreviations, r.month, r.avg_temp_fahrenheit) for r in temperature.collect()]
    people = {r.state_code: tuple(r)[6:] for r in demographics.collect()}
    height = {r.state: r.avg_elevation_ft for r in airport.collect()}
    expected = Counter()
    for _, month, residence, port, address in rows:
        if residence is None or address not in states or port not in cities:
            continue
        for state, t_month, degrees in warm:
            if state == address and t_month == month and state in people and state in height:
                origin = countries.get(str(residence))
                key = (2016, month, origin, states[state], degrees, height[state], *people[state])
                expected[key] += 1
    wanted = sorted(((*k[:4], n, *k[4:]) for k, n in expected.items()), key=repr)

    lists = golden.states, golden.cities, golden.countries
    counts = facts.arrival_counts(golden.admit(rows), *lists)
    assert rows_of(facts.fact_arrivals(counts, temperature, demographics, airport)) == wanted
    immigration = dimensions.dim_immigration(golden.admit(rows), *lists)
    joined = facts.fact_joined_first(immigration, temperature, demographics, airport)
    assert rows_of(joined) == wanted
    assert len(wanted) > 5


def test_rounding_is_half_up(spark):
    numbers = [k / 100 for k in range(-3000, 3000)] + [200.5, 32.75, 2.25]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    for row in df.select("n", L.round1("n").alias("r")).collect():
        assert row.r == half_up(row.n), row.n


def test_bad_values_become_null(spark):
    df = spark.createDataFrame(
        [("", "0", "no date"), ("n/a", "5", "2013-02-30"), (None, None, None), ("7", "2", "2013-06-01")],
        "a string, b string, d string",
    )
    found = df.select(
        L.as_float32("a"), L.percent_of("a", "b"), L.fahrenheit("a"), L.as_date("d").cast("string")
    )
    nothing = (None, None, None, None)
    assert [tuple(row) for row in found.collect()] == [
        nothing, nothing, nothing, (7.0, 350.0, 44.6, "2013-06-01"),
    ]
    zero = spark.createDataFrame([("7", "0")], "a string, b string")
    assert zero.select(L.percent_of("a", "b")).first()[0] is None


def test_year_filter_on_text_and_dates(spark):
    text = spark.createDataFrame(
        [("2012-12-31",), ("2013-01-01",), ("2013-12-31",), ("2014-01-01",), ("x",)], "dt string"
    )
    kept = [("2013-01-01",), ("2013-12-31",)]
    assert rows_of(text.where(L.in_year(text, "dt", 2013))) == kept
    typed = text.select(L.as_date("dt").alias("dt"))
    found = typed.where(L.in_year(typed, "dt", 2013)).select(typed.dt.cast("string"))
    assert rows_of(found) == kept
