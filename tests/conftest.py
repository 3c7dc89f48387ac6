import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from landfall import schemas  # noqa: E402
from landfall.operators.lookups import code_list  # noqa: E402
from landfall.session import build_session  # noqa: E402
from landfall.sources.labels import reverse_labels  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "landfall-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Golden:
    """Ten admissions and small companions that show every reason to keep or drop a row."""

    states = [("AK", "ALASKA"), ("CA", "CALIFORNIA"), ("NC", "N. CAROLINA"), ("99", "All Other Codes")]
    countries = [("209", "JAPAN"), ("582", "MEXICO"), ("135", "UNITED KINGDOM")]
    cities = [("ANC", "ANCHORAGE"), ("LOS", "LOS ANGELES")]
    # cicid, month, residence, port, address
    admissions = [
        (1, 6, 209, "ANC", "AK"),
        (2, 6, 209, "ANC", "AK"),
        (3, 6, 582, "LOS", "CA"),
        (4, 6, 582, "LOS", None),
        (5, 6, None, "LOS", "CA"),
        (6, 6, 135, "ZZZ", "CA"),
        (7, 6, 135, "LOS", "XX"),
        (8, 6, 135, "LOS", "NC"),
        (9, 7, 135, "LOS", "CA"),
        (10, 6, 135, "LOS", "99"),
    ]
    unknown_country = (11, 6, 998, "LOS", "CA")
    temperatures = [
        ("2013-06-01", "12.34", "Alaska", "United States"),
        ("2013-06-01", "12.34", "Alaska", "United States"),
        ("2013-06-01", "20.05", "California", "United States"),
        ("2012-06-01", "9.9", "Alaska", "United States"),
        ("2013-06-01", "15.0", "Ontario", "Canada"),
        ("2013-06-01", "22.2", "North Carolina", "United States"),
        ("2013-07-01", None, "Alaska", "United States"),
    ]
    airports = [
        ("small_airport", "US", "US-AK", "100"),
        ("small_airport", "US", "US-AK", "301"),
        ("small_airport", "US", "US-AK", None),
        ("large_airport", "US", "US-AK", "999"),
        ("small_airport", "US", "US-CA", "50"),
        ("small_airport", "CA", "CA-BC", "70"),
    ]
    native, asian, black, hispanic, white = (
        "American Indian and Alaska Native", "Asian", "Black or African-American",
        "Hispanic or Latino", "White",
    )
    alaska = ("Alaska", "AK", "32.2", "60", "40", "100", "10", "20")
    city_a = ("California", "CA", "30.0", "100", "100", "200", "20", "50")
    city_b = ("California", "CA", "35.5", "45", "55", "100", "5", None)
    demographics = [
        (*alaska, native, "8"),
        (*alaska, asian, "10"),
        (*alaska, black, "5"),
        (*alaska, hispanic, "7"),
        (*alaska, white, "50"),
        (*city_a, white, "100"),
        (*city_a, asian, "60"),
        (*city_b, white, "20"),
        (*city_b, black, "30"),
    ]
    fact = [
        (2016, 6, "JAPAN", "ALASKA", 2, 54.2, 200.5, 20.0, 8.0, 10.0, 7.0, 5.0, 50.0),
        (2016, 6, "MEXICO", "CALIFORNIA", 1, 68.1, 50.0, 25.0, None, 30.0, None, 30.0, 35.0),
    ]
    unknown_fact = (2016, 6, None, "CALIFORNIA", 1, 68.1, 50.0, 25.0, None, 30.0, None, 30.0, 35.0)


class GoldenFrames:
    def __init__(self, spark):
        self.spark = spark
        labels = "code string, label string"
        self.state_labels = spark.createDataFrame(Golden.states, labels)
        self.states = code_list(self.state_labels)
        self.state_names = code_list(reverse_labels(self.state_labels))
        self.countries = code_list(spark.createDataFrame(Golden.countries, labels))
        self.cities = code_list(spark.createDataFrame(Golden.cities, labels))
        self.temperatures = spark.createDataFrame(Golden.temperatures, schemas.TEMPERATURES)
        self.airports = spark.createDataFrame(Golden.airports, schemas.AIRPORTS)
        self.demographics = spark.createDataFrame(Golden.demographics, schemas.DEMOGRAPHICS)
        self.admissions = self.admit(Golden.admissions)

    def admit(self, rows):
        doubled = [
            (float(i), 2016.0, float(month), None if res is None else float(res), port, addr)
            for i, month, res, port, addr in rows
        ]
        columns = (
            "cicid double, i94yr double, i94mon double, i94res double, i94port string, i94addr string"
        )
        given = self.spark.createDataFrame(doubled, columns)
        absent = [f for f in schemas.I94.fields if f.name not in given.columns]
        full = given.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
        return schemas.conform(full, schemas.I94)


@pytest.fixture(scope="session")
def golden(spark):
    return GoldenFrames(spark)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
