"""Label lines, code lists and what labels say."""

import pytest
from conftest import rows_of

from landfall.operators import lookups, ports
from landfall.sources.labels import load_labels, parse_labels, reverse_labels

LINES = [
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'",
    "   'ALC'\t=\t'ALCAN, AK             '",
    "   721 =  'CURACAO' ",
    "   'INT'\t=\t'INT''L FALLS, MN      '",
    "   'AG'\t\t=\t'No PORT Code (AG)'",
    "   'CP '\t=\t'No PORT Code (CP)'",
    "   996 =  'No Country Code (996)' ;",
    "\t'AL'='ALABAMA'",
    "\t'99'='All Other Codes' ;",
]


def frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_every_line_shape(spark):
    found = dict(tuple(row) for row in parse_labels(frame(spark, LINES)).collect())
    assert found == {
        "582": "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)",
        "ALC": "ALCAN, AK",
        "721": "CURACAO",
        "INT": "INT'L FALLS, MN",
        "AG": "No PORT Code (AG)",
        "CP": "No PORT Code (CP)",
        "996": "No Country Code (996)",
        "AL": "ALABAMA",
        "99": "All Other Codes",
    }


def test_raw_keeps_padding_and_plain_quoting(spark):
    lines = [LINES[1], LINES[3], LINES[5]]
    found = {tuple(row) for row in parse_labels(frame(spark, lines), raw=True).collect()}
    assert found == {
        ("ALC", "ALCAN, AK             "),
        ("CP ", "No PORT Code (CP)"),
        ("INT'\t=\t'INT", "L FALLS, MN      "),
    }


def test_line_of_another_shape(spark):
    lines = frame(spark, [LINES[1], "value i94cntyl", ";"])
    with pytest.raises(Exception, match="not a label line"):
        parse_labels(lines).collect()
    assert rows_of(parse_labels(lines, on_bad_line="drop")) == [("ALC", "ALCAN, AK")]


def test_load_from_file(spark, tmp_path):
    path = tmp_path / "codes.txt"
    path.write_text("\n".join(LINES) + "\n")
    assert load_labels(spark, str(path)).count() == len(LINES)


def test_repeated_codes_are_refused(spark):
    pairs = spark.createDataFrame([("0", "STATELESS"), ("705", "STATELESS")], "code string, label string")
    assert lookups.code_list(pairs).rows == 2
    with pytest.raises(ValueError, match="more than once"):
        lookups.code_list(reverse_labels(pairs))


def test_validity(spark):
    labels = [
        ("INVALID: STATELESS", "invalid"),
        ("INVALID - IWAKUNI, JAPAN", "invalid"),
        ("Collapsed Tanzania (should not show)", "collapsed"),
        ("Collapsed into INT, MN", "collapsed"),
        ("No PORT Code (AG)", "no code"),
        ("No Country Code (54)", "no code"),
        ("NORWAY", "valid"),
        ("NOM, AK", "valid"),
        (None, None),
    ]
    df = spark.createDataFrame(labels, "label string, expected string")
    wrong = df.where(~ports.validity("label").eqNullSafe(df.expected))
    assert wrong.collect() == []


def test_city_and_state(spark):
    labels = [
        ("A", "PASO DEL NORTE,TX", "PASO DEL NORTE", "TX"),
        ("B", "LITTLE ROCK, AR (BPS)", "LITTLE ROCK", "AR"),
        ("C", "ASPEN, CO #ARPT", "ASPEN", "CO"),
        ("D", "GEN M. ESCOBEDO, Monterrey, MX", None, None),
        ("E", "Halifax, NS, Canada", None, None),
        ("F", "BELLINGHAM, WASHINGTON #INTL", None, None),
        ("G", "WASHINGTON DC", None, None),
        ("H", "Collapsed into INT, MN", None, None),
        ("I", "SAIPAN, SPN", None, None),
    ]
    df = spark.createDataFrame([row[:2] for row in labels], "code string, label string")
    found = ports.split_city_state(df, lookups.us_states(spark))
    assert [tuple(row) for row in found.orderBy("code").collect()] == labels


def test_collapsed_ports(spark):
    pairs = [
        ("FRG", "Collapsed (FOK) 06/15"),
        ("GTF", "Collapsed into INT, MN"),
        ("T01", "Collapsed (SEA) 06/15"),
        ("FOK", "SUFFOLK COUNTY, NY"),
        ("INT", "INT'L FALLS, MN"),
    ]
    found = ports.collapsed_into(spark.createDataFrame(pairs, "code string, label string"))
    assert rows_of(found) == [
        ("FRG", "FOK", "SUFFOLK COUNTY, NY"),
        ("GTF", "INT", "INT'L FALLS, MN"),
        ("T01", "SEA", None),
    ]


def test_other_bucket(spark, golden):
    df = spark.createDataFrame([("AK",), ("XX",), ("99",), (None,)], "addr string")
    found = lookups.bucket_other(df, df.addr, golden.states, "bucket")
    assert rows_of(found) == rows_of(
        spark.createDataFrame(
            [("AK", "AK"), ("XX", "99"), ("99", "99"), (None, "99")], "addr string, bucket string"
        )
    )


def test_the_last_state_counts(spark):
    """A line of the data dictionary whose city holds a comma and two letters that are no state."""
    labels = spark.createDataFrame([("CRU", "CRUZ BAY, ST JOHN, VI")], "code string, label string")
    found = ports.split_city_state(labels, lookups.us_states(spark)).first()
    assert (found.city, found.state) == ("CRUZ BAY, ST JOHN", "VI")
