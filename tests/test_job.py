"""The whole run over files, rebuilt years and increments."""

import csv
import os
import shutil
from pathlib import Path

import pytest
from conftest import Golden, rows_of
from pyspark.sql import functions as F

from landfall import __main__ as command
from landfall import schemas
from landfall.operators import dimensions, facts
from landfall.operators.lookups import code_list
from landfall.plans.job import JobConfig, run_job
from landfall.sources import readers, versions
from landfall.streaming import increments
from landfall.streaming.increments import add_increment, saved_counts


def write_text(path, header, rows, sep=","):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, delimiter=sep)
        writer.writerow(header)
        writer.writerows([["" if value is None else value for value in row] for row in rows])
    return str(path)


def write_labels(path, pairs):
    path.write_text("".join(f"   '{code}'\t=\t'{label}   '\n" for code, label in pairs))
    return str(path)


@pytest.fixture
def files(golden, tmp_path):
    """The fixture as source files; the city file has a column more and another order."""
    golden.admissions.write.parquet(str(tmp_path / "i94"))
    names = schemas.DEMOGRAPHICS.fieldNames()
    cities = [("Some City", *row[::-1]) for row in Golden.demographics]
    return {
        "admissions": str(tmp_path / "i94"),
        "demographics": write_text(tmp_path / "d.csv", ["City", *names[::-1]], cities, ";"),
        "airports": write_text(tmp_path / "a.csv", schemas.AIRPORTS.fieldNames(), Golden.airports),
        "temperatures": write_text(
            tmp_path / "t.csv", schemas.TEMPERATURES.fieldNames(), Golden.temperatures
        ),
        "countries": write_labels(tmp_path / "countries.txt", Golden.countries),
        "states": write_labels(tmp_path / "states.txt", Golden.states),
        "cities": write_labels(tmp_path / "cities.txt", Golden.cities),
        "output": str(tmp_path / "fact"),
    }


def test_run(spark, files):
    result = run_job(spark, JobConfig(**files, fail_on_quality=True))
    assert rows_of(result.fact) == Golden.fact
    assert result.fact.schema == schemas.FACT
    assert result.total.first()[0] == 3
    assert rows_of(result.null_flags) == [(False,) * 4]
    assert {row.check for row in result.report.collect()} == {
        "total arrivals", "rows with a missing key", "temperature keys", "demographics keys",
        "airport keys",
    }
    views = {table.name for table in spark.catalog.listTables()}
    assert {"immigration", "temperature", "demographics", "airport"} <= views
    again = run_job(spark, JobConfig(**files))
    assert rows_of(again.fact) == Golden.fact


def test_failed_quality_stops_the_run(spark, files):
    files["admissions_format"] = "csv"
    files["admissions"] = write_text(
        files["output"] + "-i94.csv", schemas.I94.fieldNames(), [[None] * len(schemas.I94)]
    )
    result = run_job(spark, JobConfig(**files))
    assert result.fact.count() == 0
    with pytest.raises(RuntimeError, match="total arrivals"):
        run_job(spark, JobConfig(**files, fail_on_quality=True))


def test_a_failed_run_leaves_the_published_fact(spark, files):
    run_job(spark, JobConfig(**files))
    files["admissions"] = files["output"] + "-none"
    Path(files["admissions"]).mkdir()
    with pytest.raises(RuntimeError, match="total arrivals"):
        run_job(spark, JobConfig(**files, fail_on_quality=True))
    assert rows_of(readers.read_fact(spark, files["output"])) == Golden.fact
    assert not [p for p in Path(files["output"]).iterdir() if p.name.startswith("_staged")]


def test_csv_extracts(spark, golden, tmp_path):
    golden.admissions.write.option("header", True).csv(str(tmp_path / "i94"))
    found = readers.read_admissions(spark, str(tmp_path / "i94"), "csv")
    assert rows_of(found) == rows_of(golden.admissions)


def test_csv_extracts_by_name(spark, golden, tmp_path):
    """Another column order, columns missing and one more; then a file with another header."""
    used = ["i94addr", "i94port", "i94res", "i94mon", "i94yr", "cicid"]
    rows = [[row[c] for c in used] + ["x"] for row in golden.admissions.collect()]
    (tmp_path / "in").mkdir()
    write_text(tmp_path / "in" / "a.csv", [*used, "extra"], rows)
    found = readers.read_admissions(spark, str(tmp_path / "in"), "csv")
    assert rows_of(found) == rows_of(golden.admissions)

    landing, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    place = (golden.states, golden.cities)
    add_increment(spark, landing, counts, fmt="csv")
    full = facts.counts_by_code(golden.admissions, *place)
    assert rows_of(saved_counts(spark, counts, *place)) == rows_of(full)

    write_text(tmp_path / "in" / "b.csv", ["extra", *used], [["x", *row[:-1]] for row in rows])
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_admissions(spark, str(tmp_path / "in"), "csv").collect()


def test_one_year_is_replaced_in_place(spark, golden, files, tmp_path):
    later = golden.admissions.withColumn("i94yr", F.lit(2017.0))
    later.write.mode("append").parquet(files["admissions"])
    both = rows_of(run_job(spark, JobConfig(**files)).fact)
    assert len(both) == 4
    # one more admission arrives for 2017 only
    later.where("cicid = 1").write.mode("append").parquet(files["admissions"])
    result = run_job(spark, JobConfig(**files, year_only=2017))
    assert rows_of(result.fact.where("year = 2016")) == Golden.fact
    assert result.total.first()[0] == 7


@pytest.fixture
def landing(spark, golden, tmp_path):
    """Functions that count what has landed, and give saved and full counts."""
    folder, counts = str(tmp_path / "in"), str(tmp_path / "counts")

    def run(states=golden.states, cities=golden.cities):
        add_increment(spark, folder, counts)
        full = facts.counts_by_code(readers.read_admissions(spark, folder), states, cities)
        return rows_of(saved_counts(spark, counts, states, cities)), rows_of(full)

    return tmp_path / "in", run


def test_increments_add_up_to_the_full_build(spark, golden, landing):
    folder, run = landing
    for part in (0, 1):
        golden.admissions.where(f"cicid % 2 = {part}").write.mode("append").parquet(str(folder / "2016-06"))
        for _ in range(2):  # nothing new: nothing changes
            found, full = run()
            assert found == full != []
    assert full == rows_of(facts.counts_by_code(golden.admissions, golden.states, golden.cities))
    # a list that changes holds for what was counted before
    more = code_list(golden.state_labels.where("code <> 'AK'"))
    found, full = run(states=more)
    assert found == full == [row for row in run()[0] if row[3] != "AK"]


def test_a_file_delivered_anew_replaces_its_counts(golden, landing):
    folder, run = landing
    folder.mkdir()
    golden.admissions.where("cicid = 1").toPandas().to_parquet(folder / "june.parquet")
    assert run()[0] == run()[1]
    os.utime(folder / "june.parquet", (1, 1))
    run()
    golden.admissions.toPandas().to_parquet(folder / "june.parquet")
    found, full = run()
    assert found == full and len(found) > 1


def test_interrupted_runs_and_empty_files(spark, golden, landing, tmp_path):
    folder, run = landing
    golden.admissions.write.parquet(str(folder))
    golden.admissions.limit(0).coalesce(1).write.mode("append").parquet(str(folder))
    found, full = run()
    counts = tmp_path / "counts"
    saved = sorted(p.name for p in (counts / "counts").iterdir())
    assert found == full and run()[0] == full
    assert sorted(p.name for p in (counts / "counts").iterdir()) == saved  # nothing is read again
    # what a run wrote before it was killed does not count
    for kind in ("ledger", "counts"):
        stored = next((counts / kind).glob("_data=*"))
        shutil.copytree(stored, counts / kind / "_data=zzz")
    assert run()[0] == full
    # the same files counted by a second run at once count once
    versions.commit(spark, str(counts), lambda now: now.entries | increments._entry("_data=zzz", now.version))
    assert run()[0] == full


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_nested_and_keyed_folders(spark, golden, tmp_path, fmt):
    root = str(tmp_path / "in")
    for half in (0, 1):
        part = golden.admissions.where(f"cicid % 2 = {half}").coalesce(1)
        part.write.format(fmt).option("header", True).save(f"{root}/2016/part-{half}")
    assert rows_of(readers.read_admissions(spark, root, fmt)) == rows_of(golden.admissions)
    keyed = str(tmp_path / "keyed")
    golden.admissions.write.format(fmt).option("header", True).partitionBy("i94yr", "i94port").save(keyed)
    assert rows_of(readers.read_admissions(spark, keyed, fmt)) == rows_of(golden.admissions)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_absent_key_columns_are_an_error(spark, golden, tmp_path, fmt):
    root = str(tmp_path / "in")
    golden.admissions.write.format(fmt).option("header", True).save(f"{root}/good")
    renamed = golden.admissions.withColumnRenamed("i94yr", "i94year").drop("i94addr")
    renamed.coalesce(1).write.format(fmt).option("header", True).save(f"{root}/bad")
    with pytest.raises(ValueError, match="i94yr, i94addr"):
        readers.read_admissions(spark, f"{root}/bad", fmt)
    if fmt == "parquet":  # CSV files of one call share a header
        with pytest.raises(ValueError, match="i94yr, i94addr"):
            readers.read_admissions(spark, root, fmt)
    (tmp_path / "none").mkdir()
    assert readers.read_admissions(spark, str(tmp_path / "none"), fmt).count() == 0


def test_a_rebuilt_year_loses_stale_months(spark, golden, files):
    later = golden.admissions.withColumn("i94yr", F.lit(2017.0))
    later.write.mode("append").parquet(files["admissions"])
    run_job(spark, JobConfig(**files))
    shutil.rmtree(files["admissions"])
    golden.admissions.write.parquet(files["admissions"])
    result = run_job(spark, JobConfig(**files, year_only=2017))  # 2017 comes out empty
    assert rows_of(result.fact) == Golden.fact and result.total.first()[0] == 3


def test_run_with_saved_counts(spark, golden, files, tmp_path):
    """A later run reads only what arrived since, and gives the full build's result."""
    cfg = JobConfig(**files, saved_counts=str(tmp_path / "saved"))
    assert rows_of(run_job(spark, cfg).fact) == Golden.fact
    golden.admissions.withColumn("i94yr", F.lit(2017.0)).write.mode("append").parquet(
        files["admissions"]
    )
    increased = rows_of(run_job(spark, cfg).fact)
    files["output"] += "-full"
    assert increased == rows_of(run_job(spark, JobConfig(**files)).fact)
    assert len(increased) == 4


def test_no_extract_yet(spark, golden, tmp_path):
    (tmp_path / "in").mkdir()
    landing, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    add_increment(spark, landing, counts)
    assert saved_counts(spark, counts, golden.states, golden.cities).count() == 0


def test_command_line(files):
    argv = []
    for name, path in files.items():
        argv += [f"--{name}", path]
    args = command.parse_args([*argv, "--use-state-aliases", "--temperature-year", "2012"])
    assert args.use_state_aliases and args.temperature_year == 2012
    assert args.on_unknown == "null" and args.year_only is None


def test_the_command_runs_and_shows_its_result(spark, files, capsys):
    argv = [text for name, path in files.items() for text in (f"--{name}", path)]
    command.main(argv)
    shown = capsys.readouterr().out
    assert "JAPAN|" in shown and "fact_table_count" in shown
    assert "rows with a missing key" in shown and shown.count("+\n") >= 12
    assert rows_of(readers.read_fact(spark, files["output"])) == Golden.fact


def test_names_ignore_case(spark, files, golden, tmp_path):
    """A temperature file whose header is in other letters."""
    header = [name.lower() for name in schemas.TEMPERATURES.fieldNames()]
    path = write_text(tmp_path / "lower.csv", header, Golden.temperatures)
    read = readers.read_temperatures(spark, path)
    want = dimensions.dim_temperature(golden.temperatures, golden.state_names)
    assert rows_of(dimensions.dim_temperature(read, golden.state_names)) == rows_of(want)
