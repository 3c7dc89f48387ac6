"""Many files, deliveries in any order, publishing in one step."""

import os
import threading
import uuid
from pathlib import Path

import pytest
from conftest import Golden, rows_of
from pyspark.sql import functions as F
from test_job import files, landing  # noqa: F401

from landfall import schemas
from landfall.operators import facts
from landfall.plans import deliveries, products
from landfall.plans.job import JobConfig, run_job
from landfall.sources import readers, versions
from landfall.streaming import increments
from landfall.streaming.increments import add_increment, compact, saved_counts


def spoil(path):
    """Make a file unreadable; it keeps its size and time."""
    seen = os.stat(path)
    path.write_bytes(b"x" * seen.st_size)
    os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    checksum = path.with_name(f".{path.name}.crc")
    if checksum.exists():
        checksum.unlink()


def parquet_files(folder):
    return [p for p in Path(folder).rglob("*.parquet")]


def jobs_of(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_jobs_do_not_grow_with_the_number_of_files(spark, golden, tmp_path):
    def jobs(files):
        folder = str(tmp_path / f"in-{files}")
        golden.admissions.repartition(files, "cicid").write.option("maxRecordsPerFile", 1).parquet(folder)
        for _ in range(files // 10):
            golden.admissions.write.mode("append").option("maxRecordsPerFile", 1).parquet(folder)
        assert len(parquet_files(folder)) >= files
        return jobs_of(spark, lambda: readers.read_admissions(spark, folder).count())

    assert jobs(40) == jobs(10)


@pytest.mark.parametrize("vectorized", ["true", "false"])
def test_a_file_without_a_key_column_is_named(spark, golden, tmp_path, vectorized):
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
    try:
        root = str(tmp_path / "in")
        golden.admissions.write.parquet(f"{root}/good")
        # NULL in every row is not the same as no column
        golden.admissions.withColumn("i94addr", F.lit(None).cast("string")).write.parquet(f"{root}/null")
        assert readers.read_admissions(spark, root).count() == 2 * len(Golden.admissions)
        golden.admissions.drop("i94port").withColumnRenamed("i94mon", "I94MON").coalesce(1).write.parquet(f"{root}/bad")
        with pytest.raises(ValueError, match="/bad/.* lacks the columns i94port$"):
            readers.read_admissions(spark, root)
        with pytest.raises(Exception, match="/bad/.* lacks the columns i94port"):
            readers.read_admissions(spark, root, check=False).collect()
        # a folder may give it
        os.rename(f"{root}/bad", f"{root}/i94port=LOS")
        for check in (True, False):
            found = readers.read_admissions(spark, root, check=check)
            assert found.count() == 3 * len(Golden.admissions)
    finally:
        spark.conf.unset("spark.sql.parquet.enableVectorizedReader")


def test_folder_values(spark, golden, tmp_path):
    root = str(tmp_path / "in")
    given = golden.admissions.withColumn("i94port", F.when(F.col("cicid") > 2, F.col("i94port")))
    given.write.partitionBy("i94yr", "i94port").parquet(root)
    assert rows_of(readers.read_admissions(spark, root)) == rows_of(given)


@pytest.mark.parametrize("check", [True, False])
def test_one_year_opens_only_its_folders(spark, golden, tmp_path, check):
    root = tmp_path / "in"
    for year in (2015.0, 2016.0, 2017.0):
        golden.admissions.withColumn("i94yr", F.lit(year)).write.mode("append").partitionBy("i94yr").parquet(str(root))
    mixed = golden.admissions.union(golden.admissions.withColumn("i94yr", F.lit(2015.0)))
    mixed.write.parquet(str(root / "more"))
    for path in parquet_files(root):
        if "i94yr=2015" in str(path) or "i94yr=2017" in str(path):
            spoil(path)
    found = readers.read_admissions(spark, str(root), year=2016, check=check)
    assert rows_of(found) == sorted(2 * rows_of(golden.admissions), key=repr)
    with pytest.raises(Exception):  # noqa: B017
        readers.read_admissions(spark, str(root), check=False).collect()


def test_one_year_reads_row_groups_by_their_bounds(spark, golden, tmp_path):
    root = str(tmp_path / "in")
    golden.admissions.write.parquet(root)
    plan = readers.read_admissions(spark, root, year=2016)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(i94yr,2016.0)" in plan


def test_an_increment_names_a_file_without_a_key_column(spark, golden, tmp_path, monkeypatch):
    landing, counts = tmp_path / "in", str(tmp_path / "counts")
    golden.admissions.coalesce(1).write.parquet(str(landing / "good"))
    golden.admissions.drop("i94res").coalesce(1).write.parquet(str(landing / "bad"))
    with pytest.raises(Exception, match="/bad/.* lacks the columns i94res"):
        add_increment(spark, str(landing), counts)
    assert versions.latest(spark, counts) is None  # nothing is recorded
    os.rename(landing / "bad", tmp_path / "aside")
    golden.admissions.coalesce(1).write.parquet(str(landing / "more"))
    monkeypatch.setattr(increments, "FILES_AT_ONCE", 1)  # a block for each file
    add_increment(spark, str(landing), counts)
    place = (golden.states, golden.cities)
    full = facts.counts_by_code(readers.read_admissions(spark, str(landing)), *place)
    assert rows_of(saved_counts(spark, counts, *place)) == rows_of(full)
    assert len(versions.latest(spark, counts).entries) == 2


def test_an_older_state_that_comes_back_holds(spark, golden, landing):  # noqa: F811
    folder, run = landing
    folder.mkdir()
    june = folder / "june.parquet"

    def deliver(condition, seconds):
        golden.admissions.where(condition).toPandas().to_parquet(june)
        os.utime(june, (seconds, seconds))
        found, full = run()
        assert found == full
        return found

    first = deliver("cicid = 1", 1_000)
    assert len(deliver("cicid < 4", 2_000)) > len(first)
    assert deliver("cicid = 1", 1_000) == first  # known before: the same size and time
    assert deliver("cicid = 3", 500) != first  # older than any before
    assert deliver("cicid < 4", 2_000) != first


def test_the_store_follows_the_files(spark, golden, tmp_path):
    landing, counts = tmp_path / "in", str(tmp_path / "counts")
    landing.mkdir()
    place = (golden.states, golden.cities)

    def size():
        return sum(p.stat().st_size for p in parquet_files(counts))

    sizes = []
    for run in range(2 * increments.FOLDERS + 4):
        for name in ("june", "july"):
            golden.admissions.where(f"cicid <= {5 + run % 6}").toPandas().to_parquet(landing / f"{name}.parquet")
            os.utime(landing / f"{name}.parquet", (run, run))
        add_increment(spark, str(landing), counts)
        sizes.append(size())
    for _ in range(versions.KEPT + 1):
        os.utime(landing / "june.parquet", (len(sizes), len(sizes) + _))
        add_increment(spark, str(landing), counts)
        compact(spark, counts)
    found = versions.latest(spark, counts)
    assert len(found.entries) == 1
    ledger = spark.read.parquet(f"{counts}/ledger/{next(iter(found.entries))}")
    assert ledger.count() == 2
    assert max(sizes) <= (increments.FOLDERS + versions.KEPT + 3) * max(sizes[:2])
    assert len(list(Path(f"{counts}/counts").glob("_data=*"))) <= 2 * versions.KEPT
    full = facts.counts_by_code(readers.read_admissions(spark, str(landing)), *place)
    assert rows_of(saved_counts(spark, counts, *place)) == rows_of(full)


def test_a_merge_keeps_what_comes_meanwhile(spark, golden, tmp_path, monkeypatch):
    landing, counts = tmp_path / "in", str(tmp_path / "counts")
    landing.mkdir()

    def deliver(name, condition):
        golden.admissions.where(condition).toPandas().to_parquet(landing / f"{name}.parquet")
        add_increment(spark, str(landing), counts)

    deliver("a", "cicid < 3")
    deliver("b", "cicid = 3")
    commit = versions.commit

    def late(*args):
        monkeypatch.setattr(versions, "commit", commit)
        deliver("a", "cicid = 1")
        return commit(*args)

    monkeypatch.setattr(versions, "commit", late)
    compact(spark, counts)
    assert len(versions.latest(spark, counts).entries) == 2
    place = (golden.states, golden.cities)
    full = facts.counts_by_code(readers.read_admissions(spark, str(landing)), *place)
    assert rows_of(saved_counts(spark, counts, *place)) == rows_of(full)


def test_saved_counts_open_no_old_file(spark, golden, files, tmp_path):  # noqa: F811
    cfg = JobConfig(**files, saved_counts=str(tmp_path / "saved"))
    assert rows_of(run_job(spark, cfg).fact) == Golden.fact
    for path in parquet_files(files["admissions"]):
        spoil(path)
    golden.admissions.withColumn("i94yr", F.lit(2017.0)).write.mode("append").parquet(files["admissions"])
    assert len(rows_of(run_job(spark, cfg).fact)) == 2 * len(Golden.fact)
    with pytest.raises(Exception):  # noqa: B017  the view is what reads them
        spark.table("immigration").collect()


def fact_rows(spark, *years):
    row = (6, "JAPAN", "ALASKA", 2, *[1.0] * 8)
    return spark.createDataFrame([(year, *row) for year in years], schemas.FACT)


def years_of(spark, path):
    return sorted(row.year for row in readers.read_fact(spark, path).collect())


class Killed(BaseException):
    pass


@pytest.mark.parametrize("year", [None, 2017])
@pytest.mark.parametrize("at", ["_claim", "claimed", "expire", "drop"])
def test_a_kill_leaves_the_old_or_the_new_fact(spark, tmp_path, monkeypatch, at, year):
    path = str(tmp_path / "fact")
    for _ in range(versions.KEPT + 1):
        readers.write_fact(fact_rows(spark, 2016), path)
    staged = readers.stage_fact(fact_rows(spark, 2017), path)
    assert years_of(spark, path) == [2016]
    new = [2017] if year is None else [2016, 2017]
    with monkeypatch.context() as patch:
        if at == "claimed":
            claim = versions._claim

            def killed(*args):
                assert claim(*args)
                raise Killed

            patch.setattr(versions, "_claim", killed)
        else:
            def killed(*args):
                raise Killed

            patch.setattr(versions, at, killed)
        with pytest.raises(Killed):
            readers.publish_fact(staged, year)
        assert years_of(spark, path) == ([2016] if at == "_claim" else new)
    readers.publish_fact(readers.stage_fact(fact_rows(spark, 2017), path), year)
    assert years_of(spark, path) == new
    versions.expire(spark, path, 1)
    assert years_of(spark, path) == new


def test_two_years_rebuilt_at_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    readers.write_fact(fact_rows(spark, 2015, 2016, 2017), path)
    staged = {year: readers.stage_fact(fact_rows(spark, year, year), path) for year in (2016, 2017)}
    both = [threading.Thread(target=readers.publish_fact, args=(s, year)) for year, s in staged.items()]
    for thread in both:
        thread.start()
    for thread in both:
        thread.join()
    assert years_of(spark, path) == [2015, 2016, 2016, 2017, 2017]


def test_many_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "table")

    def write(name):
        versions.commit(spark, path, lambda now: now.entries | {name: {"folders": []}})

    threads = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(12)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    found = versions.latest(spark, path)
    assert found.version == 12 and set(found.entries) == {f"w{i}" for i in range(12)}


def test_a_number_is_taken_once_by_rename(spark, tmp_path):
    path = spark._jvm.org.apache.hadoop.fs.Path
    target = path(f"file:{tmp_path}/1.json")
    for name, won in (("a", True), ("b", False)):
        (tmp_path / name).write_text(name)
        assert versions._rename_if_free(spark, path(f"file:{tmp_path}/{name}"), target) is won
    assert (tmp_path / "1.json").read_text() == "a"


def test_a_plain_fact_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact_rows(spark, 2015, 2016).write.partitionBy("year", "immigration_month").parquet(path)
    assert years_of(spark, path) == [2015, 2016]
    readers.write_fact_year(fact_rows(spark, 2016, 2016), path, 2016)
    assert years_of(spark, path) == [2015, 2016, 2016]
    checks = readers.checks_of(spark, path, readers.published_years(spark, path))
    assert {year: sums["arrivals"] for year, sums in checks.items()} == {"year=2015": 2, "year=2016": 4}


def test_a_year_run_reads_no_other_year(spark, golden, files):  # noqa: F811
    later = golden.admissions.withColumn("i94yr", F.lit(2017.0))
    later.write.mode("append").parquet(files["admissions"])
    assert run_job(spark, JobConfig(**files)).total.first()[0] == 6
    for path in parquet_files(files["output"]):
        if "year=2016" in str(path):
            spoil(path)
    result = run_job(spark, JobConfig(**files, year_only=2017))
    assert result.total.first()[0] == 6
    assert rows_of(result.null_flags) == [(False,) * 4]
    assert {r["check"]: r["observed"] for r in result.report.collect()}["total arrivals"] == 6


def test_a_large_month_lands_in_several_files(spark, golden, tmp_path):
    """A month that no task should hold is split; small ones are not."""
    rows = golden.admissions.select("*", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("col")
    rows = rows.withColumn("i94mon", F.when(F.rand(3) < 0.9, 4.0).otherwise(5.0)).repartition(8)
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "4k")
    try:
        products.landed(rows, str(tmp_path))
    finally:
        spark.conf.set(advisory, before)
    months = {p.name: len(parquet_files(p)) for p in tmp_path.iterdir() if p.is_dir()}
    assert max(months.values()) > 1
    assert rows_of(readers.read_admissions(spark, str(tmp_path)).select("cicid", "i94addr")) == rows_of(rows.select("cicid", "i94addr"))


def test_a_month_of_several_files_is_redelivered(spark, golden, tmp_path):
    """No task holds the month; the files of the second delivery replace those of the first by name."""
    landing, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    rows = golden.admissions.select("*", F.explode(F.sequence(F.lit(0), F.lit(30))).alias("k"))
    rows = rows.withColumn("cicid", F.col("cicid") * 31 + F.col("k")).drop("k")
    names = []
    for given, time in ((rows.where("cicid % 2 = 0"), None), (rows, deliveries.OLDER)):
        deliveries._deliver_month(spark, given, landing, 4, time)
        names.append(sorted(p.name for p in parquet_files(landing)))
        add_increment(spark, landing, counts)
    assert names[0] == names[1] and len(names[1]) == 4
    held = increments._holding_counts(spark, counts, versions.latest(spark, counts))
    want = facts.addressed(rows).count()
    assert held.agg(F.sum("arrivals")).first()[0] == want
