"""Queries on deliveries in any order, merged stores, years replaced at once and checks from saved sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from landfall.operators import facts, quality
from landfall.plans import shapes
from landfall.plans.catalog import query
from landfall.plans.products import SPLIT_DAY, landed
from landfall.session import hadoop_path, scratch_path
from landfall.sources import readers, tables, versions
from landfall.streaming.increments import add_increment, compact, saved_counts

YEAR = tables.TEMPERATURE_YEAR
# A month that is delivered wrongly at first, and its last delivery's time: older than the first one's.
CORRECTED = f"{YEAR}-01"
OLDER = 1_000_000_000_000
# Rows of the corrected month to a file.
FILE_ROWS = 1_000_000


@query("scan_i94_year", ["src_i94"], f"SELECT * FROM src_i94 WHERE i94yr = {YEAR}")
def scan_i94_year(spark, sf):
    """One year of extracts, of which some lie in folders by year and some do not."""
    rows = tables.admissions(spark, sf).withColumn("cicid", F.col("cicid").cast("double"))
    path = scratch_path(spark, "extracts")
    half = F.col("cicid") % 2 == 0
    rows.where(half).write.partitionBy("i94yr").parquet(f"{path}/by-year")
    rows.where(~half).write.parquet(f"{path}/unsorted")
    read = readers.read_admissions(spark, path, year=YEAR).select(*rows.columns)
    return read.withColumn("cicid", F.col("cicid").cast("bigint"))


def _fact_of_store(spark, sf, counts):
    states, cities, countries = shapes.code_lists(spark, sf)
    counted = saved_counts(spark, counts, states, cities)
    return shapes.fact_of(spark, sf, facts.name_counts(counted, states, countries))


def _deliver_month(spark, rows, landing, files=1, time=None):
    """Put ``rows`` in the files of the corrected month, with a time of their own if given.

    A row's file, of ``files``, follows from its key, so names are the same each time.
    """
    made = scratch_path(spark, "delivery")
    rows.withColumn("cicid", F.col("cicid").cast("double")).repartition(files, "cicid").write.parquet(made)
    _, folder = hadoop_path(spark, f"{landing}/{CORRECTED}")
    for name in versions.children(spark, made):
        if not name.endswith(".parquet"):
            continue
        system, source = hadoop_path(spark, f"{made}/{name}")
        _, target = hadoop_path(spark, f"{landing}/{CORRECTED}/extract-{name.split('-')[1]}.parquet")
        system.mkdirs(folder)
        system.delete(target, False)
        system.rename(source, target)
        if time is not None:
            system.setTimes(target, time, -1)


@query("incremental_redelivered", ["fact"], "SELECT * FROM fact")
def incremental_redelivered(spark, sf):
    """A month arrives twice under the same names, the right one second and with the older time."""
    landing, counts = scratch_path(spark, "landing"), scratch_path(spark, "counts")
    bounds = (f"{CORRECTED}-01", f"{YEAR}-02-01")
    for days in ({"end_day": bounds[0]}, {"first_day": bounds[1]}):
        landed(tables.admissions(spark, sf, **days), landing)
    made = scratch_path(spark, "month")
    month = tables.admissions(spark, sf, *bounds)
    month.write.parquet(made)
    month = spark.read.schema(month.schema).parquet(made)
    files = 1 + month.count() // FILE_ROWS
    _deliver_month(spark, month.where("cicid % 2 = 0"), landing, files)
    add_increment(spark, landing, counts)
    _deliver_month(spark, month, landing, files, OLDER)
    add_increment(spark, landing, counts)
    return _fact_of_store(spark, sf, counts)


@query("incremental_compacted", ["fact"], "SELECT * FROM fact")
def incremental_compacted(spark, sf):
    """Counts of two landings merged into one folder, a third one beside it."""
    landing, counts = scratch_path(spark, "landing"), scratch_path(spark, "counts")
    landed(tables.admissions(spark, sf, None, SPLIT_DAY), landing)
    add_increment(spark, landing, counts)
    landed(tables.admissions(spark, sf, SPLIT_DAY, f"{YEAR}-07-01"), landing)
    add_increment(spark, landing, counts)
    compact(spark, counts)
    landed(tables.admissions(spark, sf, f"{YEAR}-07-01"), landing)
    add_increment(spark, landing, counts)
    return _fact_of_store(spark, sf, counts)


def _published(spark, sf, years):
    """The fact with a wrong extra month in some years, and these years rebuilt but not yet published."""
    path = scratch_path(spark, "fact")
    context = shapes.dimensions_of_rows(spark, sf)
    whole = facts.fact_arrivals(shapes.counts(spark, sf), *context)
    extra = whole.where(F.col("year").isin(*years)).withColumn("immigration_month", F.lit(13))
    readers.write_fact(whole.unionByName(extra), path)
    rebuilt = {}
    for year in years:
        counts = shapes.counts(spark, sf, f"{year}-01-01", f"{year + 1}-01-01")
        rebuilt[year] = readers.stage_fact(facts.fact_arrivals(counts, *context), path)
    return path, rebuilt


@query("fact_years_at_once", ["fact"], "SELECT * FROM fact")
def fact_years_at_once(spark, sf):
    """Two years are rebuilt from one state of the fact and published one after the other."""
    path, rebuilt = _published(spark, sf, [YEAR, YEAR + 1])
    for year, staged in rebuilt.items():
        readers.publish_fact(staged, year)
    return readers.read_fact(spark, path)


@query(
    "dq_from_sums",
    ["fact"],
    """SELECT 'total arrivals' AS check, sum(to_immigration_state_count) > 0 AS passed,
              CAST(sum(to_immigration_state_count) AS BIGINT) AS observed FROM fact
       UNION ALL
       SELECT 'rows with a missing key', count(*) = 0, count(*) FROM fact
       WHERE year IS NULL OR immigration_month IS NULL OR immigration_origin IS NULL
          OR to_immigration_state IS NULL""",
)
def dq_from_sums(spark, sf):
    """The checks after one year is replaced, from the sums that each year was published with."""
    path, rebuilt = _published(spark, sf, [YEAR])
    entries = readers.publish_fact(rebuilt[YEAR], YEAR)
    return quality.report_of_sums(spark, list(readers.checks_of(spark, path, entries).values()))
