"""Adding new extracts without reading the old ones again.

A ledger has every delivery that was counted: file, size, modification time and the number of the
change that recorded it. A file whose size or time is not that of its last delivery was delivered anew,
also if its time is older, as with a file restored from a copy, and also if it is back in a state
known from before. The last delivery holds, so a correction replaces what it corrects. Counts are
saved before any code list is applied, so changed lists take effect at the next build of the fact.

Ledger and counts are one versioned table: a block of files is recorded in one step with its
counts, or not at all. Once it has many folders they are merged, and what no longer holds goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import facts
from landfall.operators.lookups import CodeList
from landfall.sources import versions
from landfall.sources.readers import admission_files, read_admissions_by_file

LEDGER_SCHEMA = "file string, size bigint, modified timestamp, _data string"
COUNTS_SCHEMA = (
    "file string, year int, month int, origin_code string, state_code string, port_code string, "
    "arrivals bigint, _data string"
)
# Files whose paths the driver holds and one job reads.
FILES_AT_ONCE = 50_000
# Folders from which they are merged.
FOLDERS = 16


def add_increment(spark: SparkSession, landing: str, counts_path: str, fmt="parquet") -> None:
    """Count the extracts under ``landing`` whose present state has not been counted yet.

    Counts of a file that was taken away from ``landing`` stay.
    """
    delivered = ["file", "size", "modified"]
    while True:
        known = _last_deliveries(spark, counts_path, versions.latest(spark, counts_path))
        new = admission_files(spark, landing).join(known, delivered, "left_anti").select("path", *delivered)
        block = [tuple(row) for row in new.limit(FILES_AT_ONCE).collect()]
        if block:
            _count_block(spark, counts_path, block, fmt)
        if len(block) < FILES_AT_ONCE:
            break
    found = versions.latest(spark, counts_path)
    if found is not None and len(found.entries) > FOLDERS:
        compact(spark, counts_path)


def _count_block(spark, counts_path, block, fmt):
    name = versions.fresh_name()
    ledger = spark.createDataFrame(block, "path string, file string, size bigint, modified timestamp")
    ledger.drop("path").coalesce(1).write.parquet(f"{counts_path}/ledger/{name}")
    # a file without a key column stops the count that meets it
    rows = read_admissions_by_file(spark, [path for path, *_ in block], fmt, check=False)
    counted = facts.count_codes(
        facts.addressed(rows), False, F.col("i94port").alias("port_code"), "file", "modified"
    )
    # a file that changed since it was listed is counted by the next run
    counted = counted.join(ledger.select("file", "modified"), ["file", "modified"], "left_semi")
    counted.drop("modified").write.parquet(f"{counts_path}/counts/{name}")
    versions.commit(spark, counts_path, lambda now: now.entries | _entry(name, now.version))


def _entry(name, sequence):
    return {name: {"folders": [f"ledger/{name}", f"counts/{name}"], "sequence": sequence}}


def _stored(spark, counts_path, kind, schema, snapshot):
    """The rows of all folders of a kind, each with the name of its folder as ``_data``."""
    names = [] if snapshot is None else list(snapshot.entries)
    if not names:
        return spark.createDataFrame([], schema)
    base = f"{counts_path}/{kind}"
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{n}" for n in names])
    return rows.withColumn("_data", F.concat(F.lit("_data="), "_data"))


def _last_deliveries(spark, counts_path, snapshot):
    """(file, size, modified, _data) of the last delivery of each file."""
    ledger = _stored(spark, counts_path, "ledger", LEDGER_SCHEMA, snapshot)
    entries = {} if snapshot is None else snapshot.entries
    sequence = spark.createDataFrame(
        [(name, entry["sequence"]) for name, entry in entries.items()], "_data string, sequence bigint"
    )
    last = F.max(F.struct("sequence", "_data", "size", "modified")).alias("last")
    found = ledger.join(F.broadcast(sequence), "_data").groupBy("file").agg(last)  # a row per folder
    return found.select("file", "last.size", "last.modified", "last._data")


def _holding_counts(spark, counts_path, snapshot):
    last = _last_deliveries(spark, counts_path, snapshot).select("file", "_data")
    stored = _stored(spark, counts_path, "counts", COUNTS_SCHEMA, snapshot)
    return stored.join(last, ["file", "_data"], "left_semi")


def compact(spark: SparkSession, counts_path: str) -> None:
    """Merge all folders into one that has the last delivery of each file and its counts.

    What other runs record meanwhile stays beside it and is newer.
    """
    old = versions.latest(spark, counts_path)
    if old is None or len(old.entries) < 2:
        return
    name = versions.fresh_name()
    _last_deliveries(spark, counts_path, old).drop("_data").write.parquet(f"{counts_path}/ledger/{name}")
    _holding_counts(spark, counts_path, old).drop("_data").write.parquet(f"{counts_path}/counts/{name}")
    last = max(entry["sequence"] for entry in old.entries.values())

    def merged(now):
        if not old.entries.keys() <= now.entries.keys():  # another run merged them
            return now.entries
        return {n: e for n, e in now.entries.items() if n not in old.entries} | _entry(name, last)

    versions.commit(spark, counts_path, merged)
    versions.expire(spark, counts_path)


def saved_counts(
    spark: SparkSession, counts_path: str, states: CodeList, cities: CodeList, trim_keys=True
) -> DataFrame:
    """All extracts, each as last counted, as one set of counts by listed code."""
    kept = _holding_counts(spark, counts_path, versions.latest(spark, counts_path))
    return facts.listed_counts(kept.drop("file", "_data"), states, cities, trim_keys)
