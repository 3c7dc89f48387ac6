"""Scans of the four sources and the fact sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.operators import quality
from landfall.sources import versions

# Without these an extract counts nothing.
KEY_COLUMNS = ["i94yr", "i94mon", "i94res", "i94port", "i94addr"]
# Rows of the fact to a file at most.
ROWS_PER_FILE = 5_000_000
# What a scan gives for a column that a file does not have; no extract holds them.
ABSENT_NUMBER = -7.13e301
ABSENT_TEXT = "~ column absent from this file ~"
VECTORIZED = "spark.sql.parquet.enableVectorizedReader"
NO_FOLDER_VALUE = "__HIVE_DEFAULT_PARTITION__"


def admission_files(spark: SparkSession, path) -> DataFrame:
    """(path, file, size, modified) of every file under ``path``, however deep; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_admissions(spark: SparkSession, path, fmt="parquet", year=None, check=True) -> DataFrame:
    """All extracts under ``path`` (files, or folders of any depth), as parquet or CSV.

    A file with rows must have the five key columns, in any letter case, or be in a ``key=value`` folder
    that gives them; anything else is an error, since absent columns would read as NULL and
    drop every row. Other columns may be absent. CSV files of one call share a header.
    An empty folder has no rows. Where a folder names a value, it holds, as with Spark's partitions.

    The check is one distributed pass over the footers, whatever the number of files. Without
    ``check`` parquet files are opened only when the rows are read, and the error comes then (the row-wise
    parquet reader takes NULLs for absent columns, so where a session asks for it the check is made). ``year``
    gives the rows of one year: files in folders of another are not opened, and in others the bounds in the
    footers tell which row groups to read.
    """
    return _extracts(spark, path, fmt, _folder_keys(spark, path), year, check).select(
        *schemas.I94.fieldNames()
    )


def read_admissions_by_file(spark: SparkSession, paths, fmt="parquet", check=True) -> DataFrame:
    """The same for the given files, with the columns ``file`` and ``modified``."""
    keys = {
        field.name: next((p for p in paths if f"/{field.name}=" not in p.lower()), None)
        for field in schemas.I94.fields
        if any(f"/{field.name}=" in p.lower() for p in paths)
    }
    return _extracts(spark, paths, fmt, keys, check=check)


def _folder_keys(spark, path):
    """Fields that a folder names, each with a file outside such folders; None if there are no files."""
    names = [field.name for field in schemas.I94.fields]
    found = (
        admission_files(spark, path)
        .agg(
            F.count(F.lit(1)).alias("files"),
            *[F.min(F.when(~_has_folder("path", n), F.col("path"))).alias(f"outside_{n}") for n in names],
            *[F.max(_has_folder("path", n)).alias(f"inside_{n}") for n in names],
        )
        .first()
    )
    if not found["files"]:
        return None
    return {n: found[f"outside_{n}"] for n in names if found[f"inside_{n}"]}


def _has_folder(path, name):
    return F.col(path).rlike(f"(?i)/{name}=[^/]*/")


def _folder_value(path, field):
    text = F.regexp_extract(path, f"(?i)/{field.name}=([^/]*)/", 1)
    text = F.nullif(F.nullif(F.url_decode(text), F.lit("")), F.lit(NO_FOLDER_VALUE))
    return text.try_cast(field.dataType)


def _extracts(spark, where, fmt, keys, year=None, check=True):
    """Rows of the files under ``where``; ``keys`` are the fields that folders name."""
    if keys is None:
        return spark.createDataFrame([], T.StructType([*schemas.I94.fields, *FILE_COLUMNS]))
    reader = spark.read.option("recursiveFileLookup", True)
    if fmt == "csv":
        rows = _delimited_text(reader, where, ",")
        present = {name.lower() for name in rows.columns}
        absent = [n for n in KEY_COLUMNS if n not in present and (n not in keys or keys[n])]
        if absent:
            at = next((keys[n] for n in absent if keys.get(n)), where if isinstance(where, str) else where[0])
            raise ValueError(f"{at} lacks the columns {', '.join(absent)}")
        rows = rows.select("*", *_file_columns())
        given = {
            f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schemas.I94.fields if f.name in present
        }
    else:
        check = check or spark.conf.get(VECTORIZED) != "true"
        schema = schemas.I94 if check else _marking_absent(schemas.I94)
        rows = reader.schema(schema).format(fmt).load(where).select("*", *_file_columns())
        given = {f.name: F.col(f.name) for f in schemas.I94.fields}
        if check:
            marked = reader.schema(_marking_absent(schemas.I94)).format(fmt).load(where)
            _refuse_absent(_of_year(marked.select("*", *_file_columns()), keys, year, True))
        else:
            given |= {name: _refused_when_read(name) for name in KEY_COLUMNS}
    rows = _of_year(rows, keys, year, fmt != "csv" and not check, given.get("i94yr") if fmt == "csv" else None)
    columns = []
    for field in schemas.I94.fields:
        value = given.get(field.name, F.lit(None).cast(field.dataType))
        if field.name in keys:
            folder = _folder_value("file", field)
            value = F.when(_has_folder("file", field.name), folder).otherwise(value)
        columns.append(value.alias(field.name))
    return rows.select(*columns, "file", "modified")


FILE_COLUMNS = [T.StructField("file", T.StringType()), T.StructField("modified", T.TimestampType())]


def _file_columns():
    return (
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _of_year(rows, keys, year, keep_marked, value=None):
    """Rows of one year, by filters that reach the list of files and the footers."""
    if year is None:
        return rows
    value = F.col("i94yr") if value is None else value
    chosen = value == float(year)
    if keep_marked:
        chosen = chosen | (value == ABSENT_NUMBER)
    if "i94yr" not in keys:
        return rows.where(chosen)
    inside = _has_folder("file", "i94yr")
    in_year = _folder_value("file", schemas.I94["i94yr"]) == float(year)
    if keys["i94yr"] is None:  # every file is in such a folder
        return rows.where(inside & in_year)
    return rows.where(inside & in_year).unionByName(rows.where(~inside).where(chosen))


def _marking_absent(schema):
    """The schema with a default for key columns, which the scan gives where a file lacks them.

    It is what a table has for columns that were added with a default after files were written.
    """
    def marked(field):
        if field.name not in KEY_COLUMNS:
            return field
        text = isinstance(field.dataType, T.StringType)
        default = f"'{ABSENT_TEXT}'" if text else f"{ABSENT_NUMBER!r}D"
        return T.StructField(field.name, field.dataType, True, {"EXISTS_DEFAULT": default})

    return T.StructType([marked(field) for field in schema.fields])


def _is_absent(name):
    text = isinstance(schemas.I94[name].dataType, T.StringType)
    return F.col(name) == F.lit(ABSENT_TEXT if text else ABSENT_NUMBER)


def _refuse_absent(marked):
    """One pass that names a file without a key column.

    In files that have the columns the footers' bounds rule the marks out, so their rows are not read.
    """
    any_absent = reduce(lambda a, b: a | b, [_is_absent(name) for name in KEY_COLUMNS])
    lacking = F.array_compact(
        F.array(*[F.when(_is_absent(n) & ~_has_folder("file", n), F.lit(n)) for n in KEY_COLUMNS])
    )
    found = (
        marked.where(any_absent)
        .select("file", F.array_join(lacking, ", ").alias("lacking"))
        .where("lacking <> ''")
        .agg(F.min(F.struct("file", "lacking")).alias("bad"))
    )
    session = marked.sparkSession
    asked = session.conf.get(VECTORIZED)
    session.conf.set(VECTORIZED, "true")  # the row-wise reader marks NULLs as well
    try:
        bad = found.first()["bad"]
    finally:
        session.conf.set(VECTORIZED, asked)
    if bad:
        raise ValueError(f"{bad['file']} lacks the columns {bad['lacking']}")


def _refused_when_read(name):
    said = F.concat(F.col("file"), F.lit(f" lacks the columns {name}"))
    value = F.when(~_is_absent(name) | F.col(name).isNull(), F.col(name))
    return value.when(_has_folder("file", name), None).otherwise(
        F.raise_error(said).cast(schemas.I94[name].dataType)
    )


def read_demographics(spark: SparkSession, path) -> DataFrame:
    return _delimited(spark, path, schemas.DEMOGRAPHICS, ";")


def read_airports(spark: SparkSession, path) -> DataFrame:
    return _delimited(spark, path, schemas.AIRPORTS, ",")


def read_temperatures(spark: SparkSession, path) -> DataFrame:
    return _delimited(spark, path, schemas.TEMPERATURES, ",")


class StagedFact:
    """A fact that is written but not published, with what the checks need of each year."""

    def __init__(self, spark, path, name):
        self.spark, self.path, self.name = spark, path, name
        self.fact = _read_years(spark, path, [f"{name}/{y}" for y in _years(spark, f"{path}/{name}")])
        self.entries = {
            year: {"folders": [f"{name}/{year}"]} for year in _years(spark, f"{path}/{name}")
        }
        for year, sums in quality.sums_by_year(self.fact).items():
            self.entries[_year_folder(year)]["checks"] = sums

    def with_published(self, year=None) -> dict[str, dict]:
        """The entries that publishing would leave."""
        return _replaced(published_years(self.spark, self.path), self.entries, year)

    def drop(self):
        versions.drop(self.spark, f"{self.path}/{self.name}")


def write_fact(fact: DataFrame, path) -> None:
    """Overwrite ``path`` with the fact, one folder per year and month."""
    publish_fact(stage_fact(fact, path))


def write_fact_year(fact: DataFrame, path, year: int) -> None:
    """Replace all of ``year`` by ``fact``, which holds rows of that year only, or none."""
    publish_fact(stage_fact(fact, path), year)


def stage_fact(fact: DataFrame, path) -> StagedFact:
    """Write the fact beside the published one, in a folder that no manifest names yet.

    Rows are rebalanced by month: AQE merges small months and splits big ones by size.
    """
    name = versions.fresh_name()
    (
        fact.hint("rebalance", "year", "immigration_month")
        .sortWithinPartitions(
            "year", "immigration_month", "immigration_origin", "to_immigration_state"
        )
        .write.partitionBy("year", "immigration_month")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .parquet(f"{path}/{name}")
    )
    return StagedFact(fact.sparkSession, path, name)


def publish_fact(staged: StagedFact, year=None) -> dict[str, dict]:
    """Put the staged fact in place of the published one, or of one year of it, in one step.

    Of two writers at once both take effect, one after the other; years that neither replaces stay.
    """
    spark, path = staged.spark, staged.path
    if versions.latest(spark, path) is None and (plain := published_years(spark, path)):
        versions.commit(spark, path, lambda now: now.entries or plain)  # so that it goes in its time
    done = versions.commit(spark, path, lambda now: _replaced(now.entries, staged.entries, year))
    versions.expire(spark, path)
    return done.entries


def _replaced(entries, staged, year):
    if year is None:
        return dict(staged)
    return {name: e for name, e in entries.items() if name != _year_folder(year)} | staged


def published_years(spark: SparkSession, path) -> dict[str, dict]:
    """The entries of the published fact by year folder.

    A folder without a manifest, as plain Spark writes it, is taken as it lies.
    """
    found = versions.latest(spark, path)
    if found is not None:
        return found.entries
    return {year: {"folders": [year]} for year in _years(spark, path)}


def checks_of(spark: SparkSession, path, entries) -> dict[str, dict]:
    """What the checks need of each year; only years without saved sums are read."""
    found = {year: entry["checks"] for year, entry in entries.items() if "checks" in entry}
    folders = [f for year, entry in entries.items() if year not in found for f in entry["folders"]]
    if folders:
        sums = quality.sums_by_year(_read_years(spark, path, folders))
        found |= {_year_folder(year): checks for year, checks in sums.items()}
    return found


def _year_folder(year):
    return f"year={NO_FOLDER_VALUE if year is None else year}"


def _years(spark, path):
    return [name for name in versions.children(spark, path) if name.startswith("year=")]


def read_fact(spark: SparkSession, path) -> DataFrame:
    """The published fact as it is now; later changes do not alter what this frame reads."""
    folders = [f for entry in published_years(spark, path).values() for f in entry["folders"]]
    return _read_years(spark, path, folders)


def _read_years(spark, path, folders):
    reader = spark.read.schema(schemas.FACT).option("basePath", path)
    plain = [f"{path}/{f}" for f in folders if f.startswith("year=")]
    versioned = [f"{path}/{f}" for f in folders if not f.startswith("year=")]
    parts = [reader.parquet(*some).select(*schemas.FACT.fieldNames()) for some in (plain, versioned) if some]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schemas.FACT)


def _delimited(spark, path, schema, sep):
    """CSV by column name, whatever else the file holds and in which order."""
    return schemas.conform(_text_columns(spark, path, sep), schema)


def _text_columns(spark, path, sep):
    """Every column as text; files of one folder whose headers differ are an error."""
    return _delimited_text(spark.read, path, sep)


def _delimited_text(reader, path, sep):
    return reader.option("header", True).option("sep", sep).option("enforceSchema", False).csv(path)
