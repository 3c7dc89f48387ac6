"""The whole run: read, build the dimensions, write the fact, check it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.codes import STATE_ALIASES
from landfall.operators import dimensions, facts, quality
from landfall.operators.lookups import code_list, fixed_list
from landfall.operators.sizes import small_sides
from landfall.plans import views
from landfall.session import settle
from landfall.sources import readers
from landfall.sources.labels import load_labels, reverse_labels
from landfall.streaming.increments import add_increment, saved_counts


@dataclass(frozen=True)
class JobConfig:
    """Input and output paths, and the choices that change results.

    The defaults give the plain results. ``year_only`` rebuilds one year of the
    output, ``raw_labels`` keeps padding and plain quoting of label files, and
    with ``saved_counts`` only extracts that are new since the last run are read.
    """

    admissions: str
    demographics: str
    airports: str
    temperatures: str
    countries: str
    states: str
    cities: str
    output: str
    admissions_format: str = "parquet"
    temperature_year: int = 2013
    temperature_country: str = "United States"
    airport_kind: str = "small_airport"
    airport_country: str = "US"
    state_code_length: int = 2
    on_unknown: str = "null"
    raw_labels: bool = False
    on_bad_label: str = "fail"
    use_state_aliases: bool = False
    year_only: int | None = None
    saved_counts: str | None = None
    fail_on_quality: bool = False


@dataclass(frozen=True)
class JobResult:
    fact: DataFrame
    total: DataFrame
    null_flags: DataFrame
    report: DataFrame


def run_job(spark: SparkSession, cfg: JobConfig) -> JobResult:
    def listed(path):
        labels = load_labels(spark, path, raw=cfg.raw_labels, on_bad_line=cfg.on_bad_label)
        return settle(labels)

    state_labels = listed(cfg.states)
    states, names = code_list(state_labels), code_list(reverse_labels(state_labels))
    cities, countries = code_list(listed(cfg.cities)), code_list(listed(cfg.countries))
    aliases = fixed_list(spark, STATE_ALIASES) if cfg.use_state_aliases else None
    trim_keys = not cfg.raw_labels

    # with saved counts only the view reads all extracts, if anyone asks it
    i94 = readers.read_admissions(
        spark, cfg.admissions, cfg.admissions_format, cfg.year_only, check=cfg.saved_counts is None
    )

    temperature, demographics, airport = small_sides(
        dimensions.dim_temperature(
            readers.read_temperatures(spark, cfg.temperatures),
            names,
            cfg.temperature_year,
            cfg.temperature_country,
            aliases,
        ),
        dimensions.dim_demographics(readers.read_demographics(spark, cfg.demographics)),
        dimensions.dim_airport(
            readers.read_airports(spark, cfg.airports),
            cfg.airport_kind,
            cfg.airport_country,
            cfg.state_code_length,
        ),
    )
    immigration = dimensions.dim_immigration(
        i94, states, cities, countries, cfg.on_unknown, trim_keys
    )
    views.register_views(immigration, temperature, demographics, airport)

    if cfg.saved_counts is None:
        by_code = facts.counts_by_code(i94, states, cities, trim_keys)
    else:
        counts_path = f"{cfg.saved_counts}/counts"
        add_increment(spark, cfg.admissions, counts_path, cfg.admissions_format)
        by_code = saved_counts(spark, counts_path, states, cities, trim_keys)
        if cfg.year_only is not None:
            by_code = by_code.where(F.col("year") == cfg.year_only)
    counts = facts.name_counts(by_code, states, countries, cfg.on_unknown)
    fact = facts.fact_arrivals(counts, temperature, demographics, airport)
    # what the output will hold is checked before it takes the place of the published one
    staged = readers.stage_fact(fact, cfg.output)
    coming = readers.checks_of(spark, cfg.output, staged.with_published(cfg.year_only))
    checks = quality.report_of_sums(
        spark,
        list(coming.values()),
        {
            "temperature keys": (temperature, ["state_abbreviations", "month"]),
            "demographics keys": (demographics, ["state_code"]),
            "airport keys": (airport, ["state"]),
        },
    )
    report = settle(checks)
    if cfg.fail_on_quality:
        try:
            quality.enforce(report)
        except RuntimeError:
            staged.drop()
            raise
    entries = readers.publish_fact(staged, cfg.year_only)
    sums = list(readers.checks_of(spark, cfg.output, entries).values())
    return JobResult(
        readers.read_fact(spark, cfg.output),
        quality.total_of_sums(spark, sums),
        quality.null_flags_of_sums(spark, sums),
        report,
    )
