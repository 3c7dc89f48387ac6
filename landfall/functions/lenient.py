"""Conversions that give NULL on bad input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(col) -> Column:
    return _col(col).try_cast("double")


def as_float32(col) -> Column:
    """32-bit parse, widened again so that averages and rounding run in double."""
    return _col(col).try_cast("float").cast("double")


def as_int(col) -> Column:
    return _col(col).try_cast("int")


def as_date(col) -> Column:
    return _col(col).try_cast("date")


def code_key(col) -> Column:
    """A numeric code as lookup text: 582.0 becomes '582'."""
    return as_int(col).cast("string")


def percent_of(part, total) -> Column:
    return F.try_divide(as_double(part), as_double(total)) * 100


def fahrenheit(celsius) -> Column:
    return as_double(celsius) * 9 / 5 + 32


def region_suffix(region, length=2) -> Column:
    """The part of an ISO region code behind the country: 'US-AK' becomes 'AK'."""
    return F.substring(_col(region), 4, length)


def round1(col) -> Column:
    return F.round(_col(col).cast("double"), 1)


def sas_date(days) -> Column:
    """Day number counted from 1960-01-01 as a date."""
    return F.date_add(F.lit("1960-01-01").cast("date"), as_int(days))


def in_year(df, column, year) -> Column:
    """Year test written as a date range, so that typed columns push it into the scan."""
    stored = df.schema[column].dataType.typeName()
    when = as_date(column) if stored == "string" else F.col(column)
    first = F.lit(f"{year:04d}-01-01").cast("date")
    after = F.lit(f"{year + 1:04d}-01-01").cast("date")
    return (when >= first) & (when < after)


def _col(col) -> Column:
    return col if isinstance(col, Column) else F.col(f"`{col}`")
