"""Column lists of the sources, the dimensions and the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(kind, names):
    return StructType([StructField(name, kind()) for name in names])


# Admission extract: numbers arrive as doubles, codes as text.
I94_NUMBERS = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode", "depdate",
    "i94bir", "i94visa", "count", "biryear", "admnum",
]
I94_TEXTS = [
    "i94port", "i94addr", "dtadfile", "visapost", "occup", "entdepa", "entdepd", "entdepu",
    "matflag", "dtaddto", "gender", "insnum", "airline", "fltno", "visatype",
]
I94 = StructType(_struct(DoubleType, I94_NUMBERS).fields + _struct(StringType, I94_TEXTS).fields)

DEMOGRAPHICS = _struct(
    StringType,
    ["State", "State Code", "Median Age", "Male Population", "Female Population",
     "Total Population", "Number of Veterans", "Foreign-born", "Race", "Count"],
)
AIRPORTS = _struct(StringType, ["type", "iso_country", "iso_region", "elevation_ft"])
TEMPERATURES = _struct(StringType, ["dt", "AverageTemperature", "State", "Country"])

FACT = StructType(
    [
        StructField("year", IntegerType()),
        StructField("immigration_month", IntegerType()),
        StructField("immigration_origin", StringType()),
        StructField("to_immigration_state", StringType()),
        StructField("to_immigration_state_count", LongType()),
    ]
    + _struct(
        DoubleType,
        ["avg_temp_fahrenheit", "avg_elevation_ft", "percent_foreign_born", "native_american",
         "asian", "hispanic_or_latino", "black", "white"],
    ).fields
)


def conform(df: DataFrame, schema: StructType, absent_is_null=False) -> DataFrame:
    """Only the columns of ``schema``, in its order and types; unreadable values become NULL.

    A column that ``df`` lacks is an error, or NULL with ``absent_is_null``.
    """
    present = {name.lower() for name in df.columns}

    def column(field):
        if absent_is_null and field.name.lower() not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])
