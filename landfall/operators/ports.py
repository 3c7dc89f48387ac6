"""What port and country labels say about their codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.lookups import CodeList

# Label shapes of the data dictionary.
INVALID = r"(?i)^invalid\b"
COLLAPSED = r"(?i)^collapsed\b"
NO_CODE = r"(?i)^no (country|port) code\b"
SURVIVOR = r"(?i)^collapsed +(?:into +)?\(?([A-Za-z0-9.]+)"
# The last ", XX" counts: a city's own name may hold one.
CITY_AND_STATE = r"^(.*), *([A-Z]{2})\b"


def validity(label) -> Column:
    label = F.col(label) if isinstance(label, str) else label
    return (
        F.when(label.rlike(INVALID), "invalid")
        .when(label.rlike(COLLAPSED), "collapsed")
        .when(label.rlike(NO_CODE), "no code")
        .when(label.isNotNull(), "valid")
    )


def split_city_state(ports: DataFrame, states: CodeList) -> DataFrame:
    """Add city and state to port labels that name a listed state.

    Foreign and irregular labels, and those that stand for no port, get NULLs.
    """
    listed = states.side().select(F.col("code").alias("state"))
    found = ports.withColumn(
        "_state",
        F.when(validity("label") == "valid", F.regexp_extract("label", CITY_AND_STATE, 2)),
    )
    joined = found.join(listed, F.col("_state") == F.col("state"), "left")
    city = F.when(
        F.col("state").isNotNull(), F.trim(F.regexp_extract("label", CITY_AND_STATE, 1))
    )
    return joined.select(*ports.columns, city.alias("city"), "state")


def collapsed_into(ports: DataFrame) -> DataFrame:
    """Codes that were merged into another, with that code and its label."""
    merged = ports.select(
        "code", F.regexp_extract("label", SURVIVOR, 1).alias("into_code")
    ).where("into_code <> ''")
    survivors = ports.select(F.col("code").alias("into_code"), F.col("label").alias("into_label"))
    return merged.join(survivors, "into_code", "left").select("code", "into_code", "into_label")
