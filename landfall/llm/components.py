"""Connected components of links between keys, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import saved

PLAIN_ROUNDS = 2


def components(links: DataFrame) -> DataFrame:
    """(key, component) of every key in ``links`` (a, b); ``component`` is the smallest key reached.

    Each round every key moves to the smallest of itself and its neighbours, and the links are
    drawn anew between the places they moved to. The first rounds go by the keys, which settles stars on
    their smallest key at once; later ones by a fresh random order each, so that an expected quarter
    of the keys leaves in every round whatever the links look like, also along a chain. Each round is
    written to the shared folder. Nothing is gathered by key: minima are partial sums.
    """
    edges, moves = saved(links.select("a", "b").where("a <> b"), "links"), []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("key", "other")
        if len(moves) < PLAIN_ROUNDS:
            nearest = both.groupBy("key").agg(F.min("other").alias("other"))
            nearest = nearest.select("key", F.least("key", "other").alias("to"))
        else:
            number = F.lit(len(moves))
            place = F.struct(F.xxhash64(number, "other").alias("place"), "other")
            own = F.struct(F.xxhash64(number, "key").alias("place"), F.col("key").alias("other"))
            nearest = both.groupBy("key").agg(F.min(place).alias("least"))
            nearest = nearest.select("key", F.least("least", own).getField("other").alias("to"))
        moved = saved(nearest, "moves")
        moves.append(moved)
        for side in ("a", "b"):
            named = moved.select(F.col("key").alias(side), F.col("to").alias(f"{side}_to"))
            edges = edges.join(named, side)
        edges = saved(
            edges.select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).where("a <> b").distinct(),
            "links",
        )
    if not moves:
        return links.select(F.col("a").alias("key"), F.col("a").alias("component")).limit(0)
    found = moves[0].select("key", F.col("to").alias("component"))
    for moved in moves[1:]:
        later = moved.select(F.col("key").alias("component"), F.col("to").alias("next"))
        found = found.join(later, "component", "left").select(
            "key", F.coalesce("next", "component").alias("component")
        )
    if len(moves) <= PLAIN_ROUNDS:
        return found
    found = saved(found, "components")
    least = found.groupBy("component").agg(F.min("key").alias("least"))
    return found.join(least, "component").select("key", F.col("least").alias("component"))
