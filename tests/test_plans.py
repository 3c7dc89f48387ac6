"""What the plans look like, and that results do not depend on how rows are spread."""

import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from landfall.operators import facts, sizes
from landfall.operators.sizes import small_side
from landfall.plans import catalog, deliveries, expressions, products, scans, shapes  # noqa: F401
from landfall.sources import readers, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_static_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_admission_filters_run_below_the_shuffle(spark, no_static_broadcast):
    """Semi joins sit right above the scan of the lines; the big sides meet by sort-merge."""
    text = plan(shapes.counts(spark, SF))
    merge = text.index("SortMergeJoin")
    assert text.count("LeftSemi") == 2
    assert text.index("LeftSemi") > merge
    assert text.index("l_shipdate") > 0
    assert re.search(r"BroadcastHashJoin \[.*\], \[_listed", text)


def test_scans_read_only_what_they_need(spark):
    text = plan(tables.temperatures(spark, SF, 2000))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    orders = re.search(r"ReadSchema: struct<(o_custkey[^>]*)>", text).group(1)
    assert orders == "o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual" in plan(
        expressions.filter_year(spark, SF)
    )
    days = plan(tables.admissions(spark, SF, "2000-01-01", "2001-01-01"))
    assert "GreaterThanOrEqual(l_shipdate" in days


def test_rows_meet_measured_dimensions_by_broadcast(spark, no_static_broadcast):
    joined = facts.star_join(shapes.immigration(spark, SF), *shapes.dimensions_of_rows(spark, SF))
    assert plan(joined).count("SortMergeJoin") == 2  # lines with orders with customers
    assert "broadcast" not in small_side(spark.range(1000), limit=10)._jdf.queryExecution().toString()


def test_hot_order_is_split_by_aqe(spark, no_static_broadcast):
    """A third of all rows on one key: the join partition is split and the counts stay whole."""
    conf = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    lines = tables.admission_lines(spark, SF)
    hot = lines.where("l_orderkey = 7").limit(1)
    copies = hot.drop("cicid").crossJoin(
        spark.range(0, 3000, 1, 8).select(F.xxhash64("id").alias("cicid"))
    )
    skewed = lines.unionByName(copies)
    orders = tables.table(spark, SF, "orders").select("o_orderkey", "o_custkey")
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = skewed.join(orders, skewed.l_orderkey == orders.o_orderkey)
        counted = joined.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), F.max("cicid").alias("last")
        )
        total = sum(row.n for row in counted.collect())
        final = plan(counted)
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert total == skewed.count()
    assert "skew=true" in final


def test_shuffled_input_and_join_settings_do_not_matter(spark):
    expected = rows_of(shapes.fact(spark, SF))
    context = shapes.dimensions_of_rows(spark, SF)
    mixed = shapes.immigration(spark, SF).repartition(7, F.rand(3))
    assert rows_of(facts.fact_joined_first(mixed, *context)) == expected
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    try:
        assert rows_of(shapes.fact(spark, SF)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_counts_add_up_to_the_rows_that_join(spark):
    rows = facts.star_join(shapes.immigration(spark, SF), *shapes.dimensions_of_rows(spark, SF))
    total = shapes.fact(spark, SF).agg(F.sum("to_immigration_state_count")).first()[0]
    assert total == rows.count() == 1216


def test_positions_follow_the_order(spark):
    found = expressions.fact_ordered(spark, SF).collect()
    assert [row.position for row in found] == list(range(1, len(found) + 1))
    origins = [row.immigration_origin for row in found]
    assert origins == sorted(origins)
    states = [row.state for row in expressions.sort_state(spark, SF).collect()]
    assert states == sorted(states)


def test_filters_sit_below_the_first_shuffle(spark, no_static_broadcast):
    """Semi joins and the residence test are met right above the scan of the lines."""
    for query in (expressions.filter_chain, expressions.filter_not_null):
        text = plan(query(spark, SF))
        merge = text.index("SortMergeJoin")
        lines = text[merge:]
        assert "l_partkey" in lines and "% 17" in lines
        assert "LeftSemi" not in text[:merge]
    assert plan(expressions.filter_chain(spark, SF)).count("LeftSemi") == 2
    assert "_listed" not in text


def test_counting_needs_no_city_names(spark):
    text = plan(products.count_by_group(spark, SF))
    assert "city_port_name" not in text and "PORT " not in text.split("Scan")[0]


def test_ranking_has_one_range_shuffle(spark, monkeypatch):
    summed = spark.range(50).selectExpr(
        "int(id % 3) year", "1 month", "string(id % 4) origin_country", "'S' dest_state_name",
        "string(id % 5) state_code", "id arrivals", *[f"double(id) {name}" for name in facts.CONTEXT],
    )
    seen = []
    monkeypatch.setattr(facts, "settle", lambda df: seen.append(plan(df)) or df.checkpoint())
    ranked = facts.rank_fact(summed)
    assert seen[0].count("Exchange") == 1 and "rangepartitioning" in seen[0]
    assert "SinglePartition" not in seen[0] + plan(ranked) and "Exchange hash" not in plan(ranked)
    rows = ranked.collect()
    assert [r.position for r in rows] == list(range(1, 51))
    assert [(r.origin_country, r.state_code) for r in rows] == sorted((r.origin_country, r.state_code) for r in rows)


def test_the_sink_splits_and_merges_by_size(spark, tmp_path):
    fact = shapes.fact(spark, SF)
    text = fact.hint("rebalance", "year", "immigration_month")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in text
    readers.write_fact(fact, str(tmp_path / "fact"))
    assert rows_of(readers.read_fact(spark, str(tmp_path / "fact"))) == rows_of(fact)


def test_sizes_count_nulls_and_bytes(spark):
    rows = spark.range(1000).selectExpr(*[f"cast(NULL AS DOUBLE) c{k}" for k in range(12)])
    assert sizes.row_bytes(rows) >= 1000 * 12 * 8
    assert sizes.row_bytes(spark.sql("SELECT 'éé' AS a")) == 16 + 16 + 4
