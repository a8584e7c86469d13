"""The ways taken for large inputs, forced on small ones by lowering the broadcast limit."""

import pytest
from pyspark.sql import functions as F

from riskloom.catalog import QUERIES
from riskloom.operators import skew
from tests.conftest import SF, rows

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get(LIMIT)
    yield lambda: spark.conf.set(LIMIT, "1")
    spark.conf.set(LIMIT, old)


@pytest.mark.parametrize("name", ["silver_alerts", "text_topk", "st_event_order", "sem_signals_by_severity_region"])
def test_same_rows_without_broadcast(spark, no_broadcast, name):
    want = rows(QUERIES[name](spark, SF))
    no_broadcast()
    assert rows(QUERIES[name](spark, SF)) == want


def test_sketch_drives_the_salted_joins(spark, no_broadcast):
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE concat('k', id) END AS lk", "id AS v")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("alone", 9)], "k string, w int")
    cond = (F.col("v") % 2 == 0) | (F.col("w") > 0)
    want = rows(left.join(right, F.col("lk") == F.col("k"), "full_outer").where(cond))
    got = skew.outer_join_unique_right(left, right, "lk", "k", cond, F.col("v") % 2 == 0)
    assert "_slot" in got._jdf.queryExecution().analyzed().toString() and rows(got) == want
    no_broadcast()
    named = left.withColumnRenamed("lk", "k")
    looked = skew.lookup_join(named, right, "k", skew.heavy_keys(named, "k"))
    assert "_slot" in looked._jdf.queryExecution().analyzed().toString()
    assert rows(looked) == rows(named.join(right, "k", "left").select("k", "v", "w"))


def test_rejects_are_parsed_once(spark):
    """The dead letter is joined with itself; its landing files are read before that."""
    plan = QUERIES["reprocessed_rejects"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "csv" not in plan
