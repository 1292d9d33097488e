from pyspark.sql import functions as F

from docflow.operators import lookup


def test_narrowed_keeps_all_that_is_due_and_little_else(spark):
    table = spark.range(50000).select(F.sha2(F.col("id").cast("string"), 256).alias("src_sha"), F.col("id").alias("set"))
    due = spark.range(0, 50000, 100).select(F.sha2(F.col("id").cast("string"), 256).alias("src_sha"))
    got = lookup.narrowed(table, due, "src_sha")
    assert got.columns == table.columns
    assert got.join(due, "src_sha").count() == 500 and got.count() < 500 + 50000 / lookup.BITS_PER_KEY * 1.2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    large_side = plan[plan.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
    assert "Exchange" not in large_side  # the table itself isn't shuffled


def test_no_and_very_many_keys(spark, monkeypatch):
    table = spark.range(10).select(F.col("id").cast("string").alias("k"))
    assert lookup.narrowed(table, table.limit(0), "k").count() == 0
    monkeypatch.setattr(lookup, "MOST_BITS", 8)
    assert lookup.narrowed(table, table, "k").count() == 10
    monkeypatch.setattr(lookup, "MOST_BITS", 64)
    assert lookup.narrowed(table, table.filter("k < 5"), "k", 5).filter("k < 5").count() == 5
