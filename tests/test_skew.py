from pyspark.sql import functions as F

from flowplan.operators import panel
from flowplan.operators.skew import every_pair, pair_groups, salted_join, salts_for


def test_salted_join_equals_plain_join_on_a_hot_key(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        "id",
    )
    lookup = facts.select("k").distinct().filter("k <> 'k7'").withColumn("v", F.length("k"))
    for how in ("inner", "left"):
        plain = facts.join(lookup, "k", how).select("k", "id", "v")
        salted = salted_join(facts, lookup, ["k"], ["id"], how).select("k", "id", "v")
        assert sorted(plain.collect(), key=str) == sorted(salted.collect(), key=str)


def test_salts_follow_the_heaviest_key(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"))
    assert salts_for(facts, ["k"], rows_per_group=1000) == 1
    assert salts_for(facts, ["k"], rows_per_group=100) == 7
    assert salts_for(facts.limit(0), ["k"]) == 1


def test_every_pair_is_the_whole_product(spark):
    left = spark.range(37).withColumnRenamed("id", "a")
    right = spark.range(11).withColumnRenamed("id", "b")
    for rows_per_task in (1, 10, 1_000_000):
        pairs = every_pair(left, right, "a", "b", rows_per_task).select("a", "b")
        assert pairs.count() == 37 * 11 == pairs.distinct().count()
    assert every_pair(left, right.limit(0), "a", "b").count() == 0


def test_tasks_of_a_product_follow_its_size(spark):
    assert pair_groups(100, 100, 10**6) == (1, 1)
    for left, right in ((10**6, 10**6), (10**9, 10), (10, 10**9), (0, 5)):
        a, b = pair_groups(left, right, 10**6)
        assert left * right / (a * b) <= 2.1 * 10**6 and a <= max(1, left) and b <= max(1, right)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = every_pair(spark.range(400).toDF("a"), spark.range(400).toDF("b"), "a", "b", 2000)
        keys = pairs.select("a", "b").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert sum(r["count"] for r in keys) == 160_000 and max(r["count"] for r in keys) < 160_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_copies_merge_before_they_reach_a_series(make):
    demand = make.demand(A=[1, 2, 3])
    copies = demand.crossJoin(demand.sparkSession.range(2000)).drop("id")
    assert panel.unique_series(copies).count() == 3
    plan = panel.unique_series(copies)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
