"""The learners' tasks and trees do not follow the shuffle setting."""

from pyspark.sql import functions as F

from accountwise.config import PRODUCT_FLAGS
from accountwise.operators import clv, cross_sell


def fitted(spark, shuffle):
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    rows = spark.range(3000).select(
        F.col("id").alias("account_id"), (F.xxhash64("id") % 100).cast("double").alias("a"), (F.xxhash64("id", F.lit(1)) % 50).cast("double").alias("b"),
        F.when(F.col("id") % 5 == 0, "validation").otherwise("train").alias("split"),
        *[(F.xxhash64("id", F.lit(k)) % 2 == 0).cast("int").alias(c) for k, c in enumerate(PRODUCT_FLAGS.values())])
    frame = rows.withColumn("log_target", F.col("a") + F.col("a") * F.col("b") / 10).repartition("account_id")
    halves = [part.rdd.getNumPartitions() for part in clv._halves(frame, ["a", "b"])[1:]]
    models = [
        clv.fit_boosted(frame, ["a", "b"], rounds=4, depth=3), clv.fit_forest(frame, ["a", "b"], trees=3, depth=3),
        *cross_sell.fit_classifiers(frame, ["a", "b"], rounds=2, depth=2).values()]
    return halves, [m.stages[-1].toDebugString.split("\n", 1)[1] for m in models]


def test_fits_do_not_follow_the_shuffle_setting(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        few, many = fitted(spark, 3), fitted(spark, 40)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert many[0] == [2, 1] and few == many
