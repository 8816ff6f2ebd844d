"""A key that holds most rows is spread over tasks, and nothing is lost."""

from pyspark.sql import functions as F

from pressflow.operators import gold, series
from pressflow.operators.skew import salted_left_join
from pressflow.sinks.lake import write_batch


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source_key"),
        F.lit("2026-01-01").alias("dt"),
        F.concat_ws("", *[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 512) for i in range(3)]).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128KB")
    try:
        write_batch(rows, str(tmp_path), ["source_key", "dt"], 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.rglob("*.parquet"))) for p in (tmp_path / "batch_id=0").glob("source_key=*")}
    assert files.pop("source_key=hot") > 3
    # folders that share no shuffle partition with the hot one stay in one piece
    assert min(files.values()) == 1
    assert spark.read.parquet(str(tmp_path)).count() == 6000


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(20_000).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = left.select("k").distinct().withColumn("v", F.upper("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_left_join(left, right, ["k"], ["id"], hot_rows=1000)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        missing = joined.where("v IS NULL OR v <> upper(k)").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in per_task) == 20_000 and missing == 0
    # half the rows share a key, yet no task holds much more than its share
    assert max(r["count"] for r in per_task) < 10_000


def test_one_series_is_ordered_slice_by_slice(spark):
    samples = spark.range(5000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 30).alias("ts"),
        F.lit("m").alias("name"), F.expr("map('name', 'hot')").alias("labels"),
        (F.col("id") * 2).cast("double").alias("value"))
    grown = series.increases(series.select_series(samples, "m"))
    assert grown.agg(F.sum("increase"), F.count("*")).first()[:] == (9998.0, 4999)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.split("\n") if "lag(value" in line)
    assert "windowspecdefinition(series" in window and "slice" in window


def test_counts_are_summed_before_their_shuffle(spark):
    view = spark.range(100).select(
        F.current_date().alias("day"), F.lit("t").alias("titre_article"),
        F.concat(F.lit("word "), F.col("id").cast("string")).alias("contenu"),
        F.when(F.col("id") < 90, "hot").otherwise("cold").alias("source"))
    for table in (gold.articles_per_day(view), gold.keyword_counts(view)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        before_shuffle = plan[plan.index("Exchange"):]
        assert "partial_count(1)" in before_shuffle
