"""What the plans must look like, and hot keys against the plain join."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import rows
from retail_strata.operators import business, cleanse
from retail_strata.operators.hot_keys import SLICE, find_hot_keys, left_join_unique
from retail_strata.operators.incremental import newer_than
from retail_strata.operators.latest import latest_per_key
from retail_strata.sources import writers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of the rows has one key, a third a null key, the rest one key each."""
    numbers = spark.range(3000).withColumn(
        "k", F.when(F.col("id") < 1000, "hot").when(F.col("id") < 2000, F.lit(None)).otherwise(F.col("id").cast("string"))
    )
    return numbers.withColumn("id", F.when(F.col("k") == "hot", F.lit(0)).otherwise(F.col("id")))


@pytest.fixture
def measures(spark):
    return spark.createDataFrame([("hot", 1), ("2000", 2), ("2500", 3), ("unused", 4)], "k string, m int")


def bag(df):
    return Counter(tuple(r) for r in df.select("k", "id", "m").collect())


def test_hot_keys_are_found(spark, skewed):
    assert set(find_hot_keys(skewed, "k", slices=8)) == {"hot", None}
    assert find_hot_keys(skewed, "k", slices=2) == []


@pytest.mark.parametrize("hot", [[], ["hot"], [None], ["hot", None], ["absent"]])
def test_split_join_equals_plain_join(spark, skewed, measures, hot):
    plain = skewed.join(measures, "k", "left")
    assert bag(left_join_unique(skewed, measures, "k", hot, slices=8)) == bag(plain)


def test_copies_of_a_hot_row_are_dealt_evenly(spark, skewed, measures):
    joined = left_join_unique(skewed, measures, "k", ["hot", None], slices=8)
    for key in (F.col("k") == "hot", F.col("k").isNull()):
        sizes = [r["count"] for r in joined.filter(key).groupBy(SLICE).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    cold = joined.filter("k <> 'hot'")
    assert cold.select(SLICE).distinct().collect() == [(0,)]


def test_product_performance_with_hot_products(spark):
    offer = [{"product_id": "hot"}] * 50 + [{"product_id": None}] * 50 + [{"product_id": f"p{i}"} for i in range(20)]
    products = cleanse.refine_products(rows.products(spark, *offer))
    sales = cleanse.refine_sales(rows.sales(spark, {"product_id": "hot"}, {"product_id": "p3", "total_amount": 99.0}))
    split = business.product_performance(products, sales, slices=4).collect()
    plain = business.product_performance(products, sales).collect()
    assert Counter(map(tuple, split)) == Counter(map(tuple, plain)) and len(split) == 120
    assert [r.total_revenue for r in split] == [r.total_revenue for r in plain]
    assert split[0].product_id == "p3" and split[1].product_id == "hot" and split[-1].total_revenue is None


def test_latest_limits_groups_before_the_shuffle(spark, skewed):
    text = plan(latest_per_key(skewed, ["k"], ["id"]))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange hashpartitioning.*WindowGroupLimit.*Partial", text, re.S)


def test_mark_prunes_partitions_and_row_groups(spark, folder):
    dated = spark.range(10).select(
        "id", F.timestamp_seconds(F.col("id") * 86400).alias("ingestion_timestamp")
    ).withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    writers.append_parquet(dated, folder + "/b", ("ingestion_date",))
    fresh = newer_than(spark.read.parquet(folder + "/b"), 6 * 86400 * 1_000_000)
    assert sorted(r.id for r in fresh.collect()) == [7, 8, 9]
    text = fresh._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*ingestion_date#\d+ >= 1970-01-05", text)
    assert "GreaterThan(ingestion_timestamp,1970-01-07" in text


def test_gold_reads_only_its_columns(spark, folder):
    writers.overwrite_parquet(cleanse.refine_sales(rows.sales(spark, {})), folder + "/s", ("order_year", "order_month"))
    sales = spark.read.parquet(folder + "/s")
    text = plan(business.sales_summary(sales))
    assert "ReadSchema: struct<order_id:string,customer_id:string,quantity:bigint,total_amount:decimal(10,2),status:string>" in text
    text = plan(business.turnover_per_product(sales))
    assert "ReadSchema: struct<order_id:string,product_id:string,quantity:bigint,total_amount:decimal(10,2)>" in text
    assert text.index("partial_sum") > text.index("Exchange")


def test_large_sides_are_not_broadcast(spark, folder):
    """Nothing forces a broadcast: with Spark's size limit off, both joins shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = cleanse.refine_sales(rows.sales(spark, {}))
        buyers = cleanse.refine_customers(rows.customers(spark, {}))
        offer = cleanse.refine_products(rows.products(spark, {}))
        for df in (business.customer_metrics(buyers, sales), business.product_performance(offer, sales, ranked=False)):
            assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df) and "Cartesian" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_partition_value_is_written_by_several_tasks(spark, folder):
    """Two values, 3 MB each: with a small advisory size each is cut into several files."""
    wide = spark.range(60000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("p"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    ).repartition(8)
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        writers.append_parquet(writers.spread_for_write(wide, ("p",)), folder + "/w", ("p",))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = spark.read.parquet(folder + "/w").select("p", F.input_file_name().alias("f")).distinct()
    per_value = {r.p: r["count"] for r in files.groupBy("p").count().collect()}
    assert per_value["hot"] >= 4
    assert spark.read.parquet(folder + "/w").count() == 60000


def test_without_adaptive_execution_rows_stay_where_they_are(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in plan(writers.spread_for_write(spark.range(5), ("id",)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_null_alone_is_split_too(spark, either_ansi):
    from pyspark.sql import functions as F

    nulls = spark.range(2000).select(F.lit(None).cast("string").alias("k"))
    measures = spark.createDataFrame([("a", 1)], "k string, m int")
    sizes = left_join_unique(nulls, measures, "k", [None], slices=8).groupBy(SLICE).count().collect()
    counts = [r["count"] for r in sizes]
    assert len(counts) == 8 and sum(counts) == 2000 and max(counts) < 300
