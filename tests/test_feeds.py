"""The feeds: content rules, foreign keys, guards, very large row numbers."""

import pytest
from pyspark.sql import functions as F

from retail_strata import schemas
from retail_strata.functions.draws import PRIME, draw, pick, pick_row
from retail_strata.plans.feeds import CATALOGUE, feed_customers, feed_products, feed_sales


def test_customers_repeat_about_one_in_twenty(spark):
    df = feed_customers(spark.range(4000))
    assert df.columns == schemas.RAW_CUSTOMERS.fieldNames()
    people = {}
    for row in df.collect():
        people.setdefault(row.customer_id, []).append(row)
    assert 4000 - len(people) == 210
    assert max(map(len, people.values())) == 3
    for versions in people.values():
        assert len({r.email for r in versions}) == len(versions)
        assert len({tuple(v for k, v in r.asDict().items() if k != "email") for r in versions}) == 1


def test_customer_values(spark):
    df = feed_customers(spark.range(4000)).withColumn("day", F.lit("2024-07-01").cast("date"))
    ages = df.select(
        F.floor(F.date_diff("day", F.col("birth_date").cast("date")) / 365) == F.col("age"),
        F.col("age").between(18, 80), F.col("created_at") <= F.col("updated_at"),
        F.col("created_at").between("2022-07-02 00:00:00", "2024-07-01 00:00:00"),
        F.col("updated_at") <= "2024-07-01 00:00:00", F.col("cpf").rlike(r"^\d{3}\.\d{3}\.\d{3}-\d{2}$"),
    )
    assert all(all(row) for row in ages.collect())
    assert df.filter("is_active").count() / 4000 == pytest.approx(0.75, abs=0.03)
    assert {r.gender for r in df.select("gender").distinct().collect()} == {"M", "F", "Other"}


def test_products_follow_the_catalogue(spark):
    df = feed_products(spark.range(3000)).collect()
    seen = set()
    for row in df:
        kinds, low, high = CATALOGUE[row.category]
        kind = row.product_name.split(" ")[0]
        seen.add((row.category, kind))
        assert kind in kinds and low <= row.price <= high and round(row.price, 2) == row.price
        assert 0 <= row.stock_quantity <= 500
    assert len(seen) == 9


def test_sales_refer_to_feed_rows_and_price(spark):
    customer_ids, product_ids = spark.range(300), spark.range(100)
    sales = feed_sales(spark.range(5000), customer_ids, product_ids)
    people, goods = feed_customers(customer_ids), feed_products(product_ids)
    assert sales.join(people, "customer_id", "left_anti").isEmpty()
    priced = sales.join(goods, "product_id").select(
        F.round(F.col("quantity") * F.col("price"), 2) == F.col("total_amount"), F.col("quantity").between(1, 5)
    )
    assert priced.count() == 5000 and all(all(r) for r in priced.collect())
    assert sales.select("product_id").distinct().count() == 100
    spread = {r.status: r["count"] for r in sales.groupBy("status").count().collect()}
    assert set(spread) == {"completed", "pending", "cancelled"} and min(spread.values()) > 1400


def test_sales_need_customers_and_products(spark):
    ids = spark.range(3)
    for customers, products in ((None, ids), (ids, None), (ids.limit(0), ids), (ids, ids.limit(0))):
        with pytest.raises(ValueError):
            feed_sales(ids, customers, products)


def test_draws_stay_in_range_for_any_row_number(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    rows = spark.createDataFrame([(0,), (PRIME - 1,), (PRIME,), (10**15,), (2**62,)], "id bigint")
    for d, w in rows.selectExpr(draw("id", 36), pick_row("id", 30, 10**12)).collect():
        assert 0 <= d < PRIME and 0 <= w < 10**12


def test_draw_is_even_and_streams_differ(spark):
    df = spark.range(30000).selectExpr(f"{pick('id', 20, 3)} AS a", f"{pick('id', 21, 3)} AS b")
    pairs = {(r.a, r.b): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert len(pairs) == 9 and min(pairs.values()) > 3000 and max(pairs.values()) < 3700
