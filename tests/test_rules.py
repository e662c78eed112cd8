"""Cleaning, checking and aggregating rules on edge values, in both ANSI modes."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import rows
from retail_strata import schemas
from retail_strata.operators import business, cleanse
from retail_strata.operators.latest import latest_per_key
from retail_strata.operators.reports import ingestion_report, row_counts

pytestmark = pytest.mark.usefixtures("either_ansi")


def column(df, name):
    return sorted((row[name] for row in df.select(name).collect()), key=repr)


def test_newest_invalid_version_removes_the_customer(spark):
    raw = rows.customers(spark, {}, {"email": "broken", "updated_at": "2024-01-03 00:00:00"})
    assert cleanse.refine_customers(raw).count() == 0


def test_equal_update_time_keeps_the_larger_email(spark):
    raw = rows.customers(spark, {"email": "a@x"}, {"email": "B@x"}, {"email": None})
    assert column(cleanse.refine_customers(raw), "email") == ["b@x"]


def test_later_ingestion_wins_before_email(spark):
    raw = rows.customers(
        spark,
        {"email": "z@x", "ingestion_timestamp": datetime(2024, 1, 1)},
        {"email": "a@x", "ingestion_timestamp": datetime(2024, 1, 2)},
        schema=schemas.BRONZE_CUSTOMERS,
    )
    assert column(cleanse.refine_customers(raw), "email") == ["a@x"]


def test_dated_version_beats_undated(spark):
    raw = rows.customers(spark, {"updated_at": None, "name": "old"}, {"updated_at": "x", "name": "bad"}, {"name": "new"})
    assert column(cleanse.refine_customers(raw), "name") == ["new"]


def test_customer_checks(spark):
    raw = rows.customers(
        spark, {"customer_id": "1", "email": None}, {"customer_id": "2", "email": "no-at"},
        {"customer_id": "3", "cpf": None}, {"customer_id": "4", "cpf": "---"},
    )
    kept = cleanse.refine_customers(raw).collect()
    assert [(r.customer_id, r.cpf) for r in kept] == [("4", "")]


def test_customer_cleaning(spark):
    raw = rows.customers(spark, {
        "name": " \tA\n ", "email": "  Ana@EXAMPLE.com ", "phone": "+55 (11) 9-1", "state": " sp ",
        "birth_date": "not a date", "created_at": "2024-13-01 00:00:00",
    })
    row = cleanse.refine_customers(raw).first()
    assert (row.name, row.email, row.phone, row.cpf, row.state) == ("\tA\n", "ana@example.com", "551191", "12345678900", "SP")
    assert (row.birth_date, row.created_at) == (None, None)
    assert row.updated_at == datetime(2024, 1, 2)
    good = cleanse.refine_customers(rows.customers(spark, {})).first()
    assert good.birth_date == date(1990, 1, 15)


def test_product_checks(spark):
    bad = [{"price": p} for p in (-1.0, 0.0, 0.001, None, 123456789.99)]
    bad += [{"stock_quantity": q} for q in (-1, None)] + [{"product_name": None}]
    assert cleanse.refine_products(rows.products(spark, *bad)).count() == 0


def test_product_rounding_and_availability(spark):
    raw = rows.products(
        spark, {"price": 1.005, "stock_quantity": 0}, {"price": 2.675, "product_name": " Sofá ", "category": " Casa "}
    )
    got = {(r.price, r.product_name, r.category, r.is_available) for r in cleanse.refine_products(raw).collect()}
    assert got == {(Decimal("1.01"), "Mesa", "Casa", False), (Decimal("2.68"), "Sofá", "Casa", True)}


def test_sales_checks_and_period(spark):
    bad = [{"total_amount": a} for a in (0.0, -1.0, None, 1e9)] + [{"quantity": q} for q in (0, None)]
    bad += [{"order_date": d} for d in (None, "", "not a date", "2024-02-30 00:00:00")]
    good = [{"status": " Completed "}, {"status": None, "order_date": "2023-12-31"}]
    got = {
        (r.status, r.order_date, r.order_year, r.order_month)
        for r in cleanse.refine_sales(rows.sales(spark, *bad, *good)).collect()
    }
    assert got == {
        ("completed", datetime(2024, 3, 4, 5, 6, 7), 2024, 3), (None, datetime(2023, 12, 31), 2023, 12),
    }


def test_payment_checks(spark):
    bad = [{"amount": a} for a in (0.0, None, 1e9)] + [{"payment_date": d} for d in (None, "x")]
    kept = cleanse.refine_payments(rows.payments(spark, *bad, {"payment_method": " PIX ", "created_at": "x"})).collect()
    assert [(r.payment_method, r.created_at) for r in kept] == [("pix", None)]


def test_silver_matches_the_declared_schema(spark):
    for made, refine, schema in (
        (rows.customers(spark, {}), cleanse.refine_customers, schemas.SILVER_CUSTOMERS),
        (rows.products(spark, {}), cleanse.refine_products, schemas.SILVER_PRODUCTS),
        (rows.sales(spark, {}), cleanse.refine_sales, schemas.SILVER_SALES),
        (rows.payments(spark, {}), cleanse.refine_payments, schemas.SILVER_PAYMENTS),
    ):
        declared = {f.name: f.dataType for f in schema.fields}
        assert all(declared[f.name] == f.dataType for f in refine(made).schema.fields)


def test_summary_counts_and_null_status(spark):
    silver = cleanse.refine_sales(rows.sales(
        spark, {}, {"customer_id": None, "order_id": None, "total_amount": 5.0}, {"status": None, "quantity": 4},
    ))
    got = {r.status: r for r in business.sales_summary(silver).collect()}
    done = got["completed"]
    assert (done.total_orders, done.unique_customers, done.total_quantity) == (1, 1, 2)
    assert (done.total_revenue, done.avg_order_value) == (Decimal("15.00"), Decimal("7.50"))
    assert (done.max_order_value, done.min_order_value) == (Decimal("10.00"), Decimal("5.00"))
    assert got[None].total_quantity == 4


def test_average_rounds_half_up_twice(spark):
    amounts = [60324.63] * 37 + [2292336.13 - 37 * 60324.63]
    silver = cleanse.refine_sales(rows.sales(spark, *[{"total_amount": a} for a in amounts]))
    assert business.sales_summary(silver).first().avg_order_value == Decimal("60324.64")


def test_without_sales_measures_are_null(spark):
    silver = cleanse.refine_sales(rows.sales(spark, {"customer_id": "c2", "product_id": "p2"}))
    buyers = cleanse.refine_customers(rows.customers(spark, {}, {"customer_id": "c2"}))
    metrics = {r.customer_id: r for r in business.customer_metrics(buyers, silver).collect()}
    assert metrics["c1"].total_orders is None and metrics["c1"].total_spent is None
    assert metrics["c2"].total_orders == 1
    offer = cleanse.refine_products(rows.products(spark, {}, {"product_id": "p2"}, {"product_id": None}))
    ranked = business.product_performance(offer, silver).collect()
    assert [r.product_id for r in ranked] == ["p2", None, "p1"]
    assert ranked[1].total_orders is None


def test_gold_columns_and_types(spark):
    sold = cleanse.refine_sales(rows.sales(spark, {}))
    paid = cleanse.refine_payments(rows.payments(spark, {}))
    buyers = cleanse.refine_customers(rows.customers(spark, {}))
    offer = cleanse.refine_products(rows.products(spark, {}))
    assert business.sales_summary(sold).dtypes == [
        ("order_year", "int"), ("order_month", "int"), ("status", "string"), ("total_orders", "bigint"),
        ("unique_customers", "bigint"), ("total_revenue", "decimal(20,2)"), ("total_quantity", "bigint"),
        ("avg_order_value", "decimal(11,2)"), ("max_order_value", "decimal(10,2)"), ("min_order_value", "decimal(10,2)"),
    ]
    assert business.customer_metrics(buyers, sold).columns == [
        "customer_id", "name", "email", "city", "state", "total_orders", "total_spent", "avg_order_value",
        "last_order_date", "first_order_date",
    ]
    assert business.product_performance(offer, sold).columns == [
        "product_id", "product_name", "category", "price", "stock_quantity", "total_orders",
        "total_quantity_sold", "total_revenue", "avg_sale_value",
    ]
    assert business.payment_analysis(paid).dtypes == [
        ("payment_method", "string"), ("status", "string"), ("total_transactions", "bigint"),
        ("total_amount", "decimal(20,2)"), ("avg_transaction_value", "decimal(11,2)"), ("avg_installments", "double"),
    ]


def test_reports(spark):
    table = spark.createDataFrame([("a",), ("a",), (None,)], "ingestion_id string")
    assert row_counts({"t": table}).collect() == [("t", 3)]
    assert ingestion_report({"t": table, "u": table.limit(0)}).collect() == [("t", 3, 1), ("u", 0, 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3)),
), max_size=12))
def test_latest_per_key_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, t int, x int").repartition(3)
    got = {tuple(r) for r in latest_per_key(df, ["k"], ["t"]).collect()}
    rank = lambda r: [(v is not None, v or 0) for v in r[1:]]
    expected = {max((r for r in data if r[0] == key), key=rank) for key in {r[0] for r in data}}
    assert got == expected
