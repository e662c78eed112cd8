"""What the declared columns do not hold stays in bronze; runs can be repeated."""

from datetime import datetime
from decimal import Decimal

import pytest
import rows

from __spark_entry__ import queries
from retail_strata import schemas
from retail_strata.plans.bronze import ingest_file, read_unheld
from retail_strata.plans.full import run_all
from retail_strata.plans.gold import aggregate_all
from retail_strata.plans.tables import PAYMENTS, PRODUCTS, Layers
from retail_strata.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"


def test_json_lines_of_all_kinds(spark, tmp_path, either_ansi):
    lines = [
        '{"order_id":"1","quantity":1}', '{"order_id":"2","quantity":"two"}', '{"order_id":"3","coupon":"x"}',
        '{"order_id": oops', "[1]", "7", "null", "{}",
    ]
    (tmp_path / "s.json").write_text("\n".join([*lines, "", "  "]))
    found = readers.read_json_lines(spark, str(tmp_path / "s.json"), schemas.RAW_SALES).collect()
    assert [(r.order_id, r.quantity) for r in found[:4]] == [("1", 1), ("2", None), ("3", None), (None, None)]
    assert [r.raw_record for r in found] == [None, *lines[1:7], None]


def test_csv_with_bad_cells_and_one_more_column(spark, tmp_path, either_ansi):
    header = ",".join(schemas.RAW_PRODUCTS.fieldNames())
    good, bad = "p1,Mesa,Casa,10.5,3,2024-01-01 10:00:00", "p2,Mesa,Casa,10.5,3.0,2024-01-01 10:00:00"
    (tmp_path / "raw").mkdir()
    file = tmp_path / "raw" / "products.csv"
    file.write_text(f"{header}\n{good}\n{bad}\np3,Mesa\n")
    layers = Layers.under(str(tmp_path))
    ingest_file(spark, layers, "csv", "products.csv", PRODUCTS.bronze_table, "one", PRODUCTS.raw_schema)
    file.write_text(f"{header},colour\n{good},red\n{bad},red\n{good},\n")
    ingest_file(spark, layers, "csv", "products.csv", PRODUCTS.bronze_table, "two", PRODUCTS.raw_schema)
    kept = {(r.ingestion_id, r.product_id): r.raw_record for r in read_unheld(spark, layers, PRODUCTS).collect()}
    assert kept == {
        ("one", "p2"): bad, ("one", "p3"): "p3,Mesa", ("two", "p1"): '{"colour":"red"}', ("two", "p2"): f"{bad},red",
    }


def test_parquet_of_other_types(spark, folder, either_ansi):
    path = f"{folder}/raw/payments.parquet"
    own = spark.createDataFrame(
        [("1", datetime(2024, 1, 2, 3), "x", Decimal("5.25"), "pix", "paid", 3),
         ("2", None, None, None, None, None, 5_000_000_000)],
        "payment_id string, payment_date timestamp, created_at string, amount decimal(12,2), "
        "payment_method string, status string, total_installments bigint",
    )
    writers.overwrite_parquet(own, path)
    first, second = sorted(readers.read_raw_parquet(spark, path, schemas.RAW_PAYMENTS).collect())
    assert (first.payment_date, first.amount, first.total_installments) == ("2024-01-02 03:00:00", 5.25, 3)
    assert first.raw_record is None and second.total_installments is None
    assert second.raw_record == '{"payment_id":"2","total_installments":5000000000}'
    writers.overwrite_parquet(own.withColumnRenamed("status", "state"), path)
    with pytest.raises(ValueError, match="no column status"):
        readers.read_raw_parquet(spark, path, schemas.RAW_PAYMENTS)


def test_unknown_parquet_columns_are_kept(spark, folder):
    layers = Layers.under(folder)
    more = rows.payments(spark, {"payment_id": "9"}).selectExpr("*", "'x' AS coupon")
    writers.overwrite_parquet(more, f"{layers.raw}/payments.parquet")
    ingest_file(spark, layers, "parquet", "payments.parquet", PAYMENTS.bronze_table, "one", PAYMENTS.raw_schema)
    assert '"coupon":"x"' in read_unheld(spark, layers, PAYMENTS).first().raw_record


def test_failed_run_names_its_id_and_one_gold_table_alone(spark, folder):
    layers = Layers.under(folder)
    with pytest.raises(Exception) as failed:
        run_all(spark, layers, "first")
    assert "run_id='first'" in failed.value.__notes__[-1]
    with pytest.raises(ValueError, match="no gold table"):
        aggregate_all(spark, layers, tables=["gold_none"])


def test_sorted_gold(spark):
    nulls_first = lambda row, keys: [(row[k] is not None, row[k]) for k in keys]
    for name, keys in (
        ("gold_sales_summary", ("order_year", "order_month", "status")),
        ("gold_payment_analysis", ("payment_method", "status")),
    ):
        found = [nulls_first(row, keys) for row in queries()[name](spark, FOLDER).collect()]
        assert found == sorted(found) and len(found) > 1
