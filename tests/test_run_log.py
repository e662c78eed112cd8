"""The run log: what waits, what broke off, and what the jobs open to find out."""

import re

import pytest
import rows
from pyspark.sql import functions as F

from retail_strata.operators.lineage import stamp_ingestion
from retail_strata.plans.bronze import bronze_log, ingest_all, ingest_file
from retail_strata.plans.run_log import RunLog, waiting
from retail_strata.plans.silver import bronze_rows, refine_entity, silver_batch, silver_log
from retail_strata.plans.tables import CUSTOMERS, PAYMENTS, SALES, Layers
from retail_strata.schemas import RUN_LOG
from retail_strata.sources import readers, writers
from retail_strata.sources.literals import literal_rows


def ingest(spark, layers, run_id, stamp=None, entity=PAYMENTS):
    moment = None if stamp is None else F.lit(stamp).cast("timestamp")
    return ingest_file(
        spark, layers, entity.raw_format, entity.raw_file, entity.bronze_table, run_id, entity.raw_schema, moment
    )


@pytest.fixture
def layers(spark, folder):
    made = Layers.under(folder)
    payments = [{"payment_id": str(i), "payment_method": ["pix", "", None][i % 3]} for i in range(9)]
    writers.overwrite_parquet(rows.payments(spark, *payments, {"amount": -1.0}), f"{made.raw}/payments.parquet")
    return made


def table(spark, layers, layer, entity=PAYMENTS):
    name = f"{layer}_{entity.name}"
    return readers.read_parquet(spark, f"{getattr(layers, layer)}/{name}", getattr(entity, f"{layer}_schema"))


def ids(spark, layers):
    found = table(spark, layers, "silver")
    return sorted((r.payment_id, r.ingestion_id, r.processing_id) for r in found.collect())


@pytest.mark.parametrize("landed", ["false", "crc32(payment_id) % 2 = 0", "true"])
def test_a_run_that_broke_off_is_completed_once(spark, layers, landed):
    ingest(spark, layers, "a")
    log = silver_log(spark, layers, PAYMENTS)
    batch = waiting(bronze_log(spark, layers, PAYMENTS.bronze_table), log)
    log.start("one", batch)
    part = silver_batch(spark, layers, PAYMENTS, "one", batch).filter(landed)
    if landed != "false":
        writers.append_parquet(part, f"{layers.silver}/silver_payments", PAYMENTS.silver_partitions)
    second = refine_entity(spark, layers, PAYMENTS, "two")
    by = "two" if landed == "false" else "one"
    assert ids(spark, layers) == sorted((str(i), "a", by) for i in range(9))
    assert second is None or second.rows == {"read": 10, "written": 9}
    assert refine_entity(spark, layers, PAYMENTS, "three") is None and log.broken_off() == []


@pytest.mark.parametrize("landed", ["false", "crc32(payment_id) % 2 = 0", "true"])
def test_an_ingestion_that_broke_off_waits_for_its_own_retry(spark, layers, landed):
    for name in ("customers.json", "sales.json"):
        made = rows.customers(spark, {}) if name.startswith("c") else rows.sales(spark, {})
        writers.write_json_lines(made, f"{layers.raw}/{name}")
    writers.write_csv(rows.products(spark, {}), f"{layers.raw}/products.csv")
    log = RunLog(spark, layers.bronze, PAYMENTS.bronze_table)
    log.start("a", [{"ingestion_id": "a", "source_file": "payments.parquet"}])
    raw = spark.read.parquet(f"{layers.raw}/payments.parquet").withColumn("raw_record", F.lit(None).cast("string"))
    if landed != "false":
        part = stamp_ingestion(raw.filter(landed), "a", "payments.parquet", F.lit("2024-01-02").cast("timestamp"))
        writers.append_parquet(part, f"{layers.bronze}/bronze_payments", ("ingestion_date",))
        assert refine_entity(spark, layers, PAYMENTS, "early") is None
    for _ in range(2):
        ingest_all(spark, layers, "a")
    assert table(spark, layers, "bronze").count() == 10
    assert refine_entity(spark, layers, PAYMENTS, "one").rows == {"read": 10, "written": 9}


def test_ingestions_are_taken_whatever_their_order(spark, layers):
    for turn, stamp in enumerate(["2024-05-06", "2024-05-05", "2024-05-05", "2023-01-01"]):
        ingest(spark, layers, f"in-{turn}", stamp)
        assert refine_entity(spark, layers, PAYMENTS, f"out-{turn}").rows["written"] == 9
        assert refine_entity(spark, layers, PAYMENTS, "idle") is None
    marks = table(spark, layers, "silver").select("processing_id", "batch_mark").distinct().collect()
    assert {r.processing_id: str(r.batch_mark.date()) for r in marks}["out-3"] == "2023-01-01"


def test_one_id_for_two_files_is_two_ingestions(spark, layers):
    ingest(spark, layers, "a")
    refine_entity(spark, layers, PAYMENTS, "one")
    writers.overwrite_parquet(rows.payments(spark, {"payment_id": "late"}), f"{layers.raw}/more.parquet")
    ingest_file(spark, layers, "parquet", "more.parquet", PAYMENTS.bronze_table, "a", PAYMENTS.raw_schema)
    assert refine_entity(spark, layers, PAYMENTS, "two").rows == {"read": 1, "written": 1}


def test_tables_without_a_log_are_adopted(spark, layers):
    raw = spark.read.parquet(f"{layers.raw}/payments.parquet")
    for day in ("01", "02", "03"):
        stamped = stamp_ingestion(raw, f"old-{day}", "payments.parquet", F.lit(f"2024-01-{day}").cast("timestamp"))
        writers.append_parquet(stamped, f"{layers.bronze}/bronze_payments", ("ingestion_date",))
    bronze = table(spark, layers, "bronze").filter("ingestion_date < '2024-01-03'")
    old = PAYMENTS.refine(bronze).selectExpr(
        "*", "current_timestamp() AS processing_timestamp", "'old' AS processing_id", "timestamp '2024-01-02' AS batch_mark"
    )
    writers.append_parquet(old, f"{layers.silver}/silver_payments", PAYMENTS.silver_partitions)
    assert refine_entity(spark, layers, PAYMENTS, "new").rows == {"read": 10, "written": 9}
    assert {i for _, i, p in ids(spark, layers) if p == "new"} == {"old-03"}
    assert refine_entity(spark, layers, PAYMENTS, "idle") is None


def test_neither_silver_nor_old_partitions_are_opened(spark, layers):
    for turn, stamp in enumerate(["2024-05-04", "2024-05-05", "2024-05-06"]):
        ingest(spark, layers, f"in-{turn}", stamp)
        if turn < 2:
            refine_entity(spark, layers, PAYMENTS, f"out-{turn}")
    source, log = bronze_log(spark, layers, PAYMENTS.bronze_table), silver_log(spark, layers, PAYMENTS)
    fresh = bronze_rows(spark, layers, PAYMENTS, waiting(source, log))
    plan = fresh._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*ingestion_date#\d+ = 2024-05-06", plan)
    assert "Exchange hashpartitioning" not in plan and "silver_payments" not in plan
    assert {r.ingestion_id for r in fresh.collect()} == {"in-2"}
    files = {f for f in fresh.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert all("ingestion_date=2024-05-06" in f for f in files)


def test_customers_of_one_batch_are_deduplicated_over_its_ingestions(spark, folder):
    layers = Layers.under(folder)
    for turn, day in (("1", "05"), ("2", "03")):
        people = rows.customers(spark, {"email": f"{turn}@x.y", "updated_at": f"2024-02-{day} 00:00:00"})
        writers.write_json_lines(people, f"{layers.raw}/customers.json")
        ingest(spark, layers, f"in-{turn}", entity=CUSTOMERS)
    assert refine_entity(spark, layers, CUSTOMERS, "one").rows == {"read": 2, "written": 1}
    assert table(spark, layers, "silver", CUSTOMERS).first().email == "1@x.y"


def test_missing_bronze_fails_as_a_missing_table(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        refine_entity(spark, Layers.under(folder), SALES, "one")


def test_literal_rows(spark):
    empty = literal_rows(spark, RUN_LOG, [])
    assert empty.count() == 0 and [f.dataType for f in empty.schema] == [f.dataType for f in RUN_LOG]
    made = literal_rows(spark, RUN_LOG, [["a", None, "it's"] + [None] * 3 + [1 << 60] + [None] * 5, [None] * 12])
    assert [tuple(r)[:3] for r in made.collect()] == [("a", None, "it's"), (None, None, None)]
    assert made.first().last_micros == 1 << 60
