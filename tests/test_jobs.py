"""Layers on disk: several runs, history, marks, overwrite, partitions, streams."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import rows
from retail_strata import schemas
from retail_strata.operators.incremental import high_water_mark, newer_than
from retail_strata.plans.bronze import ingest_all, ingest_file
from retail_strata.plans.full import bronze_report, existing_tables, layer_report, new_run_id, run_all
from retail_strata.plans.gold import aggregate_all, build_gold, read_gold
from retail_strata.plans.silver import read_silver, refine_all, refine_entity
from retail_strata.plans.side_by_side import side_by_side
from retail_strata.plans.tables import CUSTOMERS, GOLD_SCHEMAS, PAYMENTS, PRODUCTS, SALES, Layers
from retail_strata.sources import readers, writers
from retail_strata.sources.scratch import scratch_folder
from retail_strata.streaming.silver_stream import start_silver_stream


def moment(text):
    return F.lit(text).cast("timestamp")


def write_raw(spark, layers, customers=({},), products=({},), sales=({},), payments=({},)):
    writers.write_json_lines(rows.customers(spark, *customers), f"{layers.raw}/customers.json")
    writers.write_csv(rows.products(spark, *products), f"{layers.raw}/products.csv")
    writers.write_json_lines(rows.sales(spark, *sales), f"{layers.raw}/sales.json")
    writers.overwrite_parquet(rows.payments(spark, *payments), f"{layers.raw}/payments.parquet")


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_two_runs_with_nothing_new_then_again_then_an_update(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers)
    ingest_all(spark, layers, "one", moment("2024-01-01 00:00:00"))
    first = refine_all(spark, layers, "one")
    assert [(s.table, s.rows) for s in first] == [
        (f"silver_{e}", {"read": 1, "written": 1}) for e in ("customers", "products", "sales", "payments")
    ]
    assert refine_all(spark, layers, "nothing new") == []
    assert set(counts(read_silver(spark, layers)).values()) == {1}

    write_raw(spark, layers, customers=[{"name": "Ana B", "updated_at": "2024-02-02 00:00:00"}])
    ingest_all(spark, layers, "two", moment("2024-01-02 00:00:00"))
    refine_all(spark, layers, "two")
    assert set(counts(read_silver(spark, layers)).values()) == {2}
    assert {r.ingestions for r in bronze_report(spark, layers).collect()} == {2}

    aggregate_all(spark, layers)
    metrics = read_gold(spark, layers)["gold_customer_metrics"]
    assert sorted((r.name, r.total_orders) for r in metrics.collect()) == [("Ana", 2), ("Ana B", 2)]
    aggregate_all(spark, layers, dedup_scope="table")
    for table, schema in GOLD_SCHEMAS.items():
        written = {f.name: f.dataType for f in spark.read.parquet(f"{layers.gold}/{table}").schema}
        assert written == {f.name: f.dataType for f in schema}
    metrics = read_gold(spark, layers)["gold_customer_metrics"]
    assert [(r.name, r.total_orders) for r in metrics.collect()] == [("Ana B", 2)]
    with pytest.raises(ValueError):
        build_gold(spark, layers, dedup_scope="run")


def test_a_batch_that_is_all_rejected_is_read_again(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers, products=[{"price": -1.0}])
    ingest_all(spark, layers, "one", moment("2024-01-01 00:00:00"))
    for run_id in ("one", "two"):
        result = refine_entity(spark, layers, PRODUCTS, run_id)
        assert result.rows == {"read": 1, "written": 0}
    silver = readers.read_if_exists(spark, f"{layers.silver}/silver_products", schemas.SILVER_PRODUCTS)
    assert silver.count() == 0
    assert high_water_mark(silver) is None


def test_empty_silver_gives_empty_gold(spark, folder):
    layers = Layers.under(folder)
    write_raw(
        spark, layers, customers=[{"email": None}], products=[{"price": None}], sales=[{"quantity": 0}],
        payments=[{"amount": 0.0}],
    )
    ingest_all(spark, layers, "one")
    assert [s.rows for s in refine_all(spark, layers, "one")] == [{"read": 1, "written": 0}] * 4
    assert [s.rows for s in aggregate_all(spark, layers, "table")] == [{"written": 0}] * 4
    assert set(counts(read_gold(spark, layers)).values()) == {0}
    write_raw(spark, layers)
    ingest_all(spark, layers, "two")
    refine_all(spark, layers, "two")
    aggregate_all(spark, layers)
    assert set(counts(read_gold(spark, layers)).values()) == {1}


def test_empty_raw_files(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers, customers=(), products=(), sales=(), payments=())
    assert [s.rows for s in ingest_all(spark, layers, "one")] == [{"written": 0}] * 4
    assert refine_all(spark, layers, "one") == []


def test_bronze_stamped_before_silver_ran_is_not_skipped(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers)
    ingest_all(spark, layers, "one", moment("2024-01-01 00:00:00"))
    refine_entity(spark, layers, SALES, "one", moment("2024-01-03 00:00:00"))
    ingest_all(spark, layers, "two", moment("2024-01-02 00:00:00"))
    assert refine_entity(spark, layers, SALES, "two").rows == {"read": 1, "written": 1}


def test_mark_survives_a_change_of_session_zone(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone, hour in (("Pacific/Kiritimati", "03:00:00+00:00"), ("Etc/GMT+12", "05:00:00+00:00")):
            spark.conf.set("spark.sql.session.timeZone", zone)
            ingest_all(spark, layers, zone, moment(f"2024-01-02 {hour}"))
            assert refine_entity(spark, layers, PAYMENTS, zone).rows["written"] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_mark_is_strict_and_null_safe(spark):
    events = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 3)], "ingestion_timestamp timestamp")
    mark = high_water_mark(events.filter("ingestion_timestamp < '2024-01-03'"))
    assert newer_than(events, mark).count() == 1
    assert newer_than(events, None).count() == 3
    assert high_water_mark(None) is None
    assert high_water_mark(events.limit(0)) is None


def test_bronze_keeps_broken_input_and_silver_rejects_it(spark, tmp_path):
    layers = Layers.under(str(tmp_path))
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "sales.json").write_text(
        '{"order_id":"1","quantity":1,"total_amount":5.5,"order_date":"2024-01-01 10:00:00"}\n{"order_id": oops\n'
    )
    (raw / "products.csv").write_text(
        "product_id,product_name,category,price,stock_quantity,created_at\n"
        'p1,"Mesa, grande",Casa,10.5,3,2024-01-01 10:00:00\np2,Sofá,Casa,cheap,3,2024-01-01 10:00:00\n'
    )
    for entity in (SALES, PRODUCTS):
        made = ingest_file(
            spark, layers, entity.raw_format, entity.raw_file, entity.bronze_table, "one", entity.raw_schema
        )
        assert made.rows == {"written": 2}
        assert refine_entity(spark, layers, entity, "one").rows == {"read": 2, "written": 1}
    product = read_silver_table(spark, layers, PRODUCTS).first()
    assert (product.product_name, product.created_at) == ("Mesa, grande", datetime(2024, 1, 1, 10))


def read_silver_table(spark, layers, entity):
    return readers.read_parquet(spark, f"{layers.silver}/{entity.silver_table}", entity.silver_schema)


def test_csv_with_other_column_order_fails(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_name,product_id,category,price,stock_quantity,created_at\na,b,c,1,1,\n")
    with pytest.raises(Exception, match="CSV header"):
        readers.read_csv(spark, str(tmp_path / "products.csv"), schemas.RAW_PRODUCTS).collect()


def test_inferred_schemas(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"b": 1, "a": "2024-01-01"}\n')
    (tmp_path / "a.csv").write_text("x,t\n1,2024-01-01 00:00:00\n")
    assert readers.read_json_lines(spark, str(tmp_path / "a.json")).dtypes == [("a", "string"), ("b", "bigint")]
    assert readers.read_csv(spark, str(tmp_path / "a.csv")).dtypes == [("x", "int"), ("t", "timestamp")]


def test_empty_partition_value_reads_back_as_null(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers, customers=[
        {"customer_id": "1", "state": ""}, {"customer_id": "2", "state": None}, {"customer_id": "3", "state": "01"},
    ])
    ingest_all(spark, layers, "one")
    refine_entity(spark, layers, CUSTOMERS, "one")
    states = {r.customer_id: r.state for r in read_silver_table(spark, layers, CUSTOMERS).collect()}
    assert states == {"1": None, "2": None, "3": "01"}


def test_overwrite_is_static_in_a_dynamic_session(spark, folder):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for category in ("Eletrônicos", "Casa"):
            writers.overwrite_parquet(rows.products(spark, {"category": category}), folder + "/t", ("category",))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.category for r in readers.read_parquet(spark, folder + "/t").collect()] == ["Casa"]


def test_missing_table_is_none_and_other_errors_are_raised(spark, folder, tmp_path):
    assert readers.read_if_exists(spark, f"{folder}/none") is None
    (tmp_path / "t").mkdir()
    assert readers.read_if_exists(spark, f"{folder}/t") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        readers.read_if_exists(spark, f"{folder}/bad").collect()


def test_full_run_from_feeds_and_its_report(spark, folder):
    layers = Layers.under(folder)
    assert layer_report(spark, layers) is None and bronze_report(spark, layers) is None
    with pytest.raises(AnalysisException):
        run_all(spark, layers, regenerate=True)
    found = existing_tables(spark, layers)
    assert sorted(found["bronze"]) == ["bronze_customers", "bronze_products", "bronze_sales"] and not found["silver"]
    writers.overwrite_parquet(rows.payments(spark, {}), f"{layers.raw}/payments.parquet")
    result = run_all(spark, layers, run_id="again")
    assert len(result.stages) == 12
    report = {r.table_name: r.row_count for r in result.report.collect()}
    assert report["bronze_sales"] == 10000 and report["silver_customers"] == 947
    assert report["gold_payment_analysis"] == 1
    assert new_run_id() != new_run_id()


@pytest.mark.parametrize("entity", [PRODUCTS, SALES, PAYMENTS], ids=lambda e: e.name)
def test_stream_takes_each_file_once(spark, folder, entity):
    layers = Layers.under(folder)
    write_raw(spark, layers)
    for turn, expected in ((1, 1), (2, 2)):
        ingest_all(spark, layers, f"ingest-{turn}")
        for _ in range(2):
            start_silver_stream(
                spark, layers, entity, f"run-{turn}", f"{folder}/checkpoint", files_per_batch=1
            ).awaitTermination()
            assert read_silver_table(spark, layers, entity).count() == expected


def test_one_silver_table_takes_a_stream_or_batches_not_both(spark, folder):
    layers = Layers.under(folder)
    write_raw(spark, layers)
    ingest_all(spark, layers, "one")
    start_silver_stream(spark, layers, SALES, "s", f"{folder}/checkpoint").awaitTermination()
    with pytest.raises(ValueError, match="stream"):
        refine_entity(spark, layers, SALES, "b")
    refine_entity(spark, layers, PAYMENTS, "b")
    with pytest.raises(ValueError, match="batch"):
        start_silver_stream(spark, layers, PAYMENTS, "s", f"{folder}/other")


def test_one_failing_table_lets_the_others_finish(spark):
    done = []

    def work(item):
        if item == 2:
            raise RuntimeError("second")
        done.append(item)
        return item * 10

    assert side_by_side(spark, work, [1, 3]) == [10, 30]
    with pytest.raises(RuntimeError, match="second"):
        side_by_side(spark, work, [1, 2, 3])
    assert sorted(done) == [1, 1, 3, 3]
    assert side_by_side(spark, work, []) == []


def test_no_stream_for_customers(spark, folder):
    with pytest.raises(ValueError):
        start_silver_stream(spark, Layers.under(folder), CUSTOMERS, "r", f"{folder}/c")


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "x").startswith(f"{shared}/retail_strata/x-")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


def test_literal_rows_round_trip(spark, folder):
    tools = spark.createDataFrame(
        [("drill", 4.5), ("ladder", 12.0), ("rope", 2.25), ("saw", 9.75)], ["tool", "kilos"]
    )
    writers.overwrite_parquet(tools, folder + "/tools")
    older = readers.read_parquet(spark, folder + "/tools").filter("kilos BETWEEN 3 AND 10").select("tool", "kilos")
    writers.overwrite_parquet(older, folder + "/older")
    assert sorted(r.tool for r in readers.read_parquet(spark, folder + "/older").collect()) == ["drill", "saw"]
