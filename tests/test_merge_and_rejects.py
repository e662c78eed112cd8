"""Gold states, current customers, bitmaps, rejects, replay, mixed files, customer stream."""

import re
from datetime import date

import duckdb
import pytest
import rows
from pyspark.sql import functions as F

from retail_strata.operators.distinct_bitmaps import bitmaps, distinct_counts
from retail_strata.operators.numbering import numbered
from retail_strata.plans.bronze import ingest_file
from retail_strata.plans.buyers import Buyers
from retail_strata.plans.compaction import CompactedTable, packed, replaced_files
from retail_strata.plans.current_customers import current_customers, merge_customers
from retail_strata.plans.gold import build_table
from retail_strata.plans.gold_increments import fold_batches, fold_entity, incremental_gold, rows_of_batch, silver_batches
from retail_strata.plans.replay import repaired_json, replay_unheld, unheld_records
from retail_strata.plans.silver import bronze_rows, read_rejects, refine_entity
from retail_strata.plans.tables import CUSTOMERS, GOLD_SCHEMAS, PAYMENTS, PRODUCTS, SALES, Layers
from retail_strata.schemas import RAW_SALES
from retail_strata.sources import readers, writers
from retail_strata.sources.bucketed import bucketed_tables
from retail_strata.sources.versions import VersionedTable
from retail_strata.streaming.customer_stream import start_customer_stream


def ingest(spark, layers, entity, made, run_id, stamp=None):
    write = {"json": writers.write_json_lines, "csv": writers.write_csv, "parquet": writers.overwrite_parquet}
    write[entity.raw_format](made, f"{layers.raw}/{entity.raw_file}")
    moment = None if stamp is None else F.lit(stamp).cast("timestamp")
    return ingest_file(
        spark, layers, entity.raw_format, entity.raw_file, entity.bronze_table, run_id, entity.raw_schema, moment
    )


def bag(df):
    return sorted(map(str, df.drop("processing_timestamp").collect()))


def test_states_of_batches_merge_to_the_full_rebuild(spark, folder):
    layers = Layers.under(folder)
    batches = [
        {"customers": [{"customer_id": "1"}, {"customer_id": "2"}],
         "sales": [{"order_id": str(i), "customer_id": ["1", "2", None][i % 3], "total_amount": 10.01 + i / 7,
                    "status": [None, "a"][i % 2]} for i in range(11)]},
        {"customers": [{"customer_id": "1", "name": "New"}], "sales": [{"customer_id": "1", "product_id": None}] * 3},
        {"customers": [], "sales": [{"quantity": 0}]},
    ]
    for turn, batch in enumerate(batches):
        ingest(spark, layers, CUSTOMERS, rows.customers(spark, *batch["customers"]), f"c{turn}")
        ingest(spark, layers, SALES, rows.sales(spark, *batch["sales"]), f"s{turn}")
        ingest(spark, layers, PRODUCTS, rows.products(spark, {}, {"product_id": f"p{turn}"}, {"product_id": None}), f"p{turn}")
        ingest(spark, layers, PAYMENTS, rows.payments(spark, {"total_installments": None}, {"amount": 3.33}), f"x{turn}")
        for entity in (CUSTOMERS, SALES, PRODUCTS, PAYMENTS):
            refine_entity(spark, layers, entity, f"r{turn}")
        fold_batches(spark, layers)
        assert set(fold_batches(spark, layers).values()) == {0}
    for table in GOLD_SCHEMAS:
        whole, merged = build_table(spark, layers, table), incremental_gold(spark, layers, table)
        assert bag(merged) == bag(whole.select(*merged.columns)) != []
    with pytest.raises(ValueError):
        incremental_gold(spark, layers, "none")


def test_only_the_files_of_the_batch_are_opened(spark, folder, monkeypatch):
    layers = Layers.under(folder)
    ingest(spark, layers, PAYMENTS, rows.payments(spark, {"payment_id": "old"}), "a")
    refine_entity(spark, layers, PAYMENTS, "one")
    (first,) = silver_batches(spark, layers, PAYMENTS).values()
    later = [{**i, "started_micros": i["started_micros"] + 2 * 3600 * 1_000_000} for i in first]
    # Nothing is as new as that: the rows do not add up, so all files are opened.
    assert rows_of_batch(spark, layers, PAYMENTS, later).count() == 1
    pruned = rows_of_batch(spark, layers, PAYMENTS, first)
    assert "modifiedAfter" in str(pruned._jdf.queryExecution().analyzed().toString()) or pruned.count() == 1
    assert fold_entity(spark, layers, PAYMENTS) == 1


def test_merge_touches_only_its_parts(spark, folder):
    layers = Layers.under(folder)
    people = [{"customer_id": str(i), "email": f"{i}@a.b"} for i in range(40)]
    ingest(spark, layers, CUSTOMERS, rows.customers(spark, *people), "a")
    refine_entity(spark, layers, CUSTOMERS, "one")
    (all_parts,) = merge_customers(spark, layers, parts=8).values()
    table = VersionedTable(spark, f"{layers.gold}/customers_current", CUSTOMERS.silver_schema)
    before = table.current()
    newer = {"customer_id": "7", "email": "new@a.b", "updated_at": "2024-03-01 00:00:00"}
    ingest(spark, layers, CUSTOMERS, rows.customers(spark, newer), "b")
    refine_entity(spark, layers, CUSTOMERS, "two")
    (touched,) = merge_customers(spark, layers, parts=8).values()
    assert len(all_parts) > 4 and len(touched) == 1
    after = table.current()
    assert {p for p in after if after[p] != before[p]} == set(touched)
    found = {r.customer_id: r.email for r in current_customers(spark, layers).collect()}
    assert len(found) == 40 and found["7"] == "new@a.b" and found["8"] == "8@a.b"
    assert merge_customers(spark, layers, parts=8) == {}
    plan = table.read(touched)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*part.*version", plan)


def test_a_version_without_its_entry_is_not_seen(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", RAW_SALES)
    assert table.read().count() == 0 and table.current() == {}
    made = rows.sales(spark, {}, {"order_id": "2"}).withColumn("p", F.lit(1))
    table.replace(made, "p", [1, 2], "first")
    orphan = made.withColumn("part", F.lit(1)).withColumn("version", F.lit("orphan")).drop("p")
    writers.append_parquet(orphan, f"{folder}/t/data", ("part", "version"))
    assert table.read().count() == 2 and table.read([2]).count() == 0
    table.replace(made.limit(0), "p", [1], "second")
    assert table.read().count() == 0 and table.batches() == {"first", "second"}


def test_numbers_are_dense_and_stay(spark, folder):
    words = spark.range(1000).selectExpr("string(id % 300) AS customer_id").union(spark.sql("SELECT CAST(NULL AS string)"))
    numbers = sorted(r.number for r in numbered(words, "customer_id", first=5, ranges=7).collect())
    assert numbers == list(range(5, 305))
    buyers = Buyers(spark, f"{folder}/b")
    sales = spark.range(900).selectExpr(
        "string(id % 70) AS customer_id", "int(2020 + id % 2) AS order_year", "int(id % 12 + 1) AS order_month"
    )
    for name, part in (("a", sales.limit(0)), ("b", sales.filter("customer_id < '4'")), ("c", sales), ("c", sales)):
        buyers.add(part, name)
    known = buyers.dictionary().collect()
    assert sorted(r.number for r in known) == list(range(70)) and len({r.customer_id for r in known}) == 70
    pandas = sales.toPandas()
    with duckdb.connect() as db:
        db.register("sales", pandas)
        expected = db.sql("""
            select 'month', order_year, order_month, count(distinct customer_id) from sales group by all union all
            select 'quarter', order_year, (order_month + 2) // 3, count(distinct customer_id) from sales group by all
            union all select 'year', order_year, 1, count(distinct customer_id) from sales group by all""").fetchall()
    found = [tuple(r) for r in buyers.rollup().select("level", "order_year", "period", "customers").collect()]
    assert sorted(found) == sorted(expected)


def test_bitmaps_over_many_buckets(spark):
    spread = spark.range(0, 400_000, 7).selectExpr("id AS number", "id % 2 AS k")
    bits = bitmaps(spread.union(spread).union(spark.sql("SELECT CAST(NULL AS bigint), 0")), ["k"])
    counts = {r.k: r.distinct_values for r in distinct_counts(bits, ["k"]).collect()}
    assert counts == {r.k: r["count"] for r in spread.groupBy("k").count().collect()}


def test_rows_read_are_rows_written_and_rejected(spark, folder):
    layers = Layers.under(folder)
    made = rows.sales(spark, {}, {"quantity": 0, "total_amount": -1.0}, {"quantity": None}, {"order_date": "x"})
    ingest(spark, layers, SALES, made, "a")
    assert refine_entity(spark, layers, SALES, "one", keep_rejects=True).rows == {
        "read": 4, "written": 1, "rejected": 3, "rejected_older_version": 0, "rejected_total_amount": 1,
        "rejected_quantity": 2, "rejected_order_date": 1,
    }
    reasons = sorted(tuple(r.reject_reasons) for r in read_rejects(spark, layers, SALES).collect())
    assert reasons == [("order_date",), ("quantity",), ("total_amount", "quantity")]
    people = rows.customers(
        spark, {"email": "old@a.b"}, {"email": "broken", "updated_at": "2024-03-01 00:00:00"}, {"customer_id": "2"}
    )
    ingest(spark, layers, CUSTOMERS, people, "a")
    result = refine_entity(spark, layers, CUSTOMERS, "one", keep_rejects=True).rows
    assert (result["read"], result["written"], result["rejected"]) == (3, 1, 2)
    assert sorted(tuple(r.reject_reasons) for r in read_rejects(spark, layers, CUSTOMERS).collect()) == [
        ("email",), ("older_version",),
    ]
    assert read_rejects(spark, layers, PAYMENTS).count() == 0
    ingest(spark, layers, PAYMENTS, rows.payments(spark, {"amount": 0.0}), "a")
    assert refine_entity(spark, layers, PAYMENTS, "one", keep_rejects=True).rows["written"] == 0
    assert read_rejects(spark, layers, PAYMENTS).count() == 1


def test_a_record_is_replayed_once(spark, tmp_path):
    layers = Layers.under(str(tmp_path))
    (tmp_path / "raw").mkdir()
    line = '{"order_id":"%s","quantity":1,"total_amount":5.5,"order_date":"2024-01-01 10:00:00"'
    lines = [line % "ok" + "}", line % "x" + ', oops', line % "x" + ', oops', line % "y" + "; no", line % "z" + ',"coupon":1}']
    (tmp_path / "raw" / "sales.json").write_text("\n".join(lines))
    ingest_file(spark, layers, "json", "sales.json", SALES.bronze_table, "in", SALES.raw_schema)
    assert refine_entity(spark, layers, SALES, "one").rows == {"read": 5, "written": 2}
    assert unheld_records(spark, layers, SALES).count() == 3
    repair = repaired_json(F.regexp_replace("raw_record", ", oops$", "}"), SALES)
    assert replay_unheld(spark, layers, SALES, repair, "again").rows == {"written": 2}
    assert replay_unheld(spark, layers, SALES, repair, "and again") is None
    both = repaired_json(F.regexp_replace("raw_record", "(, oops|; no)$", "}"), SALES)
    assert replay_unheld(spark, layers, SALES, both, "rest").rows == {"written": 1}
    assert refine_entity(spark, layers, SALES, "two").rows == {"read": 3, "written": 3}
    silver = readers.read_parquet(spark, f"{layers.silver}/silver_sales", SALES.silver_schema)
    assert sorted(r.order_id for r in silver.collect()) == ["ok", "x", "x", "y", "z"]
    assert unheld_records(spark, layers, SALES).count() == 0


def test_array_lines(spark, tmp_path, either_ansi):
    lines = ['[{"order_id":"1"},{"order_id":"2","coupon":3}]', " [ ]", '[{"order_id":"3"},4]', '{"order_id":"4"}', "[{]"]
    (tmp_path / "s.json").write_text("\n".join(lines))
    found = readers.read_json_lines(spark, str(tmp_path / "s.json"), RAW_SALES).collect()
    assert [(r.order_id, r.raw_record) for r in found] == [
        ("1", None), ("2", '{"order_id":"2","coupon":3}'), (None, lines[2]), ("4", None), (None, "[{]"),
    ]


def test_parquet_files_of_several_schemas(spark, folder):
    path = f"{folder}/raw/payments.parquet"
    own = rows.payments(spark, {"payment_id": "1", "total_installments": 3})
    for changed in ({}, {"total_installments": "bigint(5000000000)"}, {"total_installments": "CAST(2 AS decimal(4,1))"}, {}):
        made = own.withColumns({c: F.expr(e) for c, e in changed.items()})
        made.coalesce(1).write.mode("append").parquet(path)
    read = readers.read_raw_parquet(spark, path, PAYMENTS.raw_schema)
    found = sorted((str(r.total_installments), r.raw_record is None) for r in read.collect())
    assert found == [("2", True), ("3", True), ("3", True), ("None", False)]
    assert read._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3


def test_late_customers_in_the_stream(spark, folder):
    layers, checkpoint = Layers.under(folder), f"{folder}/checkpoint"

    def turn(name, stamp, *people):
        ingest(spark, layers, CUSTOMERS, rows.customers(spark, *people), name, stamp)
        start_customer_stream(spark, layers, name, checkpoint).awaitTermination()

    newer = {"email": "new@a.b", "updated_at": "2024-03-01 00:00:00"}
    turn("a", "2024-05-01 12:10:00", {"email": "old@a.b"}, {"customer_id": "2", "email": "2@a.b"})
    turn("b", "2024-05-01 13:05:00", {"customer_id": "3", "email": "3@a.b"})  # the first window is not over yet
    turn("c", "2024-05-01 12:50:00", newer, {"customer_id": "2", "email": "broken", "updated_at": "2024-04-01 00:00:00"})
    turn("d", "2024-05-01 15:00:00", {"customer_id": "4", "email": "4@a.b"})
    turn("e", "2024-05-01 12:55:00", {"customer_id": "5", "email": "too@late"})
    turn("f", "2024-05-02 15:00:00", {"customer_id": "6", "email": "6@a.b"})
    silver = readers.read_parquet(spark, f"{layers.silver}/silver_customers", CUSTOMERS.silver_schema)
    assert {r.customer_id: r.email for r in silver.collect()} == {"c1": "new@a.b", "3": "3@a.b", "4": "4@a.b"}
    with pytest.raises(ValueError, match="stream"):
        refine_entity(spark, layers, CUSTOMERS, "batch")


def test_compaction_keeps_rows_and_what_comes_meanwhile(spark, folder):
    path, by = f"{folder}/bronze", ("day",)
    schema = "id bigint, text string, day string"
    wide = spark.range(4000).selectExpr("id", "sha2(string(id), 512) AS text", "string(id % 2) AS day")
    for part in range(6):
        writers.append_parquet(wide.filter(f"id % 6 = {part}").coalesce(2), path, by)
    table = CompactedTable(spark, path, spark.createDataFrame([], schema).schema)
    before = table.files().count()
    first = table.compact(1 << 20, by)
    assert (first.files_before, first.files_after) == (before, 2) and before >= 12
    writers.append_parquet(spark.range(4000, 4010).selectExpr("id", "'x' AS text", "'0' AS day"), path, by)
    assert sorted(r.id for r in table.read().collect()) == list(range(4010))
    # The second packing takes the staged files up as well; a third finds nothing to do.
    assert table.compact(1 << 20, by).files_after == 2
    assert table.compact(1 << 20, by).groups == 0
    assert sorted(r.id for r in table.read().collect()) == list(range(4010))
    assert {r.day for r in table.read().select("day").distinct().collect()} == {"0", "1"}
    assert replaced_files(table).count() > before
    # A staging folder without an entry is not read.
    writers.append_parquet(wide, f"{path}_compact/data/group-left", by)
    assert table.read().count() == 4010


def test_files_are_packed_up_to_the_target(spark):
    lengths = [10, 20, 30, 40, 45, 60, 100]
    files = spark.createDataFrame([(f"p/{i}", n, "p") for i, n in enumerate(lengths)], "path string, length bigint, partition string")
    groups = [sorted(int(p[2:]) for p in r.paths) for r in packed(files, 100).collect()]
    assert sorted(groups) == [[0, 1, 2, 3]]  # 10 + 20 + 30 + 40 fill one; 45 would be alone; 60 and 100 are full


def test_bucketed_sides_need_no_exchange(spark, folder):
    from retail_strata.operators import business, cleanse

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed_tables(spark, "bucket_test", f"{folder}/b") as tables:
            sales = cleanse.refine_sales(rows.sales(spark, {}, {"customer_id": "c2"}, {"customer_id": None}))
            tables.write("sales", sales, "customer_id", 4)
            tables.write("customers", cleanse.refine_customers(rows.customers(spark, {})), "customer_id", 4)
            metrics = business.customer_metrics(tables.read("customers"), tables.read("sales"))
            assert "Exchange" not in metrics._jdf.queryExecution().executedPlan().toString()
            assert [(r.customer_id, r.total_orders) for r in metrics.collect()] == [("c1", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_jobs_read_a_compacted_table_by_its_manifest(spark, folder):
    layers = Layers.under(folder)
    for turn in range(3):
        ingest(spark, layers, PAYMENTS, rows.payments(spark, {"payment_id": f"p{turn}"}), f"in-{turn}", "2024-05-01")
    bronze = CompactedTable(spark, f"{layers.bronze}/bronze_payments", PAYMENTS.bronze_schema)
    assert bronze.compact(1 << 20, ("ingestion_date",)).files_after == 1
    first = {"source_file": "payments.parquet", "first_date": date(2024, 5, 1), "last_date": date(2024, 5, 1)}
    micros = {"first_micros": 1714521600000000, "last_micros": 1714521600000000, "rows_read": 1}
    keys = [{"ingestion_id": f"in-{i}", **first, **micros} for i in range(3)]
    files = bronze_rows(spark, layers, PAYMENTS, keys).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == 1 and "_compact/data/group-" in files[0].f
    assert refine_entity(spark, layers, PAYMENTS, "one").rows == {"read": 3, "written": 3}
    silver = CompactedTable(spark, f"{layers.silver}/silver_payments", PAYMENTS.silver_schema)
    ingest(spark, layers, PAYMENTS, rows.payments(spark, {"payment_id": "p3"}), "in-3", "2024-05-02")
    refine_entity(spark, layers, PAYMENTS, "two")
    silver.compact(1 << 20, ("payment_method",))
    assert refine_entity(spark, layers, PAYMENTS, "idle") is None
    whole = build_table(spark, layers, "gold_payment_analysis").collect()
    assert [r.total_transactions for r in whole] == [4]
    assert fold_entity(spark, layers, PAYMENTS) == 2
    assert [r.total_transactions for r in incremental_gold(spark, layers, "gold_payment_analysis").collect()] == [4]
