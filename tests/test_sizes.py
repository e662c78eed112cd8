"""Steps that must hold, and be no dearer than needed, on tables of any size."""

import json
import re

import rows
from pyspark.sql import types as T

from retail_strata import queries
from retail_strata.plans import raw_views
from retail_strata.plans.bronze import bronze_log, ingest_file
from retail_strata.plans.compaction import CompactedTable
from retail_strata.plans.gold_increments import rows_of_batch, silver_batches
from retail_strata.plans.run_log import waiting
from retail_strata.plans.silver import refine_entity, silver_batch, silver_log
from retail_strata.plans.tables import SALES, Layers
from retail_strata.sources import readers, writers


def test_compaction_of_more_than_one_target(spark, folder, monkeypatch):
    """Partitions of several targets keep several files."""
    spark.range(6000).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "'O' AS o_orderstatus", "double(id * 7919 % 10007) AS o_totalprice",
        "timestamp_ntz'2024-01-01' AS o_orderdate", "sha2(string(id), 256) AS o_orderpriority",
    ).write.parquet(f"{folder}/orders.parquet")
    compact, done = CompactedTable.compact, []

    def to_small_files(table, target_bytes, by):
        done.append(compact(table, 300_000, by))
        return done[-1]

    monkeypatch.setattr(CompactedTable, "compact", to_small_files)
    kept = queries.compact_bronze(spark, folder)
    assert kept.count() == 30000
    assert kept.groupBy("payment_id").count().filter("count = 5").count() == 6000
    assert 2 < done[-1].files_after < done[-1].files_before


def test_keys_are_looked_up_only_where_a_line_is_not_plain():
    """Plain lines are told by a pattern; whatever it matches has declared keys only."""
    pattern = re.compile(readers._only_declared(["a", "b c"]).replace(r"\z", r"\Z"))
    for line in ('{"a":1}', '{"a":"x: {y}","b c":-2.5e3}', '{"b c":null,"a":true}', '{"a":1,"a":"é"}'):
        assert pattern.search(line) and set(json.loads(line)) <= {"a", "b c"}, line
    for line in ('{"a":1,"z":2}', '{"a":"\\"z\\":1"}', '{"a":{"z":1}}', '{"a":[1]}', '[{"a":1}]', '{"a":1} x', '{}', '{"a":NaN}', ' {"a":1}'):
        assert not pattern.search(line), line


def test_undeclared_keys_behind_plain_lines(spark, folder):
    """Lines of both kinds in one file, and arrays of them."""
    schema = "a string, b long"
    texts = ['{"a":"x","b":1}', '{"a":"x","b":1,"z":2}', '{"a":"x","z":null}', '{"b":"two"}', '{"a":"\\u003a","b":3}',
             '[{"a":"1"},{"a":"2","z":0}]', '{"a":"x', '{"a":007}', '{"b":01,"a":"y"}', '{"a":"1","b":2} ']
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{folder}/lines")
    made = readers.read_json_lines(spark, f"{folder}/lines", T.StructType.fromDDL(schema)).collect()
    kept = [row[readers.RAW_RECORD] for row in made if row[readers.RAW_RECORD] is not None]
    assert sorted(kept) == sorted([texts[1], texts[2], texts[3], texts[6], texts[7], texts[8], '{"a":"2","z":0}'])


def test_lines_are_shuffled_as_numbers(spark, folder):
    """Texts of a sale are made after the join with its order."""
    spark.sql("SELECT 1L o_orderkey, 2L o_custkey, 'O' o_orderstatus, timestamp_ntz'2024-01-01' o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.sql(
        "SELECT 1L l_orderkey, 3L l_partkey, 4 l_linenumber, 5.0D l_quantity, 6.5D l_extendedprice"
    ).write.parquet(f"{folder}/lineitem.parquet")
    sales = raw_views.sales_raw(spark, folder)
    assert sales.first()[:5] == ("1-4", "2", "3", 5, 6.5)
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("concat(") < plan.index("Join ")


def test_batches_prune_silver_by_their_stamps(spark, folder):
    """Row groups of other batches are passed over by statistics; each state is whole."""
    layers = Layers.under(folder)
    for turn in ("1", "2"):
        writers.write_json_lines(rows.sales(spark, {"order_id": turn}), f"{layers.raw}/{SALES.raw_file}")
        ingest_file(spark, layers, "json", SALES.raw_file, SALES.bronze_table, f"i{turn}", SALES.raw_schema)
        refine_entity(spark, layers, SALES, f"r{turn}")
    for batch in silver_batches(spark, layers, SALES).values():
        taken = rows_of_batch(spark, layers, SALES, batch)
        assert [r.order_id for r in taken.collect()] == [batch[0]["ingestion_id"][1:]]
        plan = taken._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(f"ingestion_id#[0-9]+ = {batch[0]['ingestion_id']}\\b", plan)


def test_stamps_of_a_batch_are_not_shuffled(spark, folder):
    layers = Layers.under(folder)
    writers.write_json_lines(rows.sales(spark, {}), f"{layers.raw}/{SALES.raw_file}")
    ingest_file(spark, layers, "json", SALES.raw_file, SALES.bronze_table, "i", SALES.raw_schema)
    (waits,) = [waiting(bronze_log(spark, layers, SALES.bronze_table), silver_log(spark, layers, SALES))]
    batch = silver_batch(spark, layers, SALES, "r", waits, laid_out=True)
    plan = batch._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("processing_id") < plan.index("RebalancePartitions")
    assert batch.columns == SALES.silver_schema.fieldNames()


def test_three_batches_of_one_row(spark, folder):
    """Thirds without a row are empty files."""
    spark.sql(
        "SELECT 1L o_orderkey, 2L o_custkey, 'O' o_orderstatus, 6.5D o_totalprice, timestamp_ntz'2024-01-01' o_orderdate, 'low' o_orderpriority"
    ).write.parquet(f"{folder}/orders.parquet")
    (row,) = queries.QUERIES["gold_incremental_payment_analysis"](spark, folder).collect()
    assert (row.payment_method, row.total_transactions, row.total_amount) == ("low", 1, 6.5)
