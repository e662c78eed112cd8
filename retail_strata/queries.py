"""One query per operator, over a folder of star-schema tables.

Results leave out run stamps and give money as double, instants without a zone
and days as their midnight, so that they compare with any SQL engine.  A query that exercises a sink
writes to the shared scratch folder and returns what it reads back.
"""

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_strata import schemas
from retail_strata.functions import columns, quoted
from retail_strata.operators import business
from retail_strata.operators.checks import REASONS
from retail_strata.operators.cleanse import latest_customers
from retail_strata.operators.incremental import high_water_mark, newer_than, newest_stamp
from retail_strata.operators.latest import latest_per_key
from retail_strata.operators.lineage import stamp_ingestion
from retail_strata.operators.reports import row_counts
from retail_strata.plans import raw_views
from retail_strata.plans.bronze import StageResult, bronze_log, ingest_all, ingest_file, read_bronze
from retail_strata.plans.buyers import Buyers
from retail_strata.plans.compaction import CompactedTable
from retail_strata.plans.current_customers import current_customers, merge_customers
from retail_strata.plans.feeds import feed_customers, feed_products, feed_sales
from retail_strata.plans.full import bronze_report, layer_report, run_all
from retail_strata.plans.gold import aggregate_all, read_gold
from retail_strata.plans.gold_increments import fold_entity, incremental_gold
from retail_strata.plans.raw_views import RAW_VIEWS, star_table
from retail_strata.plans.replay import repaired_json, replay_unheld
from retail_strata.plans.run_log import waiting
from retail_strata.plans.silver import read_rejects, read_silver, refine_all, refine_entity, silver_batch, silver_log
from retail_strata.plans.tables import CUSTOMERS, GOLD_SCHEMAS, PAYMENTS, PRODUCTS, SALES, Entity, Layers
from retail_strata.sources.bucketed import bucketed_tables
from retail_strata.sources.readers import RAW_RECORD, path_exists, read_parquet
from retail_strata.sources.scratch import scratch_folder
from retail_strata.sources.writers import append_parquet, overwrite_parquet, spread_for_write, write_json_lines
from retail_strata.streaming.customer_stream import start_customer_stream
from retail_strata.streaming.silver_stream import start_silver_stream

Query = Callable[[SparkSession, str], DataFrame]

RUN_STAMPS = ("ingestion_timestamp", "ingestion_date", "processing_timestamp", "batch_mark")


def comparable(df: DataFrame) -> DataFrame:
    """Plain types only, and nothing that depends on when the query ran."""
    plain = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz", T.DateType: "timestamp_ntz"}
    kinds = {f.name: plain.get(type(f.dataType)) for f in df.schema.fields if f.name not in RUN_STAMPS}
    return df.selectExpr(*[
        f"CAST({quoted(name)} AS {kind}) AS {quoted(name)}" if kind else quoted(name)
        for name, kind in kinds.items()
    ])


def _scratch_layers(spark: SparkSession, purpose: str) -> Layers:
    return Layers.under(scratch_folder(spark, purpose))


def _silver_table(spark: SparkSession, layers: Layers, entity: Entity) -> DataFrame:
    return read_parquet(spark, f"{layers.silver}/{entity.silver_table}", entity.silver_schema)


# Silver and gold, straight from the raw views.


def _refined(entity: Entity, spark: SparkSession, folder: str) -> DataFrame:
    return entity.refine(RAW_VIEWS[entity.name](spark, folder))


def _silver(entity: Entity, spark: SparkSession, folder: str) -> DataFrame:
    return comparable(_refined(entity, spark, folder))


def gold_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(business.sales_summary(_refined(SALES, spark, folder)))


def gold_customer_metrics(spark: SparkSession, folder: str) -> DataFrame:
    customers, sales = (_refined(e, spark, folder) for e in (CUSTOMERS, SALES))
    return comparable(business.customer_metrics(customers, sales))


def gold_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    products, sales = (_refined(e, spark, folder) for e in (PRODUCTS, SALES))
    return comparable(business.product_performance(products, sales))


def gold_product_performance_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all sales are of one product and a third of none."""
    products, sales = (_refined(e, spark, folder) for e in (PRODUCTS, SALES))
    hot = F.expr("CASE quantity % 3 WHEN 0 THEN '7' WHEN 1 THEN NULL ELSE product_id END")
    return comparable(business.product_performance(products, sales.withColumn("product_id", hot)))


def gold_payment_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(business.payment_analysis(_refined(PAYMENTS, spark, folder)))


def _customers_over_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Silver customers after the same raw file was ingested and refined twice."""
    layers = _scratch_layers(spark, "customers-two-runs")
    raw_views.write_raw_file(spark, folder, layers, CUSTOMERS)
    for run_id in ("run-1", "run-2"):
        ingest_file(
            spark, layers, CUSTOMERS.raw_format, CUSTOMERS.raw_file, CUSTOMERS.bronze_table, run_id,
            CUSTOMERS.raw_schema,
        )
        refine_entity(spark, layers, CUSTOMERS, run_id)
    return read_parquet(spark, f"{layers.silver}/{CUSTOMERS.silver_table}", CUSTOMERS.silver_schema)


def gold_customer_metrics_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplication by batch: one gold row per customer and run."""
    customers = _customers_over_two_runs(spark, folder)
    return comparable(business.customer_metrics(customers, _refined(SALES, spark, folder)))


def gold_customer_metrics_newest(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplication by table: one gold row per customer, whatever the runs."""
    customers = latest_customers(_customers_over_two_runs(spark, folder))
    return comparable(business.customer_metrics(customers, _refined(SALES, spark, folder)))


# Scans and sinks.


def _ingested(entity: Entity, spark: SparkSession, folder: str) -> DataFrame:
    layers = _scratch_layers(spark, f"ingest-{entity.name}")
    raw_views.write_raw_file(spark, folder, layers, entity)
    result = ingest_file(
        spark, layers, entity.raw_format, entity.raw_file, entity.bronze_table, "run-1", entity.raw_schema
    )
    return comparable(read_parquet(spark, result.path, entity.bronze_schema))


def ingest_parquet_native(spark: SparkSession, folder: str) -> DataFrame:
    """Payments with timestamp, decimal and long columns, then with the declared types:
    two appends to one bronze table, each refined into silver."""
    layers = _scratch_layers(spark, "parquet-native")
    declared = raw_views.payments_raw(spark, folder)
    native = declared.withColumns(columns(
        payment_date="timestamp(payment_date)", amount="CAST(amount AS decimal(12,2))",
        total_installments="bigint(total_installments)",
    ))
    for turn, payments in (("1", native), ("2", declared)):
        overwrite_parquet(payments, f"{layers.raw}/{PAYMENTS.raw_file}")
        ingest_file(
            spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table,
            f"ingest-{turn}", PAYMENTS.raw_schema,
        )
        refine_entity(spark, layers, PAYMENTS, f"refine-{turn}")
    silver = read_parquet(spark, f"{layers.silver}/{PAYMENTS.silver_table}", PAYMENTS.silver_schema)
    return comparable(silver)


def ingest_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Sales with broken lines, cells of another type and an unknown field: bronze keeps
    the text of each."""
    layers = _scratch_layers(spark, "ingest-dirty")
    lines = star_table(spark, folder, "orders").selectExpr(
        """concat('{"order_id":"', o_orderkey, CASE o_orderkey % 10
             WHEN 1 THEN '", oops'
             WHEN 2 THEN '","quantity":"two"}'
             WHEN 3 THEN '","quantity":3,"coupon":"x"}'
             ELSE '","quantity":3}' END) AS value"""
    )
    lines.write.text(f"{layers.raw}/{SALES.raw_file}")
    made = ingest_file(
        spark, layers, "json", SALES.raw_file, SALES.bronze_table, "run-1", SALES.raw_schema
    )
    bronze = read_parquet(spark, made.path, T.StructType([*SALES.bronze_schema.fields]).add(RAW_RECORD, "string"))
    return bronze.select("order_id", "quantity", RAW_RECORD)


def ingest_json_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as arrays, one line per order: every element is a record."""
    layers = _scratch_layers(spark, "json-arrays")
    sales = raw_views.sales_raw(spark, folder).withColumn("order_key", F.split("order_id", "-")[0])
    lines = sales.groupBy("order_key").agg(F.to_json(F.collect_list(F.struct(*schemas.RAW_SALES.fieldNames()))).alias("value"))
    lines.select("value").write.text(f"{layers.raw}/{SALES.raw_file}")
    made = ingest_file(
        spark, layers, "json", SALES.raw_file, SALES.bronze_table, "run-1", SALES.raw_schema
    )
    return comparable(read_parquet(spark, made.path, SALES.bronze_schema))


def ingest_parquet_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Payments in one folder whose writers chose int32, int64 and decimal columns."""
    layers = _scratch_layers(spark, "parquet-mixed")
    payments = raw_views.payments_raw(spark, folder)
    kinds = (
        {}, {"total_installments": "bigint(total_installments)", "amount": "CAST(amount AS decimal(12,2))"},
        {"total_installments": "CAST(total_installments AS decimal(6,0))", "payment_date": "timestamp(payment_date)"},
    )
    for turn, changed in enumerate(kinds):
        part = payments.filter(F.pmod(F.crc32("payment_id"), F.lit(len(kinds))) == turn)
        part.withColumns(columns(**changed)).write.mode("append").parquet(f"{layers.raw}/{PAYMENTS.raw_file}")
    ingest_file(
        spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table, "ingest-1", PAYMENTS.raw_schema
    )
    refine_entity(spark, layers, PAYMENTS, "refine-1")
    return comparable(_silver_table(spark, layers, PAYMENTS))


def replay_kept_records(spark: SparkSession, folder: str) -> DataFrame:
    """Sales whose lines broke off are repaired and replayed twice; silver has every sale
    once, and those it rejects stay out."""
    layers = _scratch_layers(spark, "replay")
    sales = raw_views.sales_raw(spark, folder)
    line = F.to_json(F.struct(*schemas.RAW_SALES.fieldNames()))
    broken = F.expr("if(quantity % 4 = 0, concat(left(v, length(v) - 1), ', oops'), v)")
    sales.withColumn("v", line).select(broken.alias("value")).write.text(f"{layers.raw}/{SALES.raw_file}")
    ingest_file(spark, layers, "json", SALES.raw_file, SALES.bronze_table, "ingest-1", SALES.raw_schema)
    refine_entity(spark, layers, SALES, "refine-1")
    repair = repaired_json(F.regexp_replace(RAW_RECORD, ", oops$", "}"), SALES)
    for turn in ("1", "2"):
        replay_unheld(spark, layers, SALES, repair, f"replay-{turn}")
        refine_entity(spark, layers, SALES, f"refine-after-{turn}")
    return comparable(_silver_table(spark, layers, SALES))


def partition_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "partition-roundtrip")
    keys = ("order_year", "order_month")
    append_parquet(spread_for_write(_refined(SALES, spark, folder), keys), path, keys)
    kinds = {f.name: f for f in schemas.SILVER_SALES.fields}
    names = [*schemas.RAW_SALES.fieldNames(), *keys]
    return comparable(read_parquet(spark, path, T.StructType([kinds[name] for name in names])))


def append_history(spark: SparkSession, folder: str) -> DataFrame:
    """The same raw file ingested twice: both runs stay."""
    layers = _scratch_layers(spark, "append-history")
    overwrite_parquet(raw_views.payments_raw(spark, folder), f"{layers.raw}/{PAYMENTS.raw_file}")
    for run_id in ("run-1", "run-2"):
        ingest_file(
            spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table, run_id, PAYMENTS.raw_schema
        )
    path = f"{layers.bronze}/{PAYMENTS.bronze_table}"
    return comparable(read_parquet(spark, path, PAYMENTS.bronze_schema))


def overwrite_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """A second overwrite replaces the first, partitions it no longer has included."""
    path = scratch_folder(spark, "overwrite-partitioned")
    customer = star_table(spark, folder, "customer")
    old = customer.withColumn("c_mktsegment", F.concat(F.lit("old "), "c_mktsegment"))
    for version in (old, customer):
        by = ("c_mktsegment",)
        overwrite_parquet(spread_for_write(version, by), path, by)
    return read_parquet(spark, path)


def filter_project(spark: SparkSession, folder: str) -> DataFrame:
    """Write, read, filter by a SQL string, project, write, read."""
    path = scratch_folder(spark, "filter-project")
    overwrite_parquet(star_table(spark, folder, "customer"), f"{path}/all")
    rich = read_parquet(spark, f"{path}/all").filter("c_acctbal > 5000")
    overwrite_parquet(rich.select("c_custkey", "c_name", "c_acctbal"), f"{path}/rich")
    return read_parquet(spark, f"{path}/rich")


# Lineage and increments.


def lineage_stamp(spark: SparkSession, folder: str) -> DataFrame:
    orders = comparable(star_table(spark, folder, "orders"))
    moment = F.lit("2024-05-06 07:08:09").cast("timestamp")
    stamped = stamp_ingestion(orders, "run-1", "orders.parquet", moment)
    plain = {c: F.col(c).cast("timestamp_ntz") for c in ("ingestion_timestamp", "ingestion_date")}
    return stamped.withColumns(plain)


def high_water_mark_of_events(spark: SparkSession, folder: str) -> DataFrame:
    return newest_stamp(star_table(spark, folder, "events"), "ts")


def incremental_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Silver holds the events up to 20 January; the newer ones are read from a
    bronze table partitioned by date."""
    path = scratch_folder(spark, "incremental-filter")
    stamp = F.col("ts").cast("timestamp")
    events = star_table(spark, folder, "events").withColumns({"ts": stamp, "ingestion_date": stamp.cast("date")})
    by = ("ingestion_date",)
    append_parquet(spread_for_write(events, by), path, by)
    bronze = read_parquet(spark, path)
    silver = bronze.filter("ts <= timestamp '2024-01-20 00:00:00'")
    return comparable(newer_than(bronze, high_water_mark(silver, "ts"), "ts"))


def incremental_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two ingestions with a silver run after each, and a last run with nothing new:
    each silver run takes exactly the ingestion before it."""
    layers = _scratch_layers(spark, "incremental-runs")
    overwrite_parquet(raw_views.payments_raw(spark, folder), f"{layers.raw}/{PAYMENTS.raw_file}")
    for turn in ("1", "2"):
        ingest_file(
            spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table,
            f"ingest-{turn}", PAYMENTS.raw_schema,
        )
        refine_entity(spark, layers, PAYMENTS, f"refine-{turn}")
    refine_entity(spark, layers, PAYMENTS, "refine-3")
    silver = read_parquet(spark, f"{layers.silver}/{PAYMENTS.silver_table}", PAYMENTS.silver_schema)
    return comparable(silver)


def incremental_late_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The newest versions are ingested first and older ones second, some of them valid
    behind an invalid newer one.  The first silver run takes both, the next two nothing."""
    layers = _scratch_layers(spark, "late-versions")
    versions = raw_views.customers_raw(spark, folder)
    older = F.expr("bigint(customer_id) % 20 = 0 AND updated_at = '2024-01-01 00:00:00'")
    for turn, part in (("1", versions.filter(~older)), ("2", versions.filter(older))):
        write_json_lines(part, f"{layers.raw}/{CUSTOMERS.raw_file}")
        ingest_file(
            spark, layers, "json", CUSTOMERS.raw_file, CUSTOMERS.bronze_table,
            f"ingest-{turn}", CUSTOMERS.raw_schema,
        )
    for turn in ("1", "2", "3"):
        refine_entity(spark, layers, CUSTOMERS, f"refine-{turn}")
    silver = read_parquet(spark, f"{layers.silver}/{CUSTOMERS.silver_table}", CUSTOMERS.silver_schema)
    return comparable(silver)


def run_log_resume(spark: SparkSession, folder: str) -> DataFrame:
    """A silver run ends after a part of its rows and before the end of its log entry.  The
    next run completes it under its own id and then takes the ingestion that came since."""
    layers = _scratch_layers(spark, "run-log-resume")
    overwrite_parquet(raw_views.payments_raw(spark, folder), f"{layers.raw}/{PAYMENTS.raw_file}")

    def ingest(run_id: str) -> None:
        ingest_file(
            spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table, run_id, PAYMENTS.raw_schema
        )

    ingest("ingest-1")
    log = silver_log(spark, layers, PAYMENTS)
    batch = waiting(bronze_log(spark, layers, PAYMENTS.bronze_table), log)
    log.start("refine-1", batch)
    part = silver_batch(spark, layers, PAYMENTS, "refine-1", batch).filter("crc32(payment_id) % 3 = 0")
    append_parquet(part, f"{layers.silver}/{PAYMENTS.silver_table}", PAYMENTS.silver_partitions)
    ingest("ingest-2")
    for run_id in ("refine-2", "refine-3"):
        refine_entity(spark, layers, PAYMENTS, run_id)
    return comparable(_silver_table(spark, layers, PAYMENTS))


def incremental_overlapping_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Three ingestions of one table: the second is stamped before the first and lands
    after silver took it, the third has the same stamp as the second.  None is hidden,
    none is taken twice."""
    layers = _scratch_layers(spark, "overlapping-runs")
    overwrite_parquet(raw_views.payments_raw(spark, folder), f"{layers.raw}/{PAYMENTS.raw_file}")
    for turn, stamp in (("1", "2024-05-06 12:00:00"), ("2", "2024-05-05 10:00:00"), ("3", "2024-05-05 10:00:00")):
        ingest_file(
            spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table, f"ingest-{turn}",
            PAYMENTS.raw_schema, F.lit(stamp).cast("timestamp"),
        )
        for run_id in (f"refine-{turn}", f"idle-{turn}"):
            refine_entity(spark, layers, PAYMENTS, run_id)
    return comparable(_silver_table(spark, layers, PAYMENTS))


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event of each user."""
    return latest_per_key(star_table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


def stream_silver(entity: Entity, spark: SparkSession, folder: str) -> DataFrame:
    """Two ingestions, each followed by a stream run that takes only the new files."""
    layers = _scratch_layers(spark, f"stream-{entity.name}")
    checkpoint = scratch_folder(spark, f"stream-{entity.name}-checkpoint")
    raw_views.write_raw_file(spark, folder, layers, entity)
    for turn in ("1", "2"):
        ingest_file(
            spark, layers, entity.raw_format, entity.raw_file, entity.bronze_table,
            f"ingest-{turn}", entity.raw_schema,
        )
        start_silver_stream(spark, layers, entity, f"refine-{turn}", checkpoint).awaitTermination()
    return comparable(read_parquet(spark, f"{layers.silver}/{entity.silver_table}", entity.silver_schema))


# Jobs and reports.


def _run(spark: SparkSession, folder: str, purpose: str) -> tuple[Layers, list[StageResult]]:
    layers = _scratch_layers(spark, purpose)
    raw_views.write_raw_files(spark, folder, layers)
    return layers, run_all(spark, layers, "run-1").stages


def job_bronze_counts(spark: SparkSession, folder: str) -> DataFrame:
    layers = _scratch_layers(spark, "job-bronze")
    raw_views.write_raw_files(spark, folder, layers)
    ingest_all(spark, layers, "run-1")
    return row_counts(read_bronze(spark, layers))


def job_silver_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The second silver run finds nothing new and adds nothing."""
    layers = _scratch_layers(spark, "job-silver")
    raw_views.write_raw_files(spark, folder, layers)
    ingest_all(spark, layers, "run-1")
    for run_id in ("run-1", "run-2"):
        refine_all(spark, layers, run_id)
    return row_counts(read_silver(spark, layers))


def job_gold_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The second gold run overwrites the first."""
    layers, _ = _run(spark, folder, "job-gold")
    aggregate_all(spark, layers)
    return row_counts(read_gold(spark, layers))


def job_gold(table: str, spark: SparkSession, folder: str) -> DataFrame:
    """A gold table as the whole run wrote it."""
    layers, _ = _run(spark, folder, f"job-{table}")
    return comparable(read_gold(spark, layers)[table])


def job_retry(spark: SparkSession, folder: str) -> DataFrame:
    """The first run fails as payments are missing, when the other tables are ingested;
    repeated under its id it gives what one clean run gives."""
    layers = _scratch_layers(spark, "job-retry")
    for entity in (CUSTOMERS, PRODUCTS, SALES):
        raw_views.write_raw_file(spark, folder, layers, entity)
    try:
        run_all(spark, layers, "run-1")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    raw_views.write_raw_file(spark, folder, layers, PAYMENTS)
    run_all(spark, layers, "run-1")
    return comparable(read_gold(spark, layers)["gold_sales_summary"])


def layer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    layers, _ = _run(spark, folder, "layer-row-counts")
    return layer_report(spark, layers)


def stage_counters(spark: SparkSession, folder: str) -> DataFrame:
    """The counters the stages report about themselves."""
    _, stages = _run(spark, folder, "stage-counters")
    counters = [(s.table, name, rows) for s in stages for name, rows in s.rows.items()]
    return spark.createDataFrame(counters, "table_name string, counter string, row_count bigint")


def report_of_ingestions(spark: SparkSession, folder: str) -> DataFrame:
    layers = _scratch_layers(spark, "ingestion-report")
    raw_views.write_raw_files(spark, folder, layers)
    for run_id in ("run-1", "run-2"):
        ingest_all(spark, layers, run_id)
    return bronze_report(spark, layers)


def _in_three_batches(spark: SparkSession, folder: str, purpose: str, entities, after) -> Layers:
    """A third of each raw view at a time, by key: ingested, refined, and ``after`` called."""
    layers = _scratch_layers(spark, purpose)
    for entity in entities:
        whole = RAW_VIEWS[entity.name](spark, folder)
        third = F.pmod(F.crc32(whole.columns[0]), F.lit(3))
        raw_views.write_raw(whole.withColumn("third", third).filter("third IS NOT NULL"), layers, entity, ("third",))
        for turn in range(3):  # a third without rows is an empty file
            if not path_exists(spark, f"{layers.raw}/{entity.raw_file}/third={turn}"):
                raw_views.write_raw(whole.limit(0), layers, entity, within=f"/third={turn}")
    for turn in range(3):
        for entity in entities:
            ingest_file(
                spark, layers, entity.raw_format, f"{entity.raw_file}/third={turn}", entity.bronze_table,
                f"ingest-{turn}", entity.raw_schema,
            )
            refine_entity(spark, layers, entity, f"refine-{turn}")
        after(layers)
    return layers


def gold_incremental(table: str, spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, each folded into the states of gold when it is there."""
    needed = {"gold_sales_summary": (SALES,), "gold_customer_metrics": (CUSTOMERS, SALES),
              "gold_product_performance": (PRODUCTS, SALES), "gold_payment_analysis": (PAYMENTS,)}[table]

    def fold(layers: Layers) -> None:
        for entity in needed:
            fold_entity(spark, layers, entity)

    layers = _in_three_batches(spark, folder, f"incremental-{table}", needed, fold)
    return comparable(incremental_gold(spark, layers, table))


def customers_current(spark: SparkSession, folder: str) -> DataFrame:
    """Newest versions after three batches: the newest rows first, then the older ones
    and then all again, each merged into the parts it touches."""
    layers = _scratch_layers(spark, "customers-current")
    versions = raw_views.customers_raw(spark, folder)
    older = F.expr("bigint(customer_id) % 20 = 0 AND updated_at = '2024-01-01 00:00:00'")
    for turn, part in (("1", versions.filter(~older)), ("2", versions.filter(older)), ("3", versions)):
        raw_views.write_raw(part, layers, CUSTOMERS)
        ingest_file(
            spark, layers, "json", CUSTOMERS.raw_file, CUSTOMERS.bronze_table, f"ingest-{turn}", CUSTOMERS.raw_schema
        )
        refine_entity(spark, layers, CUSTOMERS, f"refine-{turn}")
        merge_customers(spark, layers, parts=8)
    return comparable(current_customers(spark, layers)).drop("ingestion_id", "processing_id")


def distinct_customers_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Buyers by month, quarter and year after three batches of sales."""
    buyers = Buyers(spark, scratch_folder(spark, "buyers"))
    sales = _refined(SALES, spark, folder)
    for turn in range(3):
        buyers.add(sales.filter(F.pmod(F.crc32("order_id"), F.lit(3)) == turn), f"batch-{turn}")
    return buyers.rollup()


def silver_rejects(entity: Entity, spark: SparkSession, folder: str) -> DataFrame:
    """Every row that silver leaves out, typed, with the checks it fails."""
    layers = _scratch_layers(spark, f"rejects-{entity.name}")
    raw_views.write_raw_file(spark, folder, layers, entity)
    ingest_file(
        spark, layers, entity.raw_format, entity.raw_file, entity.bronze_table, "ingest-1", entity.raw_schema
    )
    refine_entity(spark, layers, entity, "refine-1", keep_rejects=True)
    rejects = read_rejects(spark, layers, entity)
    return comparable(rejects.withColumn(REASONS, F.array_join(REASONS, ",")))


def stream_silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Ingestions of three days: the first two windows are over, the third still waits."""
    layers = _scratch_layers(spark, "stream-customers")
    checkpoint = scratch_folder(spark, "stream-customers-checkpoint")
    raw_views.write_raw_file(spark, folder, layers, CUSTOMERS)
    for turn, day in (("1", "2024-05-01"), ("2", "2024-05-02"), ("3", "2024-05-03")):
        ingest_file(
            spark, layers, "json", CUSTOMERS.raw_file, CUSTOMERS.bronze_table, f"ingest-{turn}",
            CUSTOMERS.raw_schema, F.lit(f"{day} 12:30:00").cast("timestamp"),
        )
        start_customer_stream(spark, layers, f"refine-{turn}", checkpoint).awaitTermination()
    return comparable(_silver_table(spark, layers, CUSTOMERS)).drop("processing_id")


def compact_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Four ingestions, compacted twice with one more between them: the same rows, fewer
    files, and the ingestion that came after the first packing is there too."""
    layers = _scratch_layers(spark, "compact-bronze")
    raw_views.write_raw_file(spark, folder, layers, PAYMENTS)
    table = CompactedTable(spark, f"{layers.bronze}/{PAYMENTS.bronze_table}", PAYMENTS.bronze_schema)
    for turn in range(5):
        if turn == 4:
            table.compact(128 << 20, ("ingestion_date",))
        ingest_file(
            spark, layers, "parquet", PAYMENTS.raw_file, PAYMENTS.bronze_table, f"ingest-{turn}",
            PAYMENTS.raw_schema, F.lit(f"2024-05-0{turn % 2 + 1} 10:00:00").cast("timestamp"),
        )
    done = table.compact(128 << 20, ("ingestion_date",))
    if done.files_after > done.files_at_most:
        raise ValueError(f"{done.files_after} files are left, more than {done.files_at_most}")
    return comparable(table.read())


def gold_customer_metrics_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Customer metrics from silver tables bucketed by customer: sales are not shuffled."""
    path = scratch_folder(spark, "bucketed")
    database = f"strata_{path.rsplit('-', 1)[1]}"
    customers, sales = (_refined(e, spark, folder) for e in (CUSTOMERS, SALES))
    with bucketed_tables(spark, database, path) as tables:
        tables.write("customers", customers, "customer_id", buckets=8)
        tables.write("sales", sales, "customer_id", buckets=8)
        metrics = business.customer_metrics(tables.read("customers"), tables.read("sales"))
        result = f"{path}/metrics"
        overwrite_parquet(metrics, result)
    return comparable(read_parquet(spark, result))


# Feeds, sized by the given tables.


def _ids(spark: SparkSession, folder: str, table: str, key: str) -> DataFrame:
    return star_table(spark, folder, table).select(F.col(key).alias("id"))


def feed_customers_query(spark: SparkSession, folder: str) -> DataFrame:
    return feed_customers(_ids(spark, folder, "customer", "c_custkey"))


def feed_products_query(spark: SparkSession, folder: str) -> DataFrame:
    return feed_products(_ids(spark, folder, "part", "p_partkey"))


def feed_sales_query(spark: SparkSession, folder: str) -> DataFrame:
    return feed_sales(
        _ids(spark, folder, "orders", "o_orderkey"),
        _ids(spark, folder, "customer", "c_custkey"),
        _ids(spark, folder, "part", "p_partkey"),
    )


QUERIES: dict[str, Query] = {
    "ingest_json": partial(_ingested, CUSTOMERS),
    "ingest_json_sales": partial(_ingested, SALES),
    "ingest_csv": partial(_ingested, PRODUCTS),
    "ingest_parquet": partial(_ingested, PAYMENTS),
    "ingest_parquet_native": ingest_parquet_native,
    "ingest_dirty": ingest_dirty,
    "ingest_json_arrays": ingest_json_arrays,
    "ingest_parquet_mixed": ingest_parquet_mixed,
    "replay_unheld": replay_kept_records,
    "partition_roundtrip": partition_roundtrip,
    "append_history": append_history,
    "overwrite_partitioned": overwrite_partitioned,
    "filter_project": filter_project,
    "lineage_stamp": lineage_stamp,
    "high_water_mark": high_water_mark_of_events,
    "incremental_filter": incremental_filter,
    "incremental_runs": incremental_runs,
    "incremental_late_versions": incremental_late_versions,
    "run_log_resume": run_log_resume,
    "incremental_overlapping_runs": incremental_overlapping_runs,
    "dedup_latest": dedup_latest,
    "silver_customers": partial(_silver, CUSTOMERS),
    "silver_products": partial(_silver, PRODUCTS),
    "silver_sales": partial(_silver, SALES),
    "silver_payments": partial(_silver, PAYMENTS),
    "gold_sales_summary": gold_sales_summary,
    "gold_customer_metrics": gold_customer_metrics,
    "gold_customer_metrics_two_runs": gold_customer_metrics_two_runs,
    "gold_customer_metrics_newest": gold_customer_metrics_newest,
    "gold_product_performance": gold_product_performance,
    "gold_product_performance_skewed": gold_product_performance_skewed,
    "gold_payment_analysis": gold_payment_analysis,
    "compact_bronze": compact_bronze,
    "gold_customer_metrics_bucketed": gold_customer_metrics_bucketed,
    "customers_current": customers_current,
    "distinct_customers_rollup": distinct_customers_rollup,
    **{f"silver_rejects_{e.name}": partial(silver_rejects, e) for e in (CUSTOMERS, PRODUCTS, SALES, PAYMENTS)},
    "stream_silver_customers": stream_silver_customers,
    "stream_silver_products": partial(stream_silver, PRODUCTS),
    "stream_silver_sales": partial(stream_silver, SALES),
    "stream_silver_payments": partial(stream_silver, PAYMENTS),
    "job_bronze_counts": job_bronze_counts,
    "job_silver_counts": job_silver_counts,
    "job_gold_counts": job_gold_counts,
    **{f"job_{table}": partial(job_gold, table) for table in GOLD_SCHEMAS},
    **{f"gold_incremental_{t.removeprefix('gold_')}": partial(gold_incremental, t) for t in GOLD_SCHEMAS},
    "job_retry": job_retry,
    "layer_row_counts": layer_row_counts,
    "ingestion_report": report_of_ingestions,
    "stage_counters": stage_counters,
    "feed_customers": feed_customers_query,
    "feed_products": feed_products_query,
    "feed_sales": feed_sales_query,
}
