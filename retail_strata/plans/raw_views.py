"""Raw retail input derived from a star schema (customer, nation, part, lineitem,
orders), with the defects planted that the silver checks look for.

Every row of the source tables takes part; the remainders below only choose
which rows carry a defect or a second version.
"""

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from retail_strata.functions import columns, named
from retail_strata.plans.tables import ENTITIES, Entity, Layers
from retail_strata.schemas import RAW_SALES
from retail_strata.sources.writers import overwrite_parquet, write_csv, write_json_lines


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Every 20th customer has a second, newer version; every 100th's is invalid."""
    nation = star_table(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    people = star_table(spark, folder, "customer").join(nation, "c_nationkey")
    versions = people.selectExpr(
        "c_custkey AS k", "c_name", "c_nationkey", "n_name",
        "explode(if(c_custkey % 20 = 0, array(0, 1), array(0))) AS v",
    )
    return versions.select(named(
        customer_id="string(k)",
        name="concat('  ', c_name, ' ')",
        email="""CASE WHEN v = 1 AND k % 100 = 0 THEN 'broken'
                      WHEN k % 50 = 7 THEN 'no-at-sign'
                      WHEN k % 50 <> 8 THEN concat(' User', k, '.V', v, '@Example.COM ') END""",
        phone="concat('+55 (11) 9', lpad(string(k), 8, '0'))",
        cpf="CASE WHEN k % 40 <> 3 THEN concat(lpad(string(k), 9, '0'), '-00') END",
        birth_date="if(k % 60 = 5, 'not a date', '1990-01-15')",
        age="k % 63 + 18",
        gender="element_at(array('M', 'F', 'Other'), int(k % 3) + 1)",
        address="concat('Rua ', k)",
        city="n_name",
        state="concat(' s', c_nationkey, ' ')",
        zip_code="lpad(string(k % 100000), 5, '0')",
        created_at="'2023-05-06 07:08:09'",
        updated_at="concat('2024-01-0', v + 1, ' 00:00:00')",
        is_active="k % 4 <> 0",
    ))


def products_raw(spark: SparkSession, folder: str) -> DataFrame:
    return star_table(spark, folder, "part").select(named(
        product_id="string(p_partkey)",
        product_name="concat(' ', p_name, ' ')",
        category="p_type",
        price="if(p_partkey % 25 = 0, -1.0D, p_retailprice)",
        stock_quantity="if(p_partkey % 30 = 0, NULL, int(p_partkey % 11) - 1)",
        created_at="timestamp('2024-02-03 04:05:06')",
    ))


def sales_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One sale per line item.  The order's texts are made before the join, once per
    order; a line's after it, so that its numbers are shuffled and not their texts."""
    orders = star_table(spark, folder, "orders").select(named(
        l_orderkey="o_orderkey",
        customer_id="string(o_custkey)",
        status="concat(' ', o_orderstatus, ' ')",
        order_date="if(o_orderkey % 101 = 0, 'not a date', string(o_orderdate))",
    ))
    numbers = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    lines = star_table(spark, folder, "lineitem").select(*numbers)
    sales = lines.join(orders, "l_orderkey").withColumns(columns(
        order_id="concat(l_orderkey, '-', l_linenumber)",
        product_id="string(l_partkey)",
        quantity="bigint(l_quantity)",
        total_amount="if(l_orderkey % 97 = 0, 0.0D, l_extendedprice)",
    ))
    return sales.select(*RAW_SALES.fieldNames())


def payments_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order."""
    return star_table(spark, folder, "orders").select(named(
        payment_id="string(o_orderkey)",
        payment_date="if(o_orderkey % 89 = 0, NULL, string(o_orderdate))",
        created_at="string(o_orderdate)",
        amount="if(o_orderkey % 83 = 0, -5.0D, o_totalprice)",
        payment_method="concat(' ', o_orderpriority)",
        status="o_orderstatus",
        total_installments="int(o_orderkey % 12) + 1",
    ))


RAW_VIEWS = {
    "customers": customers_raw,
    "products": products_raw,
    "sales": sales_raw,
    "payments": payments_raw,
}


def write_raw(rows: DataFrame, layers: Layers, entity: Entity, by: tuple[str, ...] = (), within: str = "") -> None:
    """The raw file of one entity, in the format its job reads; a folder for each value of
    the columns ``by``, or only the folder ``within``.  JSON repeats its keys in every line:
    packed, a file takes a fifth of the disk, and one is read by a task as one was written."""
    writers = {"json": partial(write_json_lines, compression="lz4"), "csv": write_csv, "parquet": overwrite_parquet}
    writers[entity.raw_format](rows, f"{layers.raw}/{entity.raw_file}{within}", by=by)


def write_raw_file(spark: SparkSession, folder: str, layers: Layers, entity: Entity) -> None:
    write_raw(RAW_VIEWS[entity.name](spark, folder), layers, entity)


def write_raw_files(spark: SparkSession, folder: str, layers: Layers) -> None:
    for entity in ENTITIES:
        write_raw_file(spark, folder, layers, entity)
