"""Raw JSON is written packed, and read as any."""

from pathlib import Path

from retail_strata.plans.raw_views import write_raw
from retail_strata.plans.tables import SALES, Layers
from retail_strata.sources.readers import RAW_RECORD, read_json_lines


def test_raw_json_takes_less_than_its_text(spark, folder):
    layers = Layers.under(folder)
    rows = spark.range(5000).selectExpr(
        "concat(id, '-1') AS order_id", "string(id % 70) AS customer_id", "string(id % 90) AS product_id",
        "id % 50 AS quantity", "id * 1.5D AS total_amount", "'2024-01-02' AS order_date", "if(id % 9 = 0, null, ' F ') AS status",
    ).select(*SALES.raw_schema.fieldNames())
    write_raw(rows, layers, SALES)
    path = f"{layers.raw}/{SALES.raw_file}"
    text = spark.read.text(path).selectExpr("sum(length(value) + 1)").first()[0]
    assert sum(f.stat().st_size for f in Path(path).glob("part-*")) < text / 2
    back = read_json_lines(spark, path, SALES.raw_schema)
    assert back.filter(f"{RAW_RECORD} IS NOT NULL").isEmpty()
    assert sorted(back.drop(RAW_RECORD).collect(), key=str) == sorted(rows.collect(), key=str)
