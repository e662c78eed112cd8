"""Rows that lost their batch's deduplication or checks do not come back."""

import json

from retail_strata.plans.bronze import ingest_file
from retail_strata.plans.silver import refine_entity
from retail_strata.plans.tables import CUSTOMERS, Layers
from retail_strata.sources.readers import read_parquet


def version(key, email, day):
    return {"customer_id": key, "name": "n", "email": email, "cpf": "1", "state": "SP",
            "birth_date": "1990-01-15", "created_at": "2023-01-01 00:00:00", "updated_at": f"2024-01-{day} 00:00:00"}


def test_older_versions_of_a_batch_stay_out(spark, tmp_path):
    layers = Layers.under(str(tmp_path))
    (tmp_path / "raw").mkdir()
    batches = [
        [version("x", "new@a.b", "20"), version("y", "broken", "20")],
        [version("x", "old@a.b", "10"), version("y", "old@a.b", "10"), version("z", "z@a.b", "05")],
    ]
    for i, rows in enumerate(batches):
        (tmp_path / "raw" / f"c{i}.json").write_text("\n".join(map(json.dumps, rows)))
        ingest_file(spark, layers, "json", f"c{i}.json", CUSTOMERS.bronze_table, f"in-{i}", CUSTOMERS.raw_schema)
    runs = [refine_entity(spark, layers, CUSTOMERS, f"run-{i}") for i in range(3)]
    assert runs[0].rows == {"read": 5, "written": 2} and runs[1] is runs[2] is None
    silver = read_parquet(spark, f"{layers.silver}/{CUSTOMERS.silver_table}", CUSTOMERS.silver_schema)
    assert sorted((r.customer_id, r.email) for r in silver.collect()) == [("x", "new@a.b"), ("z", "z@a.b")]


def test_mark_of_a_batch_is_its_newest_row(spark, tmp_path):
    """The newest ingestion brings only losers, so no surviving row has its stamp."""
    layers = Layers.under(str(tmp_path))
    (tmp_path / "raw").mkdir()
    for i, rows in enumerate([[version("x", "new@a.b", "20")], [version("x", "old@a.b", "10")]]):
        (tmp_path / "raw" / f"c{i}.json").write_text("\n".join(map(json.dumps, rows)))
        ingest_file(spark, layers, "json", f"c{i}.json", CUSTOMERS.bronze_table, f"in-{i}", CUSTOMERS.raw_schema)
    assert refine_entity(spark, layers, CUSTOMERS, "run-0").rows == {"read": 2, "written": 1}
    assert refine_entity(spark, layers, CUSTOMERS, "run-1") is None
