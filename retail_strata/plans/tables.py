"""The four entities and where their layers live."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from retail_strata import schemas
from retail_strata.operators import cleanse


@dataclass(frozen=True)
class Layers:
    """Root folder of each layer; any path or URI Spark can reach."""

    raw: str
    bronze: str
    silver: str
    gold: str

    @staticmethod
    def under(root: str) -> "Layers":
        base = root.rstrip("/")
        return Layers(*(f"{base}/{layer}" for layer in ("raw", "bronze", "silver", "gold")))


@dataclass(frozen=True, eq=False)
class Entity:
    name: str
    raw_format: str
    raw_schema: StructType
    bronze_schema: StructType
    silver_schema: StructType
    silver_partitions: tuple[str, ...]
    refine: Callable[[DataFrame], DataFrame]
    judge: Callable[[DataFrame], DataFrame]
    rules: dict[str, str]

    @property
    def raw_file(self) -> str:
        return f"{self.name}.{self.raw_format}"

    @property
    def bronze_table(self) -> str:
        return f"bronze_{self.name}"

    @property
    def silver_table(self) -> str:
        return f"silver_{self.name}"


CUSTOMERS = Entity(
    "customers", "json", schemas.RAW_CUSTOMERS, schemas.BRONZE_CUSTOMERS,
    schemas.SILVER_CUSTOMERS, ("state",), cleanse.refine_customers, cleanse.judge_customers,
    cleanse.CUSTOMER_RULES,
)
PRODUCTS = Entity(
    "products", "csv", schemas.RAW_PRODUCTS, schemas.BRONZE_PRODUCTS,
    schemas.SILVER_PRODUCTS, ("category",), cleanse.refine_products, cleanse.judge_products,
    cleanse.PRODUCT_RULES,
)
SALES = Entity(
    "sales", "json", schemas.RAW_SALES, schemas.BRONZE_SALES,
    schemas.SILVER_SALES, ("order_year", "order_month"), cleanse.refine_sales, cleanse.judge_sales,
    cleanse.SALES_RULES,
)
PAYMENTS = Entity(
    "payments", "parquet", schemas.RAW_PAYMENTS, schemas.BRONZE_PAYMENTS,
    schemas.SILVER_PAYMENTS, ("payment_method",), cleanse.refine_payments, cleanse.judge_payments,
    cleanse.PAYMENT_RULES,
)

ENTITIES = (CUSTOMERS, PRODUCTS, SALES, PAYMENTS)
GOLD_SCHEMAS = {
    "gold_sales_summary": schemas.GOLD_SALES_SUMMARY,
    "gold_customer_metrics": schemas.GOLD_CUSTOMER_METRICS,
    "gold_product_performance": schemas.GOLD_PRODUCT_PERFORMANCE,
    "gold_payment_analysis": schemas.GOLD_PAYMENT_ANALYSIS,
}
