"""Mergeable states of the gold tables.

A state has one row per key and batch, with sums, counts, least and largest values; the
states of any set of batches merge into what one aggregate over all their rows gives.
Averages are kept as sum and count, distinct counts as the distinct (key, value) rows.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.functions import columns, named
from retail_strata.functions.measures import mean_of_money, mean_of_whole_numbers


@dataclass(frozen=True)
class State:
    """``partial`` over silver rows, ``merge`` (an aggregate by name) over states, and
    ``final`` over merged states; ``measures`` are the columns that gold keeps."""

    keys: list[str]
    partial: dict[str, str]
    merge: dict[str, str]
    final: dict[str, str] = field(default_factory=dict)
    measures: list[str] = field(default_factory=list)

    def of_batch(self, silver: DataFrame) -> DataFrame:
        return silver.groupBy(self.keys).agg(*named(**self.partial))

    def merged(self, states: DataFrame) -> DataFrame:
        aggregates = {name: f"{how}({name})" for name, how in self.merge.items()}
        whole = states.groupBy(self.keys).agg(*named(**aggregates)).withColumns(columns(**self.final))
        return whole.select(*self.keys, *self.measures)


SALES_BY_MONTH = State(
    keys=["order_year", "order_month", "status"],
    partial={
        "total_orders": "count(order_id)", "revenue": "sum(total_amount)", "amounts": "count(total_amount)",
        "total_quantity": "sum(quantity)", "max_order_value": "max(total_amount)",
        "min_order_value": "min(total_amount)", "unique_customers": "bigint(0)",
    },
    merge={
        "total_orders": "sum", "revenue": "sum", "amounts": "sum", "total_quantity": "sum",
        "max_order_value": "max", "min_order_value": "min", "unique_customers": "sum",
    },
    final={"total_revenue": "CAST(revenue AS decimal(20,2))", "avg_order_value": mean_of_money("revenue", "amounts")},
    measures=[
        "total_orders", "unique_customers", "total_revenue", "total_quantity", "avg_order_value",
        "max_order_value", "min_order_value",
    ],
)

SALES_BY_CUSTOMER = State(
    keys=["customer_id"],
    partial={
        "total_orders": "count(order_id)", "spent": "sum(total_amount)", "amounts": "count(total_amount)",
        "last_order_date": "max(order_date)", "first_order_date": "min(order_date)",
    },
    merge={
        "total_orders": "sum", "spent": "sum", "amounts": "sum", "last_order_date": "max", "first_order_date": "min",
    },
    final={"total_spent": "CAST(spent AS decimal(20,2))", "avg_order_value": mean_of_money("spent", "amounts")},
    measures=["total_orders", "total_spent", "avg_order_value", "last_order_date", "first_order_date"],
)

SALES_BY_PRODUCT = State(
    keys=["product_id"],
    partial={
        "total_orders": "count(order_id)", "total_quantity_sold": "sum(quantity)", "revenue": "sum(total_amount)",
        "amounts": "count(total_amount)",
    },
    merge={"total_orders": "sum", "total_quantity_sold": "sum", "revenue": "sum", "amounts": "sum"},
    final={"total_revenue": "CAST(revenue AS decimal(20,2))", "avg_sale_value": mean_of_money("revenue", "amounts")},
    measures=["total_orders", "total_quantity_sold", "total_revenue", "avg_sale_value"],
)

PAYMENTS_BY_METHOD = State(
    keys=["payment_method", "status"],
    partial={
        "total_transactions": "count(payment_id)", "paid": "sum(amount)", "amounts": "count(amount)",
        "installments": "sum(total_installments)", "with_installments": "count(total_installments)",
    },
    merge={
        "total_transactions": "sum", "paid": "sum", "amounts": "sum", "installments": "sum", "with_installments": "sum",
    },
    final={
        "total_amount": "CAST(paid AS decimal(20,2))", "avg_transaction_value": mean_of_money("paid", "amounts"),
        "avg_installments": mean_of_whole_numbers("installments", "with_installments"),
    },
    measures=["total_transactions", "total_amount", "avg_transaction_value", "avg_installments"],
)


def buyers_of_month(sales: DataFrame) -> DataFrame:
    """The distinct customers of each month and status."""
    return sales.filter("customer_id IS NOT NULL").select(*SALES_BY_MONTH.keys, "customer_id").distinct()


def merged_summary(states: DataFrame, buyers: DataFrame) -> DataFrame:
    """Monthly states with the number of distinct buyers over all batches.  The numbers
    come in as rows of the same keys, so nothing is joined and a null status stays."""
    counts = buyers.distinct().groupBy(SALES_BY_MONTH.keys).agg(F.count("customer_id").alias("unique_customers"))
    return SALES_BY_MONTH.merged(states.unionByName(counts, allowMissingColumns=True)).sort(SALES_BY_MONTH.keys)
