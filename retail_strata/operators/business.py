"""Gold tables: summaries of silver for consumers.

Every aggregate is partial before its shuffle, so a hot customer, product,
status or payment method costs one row per map task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_strata.functions import named
from retail_strata.functions.measures import mean
from retail_strata.operators.hot_keys import SLICE, find_hot_keys, left_join_unique, slices_of


PROFILE = ["customer_id", "name", "email", "city", "state"]
OFFER = ["product_id", "product_name", "category", "price", "stock_quantity"]


def sales_summary(sales: DataFrame) -> DataFrame:
    """Orders, customers and revenue per month and status, in that order.  The
    distinct count is spread by customer before it is added up per month."""
    keys = ["order_year", "order_month", "status"]
    measures = named(
        total_orders="count(order_id)",
        unique_customers="count(DISTINCT customer_id)",
        total_revenue="sum(total_amount)",
        total_quantity="sum(quantity)",
        avg_order_value=mean("total_amount"),
        max_order_value="max(total_amount)",
        min_order_value="min(total_amount)",
    )
    return sales.groupBy(keys).agg(*measures).sort(keys)


def spending_per_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(*named(
        total_orders="count(order_id)",
        total_spent="sum(total_amount)",
        avg_order_value=mean("total_amount"),
        last_order_date="max(order_date)",
        first_order_date="min(order_date)",
    ))


def customer_metrics(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Every silver customer with their spending; null measures without a sale.

    Silver holds a customer at most once per run, so no key can be hot on the
    customer side, and the sales side has one row per customer by then.
    """
    return customers.select(*PROFILE).join(spending_per_customer(sales), "customer_id", "left")


def turnover_per_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(*named(
        total_orders="count(order_id)",
        total_quantity_sold="sum(quantity)",
        total_revenue="sum(total_amount)",
        avg_sale_value=mean("total_amount"),
    ))


def product_performance(
    products: DataFrame, sales: DataFrame, ranked: bool = True, slices: int | None = None,
) -> DataFrame:
    """Every silver product row with its turnover; null measures without a sale.

    Products are never deduplicated, so one id may fill much of the table: hot
    ids are looked for first and split.  ``ranked`` sorts by revenue, best first
    and unsold last; product id and slice as further keys let Spark cut the many
    rows of equal or no revenue into several sort ranges.
    """
    offer = products.select(*OFFER)
    slices = slices_of(offer) if slices is None else slices
    hot = find_hot_keys(offer, "product_id", slices)
    joined = left_join_unique(offer, turnover_per_product(sales), "product_id", hot, slices)
    if ranked:
        joined = joined.sort(F.col("total_revenue").desc_nulls_last(), "product_id", SLICE)
    return joined.drop(SLICE)


def payment_analysis(payments: DataFrame) -> DataFrame:
    """Payments per method and status, in that order."""
    keys = ["payment_method", "status"]
    measures = named(
        total_transactions="count(payment_id)",
        total_amount="sum(amount)",
        avg_transaction_value=mean("amount"),
        avg_installments=mean("total_installments"),
    )
    return payments.groupBy(keys).agg(*measures).sort(keys)
