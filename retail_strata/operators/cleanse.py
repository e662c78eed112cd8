"""Silver rules: clean, type and check the four entities.

Checks are positive filters, so a null in any of them rejects the row.
"""

from pyspark.sql import DataFrame

from retail_strata.functions import columns
from retail_strata.functions.cleaning import day, digits, instant, lowered, money, trimmed, uppered
from retail_strata.operators.checks import judged, passed
from retail_strata.operators.latest import latest_per_key, place_per_key

NEWEST_BY = ["updated_at", "ingestion_timestamp", "email"]

# What a row must hold, by the name under which it is rejected.
CUSTOMER_RULES = {"email": "contains(email, '@')", "cpf": "cpf IS NOT NULL"}
PRODUCT_RULES = {
    "price": "price > 0", "stock_quantity": "stock_quantity >= 0", "product_name": "product_name IS NOT NULL",
}
SALES_RULES = {"total_amount": "total_amount > 0", "quantity": "quantity > 0", "order_date": "order_date IS NOT NULL"}
PAYMENT_RULES = {"amount": "amount > 0", "payment_date": "payment_date IS NOT NULL"}


def clean_customers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(columns(
        name=trimmed("name"),
        email=lowered("email"),
        phone=digits("phone"),
        cpf=digits("cpf"),
        state=uppered("state"),
        birth_date=day("birth_date"),
        created_at=instant("created_at"),
        updated_at=instant("updated_at"),
    ))


def latest_customers(customers: DataFrame) -> DataFrame:
    """Newest version by update time, then by ingestion time, then by e-mail."""
    return latest_per_key(customers, ["customer_id"], [c for c in NEWEST_BY if c in customers.columns])


def refine_customers(raw: DataFrame) -> DataFrame:
    """Deduplicate first and check second: a customer whose newest version is
    invalid is left out even if an older version was valid."""
    newest = latest_customers(clean_customers(raw))
    return newest.filter(passed(CUSTOMER_RULES))


def judge_customers(raw: DataFrame) -> DataFrame:
    """All rows with what they fail; a version that a newer one of the batch replaces
    fails for that, whatever else it holds."""
    cleaned = clean_customers(raw)
    newest_by = [c for c in NEWEST_BY if c in cleaned.columns]
    placed = place_per_key(cleaned, ["customer_id"], newest_by)
    return judged(placed, CUSTOMER_RULES, older="_place > 1").drop("_place")


def clean_products(raw: DataFrame) -> DataFrame:
    return raw.withColumns(columns(
        product_name=trimmed("product_name"), category=trimmed("category"), price=money("price"),
    ))


def _available(products: DataFrame) -> DataFrame:
    return products.withColumns(columns(
        is_available="CASE WHEN stock_quantity > 0 THEN true ELSE false END",
    ))


def refine_products(raw: DataFrame) -> DataFrame:
    return _available(clean_products(raw).filter(passed(PRODUCT_RULES)))


def judge_products(raw: DataFrame) -> DataFrame:
    return _available(judged(clean_products(raw), PRODUCT_RULES))


def clean_sales(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns(columns(
        order_date=instant("order_date"), total_amount=money("total_amount"), status=lowered("status"),
    ))
    return typed.withColumns(columns(order_year="year(order_date)", order_month="month(order_date)"))


def refine_sales(raw: DataFrame) -> DataFrame:
    return clean_sales(raw).filter(passed(SALES_RULES))


def judge_sales(raw: DataFrame) -> DataFrame:
    return judged(clean_sales(raw), SALES_RULES)


def clean_payments(raw: DataFrame) -> DataFrame:
    return raw.withColumns(columns(
        payment_date=instant("payment_date"),
        created_at=instant("created_at"),
        amount=money("amount"),
        payment_method=lowered("payment_method"),
        status=lowered("status"),
    ))


def refine_payments(raw: DataFrame) -> DataFrame:
    return clean_payments(raw).filter(passed(PAYMENT_RULES))


def judge_payments(raw: DataFrame) -> DataFrame:
    return judged(clean_payments(raw), PAYMENT_RULES)
