"""Declared schemas of the raw, bronze and silver tables.

Declaring them saves the inference pass over text input and keeps repeated
appends to one directory type-compatible.
"""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _BOOL, _DATE, _STAMP = T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()
MONEY = T.DecimalType(10, 2)

RAW_CUSTOMERS = _struct(
    customer_id=_STRING, name=_STRING, email=_STRING, phone=_STRING, cpf=_STRING,
    birth_date=_STRING, age=_LONG, gender=_STRING, address=_STRING, city=_STRING,
    state=_STRING, zip_code=_STRING, created_at=_STRING, updated_at=_STRING,
    is_active=_BOOL,
)

RAW_PRODUCTS = _struct(
    product_id=_STRING, product_name=_STRING, category=_STRING, price=_DOUBLE,
    stock_quantity=_INT, created_at=_STAMP,
)

RAW_SALES = _struct(
    order_id=_STRING, customer_id=_STRING, product_id=_STRING, quantity=_LONG,
    total_amount=_DOUBLE, status=_STRING, order_date=_STRING,
)

RAW_PAYMENTS = _struct(
    payment_id=_STRING, payment_date=_STRING, created_at=_STRING, amount=_DOUBLE,
    payment_method=_STRING, status=_STRING, total_installments=_INT,
)

INGESTION_STAMPS = _struct(
    ingestion_timestamp=_STAMP, ingestion_id=_STRING, source_file=_STRING, ingestion_date=_DATE,
)

PROCESSING_STAMPS = _struct(processing_timestamp=_STAMP, processing_id=_STRING, batch_mark=_STAMP)


#: Stamps as microseconds since 1970: the same in every session time zone.
RUN_LOG = _struct(
    attempt=_STRING, run_id=_STRING, state=_STRING, ingestion_id=_STRING, source_file=_STRING,
    first_micros=_LONG, last_micros=_LONG, first_date=_DATE, last_date=_DATE, rows_read=_LONG,
    rows_written=_LONG, logged_micros=_LONG,
)


def _evolve(base: T.StructType, *more: T.StructType, **changed: T.DataType) -> T.StructType:
    """``base`` with some types replaced, then new and extra columns appended."""
    kinds = {f.name: f.dataType for f in base.fields}
    kinds.update(changed)
    for extra in more:
        kinds.update({f.name: f.dataType for f in extra.fields})
    return _struct(**kinds)


BRONZE_CUSTOMERS = _evolve(RAW_CUSTOMERS, INGESTION_STAMPS)
BRONZE_PRODUCTS = _evolve(RAW_PRODUCTS, INGESTION_STAMPS)
BRONZE_SALES = _evolve(RAW_SALES, INGESTION_STAMPS)
BRONZE_PAYMENTS = _evolve(RAW_PAYMENTS, INGESTION_STAMPS)

SILVER_CUSTOMERS = _evolve(
    BRONZE_CUSTOMERS, PROCESSING_STAMPS,
    birth_date=_DATE, created_at=_STAMP, updated_at=_STAMP,
)
SILVER_PRODUCTS = _evolve(BRONZE_PRODUCTS, PROCESSING_STAMPS, price=MONEY, is_available=_BOOL)
SILVER_SALES = _evolve(
    BRONZE_SALES, PROCESSING_STAMPS,
    order_date=_STAMP, order_year=_INT, order_month=_INT, total_amount=MONEY,
)
SILVER_PAYMENTS = _evolve(
    BRONZE_PAYMENTS, PROCESSING_STAMPS,
    payment_date=_STAMP, created_at=_STAMP, amount=MONEY,
)

_REVENUE, _MEAN = T.DecimalType(20, 2), T.DecimalType(11, 2)
_GOLD_STAMP = _struct(processing_timestamp=_STAMP)

GOLD_SALES_SUMMARY = _evolve(_struct(
    order_year=_INT, order_month=_INT, status=_STRING, total_orders=_LONG, unique_customers=_LONG,
    total_revenue=_REVENUE, total_quantity=_LONG, avg_order_value=_MEAN, max_order_value=MONEY,
    min_order_value=MONEY,
), _GOLD_STAMP)
GOLD_CUSTOMER_METRICS = _evolve(_struct(
    customer_id=_STRING, name=_STRING, email=_STRING, city=_STRING, state=_STRING, total_orders=_LONG,
    total_spent=_REVENUE, avg_order_value=_MEAN, last_order_date=_STAMP, first_order_date=_STAMP,
), _GOLD_STAMP)
GOLD_PRODUCT_PERFORMANCE = _evolve(_struct(
    product_id=_STRING, product_name=_STRING, category=_STRING, price=MONEY, stock_quantity=_INT,
    total_orders=_LONG, total_quantity_sold=_LONG, total_revenue=_REVENUE, avg_sale_value=_MEAN,
), _GOLD_STAMP)
GOLD_PAYMENT_ANALYSIS = _evolve(_struct(
    payment_method=_STRING, status=_STRING, total_transactions=_LONG, total_amount=_REVENUE,
    avg_transaction_value=_MEAN, avg_installments=_DOUBLE,
), _GOLD_STAMP)
