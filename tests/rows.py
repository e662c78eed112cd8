"""Small hand-made inputs."""

from retail_strata import schemas


def frame(spark, schema, rows, **defaults):
    """A frame with the declared schema; columns a row does not name take the default."""
    names = schema.fieldNames()
    return spark.createDataFrame([tuple({**defaults, **row}.get(n) for n in names) for row in rows], schema)


def customers(spark, *rows, schema=schemas.RAW_CUSTOMERS):
    return frame(
        spark, schema, rows, customer_id="c1", name="Ana", email="ana@example.com", cpf="123.456.789-00",
        phone="(11) 9-1", state="sp", birth_date="1990-01-15", created_at="2024-01-01 00:00:00",
        updated_at="2024-01-02 00:00:00",
    )


def products(spark, *rows):
    return frame(
        spark, schemas.RAW_PRODUCTS, rows, product_id="p1", product_name="Mesa", category="Casa",
        price=10.0, stock_quantity=5,
    )


def sales(spark, *rows):
    return frame(
        spark, schemas.RAW_SALES, rows, order_id="o1", customer_id="c1", product_id="p1", quantity=1,
        total_amount=10.0, status="completed", order_date="2024-03-04 05:06:07",
    )


def payments(spark, *rows):
    return frame(
        spark, schemas.RAW_PAYMENTS, rows, payment_id="x1", payment_date="2024-03-04 05:06:07",
        created_at="2024-03-04 05:06:07", amount=10.0, payment_method="pix", status="paid",
        total_installments=1,
    )
