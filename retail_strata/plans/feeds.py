"""Synthetic input of any size, computed by Spark.

A feed takes a frame with one ``id`` per row to make (``spark.range(n)``, or the
keys 0 .. n-1 of an existing table) and a reference day that all dates count
back from, so nothing depends on the clock.
"""

from pyspark.sql import DataFrame, SparkSession

from retail_strata.functions import named
from retail_strata.functions.draws import draw, pick, pick_row
from retail_strata.plans.tables import Layers
from retail_strata.sources.writers import write_csv, write_json_lines

# Catalogue and price ranges.
CATALOGUE = {
    "Eletrônicos": (["Smartphone", "Notebook", "Tablet"], 500, 5000),
    "Moda": (["Camiseta", "Calça", "Tênis"], 50, 500),
    "Casa": (["Sofá", "Mesa", "Cadeira"], 200, 3000),
}
STATES = ["SP", "RJ", "MG", "RS", "BA", "PR", "PE", "CE"]
DAY_SECONDS = 86400


def _one_of(values: list[str], position: str) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({listed}), int({position}) + 1)"


def _padded(number: str, width: int) -> str:
    return f"lpad(string({number}), {width}, '0')"


def _before(day: str, seconds: str) -> str:
    """Text of the instant ``seconds`` before midnight of ``day``, free of time zones."""
    return f"string(timestamp_ntz'{day} 00:00:00' - make_dt_interval(0, 0, 0, {seconds}))"


def _source(customer_row: str) -> str:
    """The row whose attributes this customer row has: its own, or for a repeat
    those of the row before, which may be a repeat itself."""
    return f"""CASE WHEN {customer_row} % 400 IN (18, 19) THEN {customer_row} - {customer_row} % 400 + 17
                    WHEN {customer_row} % 20 = 19 THEN {customer_row} - 1
                    ELSE {customer_row} END"""


def feed_customers(ids: DataFrame, day: str = "2024-07-01") -> DataFrame:
    """Customers, about one in twenty a repeat of the one before it, e-mail apart.

    Which rows repeat follows from the row number alone.
    """
    cpf = [_padded(pick("src", 6 + part, 1000), 3) for part in range(3)]
    created = pick("src", 3, 2 * 365 * DAY_SECONDS)
    return ids.selectExpr("id", f"{_source('id')} AS src").select(named(
        customer_id=f"concat('C', {_padded('src', 12)})",
        name="concat('Cliente ', src)",
        email="concat('cliente', id, '@example.com')",
        phone=f"concat('+55 (11) 9', {_padded(pick('src', 5, 100000000), 8)})",
        cpf=f"concat({cpf[0]}, '.', {cpf[1]}, '.', {cpf[2]}, '-', {_padded(pick('src', 9, 100), 2)})",
        birth_date=f"string(date_sub(date'{day}', int(({pick('src', 1, 63)} + 18) * 365 + {pick('src', 2, 365)})))",
        age=f"{pick('src', 1, 63)} + 18",
        gender=_one_of(["M", "F", "Other"], pick("src", 10, 3)),
        address=f"concat('Rua ', {pick('src', 11, 900)} + 1)",
        city=f"concat('Cidade ', {pick('src', 12, 300)} + 1)",
        state=_one_of(STATES, pick("src", 13, len(STATES))),
        zip_code=f"concat({_padded(pick('src', 14, 100000), 5)}, '-000')",
        created_at=_before(day, created),
        updated_at=_before(day, f"{draw('src', 4)} % ({created} + 1)"),
        is_active=f"{pick('src', 15, 4)} < 3",
    ))


def _price(row: str) -> str:
    """A price within the range of the row's category, drawn in whole cents."""
    cents = [
        f"{pick(row, 22, (high - low) * 100 + 1)} + {low * 100}" for _, low, high in CATALOGUE.values()
    ]
    return f"element_at(array({', '.join(cents)}), int({pick(row, 20, len(cents))}) + 1) / 100D"


def feed_products(ids: DataFrame, day: str = "2024-07-01") -> DataFrame:
    category = pick("id", 20, len(CATALOGUE))
    kinds = [_one_of(kinds, pick("id", 21, len(kinds))) for kinds, _, _ in CATALOGUE.values()]
    return ids.select(named(
        product_id=f"concat('P', {_padded('id', 12)})",
        product_name=f"concat(element_at(array({', '.join(kinds)}), int({category}) + 1), ' Empresa ', id)",
        category=_one_of(list(CATALOGUE), category),
        price=_price("id"),
        stock_quantity=f"int({pick('id', 23, 501)})",
        created_at=_before(day, pick("id", 24, 365 * DAY_SECONDS)),
    ))


def feed_sales(
    ids: DataFrame, customer_ids: DataFrame | None, product_ids: DataFrame | None,
    day: str = "2024-07-01",
) -> DataFrame:
    """Sales of existing customers and products.

    Takes the id frames of the two other feeds.  Their attributes follow from the
    row numbers, so a foreign key needs only the length of each feed and no join.
    """
    if customer_ids is None or product_ids is None:
        raise ValueError("sales need the customer and the product feed first")
    n_customers, n_products = customer_ids.count(), product_ids.count()
    if not n_customers or not n_products:
        raise ValueError("sales need at least one customer and one product")
    drawn = ids.select("id", *named(
        customer=pick_row("id", 30, n_customers),
        product=pick_row("id", 32, n_products),
        quantity=f"{pick('id', 34, 5)} + 1",
    ))
    return drawn.select(named(
        order_id=f"concat('O', {_padded('id', 14)})",
        customer_id=f"concat('C', {_padded(_source('customer'), 12)})",
        product_id=f"concat('P', {_padded('product', 12)})",
        quantity="quantity",
        total_amount=f"round(quantity * ({_price('product')}), 2)",
        status=_one_of(["completed", "pending", "cancelled"], pick("id", 35, 3)),
        order_date=_before(day, pick("id", 36, 183 * DAY_SECONDS)),
    ))


def write_feeds(
    spark: SparkSession, layers: Layers, customers: int = 1000, products: int = 500,
    orders: int = 5000, day: str = "2024-07-01",
) -> None:
    """Write the raw customers, products and sales; payments come from elsewhere."""
    customer_ids, product_ids = spark.range(customers), spark.range(products)
    sales = feed_sales(spark.range(orders), customer_ids, product_ids, day)
    write_json_lines(feed_customers(customer_ids, day), f"{layers.raw}/customers.json")
    write_csv(feed_products(product_ids, day), f"{layers.raw}/products.csv")
    write_json_lines(sales, f"{layers.raw}/sales.json")
