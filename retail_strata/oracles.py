"""The same results in plain SQL, worked out independently of the Spark code."""

# Raw views -----------------------------------------------------------------

_RAW = {
    "customers_raw": """
        select cast(c.c_custkey as varchar) as customer_id,
          '  ' || c.c_name || ' ' as name,
          case when c.v = 1 and c.c_custkey % 100 = 0 then 'broken'
               when c.c_custkey % 50 = 7 then 'no-at-sign'
               when c.c_custkey % 50 = 8 then null
               else ' User' || c.c_custkey || '.V' || c.v || '@Example.COM ' end as email,
          '+55 (11) 9' || lpad(cast(c.c_custkey as varchar), 8, '0') as phone,
          case when c.c_custkey % 40 = 3 then null
               else lpad(cast(c.c_custkey as varchar), 9, '0') || '-00' end as cpf,
          case when c.c_custkey % 60 = 5 then 'not a date' else '1990-01-15' end as birth_date,
          c.c_custkey % 63 + 18 as age,
          case c.c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'Other' end as gender,
          'Rua ' || c.c_custkey as address,
          n.n_name as city,
          ' s' || c.c_nationkey || ' ' as state,
          lpad(cast(c.c_custkey % 100000 as varchar), 5, '0') as zip_code,
          '2023-05-06 07:08:09' as created_at,
          '2024-01-0' || (1 + c.v) || ' 00:00:00' as updated_at,
          c.c_custkey % 4 <> 0 as is_active
        from (select *, 0 as v from customer
              union all
              select *, 1 as v from customer where c_custkey % 20 = 0) c
        join nation n on c.c_nationkey = n.n_nationkey""",
    "products_raw": """
        select cast(p_partkey as varchar) as product_id, ' ' || p_name || ' ' as product_name,
          p_type as category,
          case when p_partkey % 25 = 0 then cast(-1 as double) else p_retailprice end as price,
          case when p_partkey % 30 = 0 then null
               else cast(p_partkey % 11 as integer) - 1 end as stock_quantity,
          timestamp '2024-02-03 04:05:06' as created_at
        from part""",
    "sales_raw": """
        select l_orderkey || '-' || l_linenumber as order_id,
          cast(o_custkey as varchar) as customer_id, cast(l_partkey as varchar) as product_id,
          cast(l_quantity as bigint) as quantity,
          case when l_orderkey % 97 = 0 then cast(0 as double) else l_extendedprice end as total_amount,
          ' ' || o_orderstatus || ' ' as status,
          case when l_orderkey % 101 = 0 then 'not a date'
               else cast(o_orderdate as varchar) end as order_date
        from lineitem join orders on l_orderkey = o_orderkey""",
    "payments_raw": """
        select cast(o_orderkey as varchar) as payment_id,
          case when o_orderkey % 89 = 0 then null
               else cast(o_orderdate as varchar) end as payment_date,
          cast(o_orderdate as varchar) as created_at,
          case when o_orderkey % 83 = 0 then cast(-5 as double) else o_totalprice end as amount,
          ' ' || o_orderpriority as payment_method, o_orderstatus as status,
          cast(1 + o_orderkey % 12 as integer) as total_installments
        from orders""",
}

# Silver, money still decimal -------------------------------------------------

_SILVER = {
    "silver_customers": """
        select * exclude (place) from (
          select *, row_number() over (partition by customer_id
            order by updated_at desc nulls last, email desc nulls last) as place
          from (
            select * replace (trim(name) as name, lower(trim(email)) as email,
              regexp_replace(phone, '[^0-9]', '', 'g') as phone,
              regexp_replace(cpf, '[^0-9]', '', 'g') as cpf,
              upper(trim(state)) as state,
              try_cast(birth_date as date) as birth_date,
              try_cast(created_at as timestamp) as created_at,
              try_cast(updated_at as timestamp) as updated_at)
            from customers_raw))
        where place = 1 and email is not null and contains(email, '@') and cpf is not null""",
    "silver_products": """
        select *, stock_quantity > 0 as is_available from (
          select * replace (trim(product_name) as product_name, trim(category) as category,
            try_cast(price as decimal(10,2)) as price)
          from products_raw)
        where price > 0 and stock_quantity >= 0 and product_name is not null""",
    "silver_sales": """
        select *, cast(year(order_date) as integer) as order_year,
          cast(month(order_date) as integer) as order_month
        from (
          select * replace (try_cast(order_date as timestamp) as order_date,
            try_cast(total_amount as decimal(10,2)) as total_amount, lower(trim(status)) as status)
          from sales_raw)
        where total_amount > 0 and quantity > 0 and order_date is not null""",
    "silver_payments": """
        select * replace (try_cast(payment_date as timestamp) as payment_date,
          try_cast(created_at as timestamp) as created_at,
          try_cast(amount as decimal(10,2)) as amount,
          lower(trim(payment_method)) as payment_method, lower(trim(status)) as status)
        from payments_raw
        where try_cast(amount as decimal(10,2)) > 0 and try_cast(payment_date as timestamp) is not null""",
}

# Gold ------------------------------------------------------------------------


def _money_mean(x: str) -> str:
    """Average of decimal(10,2) to six decimals half up, then to cents half up,
    in whole numbers: averaging doubles goes wrong on exact ties."""
    millionths = f"((2 * cast(sum({x}) * 100 as hugeint) * 10000 + count({x})) // (2 * count({x})))"
    return f"cast(({millionths} + 5000) // 10000 as double) / 100"


def _int_mean(x: str) -> str:
    return f"cast((200 * cast(sum({x}) as hugeint) + count({x})) // (2 * count({x})) as double) / 100"


def _double(x: str) -> str:
    return f"cast({x} as double)"


_GOLD = {
    "gold_sales_summary": f"""
        select order_year, order_month, status, count(order_id) as total_orders,
          count(distinct customer_id) as unique_customers, {_double('sum(total_amount)')} as total_revenue,
          cast(sum(quantity) as bigint) as total_quantity,
          {_money_mean('total_amount')} as avg_order_value,
          {_double('max(total_amount)')} as max_order_value, {_double('min(total_amount)')} as min_order_value
        from silver_sales group by all order by order_year, order_month, status""",
    "gold_customer_metrics": f"""
        select c.customer_id, c.name, c.email, c.city, c.state, m.* exclude (customer_id)
        from silver_customers c left join (
          select customer_id, count(order_id) as total_orders,
            {_double('sum(total_amount)')} as total_spent,
            {_money_mean('total_amount')} as avg_order_value,
            max(order_date) as last_order_date, min(order_date) as first_order_date
          from silver_sales group by customer_id) m on c.customer_id = m.customer_id""",
    "gold_product_performance": f"""
        select p.product_id, p.product_name, p.category, {_double('p.price')} as price, p.stock_quantity,
          m.* exclude (product_id)
        from silver_products p left join (
          select product_id, count(order_id) as total_orders,
            cast(sum(quantity) as bigint) as total_quantity_sold,
            {_double('sum(total_amount)')} as total_revenue,
            {_money_mean('total_amount')} as avg_sale_value
          from silver_sales group by product_id) m on p.product_id = m.product_id
        order by total_revenue desc nulls last""",
    "gold_payment_analysis": f"""
        select payment_method, status, count(payment_id) as total_transactions,
          {_double('sum(amount)')} as total_amount,
          {_money_mean('amount')} as avg_transaction_value,
          {_int_mean('total_installments')} as avg_installments
        from silver_payments group by all order by payment_method, status""",
}

_LAYERS = {**_RAW, **_SILVER, **_GOLD}
_ENTITIES = ("customers", "products", "sales", "payments")


def _over(body: str) -> str:
    """A query over the raw, silver and gold tables as named subqueries."""
    tables = ",\n".join(f"{name} as ({sql})" for name, sql in _LAYERS.items())
    return f"with {tables}\n{body}"


def _counts(tables) -> str:
    return " union all ".join(
        f"select '{label}' as table_name, count(*) as row_count from {table}" for label, table in tables
    )


_BRONZE_COUNTS = [(f"bronze_{e}", f"{e}_raw") for e in _ENTITIES]
_SILVER_COUNTS = [(f"silver_{e}", f"silver_{e}") for e in _ENTITIES]
_GOLD_COUNTS = [(g, g) for g in _GOLD]


def _labelled(column: str, label: str, body: str) -> str:
    return f"select '{label}' as {column}, * from ({body})"


# Money as double, days as their midnight.
_PLAIN = {
    "customers": "cast(birth_date as timestamp) as birth_date",
    "products": f"{_double('price')} as price",
    "sales": f"{_double('total_amount')} as total_amount",
    "payments": f"{_double('amount')} as amount",
}


def _silver(entity: str) -> str:
    return f"select * replace ({_PLAIN[entity]}) from silver_{entity}"


def _bronze(entity: str, raw_format: str, run_id: str = "run-1") -> str:
    return (
        f"select *, '{run_id}' as ingestion_id, '{entity}.{raw_format}' as source_file from {entity}_raw"
    )


def _silver_runs(entity: str, raw_format: str, turns) -> str:
    return " union all ".join(
        f"select *, 'ingest-{turn}' as ingestion_id, '{entity}.{raw_format}' as source_file, "
        f"'refine-{turn}' as processing_id from ({_silver(entity)})"
        for turn in turns
    )


def _two_silver_runs(entity: str, raw_format: str) -> str:
    return _silver_runs(entity, raw_format, (1, 2))


# Rejects: what each row of an entity fails, in the order of its checks.
_FAILS = {
    "customers": """
        select * exclude (place), concat_ws(',', case when place > 1 then 'older_version' end,
          case when not coalesce(contains(email, '@'), false) then 'email' end,
          case when cpf is null then 'cpf' end) as reject_reasons
        from (
          select *, row_number() over (partition by customer_id
            order by updated_at desc nulls last, email desc nulls last) as place
          from (
            select * replace (trim(name) as name, lower(trim(email)) as email,
              regexp_replace(phone, '[^0-9]', '', 'g') as phone,
              regexp_replace(cpf, '[^0-9]', '', 'g') as cpf, upper(trim(state)) as state,
              cast(try_cast(birth_date as date) as timestamp) as birth_date,
              try_cast(created_at as timestamp) as created_at, try_cast(updated_at as timestamp) as updated_at)
            from customers_raw))""",
    "products": """
        select * replace (cast(price as double) as price),
          case when stock_quantity > 0 then true else false end as is_available,
          concat_ws(',', case when not coalesce(price > 0, false) then 'price' end,
            case when not coalesce(stock_quantity >= 0, false) then 'stock_quantity' end,
            case when product_name is null then 'product_name' end) as reject_reasons
        from (
          select * replace (trim(product_name) as product_name, trim(category) as category,
            try_cast(price as decimal(10,2)) as price)
          from products_raw)""",
    "sales": """
        select * replace (cast(total_amount as double) as total_amount),
          cast(year(order_date) as integer) as order_year, cast(month(order_date) as integer) as order_month,
          concat_ws(',', case when not coalesce(total_amount > 0, false) then 'total_amount' end,
            case when not coalesce(quantity > 0, false) then 'quantity' end,
            case when order_date is null then 'order_date' end) as reject_reasons
        from (
          select * replace (try_cast(order_date as timestamp) as order_date,
            try_cast(total_amount as decimal(10,2)) as total_amount, lower(trim(status)) as status)
          from sales_raw)""",
    "payments": """
        select * replace (cast(amount as double) as amount),
          concat_ws(',', case when not coalesce(amount > 0, false) then 'amount' end,
            case when payment_date is null then 'payment_date' end) as reject_reasons
        from (
          select * replace (try_cast(payment_date as timestamp) as payment_date,
            try_cast(created_at as timestamp) as created_at, try_cast(amount as decimal(10,2)) as amount,
            lower(trim(payment_method)) as payment_method, lower(trim(status)) as status)
          from payments_raw)""",
}
_FORMATS = {"customers": "json", "products": "csv", "sales": "json", "payments": "parquet"}


def _rejects(entity: str) -> str:
    return (
        f"select *, 'ingest-1' as ingestion_id, '{entity}.{_FORMATS[entity]}' as source_file, "
        f"'refine-1' as processing_id from ({_FAILS[entity]}) where reject_reasons <> ''"
    )


def _buyers(level: str, period: str) -> str:
    return (
        f"select '{level}' as level, order_year, cast({period} as integer) as period, "
        "count(distinct customer_id) as customers from silver_sales group by all"
    )


# Feeds -----------------------------------------------------------------------


def _draw(row: str, stream: int) -> str:
    spread = f"((({row}) + 1) % 2147483647 * 48271 + {stream * 7919}) % 2147483647"
    return f"(({spread}) * (({spread}) % 65521 + {stream + 1}) % 2147483647)"


def _pick(row: str, stream: int, size) -> str:
    return f"({_draw(row, stream)} % {size})"


def _pick_row(row: str, stream: int, size: str) -> str:
    return f"(({_draw(row, stream)} * 2147483647 + {_draw(row, stream + 1)}) % {size})"


def _padded(number: str, width: int) -> str:
    return f"lpad(cast({number} as varchar), {width}, '0')"


def _before(seconds: str) -> str:
    return f"strftime(timestamp '2024-07-01 00:00:00' - to_seconds({seconds}), '%Y-%m-%d %H:%M:%S')"


def _source(row: str) -> str:
    return (
        f"case when {row} % 400 in (18, 19) then {row} - {row} % 400 + 17 "
        f"when {row} % 20 = 19 then {row} - 1 else {row} end"
    )


_YEAR = 365 * 86400
_STATES = ["SP", "RJ", "MG", "RS", "BA", "PR", "PE", "CE"]

_FEED_CUSTOMERS = f"""
    select 'C' || {_padded('src', 12)} as customer_id, 'Cliente ' || src as name,
      'cliente' || id || '@example.com' as email,
      '+55 (11) 9' || {_padded(_pick('src', 5, 100000000), 8)} as phone,
      {_padded(_pick('src', 6, 1000), 3)} || '.' || {_padded(_pick('src', 7, 1000), 3)} || '.'
        || {_padded(_pick('src', 8, 1000), 3)} || '-' || {_padded(_pick('src', 9, 100), 2)} as cpf,
      strftime(date '2024-07-01' - cast({_pick('src', 1, 63)} * 365 + 6570 + {_pick('src', 2, 365)} as integer),
        '%Y-%m-%d') as birth_date,
      {_pick('src', 1, 63)} + 18 as age,
      (['M', 'F', 'Other'])[{_pick('src', 10, 3)} + 1] as gender,
      'Rua ' || ({_pick('src', 11, 900)} + 1) as address,
      'Cidade ' || ({_pick('src', 12, 300)} + 1) as city,
      ({_STATES})[{_pick('src', 13, 8)} + 1] as state,
      {_padded(_pick('src', 14, 100000), 5)} || '-000' as zip_code,
      {_before(_pick('src', 3, 2 * _YEAR))} as created_at,
      {_before(f"({_draw('src', 4)} % ({_pick('src', 3, 2 * _YEAR)} + 1))")} as updated_at,
      {_pick('src', 15, 4)} < 3 as is_active
    from (select c_custkey as id, {_source('c_custkey')} as src from customer)"""


def _cents(row: str) -> str:
    return (
        f"case {_pick(row, 20, 3)} when 0 then 50000 + {_pick(row, 22, 450001)} "
        f"when 1 then 5000 + {_pick(row, 22, 45001)} else 20000 + {_pick(row, 22, 280001)} end"
    )


_FEED_PRODUCTS = f"""
    select 'P' || {_padded('id', 12)} as product_id,
      (case cat when 0 then ['Smartphone', 'Notebook', 'Tablet']
        when 1 then ['Camiseta', 'Calça', 'Tênis'] else ['Sofá', 'Mesa', 'Cadeira'] end)
        [{_pick('id', 21, 3)} + 1] || ' Empresa ' || id as product_name,
      (['Eletrônicos', 'Moda', 'Casa'])[cat + 1] as category,
      cast({_cents('id')} as double) / 100 as price,
      cast({_pick('id', 23, 501)} as integer) as stock_quantity,
      {_before(_pick('id', 24, _YEAR))} as created_at
    from (select p_partkey as id, {_pick('p_partkey', 20, 3)} as cat from part)"""

_FEED_SALES = f"""
    select 'O' || {_padded('id', 14)} as order_id,
      'C' || {_padded(_source('customer'), 12)} as customer_id,
      'P' || {_padded('product', 12)} as product_id,
      quantity, cast(quantity * ({_cents('product')}) as double) / 100 as total_amount,
      (['completed', 'pending', 'cancelled'])[{_pick('id', 35, 3)} + 1] as status,
      {_before(_pick('id', 36, 183 * 86400))} as order_date
    from (
      select o_orderkey as id, {_pick('o_orderkey', 34, 5)} + 1 as quantity,
        {_pick_row('o_orderkey', 30, '(select count(*) from customer)')} as customer,
        {_pick_row('o_orderkey', 32, '(select count(*) from part)')} as product
      from orders)"""

# ------------------------------------------------------------------------------


def _stage_counters() -> str:
    parts = [
        (table, counter, source)
        for stage, counters in (
            (_BRONZE_COUNTS, {"written": 1}), (_GOLD_COUNTS, {"written": 1}),
        )
        for table, source in stage
        for counter in counters
    ]
    for entity in _ENTITIES:
        parts += [(f"silver_{entity}", "read", f"{entity}_raw"), (f"silver_{entity}", "written", f"silver_{entity}")]
    return " union all ".join(
        f"select '{table}' as table_name, '{counter}' as counter, count(*) as row_count from {source}"
        for table, counter, source in parts
    )


ORACLES: dict[str, str] = {
    "ingest_json": _over(_bronze("customers", "json")),
    "ingest_json_sales": _over(_bronze("sales", "json")),
    "ingest_csv": _over(_bronze("products", "csv")),
    "ingest_parquet": _over(_bronze("payments", "parquet")),
    "ingest_parquet_native": _over(_two_silver_runs("payments", "parquet")),
    "ingest_dirty": """
        select case when kind = 1 then null else id end as order_id,
          case when kind in (1, 2) then null else cast(3 as bigint) end as quantity,
          case kind when 1 then '{"order_id":"' || id || '", oops'
            when 2 then '{"order_id":"' || id || '","quantity":"two"}'
            when 3 then '{"order_id":"' || id || '","quantity":3,"coupon":"x"}' end as raw_record
        from (select cast(o_orderkey as varchar) as id, o_orderkey % 10 as kind from orders)""",
    "ingest_json_arrays": _over(_bronze("sales", "json")),
    "ingest_parquet_mixed": _over(_silver_runs("payments", "parquet", (1,))),
    "replay_unheld": _over(f"""
        select * exclude (broken) replace (case when broken then 'refine-after-1' else 'refine-1' end as processing_id),
          case when broken then 'replay-1' else 'ingest-1' end as ingestion_id,
          case when broken then 'replay' else 'sales.json' end as source_file
        from (select *, '' as processing_id, quantity % 4 = 0 as broken
          from ({_silver("sales")}))"""),
    "partition_roundtrip": _over(_silver("sales")),
    "append_history": _over(
        " union all ".join(_bronze("payments", "parquet", f"run-{n}") for n in (1, 2))
    ),
    "overwrite_partitioned": "select * from customer",
    "filter_project": "select c_custkey, c_name, c_acctbal from customer where c_acctbal > 5000",
    "lineage_stamp": """
        select *, timestamp '2024-05-06 07:08:09' as ingestion_timestamp,
          'run-1' as ingestion_id, 'orders.parquet' as source_file, timestamp '2024-05-06 00:00:00' as ingestion_date
        from orders""",
    "high_water_mark": "select max(ts) as mark from events",
    "incremental_filter": "select * from events where ts > timestamp '2024-01-20 00:00:00'",
    "incremental_runs": _over(_two_silver_runs("payments", "parquet")),
    "incremental_late_versions": _over(
        "select *, 'ingest-1' as ingestion_id, 'customers.json' as source_file, "
        f"'refine-1' as processing_id from ({_silver('customers')})"
    ),
    "run_log_resume": _over(_two_silver_runs("payments", "parquet")),
    "incremental_overlapping_runs": _over(_silver_runs("payments", "parquet", (1, 2, 3))),
    "dedup_latest": """
        select * exclude (place) from (
          select *, row_number() over (partition by user_id order by ts desc, event_id desc) as place
          from events)
        where place = 1""",
    **{f"silver_{e}": _over(_silver(e)) for e in _ENTITIES},
    **{g: _over(f"select * from {g}") for g in _GOLD},
    "gold_product_performance_skewed": _over(_GOLD["gold_product_performance"].replace("from silver_sales", """
          from (select * replace (case quantity % 3 when 0 then '7' when 1 then null else product_id end
              as product_id) from silver_sales)""")),
    **{f"job_{g}": _over(f"select * from {g}") for g in _GOLD},
    **{g.replace("gold_", "gold_incremental_", 1): _over(f"select * from {g}") for g in _GOLD},
    "job_retry": _over("select * from gold_sales_summary"),
    "gold_customer_metrics_two_runs": _over(
        "select * from gold_customer_metrics union all select * from gold_customer_metrics"
    ),
    "gold_customer_metrics_newest": _over("select * from gold_customer_metrics"),
    "compact_bronze": _over(" union all ".join(_bronze("payments", "parquet", f"ingest-{n}") for n in range(5))),
    "gold_customer_metrics_bucketed": _over("select * from gold_customer_metrics"),
    # Over batches, an older valid version comes in where a newer one was rejected.
    "customers_current": _over(f"""
        select * exclude (reject_reasons, place), 'customers.json' as source_file from (
          select *, row_number() over (partition by customer_id order by updated_at desc nulls last) as place
          from ({_FAILS['customers']}) where reject_reasons in ('', 'older_version'))
        where place = 1"""),
    "distinct_customers_rollup": _over(" union all ".join([
        _buyers("month", "order_month"), _buyers("quarter", "(order_month + 2) // 3"), _buyers("year", "1"),
    ])),
    **{f"silver_rejects_{e}": _over(_rejects(e)) for e in _ENTITIES},
    "stream_silver_customers": _over(
        "select * exclude (processing_id) from (" + _two_silver_runs("customers", "json") + ")"
    ),
    "stream_silver_products": _over(_two_silver_runs("products", "csv")),
    "stream_silver_sales": _over(_two_silver_runs("sales", "json")),
    "stream_silver_payments": _over(_two_silver_runs("payments", "parquet")),
    "job_bronze_counts": _over(_counts(_BRONZE_COUNTS)),
    "job_silver_counts": _over(_counts(_SILVER_COUNTS)),
    "job_gold_counts": _over(_counts(_GOLD_COUNTS)),
    "layer_row_counts": _over(" union all ".join(
        _labelled("layer", layer, _counts(tables))
        for layer, tables in (("bronze", _BRONZE_COUNTS), ("silver", _SILVER_COUNTS), ("gold", _GOLD_COUNTS))
    )),
    "ingestion_report": _over(" union all ".join(
        f"select '{label}' as table_name, 2 * count(*) as row_count, cast(2 as bigint) as ingestions from {table}"
        for label, table in _BRONZE_COUNTS
    )),
    "stage_counters": _over(_stage_counters()),
    "feed_customers": _FEED_CUSTOMERS,
    "feed_products": _FEED_PRODUCTS,
    "feed_sales": _FEED_SALES,
}
