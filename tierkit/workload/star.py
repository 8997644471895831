"""Star-schema models and the suite that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.checks import run_checks
from tierkit.functions import surrogate_key
from tierkit.plans import build_models, retail_star, run_daily
from tierkit.sources import bronze_path, coerce_bronze, create_layers, write_layer
from tierkit.workload.registry import Tables, dates_as_text, fresh_root, key_sql, query

STATUS_CASE = (
    "CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Finished' WHEN 'P' THEN 'Pending' ELSE 'Unknown' END"
)

query(
    "fact_sales",
    f"""
    SELECT {key_sql('l_orderkey', 'l_linenumber')} AS sales_id_wid,
           {key_sql('l_partkey')} AS product_id_wid,
           {key_sql('o_custkey')} AS customer_id_wid,
           {key_sql('l_suppkey')} AS supplier_id_wid,
           {key_sql('o_orderstatus')} AS order_status_id_wid,
           {key_sql('CAST(o_orderdate AS DATE)')} AS order_date_id_wid,
           l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS productid,
           o_custkey AS customerid, o_orderstatus AS order_status, strftime(o_orderdate, '%Y-%m-%d') AS orderdate,
           l_extendedprice AS unitprice, l_quantity AS orderqty,
           l_extendedprice * l_quantity AS revenue, o_totalprice AS totaldue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)(lambda t: dates_as_text(retail_star.fact_sales(t)))

CUSTOMER_SQL = f"""
    SELECT {key_sql('c_custkey')} AS customer_id_wid, c_custkey AS integration_id,
           trim(regexp_replace(concat_ws(' ', split_part(c_name, '#', 1),
                CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE '' END, split_part(c_name, '#', 2)),
                '\\s+', ' ', 'g')) AS fullname,
           n_name AS nation_name, r_name AS region_name
    FROM customer LEFT JOIN nation ON
        try_cast(CASE WHEN c_acctbal < 0 THEN 'none' ELSE CAST(c_nationkey AS VARCHAR) END AS BIGINT) = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
"""

query("dim_customer", CUSTOMER_SQL)(retail_star.dim_customer)

query(
    "dim_product",
    f"""
    WITH subcategory AS (
        SELECT CAST(substr(p_brand, 7, 2) AS BIGINT) AS subcategory_id, min(p_brand) AS product_subcategory_name,
               min(split_part(p_type, ' ', 1)) AS parent_category FROM part GROUP BY 1
    ), category AS (SELECT DISTINCT split_part(p_type, ' ', 1) AS category_id FROM part)
    SELECT {key_sql('p_partkey')} AS product_id_wid, p_partkey AS integration_id, p_name AS product_name,
           p_brand AS brand, p_type AS product_type, p_size AS size, p_retailprice AS listprice,
           subcategory_id, product_subcategory_name, upper(category_id) AS product_category_name
    FROM (SELECT *, CAST(CASE WHEN p_size < 45 THEN CAST(substr(p_brand, 7, 2) AS DOUBLE) END AS BIGINT) AS subcategory_id
          FROM part) LEFT JOIN subcategory USING (subcategory_id) LEFT JOIN category ON parent_category = category_id
    """,
)(retail_star.dim_product)

query(
    "dim_address",
    f"""
    SELECT {key_sql('s_suppkey')} AS address_id_wid, s_suppkey AS integration_id, s_name AS addressline1,
           n_name AS nation_name, r_name AS region_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)(retail_star.dim_address)

query(
    "dim_used_key",
    f"""
    SELECT {key_sql('o_custkey')} AS customer_id_wid, o_custkey AS integration_id, c_mktsegment AS segment
    FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
    LEFT JOIN customer ON o_custkey = c_custkey
    """,
)(retail_star.dim_used_customer)

query(
    "dim_order_status",
    f"""
    SELECT {key_sql('o_orderstatus')} AS order_status_id_wid, o_orderstatus AS integration_id,
           {STATUS_CASE} AS order_status_name
    FROM (SELECT DISTINCT o_orderstatus FROM orders)
    """,
)(retail_star.dim_order_status)

query(
    "revenue_by_status",
    f"""
    SELECT {STATUS_CASE} AS order_status_name, round(sum(l_extendedprice * l_quantity), 2) AS revenue,
           count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """,
)(retail_star.revenue_by_status)

query(
    "order_totals",
    """
    SELECT strftime(o_orderdate, '%Y-%m-01') AS order_month,
           round(sum(o_totalprice), 2) AS totaldue, count(*) AS n_orders
    FROM orders GROUP BY 1
    """,
)(lambda t: dates_as_text(retail_star.order_totals(t)))


query(
    "dim_date",
    f"""
    SELECT {key_sql('date_day')} AS date_id_wid, date_day AS integration_id
    FROM (SELECT CAST(unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)
                 AS date_day FROM orders)
    """,
)(retail_star.dim_date)


@query(
    "surrogate_key_multi",
    f"""
    SELECT event_id,
           {key_sql('event_id', "nullif(event_type, 'error')", 'nullif(user_id % 7, 0)')} AS marked_key,
           md5(concat_ws('-', CAST(event_id AS VARCHAR), coalesce(nullif(event_type, 'error'), ''))) AS empty_key
    FROM events
    """,
)
def surrogate_key_multi(t: Tables) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return t["events"].select(
        "event_id",
        surrogate_key("event_id", kind, F.nullif(F.col("user_id") % 7, F.lit(0))).alias("marked_key"),
        surrogate_key("event_id", kind, nulls_as_empty=True).alias("empty_key"),
    )


UNKNOWN = key_sql("NULL")


def _dimension_rows(table: str, key: str, label: str | None, rows: str) -> str:
    """SQL of the key and label checks of one dimension."""
    one = "SELECT '{t}.{rule}_{c}' AS \"check\", CAST(({sql}) AS BIGINT) AS failures"
    parts = []
    for c in filter(None, (key, "integration_id", label)):
        known = f" AND {key} <> {UNKNOWN}" if table in retail_star.WITH_UNKNOWN and c != key else ""
        null_sql = f"SELECT count(*) FROM ({rows}) WHERE {c} IS NULL{known}"
        parts.append(one.format(t=table, rule="not_null", c=c, sql=null_sql))
        if c != label:
            dup_sql = f"SELECT count(*) FROM (SELECT {c} FROM ({rows}) WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
            parts.append(one.format(t=table, rule="unique", c=c, sql=dup_sql))
    return "\n    UNION ALL ".join(parts)


def _or_unknown(rows: str, columns: int) -> str:
    return f"{rows} UNION ALL SELECT {UNKNOWN}{', NULL' * (columns - 1)}"


DAYS = "SELECT CAST(unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders"
DIMENSION_ROWS = {
    "dim_product": _or_unknown(
        f"SELECT {key_sql('p_partkey')} AS product_id_wid, p_partkey AS integration_id, p_name AS product_name FROM part", 3
    ),
    "dim_address": _or_unknown(
        f"SELECT {key_sql('s_suppkey')} AS address_id_wid, s_suppkey AS integration_id, s_name AS addressline1 FROM supplier",
        3,
    ),
    "dim_customer": _or_unknown(f"SELECT customer_id_wid, integration_id, fullname FROM ({CUSTOMER_SQL})", 3),
    "dim_used_customer": f"SELECT {key_sql('o_custkey')} AS customer_id_wid, o_custkey AS integration_id, "
    "c_mktsegment AS segment FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL) "
    "LEFT JOIN customer ON o_custkey = c_custkey",
    "dim_order_status": f"SELECT {key_sql('o_orderstatus')} AS order_status_id_wid, o_orderstatus AS integration_id, "
    f"{STATUS_CASE} AS order_status_name FROM (SELECT DISTINCT o_orderstatus FROM orders)",
    "dim_date": _or_unknown(f"SELECT {key_sql('d')} AS date_id_wid, d AS integration_id FROM ({DAYS})", 2),
}


def _orphans(name: str, key: str, table: str, parent: str) -> str:
    """SQL of one relationship of the fact: lines whose key the dimension lacks."""
    return (
        f"UNION ALL SELECT 'fact_sales.relationships_{name}_{parent}', count(*) FROM fact "
        f"WHERE {key_sql(key)} NOT IN (SELECT {parent} FROM ({DIMENSION_ROWS[table]}))"
    )


FACT_COUNTS = f"""
    SELECT 'fact_sales.unique_combination_orderkey_linenumber', count(*) FROM
        (SELECT l_orderkey, l_linenumber FROM fact GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'fact_sales.unique_sales_id_wid', count(*) FROM
        (SELECT {key_sql('l_orderkey', 'l_linenumber')} AS k FROM fact GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'fact_sales.not_null_orderkey', count(*) FROM fact WHERE l_orderkey IS NULL
    UNION ALL SELECT 'fact_sales.not_null_sales_id_wid', count(*) FROM fact
        WHERE {key_sql('l_orderkey', 'l_linenumber')} IS NULL
    UNION ALL SELECT 'fact_sales.not_null_customer_id_wid', count(*) FROM fact WHERE {key_sql('o_custkey')} IS NULL
    UNION ALL SELECT 'fact_sales.not_null_order_date_id_wid', count(*) FROM fact
        WHERE {key_sql('CAST(o_orderdate AS DATE)')} IS NULL
    {_orphans('customer_id_wid', 'o_custkey', 'dim_customer', 'customer_id_wid')}
    {_orphans('product_id_wid', 'l_partkey', 'dim_product', 'product_id_wid')}
    {_orphans('supplier_id_wid', 'l_suppkey', 'dim_address', 'address_id_wid')}
    {_orphans('order_date_id_wid', 'CAST(o_orderdate AS DATE)', 'dim_date', 'date_id_wid')}
    {_orphans('order_status_id_wid', 'o_orderstatus', 'dim_order_status', 'order_status_id_wid')}
    UNION ALL SELECT 'fact_sales.sold_something', count(*) FROM fact WHERE NOT (l_extendedprice * l_quantity > 0 AND l_quantity > 0)
    UNION ALL SELECT 'fact_sales.totaldue_not_negative', count(*) FROM fact WHERE o_totalprice < 0
    UNION ALL SELECT 'fact_sales.columns_match_set', 0
"""


def _suite_sql(warned: str) -> str:
    """SQL of the metrics of the whole star; checks whose name matches ``warned`` only warn."""
    dims = [_dimension_rows(d, *retail_star.KEY_AND_LABEL[d], DIMENSION_ROWS[d]) for d in DIMENSION_ROWS]
    labels = f"""SELECT 'accepted_values_order_status_name', count(*) FROM
        (SELECT DISTINCT {STATUS_CASE} AS label FROM orders) WHERE label NOT IN ('Open', 'Finished')"""
    counts = "\n    UNION ALL ".join([*dims, labels, FACT_COUNTS])
    return f"""
    WITH fact AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey), counted AS ({counts})
    SELECT "check", CAST(failures AS BIGINT) AS failures,
           CASE WHEN failures = 0 THEN 'pass' WHEN regexp_matches("check", '{warned}') THEN 'warn' ELSE 'error' END AS status
    FROM counted
    """


@query("star_suite", _suite_sql("^accepted_values"))
def star_suite(t: Tables) -> DataFrame:
    """The star written as gold tables, then all its checks in one job over those."""
    root, tag = fresh_root(t)
    gold = build_models(t, retail_star.MODELS, create_layers(t.spark, root, tag)["gold"])
    return run_checks(retail_star.star_checks(gold)).select("check", "failures", "status")


#: The tables of the shop by the schema they are landed under.
SHOP = {
    "Sales": ("Customer", "Orders", "Lineitem"),
    "Production": ("Part",),
    "Purchasing": ("Supplier",),
    "Person": ("Nation", "Region"),
}


@query("daily_build", _suite_sql("^accepted_values|^fact_sales.unique"))
def daily_build(t: Tables) -> DataFrame:
    """Raw files to silver to every model to every check and the gate; one row per check.

    The order lines repeat keys, so the two rules on the grain of the fact warn here.
    """
    root, tag = fresh_root(t)
    tables = [(schema, table) for schema, names in SHOP.items() for table in names]
    for schema, table in tables:
        write_layer(coerce_bronze(t[table.lower()]), bronze_path(root, "shop", schema, table))

    def over_silver(model):
        return lambda silver: model({b.lower(): silver[f"silver_{a}_{b}".lower()] for a, b in tables})

    models = {name: over_silver(model) for name, model in retail_star.MODELS.items()}
    checks = lambda gold: retail_star.star_checks(gold, grain="warn")
    results = run_daily(t.spark, root, "shop", tables, models, checks, prefix=tag)
    return t.spark.createDataFrame(results).select("check", "failures", "status")


@query(
    "typed_orders",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, date_trunc('month', o_orderdate) AS order_month,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS price
    FROM orders
    """,
)
def typed_orders(t: Tables) -> DataFrame:
    """Orders with a DATE, a TIMESTAMP and a DECIMAL column, compared as they are."""
    return t["orders"].select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("order_month"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
