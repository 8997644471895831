"""Value profiles, scalar results and URL parts over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.functions import url_host, url_parameter, url_path
from tierkit.operators import (
    column_values,
    filtered_columns,
    normalize_columns,
    result_arrays,
    single_value,
)
from tierkit.workload.registry import Tables, query


@query(
    "column_values",
    "SELECT event_type, count(*) AS n_rows FROM events WHERE value > 50 GROUP BY 1",
)
def event_kinds(t: Tables) -> DataFrame:
    return column_values(t["events"], "event_type", where="value > 50")


@query(
    "column_values_top",
    """
    SELECT p_brand, n_rows FROM (SELECT p_brand, count(*) AS n_rows FROM part GROUP BY 1)
    ORDER BY n_rows DESC, p_brand LIMIT 5
    """,
)
def top_brands(t: Tables) -> DataFrame:
    return column_values(t["part"], "p_brand", max_records=5)


@query(
    "filtered_columns",
    """
    SELECT max(l_orderkey) AS l_orderkey, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey,
           max(l_linenumber) AS l_linenumber, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice,
           max(l_discount) AS l_discount, max(l_tax) AS l_tax FROM lineitem
    """,
)
def highest_values(t: Tables) -> DataFrame:
    lines = t["lineitem"]
    kept = filtered_columns(lines, exclude=["L_ReturnFlag", "l_linestatus", "l_shipdate"])
    return lines.agg(*[F.max(c).alias(c) for c in kept])


@query(
    "single_value",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
    """,
)
def above_average(t: Tables) -> DataFrame:
    orders = t["orders"]
    average = single_value(orders.agg(F.avg("o_totalprice")))
    return orders.filter(F.col("o_totalprice") > average).select("o_orderkey", "o_totalprice")


@query(
    "single_value_default",
    """
    SELECT event_type, count(*) AS n_rows, coalesce((SELECT max(l_quantity) FROM lineitem WHERE l_quantity < 0 LIMIT 1), -1)
           AS fallback FROM events GROUP BY 1
    """,
)
def default_value(t: Tables) -> DataFrame:
    none = t["lineitem"].filter("l_quantity < 0").groupBy("l_quantity").agg(F.lit(0).alias("x")).select("l_quantity")
    counts = t["events"].groupBy("event_type").agg(F.count("*").alias("n_rows"))
    return counts.withColumn("fallback", single_value(none, default=-1.0))


@query(
    "results_as_arrays",
    """
    SELECT string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS o_orderpriority,
           string_agg(n_orders, ',' ORDER BY o_orderpriority) AS n_orders
    FROM (SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1)
    """,
)
def priorities_as_arrays(t: Tables) -> DataFrame:
    counts = t["orders"].groupBy("o_orderpriority").agg(F.count("*").alias("n_orders"))
    arrays = result_arrays(counts, order_by=["o_orderpriority"], max_rows=1000)
    return arrays.select(*[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in arrays.columns])


URL_HOST_SQL = """split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''),
                 'https://', ''), '/', 1), '?', 1)"""


@query("url_host", f"SELECT {URL_HOST_SQL} AS host, count(*) AS n_pages FROM pages GROUP BY 1")
def pages_by_host(t: Tables) -> DataFrame:
    return t["pages"].groupBy(url_host("url").alias("host")).agg(F.count("*").alias("n_pages"))


@query(
    "url_path",
    """
    SELECT page_id, split_part(CASE WHEN position('/' IN bare) > 0 THEN substring(bare, position('/' IN bare) + 1)
                                    WHEN position('?' IN bare) > 0 THEN '' ELSE bare END, '?', 1) AS path
    FROM (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS bare FROM pages)
    """,
)
def page_paths(t: Tables) -> DataFrame:
    return t["pages"].select("page_id", url_path("url").alias("path"))


@query(
    "url_param",
    """
    SELECT nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref,
           nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source,
           count(*) AS n_pages, count(nullif(split_part(split_part(url, 'page=', 2), '&', 1), '')) AS n_numbered
    FROM pages GROUP BY 1, 2
    """,
)
def pages_by_parameter(t: Tables) -> DataFrame:
    parameters = [url_parameter("url", p).alias(p) for p in ("ref", "utm_source")]
    return (
        t["pages"]
        .groupBy(*parameters)
        .agg(F.count("*").alias("n_pages"), F.count(url_parameter("url", "page")).alias("n_numbered"))
    )


@query(
    "slug_columns",
    """
    SELECT o_orderpriority AS _1st_priority, count(*) AS total_orders_, max(o_totalprice) AS max_price_eur
    FROM orders GROUP BY 1
    """,
)
def slug_columns(t: Tables) -> DataFrame:
    report = t["orders"].groupBy(F.col("o_orderpriority").alias("1st Priority!")).agg(
        F.count("*").alias("Total  orders -"), F.max("o_totalprice").alias("Max-Price (EUR)")
    )
    return normalize_columns(report)
