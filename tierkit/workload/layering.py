"""Raw, cleaned and named tables: every query here writes with Spark and reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.operators import union_tables
from tierkit.sources import (
    coerce_bronze,
    create_layers,
    external_table,
    materialize_view,
    promote_to_silver,
    read_seed,
    relations_by_prefix,
    replace_table_as,
    sample_table,
    union_tables_matching,
    write_layer,
)
from tierkit.sources.layers import bronze_path, scan_parquet
from tierkit.workload.registry import Tables, fresh_root, query


@query(
    "coerce_bronze",
    """
    SELECT o_orderkey, to_base64(encode(o_orderpriority)) AS priority_bytes,
           CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS price,
           CAST(NULL AS VARCHAR) AS nothing, '{"status":"' || o_orderstatus || '"}' AS detail, o_orderkey % 2 = 0 AS even
    FROM orders
    """,
)
def coerced_orders(t: Tables) -> DataFrame:
    raw = t["orders"].select(
        "o_orderkey",
        F.col("o_orderpriority").cast("binary").alias("priority_bytes"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.lit(None).alias("nothing"),
        F.struct(F.col("o_orderstatus").alias("status")).alias("detail"),
        (F.col("o_orderkey") % 2 == 0).alias("even"),
    )
    path = bronze_path(fresh_root(t)[0], "shop", "Sales", "Orders")
    write_layer(coerce_bronze(raw), path)
    return scan_parquet(t.spark, path)


@query(
    "promote_table",
    """
    SELECT o_orderstatus, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_totalprice > 1000 GROUP BY 1
    """,
)
def promoted_orders(t: Tables) -> DataFrame:
    root, tag = fresh_root(t)
    layers = create_layers(t.spark, root, tag)
    path = bronze_path(root, "shop", "Sales", "Orders")
    write_layer(coerce_bronze(t["orders"]), path)
    silver = promote_to_silver(
        t.spark, path, layers["silver"], "Sales", "Orders", clean=lambda df: df.filter("o_totalprice > 1000")
    )
    return silver.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "replace_table",
    "SELECT c_custkey, c_acctbal, upper(c_mktsegment) AS segment FROM customer WHERE c_acctbal >= 0",
)
def replaced_customers(t: Tables) -> DataFrame:
    """A table replaced by a query over its own previous version."""
    root, tag = fresh_root(t)
    table = f"{create_layers(t.spark, root, tag)['gold']}.customers"
    before = replace_table_as(t["customer"].select("c_custkey", "c_acctbal", "c_mktsegment"), table, where="c_acctbal >= 0")
    return replace_table_as(before.select("c_custkey", "c_acctbal", F.upper("c_mktsegment").alias("segment")), table)


@query(
    "external_table",
    "SELECT s_nationkey, count(*) AS n_suppliers, max(s_acctbal) AS richest FROM supplier GROUP BY 1",
)
def external_suppliers(t: Tables) -> DataFrame:
    root, tag = fresh_root(t)
    path = bronze_path(root, "shop", "Purchasing", "Supplier")
    write_layer(t["supplier"], path)
    bronze = create_layers(t.spark, root, tag)["bronze"]
    suppliers = external_table(t.spark, f"{bronze}.purchasing_supplier", path)
    return suppliers.groupBy("s_nationkey").agg(
        F.count("*").alias("n_suppliers"), F.max("s_acctbal").alias("richest")
    )


@query(
    "empty_table",
    """
    SELECT 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns, count(*) AS n_rows
    FROM orders WHERE o_totalprice < 0
    """,
)
def empty_orders(t: Tables) -> DataFrame:
    """A table without rows keeps its columns."""
    path = bronze_path(fresh_root(t)[0], "shop", "Sales", "Returns")
    write_layer(t["orders"].filter("o_totalprice < 0"), path)
    empty = scan_parquet(t.spark, path)
    return empty.agg(F.lit(",".join(empty.columns)).alias("columns"), F.count("*").alias("n_rows"))


@query(
    "seed_load",
    """
    SELECT c_custkey, nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, '') AS segment,
           CAST(c_acctbal AS DOUBLE) AS balance FROM customer
    """,
)
def seeded_customers(t: Tables) -> DataFrame:
    path = f"{fresh_root(t)[0]}/seeds/customers"
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    rows = t["customer"].select("c_custkey", segment.alias("segment"), F.col("c_acctbal").alias("balance"))
    rows.write.option("header", True).option("emptyValue", "").csv(path)
    return read_seed(t.spark, path, "c_custkey bigint, segment string, balance double")


@query(
    "materialize_view",
    "SELECT l_returnflag, count(*) AS n_lines FROM lineitem WHERE l_quantity > 25 GROUP BY 1",
)
def viewed_lines(t: Tables) -> DataFrame:
    view = materialize_view(t["lineitem"].filter("l_quantity > 25"), f"{fresh_root(t)[1]}lines")
    return view.groupBy("l_returnflag").agg(F.count("*").alias("n_lines"))


@query(
    "sample_rows",
    "SELECT least(count(*), 100) AS n_rows, 6 AS n_columns FROM orders",
)
def sampled_orders(t: Tables) -> DataFrame:
    sample = sample_table(t["orders"], 100)
    return sample.agg(F.count("*").alias("n_rows"), F.lit(len(sample.columns)).alias("n_columns"))


@query(
    "relations_union",
    """
    SELECT 'events_' || event_type AS source, event_id, user_id,
           CASE WHEN event_type = 'view' THEN value END AS value
    FROM events WHERE event_type <> 'error'
    """,
)
def matching_events(t: Tables) -> DataFrame:
    """One view per kind of event, found by name and united; only views carry a value column."""
    _, tag = fresh_root(t)
    for kind in ("click", "view", "signup", "purchase", "error"):
        rows = t["events"].filter(F.col("event_type") == kind)
        materialize_view(rows.select("event_id", "user_id", *(["value"] if kind == "view" else [])), f"{tag}events_{kind}")
    united = union_tables_matching(
        t.spark, "%", f"{tag.upper()}events%", exclude="%error", source_column="source"
    )
    return united.withColumn("source", F.replace("source", F.lit(tag)))


@query(
    "relations_prefix",
    """
    SELECT 'lines_' || lower(l_returnflag) AS source, count(*) AS n_lines, max(l_quantity) AS most FROM lineitem
    WHERE l_returnflag IN ('A', 'R') GROUP BY 1
    """,
)
def lines_by_prefix(t: Tables) -> DataFrame:
    """Views found by the beginning of their names, and united."""
    _, tag = fresh_root(t)
    for flag in ("A", "R", "N"):
        rows = t["lineitem"].filter(F.col("l_returnflag") == flag).select("l_quantity")
        materialize_view(rows, f"{tag}lines_{flag.lower()}")
    found = relations_by_prefix(t.spark, "%", f"{tag}lines_", exclude="%_n")
    united = union_tables({n.removeprefix(tag): t.spark.table(n) for n in found}, source_column="source")
    return united.groupBy("source").agg(F.count("*").alias("n_lines"), F.max("l_quantity").alias("most"))
