"""The same star shapes over the retail tables (customer, orders, lineitem, part, ...)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.checks import (
    Check,
    accepted_values,
    columns_match_set,
    expression_is_true,
    not_null,
    relationships,
    unique,
    unique_combination,
)
from tierkit.checks.core import row_check
from tierkit.functions import squeeze_spaces, surrogate_key
from tierkit.functions.keys import NULL_MARK
from tierkit.operators import date_bounds, date_spine
from tierkit.plans.sales_star import labelled, with_unknown_member

Tables = Mapping[str, DataFrame]

ORDER_STATUS = {"O": "Open", "F": "Finished", "P": "Pending"}

FACT_COLUMNS = [
    *("sales_id_wid", "product_id_wid", "customer_id_wid", "supplier_id_wid", "order_status_id_wid"),
    *("order_date_id_wid", "orderkey", "linenumber", "productid", "customerid", "order_status", "orderdate"),
    *("unitprice", "orderqty", "revenue", "totaldue"),
]


def _places(t: Tables) -> DataFrame:
    region = t["region"].select("r_regionkey", F.col("r_name").alias("region_name"))
    nation = t["nation"].join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return nation.select("n_nationkey", F.col("n_name").alias("nation_name"), "region_name")


def dim_customer(t: Tables) -> DataFrame:
    """Customers by name and place. A name has three parts, of which the middle one may be missing;
    the id of the nation comes as text, and text that is no number finds no nation."""
    first, last = F.split_part("c_name", F.lit("#"), F.lit(1)), F.split_part("c_name", F.lit("#"), F.lit(2))
    middle = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    parts = [F.coalesce(p, F.lit("")) for p in (first, middle, last)]
    nation_text = F.when(F.col("c_acctbal") < 0, "none").otherwise(F.col("c_nationkey").cast("string"))
    customer = t["customer"].withColumn("nation_id", nation_text.try_cast("bigint"))
    return customer.join(_places(t), F.col("nation_id") == F.col("n_nationkey"), "left").select(
        surrogate_key("c_custkey").alias("customer_id_wid"),
        F.col("c_custkey").cast("bigint").alias("integration_id"),
        squeeze_spaces(F.concat_ws(" ", *parts)).alias("fullname"),
        "nation_name",
        "region_name",
    )


def dim_product(t: Tables) -> DataFrame:
    """Parts with their subcategory (the brand) and category (the first word of the type).

    Both lookups come from the parts themselves; the id of the subcategory arrives as a double,
    NULL for the largest sizes, and is cast back before it is joined.
    """
    brand, kind = F.substring("p_brand", 7, 2), F.split_part("p_type", F.lit(" "), F.lit(1))
    subcategory = t["part"].groupBy(brand.cast("bigint").alias("subcategory_id")).agg(
        F.min("p_brand").alias("product_subcategory_name"), F.min(kind).alias("parent_category")
    )
    category = t["part"].select(kind.alias("category_id"), F.upper(kind).alias("product_category_name")).distinct()
    arrived = F.when(F.col("p_size") < 45, brand.cast("double"))
    product = t["part"].withColumn("subcategory_id", arrived.try_cast("bigint"))
    return (
        product.join(subcategory, "subcategory_id", "left")
        .join(category, F.col("parent_category") == F.col("category_id"), "left")
        .select(
            surrogate_key("p_partkey").alias("product_id_wid"),
            F.col("p_partkey").alias("integration_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("product_type"),
            F.col("p_size").alias("size"),
            F.col("p_retailprice").alias("listprice"),
            *("subcategory_id", "product_subcategory_name", "product_category_name"),
        )
    )


def dim_address(t: Tables) -> DataFrame:
    return t["supplier"].join(_places(t), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        surrogate_key("s_suppkey").alias("address_id_wid"),
        F.col("s_suppkey").alias("integration_id"),
        F.col("s_name").alias("addressline1"),
        "nation_name",
        "region_name",
    )


def dim_used_customer(t: Tables) -> DataFrame:
    used = t["orders"].filter(F.col("o_custkey").isNotNull()).select("o_custkey").distinct()
    return used.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left").select(
        surrogate_key("o_custkey").alias("customer_id_wid"),
        F.col("o_custkey").alias("integration_id"),
        F.col("c_mktsegment").alias("segment"),
    )


def dim_order_status(t: Tables) -> DataFrame:
    status = t["orders"].select("o_orderstatus").distinct()
    return status.select(
        surrogate_key("o_orderstatus").alias("order_status_id_wid"),
        F.col("o_orderstatus").alias("integration_id"),
        labelled(F.col("o_orderstatus"), ORDER_STATUS).alias("order_status_name"),
    )


def fact_sales(t: Tables) -> DataFrame:
    """One row per order line; a hot order is split across tasks by adaptive skew-join handling.

    Only what the tables hold is shuffled; hashes, which nothing compresses well, and the revenue
    are computed after the join.
    """
    order = t["orders"].select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("customerid"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("date").alias("orderdate"),
        F.col("o_totalprice").alias("totaldue"),
    )
    line = t["lineitem"].select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("productid"),
        F.col("l_suppkey").alias("supplierid"),
        F.col("l_extendedprice").alias("unitprice"),
        F.col("l_quantity").alias("orderqty"),
    )
    added = {
        "sales_id_wid": surrogate_key("orderkey", "linenumber"),
        "product_id_wid": surrogate_key("productid"),
        "supplier_id_wid": surrogate_key("supplierid"),
        "customer_id_wid": surrogate_key("customerid"),
        "order_status_id_wid": surrogate_key("order_status"),
        "order_date_id_wid": surrogate_key("orderdate"),
        "revenue": F.col("unitprice") * F.col("orderqty"),
    }
    return line.join(order, "orderkey").withColumns(added).select(*FACT_COLUMNS)


def revenue_by_status(t: Tables) -> DataFrame:
    """Sales by status label; lines fold to one row per order before the join, so no key is hot in it."""
    amount = F.col("l_extendedprice") * F.col("l_quantity")
    per_order = t["lineitem"].groupBy("l_orderkey").agg(F.sum(amount).alias("revenue"), F.count("*").alias("lines"))
    order = t["orders"].select("o_orderkey", "o_orderstatus")
    per_status = (
        per_order.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderstatus")
        .agg(
            F.round(F.sum("revenue"), 2).alias("revenue"),
            F.sum("lines").alias("n_lines"),
            F.count("*").alias("n_orders"),
        )
    )
    return per_status.select(
        labelled(F.col("o_orderstatus"), ORDER_STATUS).alias("order_status_name"), "revenue", "n_lines", "n_orders"
    )


def order_totals(t: Tables) -> DataFrame:
    """Order totals by month from one row per order, which lines would multiply."""
    return (
        t["orders"]
        .groupBy(F.trunc("o_orderdate", "month").alias("order_month"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("totaldue"), F.count("*").alias("n_orders"))
    )


def dim_date(t: Tables) -> DataFrame:
    """A calendar over the order dates, keyed like the fact's order date."""
    days = date_spine(t["orders"].sparkSession, "day", *date_bounds(t["orders"], "o_orderdate"))
    return days.select(surrogate_key("date_day").alias("date_id_wid"), F.col("date_day").alias("integration_id"))


def _with_unknown(model, key: str):
    return lambda t: with_unknown_member(model(t), key)


#: Dimensions carry the member that facts with a NULL key point to.
MODELS = {
    "dim_customer": _with_unknown(dim_customer, "customer_id_wid"),
    "dim_product": _with_unknown(dim_product, "product_id_wid"),
    "dim_address": _with_unknown(dim_address, "address_id_wid"),
    "dim_date": _with_unknown(dim_date, "date_id_wid"),
    "dim_used_customer": dim_used_customer,
    "dim_order_status": dim_order_status,
    "fact_sales": fact_sales,
}


KEY_AND_LABEL = {
    "dim_product": ("product_id_wid", "product_name"),
    "dim_address": ("address_id_wid", "addressline1"),
    "dim_customer": ("customer_id_wid", "fullname"),
    "dim_used_customer": ("customer_id_wid", "segment"),
    "dim_order_status": ("order_status_id_wid", "order_status_name"),
    "dim_date": ("date_id_wid", None),
}

#: Dimensions with an unknown member, whose other columns are NULL.
WITH_UNKNOWN = ("dim_customer", "dim_product", "dim_address", "dim_date")


def dimension_checks(gold: Tables) -> list[tuple[DataFrame, Check]]:
    """Both keys of every dimension unique and filled, its label filled, statuses known; the
    unknown member may lack all but its key."""
    unknown = F.md5(F.lit(NULL_MARK))
    plan = []
    for table, (key, label) in KEY_AND_LABEL.items():
        known = F.lit(table not in WITH_UNKNOWN) | (F.col(key) != unknown)
        rules = [unique(c) for c in (key, "integration_id")] + [not_null(key)]
        rules += [row_check(f"not_null_{c}", F.col(c).isNull() & known) for c in ("integration_id", label) if c]
        plan += [(gold[table], r.named(f"{table}.{r.name}")) for r in rules]
    known = accepted_values("order_status_name", ["Open", "Finished"]).limits("warn")
    return [*plan, (gold["dim_order_status"], known)]


def star_checks(gold: Tables, grain: str = "error") -> list[tuple[DataFrame, Check]]:
    """The dimensions, and grain and links of the fact; ``grain`` is the severity of the two rules
    that no order line comes twice."""
    rules = [
        unique_combination(["orderkey", "linenumber"]).limits(grain),
        unique("sales_id_wid").limits(grain),
        *(not_null(c) for c in ("sales_id_wid", "orderkey", "customer_id_wid", "order_date_id_wid")),
        relationships("customer_id_wid", gold["dim_customer"], "customer_id_wid"),
        relationships("product_id_wid", gold["dim_product"], "product_id_wid"),
        relationships("supplier_id_wid", gold["dim_address"], "address_id_wid"),
        relationships("order_date_id_wid", gold["dim_date"], "date_id_wid"),
        relationships("order_status_id_wid", gold["dim_order_status"], "order_status_id_wid"),
        expression_is_true("revenue > 0 AND orderqty > 0", "sold_something"),
        expression_is_true("totaldue >= 0", "totaldue_not_negative"),
        columns_match_set(FACT_COLUMNS),
    ]
    return dimension_checks(gold) + [(gold["fact_sales"], r.named(f"fact_sales.{r.name}")) for r in rules]
