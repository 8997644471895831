"""Star schema of a sales company, built from its silver tables (name -> DataFrame).

Small dimensions are left to Spark's own size-checked broadcast; no join is hinted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.checks import (
    Check,
    accepted_values,
    expression_is_true,
    not_null,
    relationships,
    unique,
    unique_combination,
)
from tierkit.functions import squeeze_spaces, surrogate_key
from tierkit.operators import date_bounds, date_spine

Tables = Mapping[str, DataFrame]

# The source tables (schema, table) the star is built from.
SOURCE_TABLES = (
    ("Person", "Address"),
    ("Person", "CountryRegion"),
    ("Person", "Person"),
    ("Person", "StateProvince"),
    ("Production", "Product"),
    ("Production", "ProductCategory"),
    ("Production", "ProductSubcategory"),
    ("Sales", "CreditCard"),
    ("Sales", "Customer"),
    ("Sales", "SalesOrderDetail"),
    ("Sales", "SalesOrderHeader"),
    ("Sales", "SalesOrderHeaderSalesReason"),
    ("Sales", "SalesReason"),
    ("Sales", "Store"),
)

# Fixed values, with the output column names of the models below: order status codes.
ORDER_STATUS = {1: "In Process", 2: "Approved", 3: "Backordered", 4: "Rejected", 5: "Shipped", 6: "Cancelled"}


def whole_key(column: str) -> Column:
    """A nullable id that arrived as a double, back as a whole number (NULL if it is none)."""
    return F.col(column).try_cast("bigint")


def labelled(column: Column, labels: Mapping) -> Column:
    """The label of a code, Unknown for the rest."""
    out = F
    for code, label in labels.items():
        out = out.when(column == code, label)
    return out.otherwise("Unknown")


def dim_product(silver: Tables) -> DataFrame:
    product = silver["silver_production_product"].withColumn("productsubcategoryid", whole_key("productsubcategoryid"))
    subcategory = silver["silver_production_productsubcategory"].select(
        "productsubcategoryid",
        F.col("productcategoryid").alias("parent_category"),
        F.col("name").alias("product_subcategory_name"),
    )
    category = silver["silver_production_productcategory"].select(
        "productcategoryid", F.col("name").alias("product_category_name")
    )
    return (
        product.join(subcategory, "productsubcategoryid", "left")
        .join(category, F.col("parent_category") == F.col("productcategoryid"), "left")
        .select(
            surrogate_key("productid").alias("product_id_wid"),
            F.col("productid").alias("integration_id"),
            F.col("name").alias("product_name"),
            *("productnumber", "makeflag", "finishedgoodsflag", "color", "productline", "class", "style"),
            *("size", "sizeunitmeasurecode", "weightunitmeasurecode", "weight"),
            *("safetystocklevel", "reorderpoint", "standardcost", "listprice", "daystomanufacture"),
            *("sellstartdate", "sellenddate", "discontinueddate"),
            *("productsubcategoryid", "product_subcategory_name", "productcategoryid", "product_category_name"),
        )
    )


def dim_customer(silver: Tables) -> DataFrame:
    def name_part(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(""))

    customer = silver["silver_sales_customer"].select(
        "customerid", whole_key("personid").alias("personid"), whole_key("storeid").alias("storeid")
    )
    person = silver["silver_person_person"].select(
        "businessentityid",
        squeeze_spaces(F.concat_ws(" ", *map(name_part, ("firstname", "middlename", "lastname")))).alias("fullname"),
    )
    store = silver["silver_sales_store"].select(
        F.col("businessentityid").alias("storebusinessentityid"), F.col("name").alias("storename")
    )
    return (
        customer.join(person, F.col("personid") == F.col("businessentityid"), "left")
        .join(store, F.col("storeid") == F.col("storebusinessentityid"), "left")
        .select(
            surrogate_key("customerid").alias("customer_id_wid"),
            F.col("customerid").cast("bigint").alias("integration_id"),
            *("businessentityid", "fullname", "storebusinessentityid", "storename"),
        )
    )


def dim_address(silver: Tables) -> DataFrame:
    address = silver["silver_person_address"].withColumn("stateprovinceid", whole_key("stateprovinceid"))
    state = silver["silver_person_stateprovince"].select(
        "stateprovinceid", "stateprovincecode", "countryregioncode", F.col("name").alias("stateprovince_name")
    )
    country = silver["silver_person_countryregion"].select("countryregioncode", F.col("name").alias("country_name"))
    return (
        address.join(state, "stateprovinceid", "left")
        .join(country, "countryregioncode", "left")
        .select(
            surrogate_key("addressid").alias("address_id_wid"),
            F.col("addressid").alias("integration_id"),
            *("addressline1", "addressline2", "city", "postalcode"),
            *("stateprovinceid", "stateprovincecode", "stateprovince_name"),
            *("countryregioncode", "country_name"),
            *("spatiallocation", "rowguid", "modifieddate"),
        )
    )


def dim_credit_card(silver: Tables) -> DataFrame:
    """Cards used in an order; of the card itself only its type is carried."""
    used = (
        silver["silver_sales_salesorderheader"]
        .select(whole_key("creditcardid").alias("creditcardid"))
        .filter(F.col("creditcardid").isNotNull())
        .distinct()
    )
    card = silver["silver_sales_creditcard"].select("creditcardid", "cardtype")
    return used.join(card, "creditcardid", "left").select(
        surrogate_key("creditcardid").alias("credit_card_id_wid"),
        F.col("creditcardid").alias("integration_id"),
        "cardtype",
    )


def dim_order_status(silver: Tables) -> DataFrame:
    status = silver["silver_sales_salesorderheader"].select(F.col("status").cast("bigint").alias("status")).distinct()
    return status.select(
        surrogate_key("status").alias("order_status_id_wid"),
        F.col("status").alias("integration_id"),
        labelled(F.col("status"), ORDER_STATUS).alias("order_status_name"),
    )


def dim_date(silver: Tables) -> DataFrame:
    """A calendar over the order dates, keyed like the fact's order date."""
    header = silver["silver_sales_salesorderheader"]
    days = date_spine(header.sparkSession, "day", *date_bounds(header, "orderdate"))
    return days.select(surrogate_key("date_day").alias("date_id_wid"), F.col("date_day").alias("integration_id"))


def fact_sales(silver: Tables) -> DataFrame:
    """One row per order line. ``totaldue`` belongs to the order and repeats on its lines.

    Keys of the order are hashed before the join, once per order, so its side of the shuffle
    carries hashes as well; those of the line are hashed after it.
    """
    header = silver["silver_sales_salesorderheader"].select(
        *("salesorderid", "customerid", "shiptoaddressid", "totaldue"),
        whole_key("creditcardid").alias("creditcardid"),
        F.col("status").cast("bigint").alias("order_status"),
        F.col("orderdate").cast("date").alias("orderdate"),
    )
    header_keys = {
        "customer_id_wid": surrogate_key("customerid"),
        "credit_card_id_wid": surrogate_key("creditcardid"),
        "ship_address_id_wid": surrogate_key("shiptoaddressid"),
        "order_status_id_wid": surrogate_key("order_status"),
        "order_date_id_wid": surrogate_key("orderdate"),
    }
    line = silver["silver_sales_salesorderdetail"].select(
        *("salesorderid", "salesorderdetailid", "productid", "unitprice", "orderqty"),
        (F.col("unitprice") * F.col("orderqty")).alias("revenue"),
    )
    line_keys = {
        "sales_id_wid": surrogate_key("salesorderid", "salesorderdetailid"),
        "product_id_wid": surrogate_key("productid"),
    }
    joined = line.join(header.withColumns(header_keys), "salesorderid").withColumns(line_keys)
    return joined.select(
        *line_keys,
        *header_keys,
        *("salesorderid", "salesorderdetailid", "productid", "customerid", "creditcardid", "shiptoaddressid"),
        *("order_status", "orderdate", "unitprice", "orderqty", "revenue", "totaldue"),
    )


def with_unknown_member(dim: DataFrame, key: str) -> DataFrame:
    """Add the row that facts with a NULL foreign key point to."""
    unknown = dim.sparkSession.range(1).select(
        *[
            (surrogate_key(F.lit(None)) if f.name == key else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in dim.schema
        ]
    )
    return dim.union(unknown)


MODELS = {
    "dim_product": dim_product,
    "dim_customer": dim_customer,
    "dim_address": dim_address,
    "dim_credit_card": dim_credit_card,
    "dim_order_status": dim_order_status,
    "dim_date": dim_date,
    "fact_sales": fact_sales,
}


def star_checks(gold: Tables) -> list[tuple[DataFrame, Check]]:
    """The declared checks: keys and labels of every dimension, grain and links of the fact."""
    key_and_label = {
        "dim_product": ("product_id_wid", "product_name"),
        "dim_address": ("address_id_wid", "addressline1"),
        "dim_customer": ("customer_id_wid", None),
        "dim_credit_card": ("credit_card_id_wid", "cardtype"),
        "dim_order_status": ("order_status_id_wid", "order_status_name"),
    }
    plan = []
    for table, (key, label) in key_and_label.items():
        rules = [rule(c) for c in (key, "integration_id") for rule in (not_null, unique)]
        rules += [not_null(label)] if label else []
        plan += [(gold[table], r.named(f"{table}.{r.name}")) for r in rules]
    fact = gold["fact_sales"]
    rules = [
        unique_combination(["sales_id_wid"]),
        not_null("sales_id_wid"),
        unique("sales_id_wid"),
        not_null("salesorderid"),
        not_null("customer_id_wid"),
        relationships("customer_id_wid", gold["dim_customer"], "customer_id_wid"),
        relationships("order_status_id_wid", gold["dim_order_status"], "order_status_id_wid"),
        not_null("order_date_id_wid"),
        relationships("order_date_id_wid", gold["dim_date"], "date_id_wid"),
        expression_is_true("totaldue >= 0", "totaldue_not_negative"),
    ]
    plan += [(fact, r.named(f"fact_sales.{r.name}")) for r in rules]
    plan.append(
        (gold["dim_order_status"], accepted_values("order_status_name", [*ORDER_STATUS.values()]).limits("warn"))
    )
    return plan
