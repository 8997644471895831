"""The sales star on hand-made silver tables, and the whole run from raw files to checks."""

import datetime
import hashlib
import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tierkit.checks import ChecksFailed, run_checks
from tierkit.functions.keys import NULL_MARK
from tierkit.plans import retail_star, run_daily, sales_star
from tierkit.sources import bronze_path, create_layers, materialize_table, write_layer


def md5(*parts):
    return hashlib.md5("-".join(parts).encode()).hexdigest()


SCHEMAS = {
    "silver_person_address": (
        "addressid bigint, addressline1 string, addressline2 string, city string, stateprovinceid bigint, "
        "postalcode string, spatiallocation string, rowguid string, modifieddate timestamp_ntz"
    ),
    "silver_person_countryregion": "countryregioncode string, name string, modifieddate timestamp_ntz",
    "silver_person_person": "businessentityid bigint, firstname string, middlename string, lastname string",
    "silver_person_stateprovince": "stateprovinceid bigint, stateprovincecode string, countryregioncode string, name string",
    "silver_production_product": (
        "productid bigint, name string, productnumber string, makeflag boolean, finishedgoodsflag boolean, "
        "color string, safetystocklevel bigint, reorderpoint bigint, standardcost double, listprice double, "
        "size string, sizeunitmeasurecode string, weightunitmeasurecode string, weight double, "
        "daystomanufacture bigint, productline string, class string, style string, productsubcategoryid double, "
        "sellstartdate timestamp_ntz, sellenddate timestamp_ntz, discontinueddate string"
    ),
    "silver_production_productcategory": "productcategoryid bigint, name string",
    "silver_production_productsubcategory": "productsubcategoryid bigint, productcategoryid bigint, name string",
    "silver_sales_creditcard": "creditcardid bigint, cardtype string, cardnumber string",
    "silver_sales_customer": "customerid bigint, personid double, storeid double",
    "silver_sales_salesorderdetail": "salesorderid bigint, salesorderdetailid bigint, orderqty bigint, productid bigint, unitprice double",
    "silver_sales_salesorderheader": (
        "salesorderid bigint, orderdate timestamp_ntz, status bigint, customerid bigint, shiptoaddressid bigint, "
        "creditcardid double, totaldue double"
    ),
    "silver_sales_salesorderheadersalesreason": "salesorderid bigint, salesreasonid bigint",
    "silver_sales_salesreason": "salesreasonid bigint, name string",
    "silver_sales_store": "businessentityid bigint, name string",
}

NOON = datetime.datetime(2022, 5, 30, 12)
ROWS = {
    "silver_person_address": [
        (1, "1 High St", None, "Bothell", 79, "98011", None, "r1", NOON),
        (2, "2 Low St", "b", "Nowhere", 5, "0", None, "r2", NOON),
    ],
    "silver_person_countryregion": [("US", "United States", NOON)],
    "silver_person_person": [(10, "Ann", None, "Lee"), (11, " Bo ", "K.", "Chi")],
    "silver_person_stateprovince": [(79, "WA", "US", "Washington"), (5, "XX", "ZZ", "Nowhere")],
    "silver_production_product": [
        (100, "Bike", "B-1", True, True, "Red", 1, 1, 1.0, 2.0, "M", "CM", "KG", 9.5, 3, "R", "H", "U", 7.0, NOON, None, None),
        (101, "Bolt", "B-2", False, False, None, 1, 1, 1.0, 2.0, None, None, None, None, 0, None, None, None, None, NOON, None, None),
        (102, "Part", "B-3", False, False, None, 1, 1, 1.0, 2.0, None, None, None, None, 0, None, None, None, 8.0, NOON, None, None),
    ],
    "silver_production_productcategory": [(1, "Bikes")],
    "silver_production_productsubcategory": [(7, 1, "Road Bikes"), (8, 9, "Loose Parts")],
    "silver_sales_creditcard": [(500, "Vista", "1111"), (501, "Unused", "2222")],
    "silver_sales_customer": [(1000, 10.0, None), (1001, 11.0, 20.0), (1002, None, None)],
    "silver_sales_salesorderdetail": [(1, 1, 2, 100, 3.5), (1, 2, 1, 101, 1.25), (2, 3, 4, 102, 10.0)],
    "silver_sales_salesorderheader": [
        (1, datetime.datetime(2022, 5, 30), 5, 1000, 1, 500.0, 9.0),
        (2, datetime.datetime(2022, 6, 2), 9, 1001, 2, None, 44.0),
    ],
    "silver_sales_salesorderheadersalesreason": [(1, 1)],
    "silver_sales_salesreason": [(1, "Price")],
    "silver_sales_store": [(20, "Bike World")],
}


@pytest.fixture(scope="module")
def silver(spark):
    return {name: spark.createDataFrame(ROWS[name], schema) for name, schema in SCHEMAS.items()}


def test_dim_product(silver, rows):
    df = sales_star.dim_product(silver)
    assert len(df.columns) == 26
    shown = ("integration_id", "productsubcategoryid", "product_subcategory_name", "productcategoryid", "product_category_name")
    assert rows(df, *shown) == [
        (100, 7, "Road Bikes", 1, "Bikes"),
        (101, None, None, None, None),
        (102, 8, "Loose Parts", None, None),
    ]
    assert rows(df.filter("integration_id = 100"), "product_id_wid", "weight") == [(md5("100"), 9.5)]


def test_dim_customer(silver, rows):
    assert rows(sales_star.dim_customer(silver)) == sorted(
        [
            (md5("1000"), 1000, 10, "Ann Lee", None, None),
            (md5("1001"), 1001, 11, "Bo K. Chi", 20, "Bike World"),
            (md5("1002"), 1002, None, None, None, None),
        ]
    )


def test_dim_address(silver, rows):
    df = sales_star.dim_address(silver)
    assert rows(df, "address_id_wid", "stateprovince_name", "countryregioncode", "country_name") == sorted(
        [(md5("1"), "Washington", "US", "United States"), (md5("2"), "Nowhere", "ZZ", None)]
    )


def test_dim_credit_card_and_unknown_member(silver, rows):
    cards = sales_star.dim_credit_card(silver)
    assert rows(cards) == [(md5("500"), 500, "Vista")]
    assert rows(sales_star.with_unknown_member(cards, "credit_card_id_wid")) == sorted(
        [(md5("500"), 500, "Vista"), (md5(NULL_MARK), None, None)]
    )


def test_dim_order_status_and_date(silver, rows):
    assert rows(sales_star.dim_order_status(silver)) == sorted([(md5("5"), 5, "Shipped"), (md5("9"), 9, "Unknown")])
    assert [r[1].isoformat() for r in sales_star.dim_date(silver).orderBy("integration_id").collect()] == [
        "2022-05-30",
        "2022-05-31",
        "2022-06-01",
        "2022-06-02",
    ]


def test_fact_sales(silver):
    fact = sales_star.fact_sales(silver)
    line = fact.filter("salesorderdetailid = 1").first()
    assert (line.sales_id_wid, line.product_id_wid, line.customer_id_wid) == (md5("1", "1"), md5("100"), md5("1000"))
    assert (line.credit_card_id_wid, line.ship_address_id_wid) == (md5("500"), md5("1"))
    assert (line.order_status_id_wid, line.order_date_id_wid) == (md5("5"), md5("2022-05-30"))
    assert (line.revenue, line.totaldue, line.orderqty) == (7.0, 9.0, 2)
    assert fact.count() == 3 and len(fact.columns) == 19
    assert fact.filter("salesorderid = 2").first().credit_card_id_wid == md5(NULL_MARK)


def test_checks_of_the_star(silver):
    gold = {name: model(silver) for name, model in sales_star.MODELS.items()}
    plan = sales_star.star_checks(gold)
    assert len(plan) == 35
    status = {r["check"]: r["status"] for r in run_checks(plan).collect()}
    assert {c: s for c, s in status.items() if s != "pass"} == {"accepted_values_order_status_name": "warn"}


def land(silver, root):
    for schema, name in sales_star.SOURCE_TABLES:
        write_layer(silver[f"silver_{schema.lower()}_{name.lower()}"], bronze_path(root, "shop", schema, name))


def test_daily_run(spark, silver, tmp_path):
    root = str(tmp_path)
    land(silver, root)
    prefix = f"d{uuid.uuid4().hex[:8]}_"
    run = (spark, root, "shop", sales_star.SOURCE_TABLES, sales_star.MODELS, sales_star.star_checks, prefix)
    results = run_daily(*run)
    assert len(results) == 35 and not [r for r in results if r["status"] == "error"]
    assert spark.table(f"{prefix}gold.fact_sales").count() == 3
    assert run_daily(*run)[0]["failures"] == 0

    broken = silver["silver_sales_salesorderdetail"]
    write_layer(broken.union(broken.limit(1)), bronze_path(root, "shop", "Sales", "SalesOrderDetail"))
    with pytest.raises(ChecksFailed, match="fact_sales.unique_sales_id_wid"):
        run_daily(*run)


def test_totaldue_repeats_on_lines(silver):
    """Order totals are taken from orders; summed over lines they count once per line."""
    over_lines = sales_star.fact_sales(silver).agg(F.sum("totaldue")).first()[0]
    over_orders = silver["silver_sales_salesorderheader"].agg(F.sum("totaldue")).first()[0]
    assert (over_lines, over_orders) == (62.0, 53.0)


def test_only_given_columns_are_shuffled(spark):
    """The join of the retail fact moves no hash and no product of columns."""
    orders = spark.createDataFrame(
        [(1, 7, "O", datetime.datetime(2022, 5, 30), 9.0)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_totalprice double",
    )
    lines = spark.createDataFrame(
        [(1, 2, 3, 4, 1.5, 2.0)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double",
    )
    fact = retail_star.fact_sales({"orders": orders, "lineitem": lines})
    row = fact.first()
    assert (row.customer_id_wid, row.order_status_id_wid, row.order_date_id_wid) == (md5("7"), md5("O"), md5("2022-05-30"))
    assert (row.sales_id_wid, row.revenue) == (md5("1", "2"), 3.0)
    above, _, below = fact._jdf.queryExecution().optimizedPlan().toString().partition("Join Inner")
    assert "md5" in above and "md5" not in below and " * " not in below


def test_tables_are_compressed_with_zstd(spark, tmp_path):
    layers = create_layers(spark, str(tmp_path), f"z{uuid.uuid4().hex[:8]}_")
    materialize_table(spark.range(5), f"{layers['gold']}.numbers")
    files = [pq.ParquetFile(f) for f in Path(tmp_path).rglob("*.parquet")]
    groups = [f.metadata.row_group(g) for f in files for g in range(f.num_row_groups)]
    assert groups and {g.column(0).compression for g in groups} == {"ZSTD"}
