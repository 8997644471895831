"""Reshaping, arithmetic, calendars, bucketing and distances over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.functions import haversine_distance, safe_add, safe_divide, safe_subtract, width_bucket
from tierkit.operators import (
    collect_values,
    date_bounds,
    date_spine,
    deduplicate,
    generate_series,
    group_by_first,
    null_blanks,
    pivot,
    pivot_columns,
    star,
    union_tables,
    unpivot,
)
from tierkit.workload.registry import Tables, dates_as_text, query


def _parties(t: Tables) -> dict[str, DataFrame]:
    return {
        "customer": t["customer"].select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        ),
        "supplier": t["supplier"].select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.col("s_nationkey").alias("nation"),
            F.col("s_acctbal").alias("balance"),
        ),
    }


@query(
    "union_superset",
    """
    SELECT 'customer' AS _source_relation, c_custkey AS id, c_name AS name, c_acctbal AS balance,
           c_mktsegment AS segment, CAST(NULL AS BIGINT) AS nation FROM customer WHERE c_acctbal > 1000
    UNION ALL
    SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier WHERE s_acctbal > 1000
    """,
)
def union_superset(t: Tables) -> DataFrame:
    return union_tables(_parties(t), type_overrides={"nation": "bigint"}, where="balance > 1000")


@query(
    "union_exclude",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
    """,
)
def union_exclude(t: Tables) -> DataFrame:
    return union_tables(_parties(t), exclude=["Balance", "nation"], source_column=None)


@query(
    "union_include",
    """
    SELECT 'customer' AS party, c_custkey AS id, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
    """,
)
def union_include(t: Tables) -> DataFrame:
    return union_tables(_parties(t), include=["ID", "balance"], source_column="party")


@query(
    "unpivot_measures",
    """
    SELECT l_returnflag, field_name, count(*) AS n_values, round(sum(value), 2) AS total FROM (
        SELECT l_returnflag, 'l_quantity' AS field_name, l_quantity AS value FROM lineitem
        UNION ALL SELECT l_returnflag, 'l_extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem
        UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem
        UNION ALL SELECT l_returnflag, 'l_linenumber', CAST(l_linenumber AS DOUBLE) FROM lineitem)
    GROUP BY 1, 2
    """,
)
def unpivot_measures(t: Tables) -> DataFrame:
    lines = t["lineitem"].drop("l_linestatus", "l_shipdate")
    melted = unpivot(lines, exclude=["l_returnflag"], remove=["l_orderkey", "l_partkey", "l_suppkey"], cast_to="double")
    return melted.groupBy("l_returnflag", "field_name").agg(
        F.count("value").alias("n_values"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "unpivot_text",
    """
    SELECT c_custkey, 'c_name' AS prop, c_name AS val FROM customer
    UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
    UNION ALL SELECT c_custkey, 'c_mktsegment', nullif(c_mktsegment, 'MACHINERY') FROM customer
    UNION ALL SELECT c_custkey, 'in_debt', CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END FROM customer
    """,
)
def unpivot_text(t: Tables) -> DataFrame:
    people = t["customer"].withColumns({
        "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")),
        "in_debt": F.col("c_acctbal") < 0,
    })
    return unpivot(people, exclude=["c_custkey"], remove=["c_acctbal"], field_name="prop", value_name="val")


@query(
    "dedup_latest",
    """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
    """,
)
def dedup_latest(t: Tables) -> DataFrame:
    latest = deduplicate(t["orders"], ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.desc_nulls_last("o_orderkey")])
    return latest.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("orderdate"), "o_totalprice")


LINE_ORDER = [
    *("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    *("l_returnflag", "l_linestatus", "l_shipdate"),
]


@query(
    "dedup_lines",
    f"""
    SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' NULLS LAST' for c in LINE_ORDER)}) = 1
    """,
)
def dedup_lines(t: Tables) -> DataFrame:
    lines = deduplicate(t["lineitem"], ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return dates_as_text(lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date")))


@query(
    "pivot_status",
    """
    SELECT o_orderpriority,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_F,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_O,
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_P
    FROM orders GROUP BY 1
    """,
)
def pivot_status(t: Tables) -> DataFrame:
    orders = t["orders"]
    header = collect_values(t.spark, orders, "o_orderstatus")
    return pivot(orders, ["o_orderpriority"], "o_orderstatus", header, prefix="n_")


@query(
    "pivot_amounts",
    """
    SELECT o_orderpriority,
           round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS total_f_usd,
           round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS total_o_usd,
           max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS "not P",
           count(DISTINCT CASE WHEN o_orderstatus >= 'O' THEN o_custkey END) AS "buyers O",
           min(CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'F' THEN o_custkey END) AS "oldest F",
           CAST(sum(CASE WHEN CAST(o_orderdate AS VARCHAR) LIKE '%-05-%' THEN 1 ELSE 0 END) AS BIGINT) AS in_may
    FROM orders GROUP BY 1
    """,
)
def pivot_amounts(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    totals = pivot_columns(
        "o_orderstatus",
        ["F", "O"],
        agg=lambda c: F.round(F.sum(c), 2),
        prefix="Total ",
        suffix="-USD",
        then_value=price,
        slug_names=True,
    )
    highest = pivot_columns("o_orderstatus", ["P"], agg=F.max, cmp="<>", prefix="not ", then_value=price, else_value=None)
    buyer = {"then_value": F.col("o_custkey"), "else_value": None, "distinct": True}
    buyers = pivot_columns("o_orderstatus", ["O"], agg=F.count, cmp=">=", prefix="buyers ", **buyer)
    oldest = pivot_columns("o_orderstatus", ["F"], agg=F.min, cmp="<=>", prefix="oldest ", **buyer)
    in_may = pivot_columns("o_orderdate", ["%-05-%"], agg=F.sum, cmp="like", alias=False)
    return t["orders"].groupBy("o_orderpriority").agg(*totals, *highest, *buyers, *oldest, in_may[0].alias("in_may"))


@query(
    "date_spine_day",
    """
    WITH days AS (SELECT CAST(unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY))
                         AS DATE) AS date_day FROM orders),
         daily AS (SELECT CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS total, count(*) AS n
                   FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT date_day, coalesce(round(total, 2), 0) AS total, coalesce(n, 0) AS n_orders
    FROM days LEFT JOIN daily ON date_day = d
    """,
)
def date_spine_day(t: Tables) -> DataFrame:
    orders = t["orders"]
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    daily = urgent.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n_orders")
    )
    days = date_spine(t.spark, "day", *date_bounds(orders, "o_orderdate"))
    return days.join(daily, "date_day", "left").fillna(0, ["total", "n_orders"])


@query(
    "date_spine_month",
    """
    WITH months AS (SELECT CAST(unnest(range(date_trunc('month', min(o_orderdate)), max(o_orderdate) + INTERVAL 1 DAY,
                                INTERVAL 1 MONTH)) AS DATE) AS date_month FROM orders)
    SELECT date_month, count(o_orderkey) AS n_orders, count(DISTINCT o_custkey) AS n_customers
    FROM months LEFT JOIN orders ON date_month = CAST(date_trunc('month', o_orderdate) AS DATE) GROUP BY 1
    """,
)
def date_spine_month(t: Tables) -> DataFrame:
    orders = t["orders"]
    first, end = date_bounds(orders, "o_orderdate")
    monthly = orders.groupBy(F.trunc("o_orderdate", "month").alias("date_month")).agg(
        F.count("o_orderkey").alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers")
    )
    months = date_spine(t.spark, "month", first.replace(day=1), end)
    return months.join(monthly, "date_month", "left").fillna(0)


@query(
    "date_spine_hour",
    """
    WITH hours AS (SELECT unnest(range(date_trunc('day', min(ts)), date_trunc('day', max(ts)) + INTERVAL 1 DAY,
                          INTERVAL 1 HOUR)) AS h FROM events),
         hourly AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT strftime(hours.h, '%Y-%m-%d %H') AS hour, coalesce(n, 0) AS n_errors FROM hours LEFT JOIN hourly USING (h)
    """,
)
def date_spine_hour(t: Tables) -> DataFrame:
    events = t["events"]
    errors = events.filter(F.col("event_type") == "error").groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date_hour")
    )
    hours = date_spine(t.spark, "hour", *date_bounds(events, "ts"))
    counted = hours.join(errors.agg(F.count("*").alias("n_errors")), "date_hour", "left").fillna(0)
    return counted.select(F.date_format("date_hour", "yyyy-MM-dd HH").alias("hour"), "n_errors")


@query(
    "generate_series",
    """
    SELECT generated_number FROM (SELECT unnest(range(1, max(o_orderkey) + 1)) AS generated_number FROM orders)
    WHERE generated_number NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def series_gaps(t: Tables) -> DataFrame:
    """Order numbers without a line."""
    highest = t["orders"].agg(F.max("o_orderkey")).first()[0]
    used = t["lineitem"].select(F.col("l_orderkey").alias("generated_number")).distinct()
    return generate_series(t.spark, highest).join(used, "generated_number", "left_anti")


@query(
    "star_except",
    """
    SELECT l_orderkey AS line_l_orderkey_raw, l_partkey AS line_l_partkey_raw, l_suppkey AS line_l_suppkey_raw,
           l_linenumber AS line_l_linenumber_raw, l_quantity AS line_l_quantity_raw,
           l_extendedprice AS line_l_extendedprice_raw, l_returnflag AS line_l_returnflag_raw,
           l_linestatus AS line_l_linestatus_raw FROM lineitem
    """,
)
def star_except(t: Tables) -> DataFrame:
    lines = t["lineitem"]
    return lines.select(*star(lines, exclude=["L_DISCOUNT", "l_tax", "l_shipdate"], prefix="line_", suffix="_raw"))


@query(
    "star_group_by",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2
    """,
)
def star_group_by(t: Tables) -> DataFrame:
    """A column list used in GROUP BY."""
    lines = t["lineitem"].select("l_returnflag", "l_linestatus", "l_quantity")
    groups = lines.groupBy(*star(lines, exclude=["l_quantity"]))
    return groups.agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


@query(
    "group_by_first",
    """
    SELECT o_orderpriority, o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS highest FROM orders GROUP BY 1, 2
    """,
)
def first_columns(t: Tables) -> DataFrame:
    orders = t["orders"].select("o_orderpriority", "o_orderstatus", "o_totalprice")
    return group_by_first(orders, 2).agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("highest"))


@query(
    "nullcheck",
    """
    SELECT c_custkey, c_name, nullif(CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END, '')
           AS c_mktsegment, c_acctbal FROM customer
    """,
)
def nullcheck(t: Tables) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment"))
    return null_blanks(t["customer"].select("c_custkey", "c_name", segment.alias("c_mktsegment"), "c_acctbal"))


@query(
    "net_by_group",
    """
    SELECT l_returnflag,
           round(sum(coalesce(l_quantity, 0) + coalesce(nullif(l_discount, 0.05), 0) + coalesce(nullif(l_tax, 0.02), 0)), 2)
               AS added,
           round(sum(coalesce(l_extendedprice, 0) - coalesce(nullif(l_quantity, 10), 0) - coalesce(nullif(l_tax, 0.02), 0)), 2)
               AS net
    FROM lineitem GROUP BY 1
    """,
)
def net_by_group(t: Tables) -> DataFrame:
    discount, tax = F.nullif(F.col("l_discount"), F.lit(0.05)), F.nullif(F.col("l_tax"), F.lit(0.02))
    quantity = F.nullif(F.col("l_quantity"), F.lit(10.0))
    return t["lineitem"].groupBy("l_returnflag").agg(
        F.round(F.sum(safe_add(["l_quantity", discount, tax])), 2).alias("added"),
        F.round(F.sum(safe_subtract(["l_extendedprice", quantity, tax])), 2).alias("net"),
    )


@query(
    "ratio_by_group",
    """
    SELECT l_suppkey, l_returnflag, round(sum(l_extendedprice) / nullif(sum(CASE WHEN l_returnflag = 'N' THEN 0
           ELSE l_quantity END), 0), 6) AS price_per_unit, sum(CAST(l_linenumber = 7 AS BIGINT)) / nullif(count(*), 0)
           AS share_last
    FROM lineitem GROUP BY 1, 2
    """,
)
def ratio_by_group(t: Tables) -> DataFrame:
    """Ratios of sums: aggregate both sides, then divide; a zero denominator gives NULL."""
    counted = F.when(F.col("l_returnflag") == "N", 0).otherwise(F.col("l_quantity"))
    return t["lineitem"].groupBy("l_suppkey", "l_returnflag").agg(
        F.round(safe_divide(F.sum("l_extendedprice"), F.sum(counted)), 6).alias("price_per_unit"),
        safe_divide(F.count_if(F.col("l_linenumber") == 7), F.count("*")).alias("share_last"),
    )


BUCKETS = 8


@query(
    "histogram",
    """
    WITH counts AS (
        SELECT l_returnflag, CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 9
               ELSE CAST(floor((l_extendedprice - 10000) / 10000) AS BIGINT) + 1 END AS bucket, count(*) AS n
        FROM lineitem GROUP BY 1, 2)
    SELECT f.l_returnflag, b.bucket, coalesce(n, 0) AS n_lines
    FROM (SELECT DISTINCT l_returnflag FROM lineitem) f, (SELECT unnest(range(0, 10)) AS bucket) b
    LEFT JOIN counts c ON c.l_returnflag = f.l_returnflag AND c.bucket = b.bucket
    """,
)
def histogram(t: Tables) -> DataFrame:
    """Lines per price bucket, empty buckets included: at most n + 2 counts per flag are gathered."""
    bucket = width_bucket("l_extendedprice", 10000, 90000, BUCKETS)
    counts = t["lineitem"].groupBy("l_returnflag", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    per_flag = counts.groupBy("l_returnflag").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("filled")
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(BUCKETS + 1)).cast("array<bigint>"))
    spread = per_flag.select("l_returnflag", "filled", every.alias("bucket"))
    return spread.select(
        "l_returnflag", "bucket", F.coalesce(F.try_element_at("filled", F.col("bucket")), F.lit(0)).alias("n_lines")
    )


def _at(key: str) -> tuple:
    """Made-up coordinates for a party, from its key."""
    return ((F.col(key) * 37) % 180 - 90).cast("double"), ((F.col(key) * 73) % 360 - 180).cast("double")


@query(
    "haversine",
    """
    WITH legs AS (
        SELECT c_nationkey, CAST((c_custkey * 37) % 180 - 90 AS DOUBLE) AS lat1,
               CAST((c_custkey * 73) % 360 - 180 AS DOUBLE) AS lon1,
               CAST((l_suppkey * 37) % 180 - 90 AS DOUBLE) AS lat2,
               CAST((l_suppkey * 73) % 360 - 180 AS DOUBLE) AS lon2
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    far AS (
        SELECT c_nationkey, 2 * 3961 * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(lat2 - lat1) / 2), 2)
               + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))) AS miles FROM legs)
    SELECT c_nationkey, count(*) AS n_lines, round(sum(miles), 1) AS total_miles,
           round(max(miles) * 1.60934, 4) AS longest_km
    FROM far GROUP BY 1
    """,
)
def haversine(t: Tables) -> DataFrame:
    """Miles between customer and supplier, over all order lines.

    Orders meet their customers first, so lines are shuffled once; a hot order is left to
    adaptive execution, and the only aggregate is partial, by nation.
    """
    customers = t["customer"].select("c_custkey", "c_nationkey")
    orders = t["orders"].select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    legs = t["lineitem"].select("l_orderkey", "l_suppkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    here, there = _at("c_custkey"), _at("l_suppkey")
    far = legs.select(
        "c_nationkey",
        haversine_distance(*here, *there).alias("miles"),
        haversine_distance(*here, *there, unit="km").alias("km"),
    )
    return far.groupBy("c_nationkey").agg(
        F.count("*").alias("n_lines"),
        F.round(F.sum("miles"), 1).alias("total_miles"),
        F.round(F.max("km"), 4).alias("longest_km"),
    )
