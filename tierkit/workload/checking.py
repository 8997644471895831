"""Every check over the test tables; violations or metrics beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit import checks as q
from tierkit.functions import url_parameter
from tierkit.operators import single_value
from tierkit.checks.core import store_failures
from tierkit.sources import create_layers
from tierkit.workload.registry import Tables, fresh_root, query


@query("chk_not_null", "SELECT event_id, user_id FROM events WHERE nullif(event_type, 'error') IS NULL")
def not_null(t: Tables) -> DataFrame:
    events = t["events"].withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))
    return q.not_null("event_type").violations(events).select("event_id", "user_id")


@query(
    "chk_unique",
    """
    SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
    GROUP BY 1 HAVING count(*) > 1
    """,
)
def unique(t: Tables) -> DataFrame:
    return q.unique("l_orderkey").violations(t["lineitem"])


@query(
    "chk_unique_combo",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def unique_combination(t: Tables) -> DataFrame:
    return q.unique_combination(["l_orderkey", "l_linenumber"]).violations(t["lineitem"])


@query(
    "chk_accepted_values",
    """
    SELECT lang AS value_field, count(*) AS n_records FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1
    """,
)
def accepted_values(t: Tables) -> DataFrame:
    return q.accepted_values("lang", ["en", "fr"]).violations(t["documents"])


@query(
    "chk_not_accepted",
    """
    SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type IN ('error', 'spam') GROUP BY 1
    """,
)
def not_accepted_values(t: Tables) -> DataFrame:
    return q.not_accepted_values("event_type", ["error", "spam"]).violations(t["events"])


@query(
    "chk_relationships",
    """
    SELECT doc_id AS from_field, count(*) AS n_rows FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1
    """,
)
def relationships(t: Tables) -> DataFrame:
    return q.relationships("doc_id", t["labels"], "doc_id").violations(t["documents"])


@query(
    "chk_relationships_where",
    """
    SELECT o_custkey AS from_field, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F'
    AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1
    """,
)
def relationships_where(t: Tables) -> DataFrame:
    check = q.relationships(
        "o_custkey", t["customer"], "c_custkey", "o_orderstatus = 'F'", "c_mktsegment <> 'BUILDING'"
    )
    return check.violations(t["orders"])


def _order_keys(t: Tables) -> tuple[DataFrame, DataFrame]:
    lines = t["lineitem"].select(F.nullif(F.col("l_orderkey"), F.lit(7)).alias("order_key"))
    return lines, t["orders"].select(F.col("o_orderkey").alias("order_key"))


SIDE_COUNTS = """
    WITH a AS (SELECT nullif(l_orderkey, 7) AS order_key, count(*) AS n FROM lineitem GROUP BY 1),
         b AS (SELECT o_orderkey AS order_key, count(*) AS n FROM orders GROUP BY 1),
         sides AS (SELECT coalesce(a.order_key, b.order_key) AS order_key, coalesce(a.n, 0) AS count_a,
                          coalesce(b.n, 0) AS count_b FROM a FULL JOIN b ON a.order_key IS NOT DISTINCT FROM b.order_key)
"""


@query(
    "chk_equal_rowcount",
    SIDE_COUNTS + "SELECT order_key, count_a, count_b, abs(count_a - count_b) AS diff_count FROM sides",
)
def equal_rowcount(t: Tables) -> DataFrame:
    lines, orders = _order_keys(t)
    return q.equal_rowcount(orders, ["order_key"]).violations(lines)


@query(
    "chk_fewer_rows",
    SIDE_COUNTS
    + """
    SELECT order_key, count_a, count_b,
           CASE WHEN count_a > count_b THEN count_a - count_b WHEN count_a = count_b THEN 1 ELSE 0 END AS row_count_delta
    FROM sides
    """,
)
def fewer_rows_than(t: Tables) -> DataFrame:
    lines, orders = _order_keys(t)
    return q.fewer_rows_than(orders, ["order_key"]).violations(lines)


@query(
    "chk_equality",
    """
    WITH a AS (SELECT o_orderkey AS orderkey FROM orders), b AS (SELECT l_orderkey AS orderkey FROM lineitem)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT orderkey FROM a EXCEPT SELECT orderkey FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT orderkey FROM b EXCEPT SELECT orderkey FROM a)
    """,
)
def equality(t: Tables) -> DataFrame:
    """Order numbers that only the orders, or only their lines, have."""
    lines = t["lineitem"].withColumnRenamed("l_orderkey", "orderkey")
    return q.equality(lines, ["orderkey"]).violations(t["orders"].withColumnRenamed("o_orderkey", "orderkey"))


@query(
    "chk_equality_multiset",
    """
    WITH both_sides AS (SELECT o_custkey AS key, 1 AS a, 0 AS b FROM orders UNION ALL SELECT l_partkey, 0, 1 FROM lineitem)
    SELECT CASE WHEN sum(a) > sum(b) THEN 'a_minus_b' ELSE 'b_minus_a' END AS which_diff, key,
           CAST(sum(a) AS BIGINT) AS count_a, CAST(sum(b) AS BIGINT) AS count_b
    FROM both_sides GROUP BY key HAVING sum(a) <> sum(b)
    """,
)
def equality_multiset(t: Tables) -> DataFrame:
    """Numbers that do not come as often as customers of orders and as parts of lines."""
    lines = t["lineitem"].withColumnRenamed("l_partkey", "key")
    return q.equality(lines, ["key"], multiset=True).violations(t["orders"].withColumnRenamed("o_custkey", "key"))


@query(
    "chk_cardinality",
    """
    WITH a AS (SELECT o_orderkey AS value_field, count(*) AS n FROM orders GROUP BY 1),
         b AS (SELECT l_orderkey AS value_field, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT coalesce(a.value_field, b.value_field) AS value_field, coalesce(a.n, 0) AS count_a,
           coalesce(b.n, 0) AS count_b, CAST(a.n IS NOT NULL AS INT) + CAST(b.n IS NOT NULL AS INT) AS n_rows
    FROM a FULL JOIN b ON a.value_field IS NOT DISTINCT FROM b.value_field
    WHERE a.n IS DISTINCT FROM b.n
    """,
)
def cardinality_equality(t: Tables) -> DataFrame:
    return q.cardinality_equality("o_orderkey", t["lineitem"], "l_orderkey").violations(t["orders"])


@query(
    "chk_expression",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem
    WHERE NOT (nullif(l_quantity, 50) * l_tax < 3 AND l_linestatus IN ('O', 'F'))
    """,
)
def expression_is_true(t: Tables) -> DataFrame:
    check = q.expression_is_true("nullif(l_quantity, 50) * l_tax < 3 AND l_linestatus IN ('O', 'F')")
    return check.violations(t["lineitem"]).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")


@query(
    "chk_range",
    """
    SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount < 0.02 OR l_discount > 0.08
    """,
)
def accepted_range(t: Tables) -> DataFrame:
    check = q.accepted_range("l_discount", 0.02, 0.08)
    return check.violations(t["lineitem"]).select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "chk_not_empty",
    """
    SELECT page_id FROM pages WHERE nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') IS NULL
    """,
)
def not_empty_string(t: Tables) -> DataFrame:
    pages = t["pages"].withColumn("number", F.coalesce(url_parameter("url", "page"), F.lit("  ")))
    return q.not_empty_string("number").violations(pages).select("page_id")


@query(
    "chk_null_proportion",
    """
    SELECT user_id, count(CASE WHEN value <= 20 THEN value END) / count(*) AS not_null_proportion FROM events
    GROUP BY 1 HAVING not_null_proportion < 0.4 OR not_null_proportion > 0.8
    """,
)
def not_null_proportion(t: Tables) -> DataFrame:
    events = t["events"].withColumn("small", F.when(F.col("value") <= 20, F.col("value")))
    return q.not_null_proportion("small", 0.4, 0.8, group_by=["user_id"]).violations(events)


@query(
    "chk_recency",
    """
    SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, DATE '2024-01-29' AS threshold FROM events
    WHERE event_type = 'purchase' GROUP BY 1 HAVING CAST(max(ts) AS DATE) < DATE '2024-01-29'
    """,
)
def recency_by_day(t: Tables) -> DataFrame:
    check = q.recency("ts", "day", 2, as_of="2024-01-31", ignore_time_component=True, group_by=["user_id"])
    return check.only("event_type = 'purchase'").violations(t["events"])


@query(
    "chk_recency_time",
    """
    SELECT user_id, epoch_us(max(ts)) AS latest FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 06:30:00'
    """,
)
def recency_by_hour(t: Tables) -> DataFrame:
    check = q.recency("ts", "hour", 18, as_of="2024-01-31 00:30:00", group_by=["user_id"])
    return check.violations(t["events"]).select("user_id", _micros("most_recent").alias("latest"))


@query(
    "chk_at_least_one",
    """
    SELECT user_id, count(CASE WHEN value > 300 THEN value END) AS n_filled FROM events GROUP BY 1 HAVING n_filled = 0
    """,
)
def at_least_one(t: Tables) -> DataFrame:
    events = t["events"].withColumn("big", F.when(F.col("value") > 300, F.col("value")))
    return q.at_least_one("big", ["user_id"]).violations(events)


@query(
    "chk_not_constant",
    """
    SELECT l_orderkey, min(l_returnflag) AS min_value, max(l_returnflag) AS max_value FROM lineitem GROUP BY 1
    HAVING count(DISTINCT l_returnflag) = 1
    """,
)
def not_constant(t: Tables) -> DataFrame:
    return q.not_constant("l_returnflag", ["l_orderkey"]).violations(t["lineitem"])


def _micros(column: str):
    """Microseconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))


def _ranges_sql(source: str, group: str, bad: str) -> str:
    """Windowed SQL of the range check; equal violations are counted."""
    by = f"PARTITION BY {group}" if group else ""
    shown = f"{group}, " if group else ""
    return f"""
    WITH w AS (SELECT *, lead(lower_bound) OVER ({by} ORDER BY lower_bound, upper_bound) AS next_lower_bound
               FROM ({source}))
    SELECT {shown}lower_bound, upper_bound, next_lower_bound, count(*) AS n_rows FROM w WHERE {bad} GROUP BY ALL
    """


@query(
    "chk_ranges",
    _ranges_sql(
        "SELECT user_id, epoch_us(ts) AS lower_bound, epoch_us(ts) + 3600000000 * (event_id % 3) AS upper_bound FROM events",
        "user_id",
        "NOT (lower_bound < upper_bound AND coalesce(upper_bound <= next_lower_bound, true))",
    ),
)
def ranges_by_user(t: Tables) -> DataFrame:
    events = t["events"].withColumn("start", _micros("ts"))
    spans = events.withColumn("stop", F.col("start") + F.lit(3600000000) * (F.col("event_id") % 3))
    return q.mutually_exclusive_ranges("start", "stop", ["user_id"]).violations(spans)


@query(
    "chk_ranges_global",
    _ranges_sql(
        "SELECT nullif(l_orderkey, 5) AS lower_bound, nullif(l_orderkey + l_linenumber - 1, 9) AS upper_bound FROM lineitem",
        "",
        """NOT (coalesce(lower_bound <= upper_bound, false) AND coalesce(upper_bound < next_lower_bound, true))""",
    ),
)
def ranges_global(t: Tables) -> DataFrame:
    spans = t["lineitem"].select(
        F.nullif(F.col("l_orderkey"), F.lit(5)).alias("a"),
        F.nullif(F.col("l_orderkey") + F.col("l_linenumber") - 1, F.lit(9)).alias("b"),
    )
    check = q.mutually_exclusive_ranges("a", "b", gaps="required", zero_length_range_allowed=True)
    return check.violations(spans)


@query(
    "chk_ranges_no_gaps",
    _ranges_sql(
        "SELECT o_custkey, epoch_us(o_orderdate) AS lower_bound, epoch_us(o_orderdate) + 86400000000 * 30 AS upper_bound "
        "FROM orders",
        "o_custkey",
        "NOT (lower_bound < upper_bound AND coalesce(upper_bound = next_lower_bound, true))",
    ),
)
def ranges_without_gaps(t: Tables) -> DataFrame:
    """Customers whose orders do not follow at exactly thirty days."""
    orders = t["orders"].withColumn("start", _micros("o_orderdate"))
    spans = orders.withColumn("stop", F.col("start") + F.lit(86400000000 * 30))
    return q.mutually_exclusive_ranges("start", "stop", ["o_custkey"], gaps="not_allowed").violations(spans)


@query(
    "chk_whole_table",
    """
    SELECT 'fresh' AS "check", CAST(max(ts) < TIMESTAMP '2024-01-30 00:00:00' AS BIGINT) AS failures FROM events
    UNION ALL SELECT 'stale', CAST(max(ts) < TIMESTAMP '2030-12-30 00:00:00' AS BIGINT) FROM events
    UNION ALL SELECT 'some_value', CAST(count(value) = 0 AS BIGINT) FROM events
    UNION ALL SELECT 'some_refund', CAST(count(CASE WHEN event_type = 'refund' THEN value END) = 0 AS BIGINT) FROM events
    """,
)
def whole_table(t: Tables) -> DataFrame:
    """Recency and at least one value without groups: one scan tells all four."""
    events = t["events"].withColumn("refund", F.when(F.col("event_type") == "refund", F.col("value")))
    plan = [
        (events, q.recency("ts", "day", 1, as_of="2024-01-31").named("fresh")),
        (events, q.recency("ts", "day", 1, as_of="2030-12-31").named("stale")),
        (events, q.at_least_one("value").named("some_value")),
        (events, q.at_least_one("refund").named("some_refund")),
    ]
    return q.run_checks(plan).select("check", "failures")


@query(
    "chk_stored_failures",
    "SELECT s_suppkey, s_acctbal FROM supplier WHERE NOT (s_acctbal >= 0)",
)
def stored_failures(t: Tables) -> DataFrame:
    """Violations kept as a table, read back."""
    root, tag = fresh_root(t)
    table = f"{create_layers(t.spark, root, tag)['gold']}.failures_balance"
    suppliers = t["supplier"].select("s_suppkey", "s_acctbal")
    return store_failures(suppliers, q.expression_is_true("s_acctbal >= 0"), table)


def _sequence_sql(source: str, group: str, bad: str) -> str:
    by = f"PARTITION BY {group}" if group else ""
    shown = f"{group}, " if group else ""
    return f"""
    WITH w AS (SELECT *, lag(value) OVER ({by} ORDER BY value) AS previous_value FROM ({source}))
    SELECT {shown}value, previous_value, count(*) AS n_rows FROM w WHERE {bad} GROUP BY ALL
    """


@query(
    "chk_sequential",
    _sequence_sql(
        "SELECT event_id + CAST(floor(user_id / 100) AS BIGINT) AS value FROM events",
        "",
        "value <> previous_value + 1",
    ),
)
def sequential_global(t: Tables) -> DataFrame:
    numbered = t["events"].select((F.col("event_id") + F.floor(F.col("user_id") / 100)).alias("number"))
    return q.sequential_values("number").violations(numbered)


@query(
    "chk_sequential_group",
    _sequence_sql(
        "SELECT l_orderkey, l_linenumber AS value FROM lineitem", "l_orderkey", "value <> previous_value + 1"
    ),
)
def sequential_lines(t: Tables) -> DataFrame:
    return q.sequential_values("l_linenumber", group_by=["l_orderkey"]).violations(t["lineitem"])


@query(
    "chk_sequential_days",
    """
    WITH w AS (SELECT o_orderpriority, o_orderstatus, o_orderdate AS value,
                      lag(o_orderdate) OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderdate) AS previous_value
               FROM orders)
    SELECT o_orderpriority, o_orderstatus, CAST(value AS DATE) AS day,
           CAST(previous_value AS DATE) AS previous_day,
           count(*) AS n_rows
    FROM w WHERE value <> previous_value + INTERVAL 1 DAY GROUP BY ALL
    """,
)
def sequential_days(t: Tables) -> DataFrame:
    check = q.sequential_values("o_orderdate", datepart="day", group_by=["o_orderpriority", "o_orderstatus"])
    return check.violations(t["orders"]).select(
        "o_orderpriority",
        "o_orderstatus",
        F.col("value").cast("date").alias("day"),
        F.col("previous_value").cast("date").alias("previous_day"),
        "n_rows",
    )


@query(
    "chk_assert_equal",
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE nullif(l_linestatus, 'O') IS DISTINCT FROM nullif(l_returnflag, 'A')
    """,
)
def assert_equal(t: Tables) -> DataFrame:
    lines = t["lineitem"].withColumns({
        "actual": F.nullif(F.col("l_linestatus"), F.lit("O")),
        "expected": F.nullif(F.col("l_returnflag"), F.lit("A")),
    })
    return q.assert_equal("actual", "expected").violations(lines).select("l_orderkey", "l_linenumber")


@query(
    "chk_columns_match",
    """
    SELECT column_name, problem, n_rows
    FROM (VALUES ('L_COMMENT', 'missing'), ('L_TAX', 'extra'), ('L_SHIPDATE', 'extra')) AS v(column_name, problem),
         (SELECT count(*) AS n_rows FROM lineitem)
    """,
)
def columns_match_set(t: Tables) -> DataFrame:
    """Columns missing or extra, with the number of rows concerned."""
    lines = t["lineitem"]
    expected = [c for c in lines.columns if c not in ("l_tax", "l_shipdate")] + ["l_comment"]
    found = q.columns_match_set(expected).violations(lines)
    return found.withColumn("n_rows", single_value(lines.agg(F.count("*"))))


@query(
    "chk_suite",
    """
    WITH n AS (
        SELECT 'tax_known' AS "check", count_if(nullif(l_tax, 0) IS NULL) AS failures, 'error' AS failed FROM lineitem
        UNION ALL SELECT 'discount_range', count_if(l_discount <= 0 OR l_discount >= 0.1), 'warn' FROM lineitem
        UNION ALL SELECT 'flags_forbidden', count(DISTINCT CASE WHEN l_returnflag IN ('A', 'R', 'X') THEN l_returnflag END),
                         'error' FROM lineitem
        UNION ALL SELECT 'status_varies', CAST(min(l_linestatus) = max(l_linestatus) AS INT), 'error' FROM lineitem
        UNION ALL SELECT 'tax_share', CAST(count(nullif(l_tax, 0)) / count(*) < 0.99 AS INT), 'error' FROM lineitem
        UNION ALL SELECT 'big_orders', count_if(o_totalprice > 400000), 'pass' FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT 'columns', 2, 'error'
        UNION ALL SELECT 'more_lines', abs((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders)), 'error')
    SELECT "check", CAST(failures AS BIGINT) AS failures, CASE WHEN failures = 0 THEN 'pass' ELSE failed END AS status FROM n
    """,
)
def suite(t: Tables) -> DataFrame:
    """Checks of several kinds in one job: all plain tallies over the lines share one scan."""
    lines = t["lineitem"].withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))
    orders = t["orders"]
    expected = [*lines.columns[1:], "l_comment"]
    plan = [
        (lines, q.not_null("l_tax").named("tax_known")),
        (lines, q.accepted_range("l_discount", 0, 0.1, inclusive=False).named("discount_range").limits("warn")),
        (lines, q.not_accepted_values("l_returnflag", ["A", "R", "X"]).named("flags_forbidden")),
        (lines, q.not_constant("l_linestatus").named("status_varies")),
        (lines, q.not_null_proportion("l_tax", 0.99).named("tax_share")),
        (
            orders,
            q.accepted_range("o_totalprice", max_value=400000)
            .named("big_orders")
            .only("o_orderstatus = 'P'")
            .limits(warn_if="> 1000000000000", error_if="< 0"),
        ),
        (lines, q.columns_match_set(expected).named("columns")),
        (lines, q.equal_rowcount(orders).named("more_lines")),
    ]
    return q.run_checks(plan).select("check", "failures", "status")
