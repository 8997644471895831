"""Joins by distance: suppliers within reach of a customer, and the nearest ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.operators import nearest, within_distance
from tierkit.workload.registry import Tables, query

_PLACES = """
    WITH customers AS (
        SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 48.1 + (c_custkey % 1000)::DOUBLE / 10000
                          ELSE ((c_custkey * 7919) % 18001)::DOUBLE / 100 - 90 END AS c_lat,
               CASE WHEN c_custkey % 3 = 0 THEN 11.5 + (c_custkey % 997)::DOUBLE / 10000
                    ELSE ((c_custkey * 104729) % 36001)::DOUBLE / 100 - 180 END AS c_lon
        FROM customer),
    suppliers AS (
        SELECT s_suppkey, ((s_suppkey * 7919 + 57) % 18001)::DOUBLE / 100 - 90 AS s_lat,
               ((s_suppkey * 104729 + 911) % 36001)::DOUBLE / 100 - 180 AS s_lon
        FROM supplier),
    legs AS (
        SELECT c_custkey, s_suppkey, 2 * 3961 * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(s_lat - c_lat) / 2), 2)
               + cos(radians(c_lat)) * cos(radians(s_lat)) * pow(sin(radians(s_lon - c_lon) / 2), 2)))) AS miles
        FROM customers, suppliers)
"""


def _customers(t: Tables) -> DataFrame:
    """Customers with a place; every third lives in one town."""
    key, town = F.col("c_custkey"), F.col("c_custkey") % 3 == 0
    lat = F.when(town, F.lit(48.1) + (key % 1000).cast("double") / 10000).otherwise(((key * 7919) % 18001).cast("double") / 100 - 90)
    lon = F.when(town, F.lit(11.5) + (key % 997).cast("double") / 10000).otherwise(((key * 104729) % 36001).cast("double") / 100 - 180)
    return t["customer"].select("c_custkey", lat.alias("c_lat"), lon.alias("c_lon"))


def _suppliers(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    lat = ((key * 7919 + 57) % 18001).cast("double") / 100 - 90
    lon = ((key * 104729 + 911) % 36001).cast("double") / 100 - 180
    return t["supplier"].select("s_suppkey", lat.alias("s_lat"), lon.alias("s_lon"))


@query(
    "within_distance",
    _PLACES + "SELECT c_custkey, s_suppkey, round(miles * 1.60934, 3) AS km FROM legs WHERE miles * 1.60934 <= 700",
)
def suppliers_in_reach(t: Tables) -> DataFrame:
    """Customers and the suppliers within 700 km; the suppliers, being fewer, touch eight cells each."""
    near = within_distance(_suppliers(t), _customers(t), 700, ("s_lat", "s_lon"), ("c_lat", "c_lon"), "km", "km")
    return near.select("c_custkey", "s_suppkey", F.round("km", 3).alias("km"))


@query(
    "nearest",
    _PLACES
    + """, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY round(miles, 6), s_suppkey) AS rank FROM legs)
    SELECT c_custkey, CAST(rank AS INTEGER) AS rank, s_suppkey, round(miles, 3) AS miles FROM ranked WHERE rank <= 3
    """,
)
def nearest_suppliers(t: Tables) -> DataFrame:
    """The three nearest suppliers of every customer."""
    found = nearest(
        _customers(t), _suppliers(t), 3, ["s_suppkey"], ("c_lat", "c_lon"), ("s_lat", "s_lon"), distance="miles"
    )
    return found.select("c_custkey", "rank", "s_suppkey", F.round("miles", 3).alias("miles"))
