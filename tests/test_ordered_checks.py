"""Checks over an order: fixtures, brute force, any partitioning, and a hot group."""

import datetime
import random
from collections import Counter
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierkit.checks import mutually_exclusive_ranges, run_checks, sequential_values


def failures(df, check):
    return run_checks([(df, check)]).first()["failures"]


def dates(df, *columns):
    return df.withColumns({c: F.col(c).cast("date") for c in columns})


class TestRanges:
    def test_shifts_of_one_machine(self, table):
        """Shifts that follow at once: 6-14, 14-22, 22-30; without the second there is a gap of eight hours."""
        shifts = table("starts int, ends int", (22, 30), (6, 14), (14, 22))
        verdicts = {g: failures(shifts, mutually_exclusive_ranges("starts", "ends", gaps=g)) for g in ("allowed", "not_allowed", "required")}
        assert verdicts == {"allowed": 0, "not_allowed": 0, "required": 2}
        apart = shifts.filter("starts <> 14")
        verdicts = {g: failures(apart, mutually_exclusive_ranges("starts", "ends", gaps=g)) for g in verdicts}
        assert verdicts == {"allowed": 0, "not_allowed": 1, "required": 0}

    def test_leases_by_flat_with_an_open_end(self, table):
        leases = dates(
            table(
                "flat string, moved_in string, moved_out string",
                ("attic", "2011-07-15", "2013-02-28"),
                ("attic", "2013-02-28", "2016-09-30"),
                ("attic", "2016-11-01", None),
                ("cellar", "2010-01-10", "2010-01-20"),
                ("cellar", "2010-01-15", "2010-03-01"),
            ),
            "moved_in",
            "moved_out",
        )
        until = "coalesce(moved_out, date'9999-12-31')"
        found = {g: failures(leases, mutually_exclusive_ranges("moved_in", until, ["flat"], gaps=g)) for g in ("allowed", "not_allowed", "required")}
        # the cellar overlaps in any case; the attic has a gap, and one lease that begins as another ends
        assert found == {"allowed": 1, "not_allowed": 2, "required": 2}
        assert failures(leases, mutually_exclusive_ranges("moved_in", "moved_out", ["flat"])) == 2

    def test_a_range_without_length(self, table):
        moments = table("a double, b double", (-1.5, 0.0), (0.0, 0.0), (0.25, 9.0))
        assert failures(moments, mutually_exclusive_ranges("a", "b", zero_length_range_allowed=True)) == 0
        assert failures(moments, mutually_exclusive_ranges("a", "b")) == 1

    def test_unknown_gaps(self):
        with pytest.raises(ValueError):
            mutually_exclusive_ranges("a", "b", gaps="sometimes")


class TestSequences:
    def test_steps_of_seven(self, table, rows):
        df = table("shelf string, v int", ("low", -7), ("low", 0), ("high", 7), ("high", 14), ("low", 21))
        assert failures(df, sequential_values("v", interval=7)) == 0
        assert failures(df, sequential_values("v", interval=7, group_by=["shelf"])) == 1
        assert rows(sequential_values("v", 7).violations(df.filter("v <> 14"))) == [(21, 7, 1)]

    def test_half_days(self, table):
        df = table("t string", "1999-12-31 12:00", "2000-01-01 00:00", "2000-01-01 12:00")
        for kind in ("timestamp", "timestamp_ntz"):
            typed = df.select(F.col("t").cast(kind))
            assert failures(typed, sequential_values("t", 12, datepart="hour")) == 0
            assert failures(typed, sequential_values("t", 1, datepart="day")) == 2

    def test_copies_and_nulls(self, table, rows):
        df = table("v int", 1, 2, 2, 2, 3, None, None)
        assert rows(sequential_values("v").violations(df)) == [(2, 2, 2)]
        assert failures(df, sequential_values("v", interval=0)) == 2


def ranges_by_hand(data, gaps, zero):
    """(group, lower, upper, next lower) -> number of violating rows."""
    fits = {"not_allowed": lambda u, n: u == n, "allowed": lambda u, n: u <= n, "required": lambda u, n: u < n}[gaps]
    found = Counter()

    def late(v):
        return (v is None, v if v is not None else 0)

    ordered = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, late(r[1]), late(r[2])))
    for group, members in groupby(ordered, key=lambda r: r[0]):
        members = list(members)
        for i, (_, low, up) in enumerate(members):
            following = members[i + 1][1] if i + 1 < len(members) else None
            sound = low is not None and up is not None and (low <= up if zero else low < up)
            clear = up is None or following is None or fits(up, following)
            if not (sound and clear):
                found[(group, low, up, following)] += 1
    return found


def sequence_by_hand(data, interval):
    found = Counter()
    ordered = sorted((r for r in data if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for group, members in groupby(ordered, key=lambda r: r[0]):
        values = [v for _, v in members]
        for previous, value in zip(values, values[1:]):
            if value != previous + interval:
                found[(group, value, previous)] += 1
    return found


def counted(df):
    return Counter({tuple(r)[:-1]: r[-1] for r in df.collect()})


GROUPS = st.one_of(st.none(), st.integers(0, 3))
BOUND = st.one_of(st.none(), st.integers(0, 12))
QUIET = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**QUIET)
@given(
    data=st.lists(st.tuples(GROUPS, BOUND, BOUND), max_size=40),
    gaps=st.sampled_from(["allowed", "required", "not_allowed"]),
    zero=st.booleans(),
    partitions=st.sampled_from([1, 4, 17]),
)
def test_ranges_against_brute_force(spark, data, gaps, zero, partitions):
    df = spark.createDataFrame(data, "g int, a int, b int")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check = mutually_exclusive_ranges("a", "b", ["g"], gaps, zero)
        assert counted(check.violations(df)) == ranges_by_hand(data, gaps, zero)
        ungrouped = mutually_exclusive_ranges("a", "b", gaps=gaps, zero_length_range_allowed=zero)
        by_hand = ranges_by_hand([(0, a, b) for _, a, b in data], gaps, zero)
        assert counted(ungrouped.violations(df)) == Counter({k[1:]: n for k, n in by_hand.items()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(**QUIET)
@given(
    data=st.lists(st.tuples(GROUPS, st.one_of(st.none(), st.integers(0, 20))), max_size=40),
    interval=st.sampled_from([0, 1, 2]),
    partitions=st.sampled_from([1, 4, 17]),
)
def test_sequences_against_brute_force(spark, data, interval, partitions):
    df = spark.createDataFrame(data, "g int, v int")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check = sequential_values("v", interval, group_by=["g"])
        assert counted(check.violations(df)) == sequence_by_hand(data, interval)
        by_hand = sequence_by_hand([(0, v) for _, v in data], interval)
        assert counted(sequential_values("v", interval).violations(df)) == Counter(
            {k[1:]: n for k, n in by_hand.items()}
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_group_is_spread_and_exact(spark):
    """One group holds most rows; its few breaks are found across tasks and Arrow batches."""
    n, holes = 60_000, {17, 20_000, 20_001, 45_678}
    hot = spark.range(n).filter(~F.col("id").isin(*holes)).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    df = hot.union(spark.range(3000).select((F.col("id") % 100 + 2).cast("int"), F.floor(F.col("id") / 100)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = counted(sequential_values("v", group_by=["g"]).violations(df))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == Counter({(1, 18, 16): 1, (1, 20_002, 19_999): 1, (1, 45_679, 45_677): 1})


def test_no_window_over_everything(spark):
    """Neither groups nor the whole table are put into one task."""
    df = spark.range(100).select(F.col("id").alias("v"))
    plan = sequential_values("v").violations(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "rangepartitioning" in plan


def test_order_of_many_types(spark, rows):
    """Neighbours come back unchanged for the types a range may have."""
    rng = random.Random(3)
    stamps = sorted(datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=rng.randrange(10**6)) for _ in range(30))
    for kind in ("timestamp_ntz", "timestamp", "date", "string", "decimal(20,3)", "double"):
        source = [str(i).zfill(4) for i in range(30)] if kind in ("string", "decimal(20,3)", "double") else [str(s) for s in stamps]
        df = spark.createDataFrame([(s,) for s in source], "s string").select(F.col("s").cast(kind).alias("a"))
        check = mutually_exclusive_ranges("a", "a", gaps="not_allowed")
        got = check.violations(df.distinct())
        assert dict(got.dtypes)["next_lower_bound"] == kind
        ordered = [r[0] for r in df.distinct().orderBy("a").collect()]
        assert sorted((r.lower_bound, r.next_lower_bound) for r in got.collect() if r.next_lower_bound is not None) == list(
            zip(ordered, ordered[1:])
        )
