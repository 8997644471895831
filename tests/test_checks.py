"""Every check with a passing and a failing case, and how failures become a verdict."""

import pytest
from pyspark.sql import functions as F

from tierkit import checks as q
from tierkit.sources import create_layers


def failures(df, check):
    return q.run_checks([(df, check)]).first()["failures"]


@pytest.fixture(scope="module")
def people(table):
    return table(
        "id int, city string, n int, g string",
        (1, "Turku", 5, "x"),
        (2, "Bergen", None, "x"),
        (3, "Aarhus", 7, "y"),
        (4, None, None, "y"),
        (4, " ", 5, "z"),
    )


class TestRowChecks:
    def test_not_null(self, people):
        assert failures(people, q.not_null("id")) == 0
        assert failures(people, q.not_null("n")) == 2
        assert q.not_null("n").violations(people).count() == 2

    def test_accepted_values(self, people):
        assert failures(people, q.accepted_values("g", ["x", "y", "z"])) == 0
        assert failures(people, q.accepted_values("city", ["Turku", "Bergen"])) == 2

    def test_not_accepted_values(self, people, rows):
        assert failures(people, q.not_accepted_values("city", ["Malmo", "Narvik"])) == 0
        check = q.not_accepted_values("g", ["x", "y", "w"])
        assert failures(people, check) == 2
        assert rows(check.violations(people)) == [("x", 2), ("y", 2)]

    def test_expression(self, table, people):
        pairs = table("net int, tax int", (80, 20), (95, 5), (60, 40), (100, 0))
        assert failures(pairs, q.expression_is_true("net + tax = 100")) == 0
        assert failures(pairs, q.expression_is_true("net = 95").only("tax between 1 and 10")) == 0
        assert failures(pairs, q.expression_is_true(F.col("tax") * 2 <= 40)) == 1
        assert failures(people, q.expression_is_true("n > 4")) == 0

    def test_not_empty_string(self, table, people):
        assert failures(people, q.not_empty_string("city", trim_whitespace=False)) == 0
        assert failures(people, q.not_empty_string("city")) == 1
        assert failures(table("s string", "\t", "a", None), q.not_empty_string("s")) == 0

    @pytest.mark.parametrize(
        "bounds, expected",
        [
            (dict(min_value=3, max_value=60), 0),
            (dict(min_value=2.5, max_value=60.5, inclusive=False), 0),
            (dict(min_value=3, max_value=60, inclusive=False), 2),
            (dict(min_value=17), 1),
            (dict(max_value=59), 1),
            (dict(max_value=17, inclusive=False), 2),
        ],
    )
    def test_accepted_range(self, table, bounds, expected):
        assert failures(table("id int", 3, 17, 60, None), q.accepted_range("id", **bounds)) == expected

    def test_accepted_range_needs_a_bound(self, spark):
        with pytest.raises(ValueError):
            q.accepted_range("id")

    def test_assert_equal(self, table):
        assert failures(table("a int, b int", (1, 1), (None, None)), q.assert_equal("a", "b")) == 0
        assert failures(table("a int, b int", (1, 2), (None, 1)), q.assert_equal("a", "b")) == 2


class TestGroupChecks:
    def test_unique(self, people, table, rows):
        assert failures(people, q.unique("city")) == 0
        assert rows(q.unique("id").violations(people)) == [(4, 2)]
        assert failures(table("a int", None, None), q.unique("a")) == 0

    def test_unique_combination(self, people, table):
        assert failures(people, q.unique_combination(["id", "city"])) == 0
        assert failures(people, q.unique_combination(["g"])) == 2
        assert failures(table("a int, b int", (None, 1), (None, 1)), q.unique_combination(["a", "b"])) == 1

    def test_relationships(self, table, rows):
        child, parent = table("id int", 1, 2, 4, 4, None), table("id int", 1, 2, 3, 3)
        assert failures(child, q.relationships("id", parent, "id", from_condition="id <> 4")) == 0
        check = q.relationships("id", parent, "id")
        assert rows(check.violations(child)) == [(4, 2)]
        assert failures(child, check) == 2
        assert failures(child, q.relationships("id", parent, "id", to_condition="id <> 2")) == 3

    def test_at_least_one(self, people, rows, table):
        assert failures(people, q.at_least_one("n")) == 0
        assert failures(people.filter("id = 2"), q.at_least_one("n")) == 1
        assert rows(q.at_least_one("n", ["id"]).violations(people)) == [(2, 0)]
        assert failures(people, q.at_least_one("n", ["g"])) == 0

    def test_not_constant(self, people, rows):
        assert failures(people, q.not_constant("n")) == 0
        assert failures(people.filter("n = 5"), q.not_constant("n")) == 1
        assert failures(people.filter("n is null"), q.not_constant("n")) == 0
        assert rows(q.not_constant("n", ["g"]).violations(people), "g") == [("x",), ("y",), ("z",)]
        assert failures(people, q.not_constant("id", ["g"])) == 1

    def test_not_null_proportion(self, people, rows, spark):
        assert failures(people, q.not_null_proportion("n", 0.6, 0.6)) == 0
        assert failures(people, q.not_null_proportion("n", 0.9)) == 1
        assert failures(people, q.not_null_proportion("n", 0, 0.5)) == 1
        assert rows(q.not_null_proportion("n", 0.9, group_by=["g"]).violations(people)) == [("x", 0.5), ("y", 0.5)]
        empty = people.limit(0)
        assert failures(empty, q.not_null_proportion("n", 0.9)) == 0
        assert q.not_null_proportion("n", 0.9).violations(empty).count() == 0

    def test_recency(self, table, rows):
        seen = table("g string, at string", ("a", "2024-01-09 12:00:00"), ("a", "2024-01-01 00:00:00"), ("b", "2024-01-08 00:00:00"))
        for kind in ("timestamp", "timestamp_ntz"):
            df = seen.withColumn("at", F.col("at").cast(kind))
            assert failures(df, q.recency("at", "day", 1, as_of="2024-01-10 12:00:00")) == 0
            assert failures(df, q.recency("at", "day", 1, as_of="2024-01-10 12:00:01")) == 1
            day = q.recency("at", "day", 1, as_of="2024-01-10 23:00:00", ignore_time_component=True)
            assert failures(df, day) == 0
            grouped = q.recency("at", "day", 1, as_of="2024-01-10 01:00:00", group_by=["g"])
            assert rows(grouped.violations(df), "g") == [("b",)]
        assert failures(df, q.recency("at", "day", 1)) == 1
        assert failures(df.withColumn("at", F.localtimestamp()), q.recency("at", "day", 1)) == 0
        assert failures(df.limit(0), q.recency("at", "day", 1)) == 0
        assert failures(df.limit(0), q.recency("at", "day", 1, empty_fails=True)) == 1


class TestComparisons:
    def test_equal_rowcount(self, table, rows):
        a, b = table("f int", 1, 1, 2), table("f int", 1, 2, 2)
        assert failures(a, q.equal_rowcount(b)) == 0
        assert failures(a, q.equal_rowcount(b, ["f"])) == 2
        assert failures(a, q.equal_rowcount(a, ["f"])) == 0
        one_sided = q.equal_rowcount(table("f int", 1, 1), ["f"])
        assert rows(one_sided.violations(a)) == [(1, 2, 2, 0), (2, 1, 0, 1)]

    def test_null_groups_meet(self, table):
        a = table("f int", None, None, 1)
        assert failures(a, q.equal_rowcount(table("f int", None, 1, None), ["f"])) == 0

    def test_fewer_rows_than(self, table, rows):
        a, b = table("g int, f int", (1, 1), (1, 2), (1, 3)), table("g int, f int", (1, 1), (1, 2), (1, 3), (1, 4))
        assert failures(a, q.fewer_rows_than(b)) == 0
        assert failures(a, q.fewer_rows_than(b, ["g"])) == 0
        assert failures(b, q.fewer_rows_than(a)) == 1
        assert failures(a, q.fewer_rows_than(a)) == 1
        assert failures(a, q.fewer_rows_than(table("g int", 2), ["g"])) == 3
        assert failures(a.limit(0), q.fewer_rows_than(b.limit(0))) == 1

    def test_equality(self, table, rows):
        a, b = table("x int, y string", (1, "a"), (2, None), (2, None)), table("x int, y string", (1, "a"), (2, None))
        assert failures(a, q.equality(b)) == 0
        assert failures(a, q.equality(b, multiset=True)) == 2
        c = table("x int, y string", (1, "b"), (3, "c"))
        assert failures(a, q.equality(c)) == 4
        assert failures(a, q.equality(table("x int, y string", (1, "a")))) == 2
        assert failures(a, q.equality(c, ["x"])) == 2
        assert rows(q.equality(c, ["x"]).violations(a)) == [("a_minus_b", 2), ("b_minus_a", 3)]

    def test_cardinality_equality(self, table, rows):
        a, b = table("v int", 1, 2, 3, None), table("w int", 2, 3, 1, None)
        assert failures(a, q.cardinality_equality("v", b, "w")) == 0
        c = table("w int", 1, 1, 2, 4, None)
        check = q.cardinality_equality("v", c, "w")
        assert rows(check.violations(a)) == [(1, 1, 2, 2), (3, 1, 0, 1), (4, 0, 1, 1)]
        assert failures(a, check) == 4

    def test_columns_match_set(self, people, rows):
        assert failures(people, q.columns_match_set(["ID", "City", "n", "g"])) == 0
        check = q.columns_match_set(["id", "city", "age"])
        assert rows(check.violations(people)) == [("AGE", "missing"), ("G", "extra"), ("N", "extra")]


class TestVerdicts:
    def test_thresholds(self, people):
        nulls = q.not_null("n")
        plan = [
            (people, nulls),
            (people, nulls.limits("warn")),
            (people, nulls.limits(warn_if="> 1", error_if="> 2")),
            (people, nulls.limits(warn_if="< 0", error_if="< 1")),
            (people, q.not_null("id").limits(warn_if="< 0", error_if="< 1")),
            (people, q.unique("id").named("ids")),
        ]
        found = {}
        metrics = q.run_checks(plan)
        assert metrics.columns == ["check", "failures", "should_warn", "should_error", "status"]
        for row in metrics.collect():
            found.setdefault(row["check"], []).append((row["failures"], row["status"]))
        assert sorted(found["not_null_n"]) == [(2, "error"), (2, "pass"), (2, "warn"), (2, "warn")]
        assert found["not_null_id"] == [(0, "error")]
        assert found["ids"] == [(1, "error")]

    def test_gate(self, people):
        good = [(people, q.not_null("id")), (people, q.not_null("n").limits("warn"))]
        assert [r["status"] for r in q.gate(q.run_checks(good))] == ["pass", "warn"]
        with pytest.raises(q.ChecksFailed, match=r"not_null_n \(2\)"):
            q.gate(q.run_checks([*good, (people, q.not_null("n"))]))

    def test_unknown_severity(self, people):
        with pytest.raises(ValueError):
            q.not_null("n").limits("fatal")

    def test_tallies_share_one_scan(self, people, spark, tmp_path):
        stored = str(tmp_path / "people")
        people.write.parquet(stored)
        df = spark.read.parquet(stored)
        plan = [(df, q.not_null(c)) for c in df.columns] + [(df, q.at_least_one("n")), (df, q.not_constant("g"))]
        text = q.run_checks(plan)._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan parquet") == 1

    def test_store_failures(self, people, spark, rows, tmp_path):
        gold = create_layers(spark, str(tmp_path), "audit_")["gold"]
        for _ in range(2):
            assert rows(q.store_failures(people, q.not_null("n"), f"{gold}.n_missing"), "id") == [(2,), (4,)]
