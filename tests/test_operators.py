import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierkit.operators import (
    collect_values,
    column_values,
    date_bounds,
    date_spine,
    deduplicate,
    filtered_columns,
    generate_series,
    group_by_first,
    intervals_between,
    normalize_columns,
    null_blanks,
    pivot,
    pivot_columns,
    result_arrays,
    single_value,
    star,
    union_tables,
    unpivot,
)

DAY = datetime.date


@pytest.fixture(scope="module")
def two_tables(table):
    return {
        "ships": table("hull int, title string, length string", (70, "Gannet", "12.5"), (71, "Heron", "long")),
        "boats": table("hull int, owner string, length double", (9, "Ida", 4.0), (70, "Per", 3.5), (8, None, None)),
    }


class TestUnion:
    def test_superset_in_first_seen_order(self, two_tables, rows):
        df = union_tables(two_tables)
        assert df.columns == ["_source_relation", "hull", "title", "length", "owner"]
        assert rows(df) == sorted(
            [
                ("ships", 70, "Gannet", "12.5", None),
                ("ships", 71, "Heron", "long", None),
                ("boats", 9, None, "4.0", "Ida"),
                ("boats", 70, None, "3.5", "Per"),
                ("boats", 8, None, None, None),
            ],
            key=lambda r: [(v is not None, str(v)) for v in r],
        )

    def test_exclude_include_and_override(self, two_tables):
        assert union_tables(two_tables, exclude=["TITLE"], source_column=None).columns == ["hull", "length", "owner"]
        df = union_tables(two_tables, include=["HULL"], source_column="src", type_overrides={"hull": "string"})
        assert df.dtypes == [("src", "string"), ("hull", "string")]

    def test_where_in_every_branch(self, two_tables, rows):
        assert rows(union_tables(two_tables, include=["hull"], where="hull > 9"), "hull") == [(70,), (70,), (71,)]

    def test_errors(self, two_tables):
        with pytest.raises(ValueError):
            union_tables(two_tables, include=["hull"], exclude=["title"])
        with pytest.raises(ValueError):
            union_tables(two_tables, include=["nothing"])


class TestUnpivot:
    def test_booleans_and_nulls(self, table, rows):
        df = table("tank int, `fish.kind` string, fed boolean, note string", (3, "carp", False, "x"), (5, None, True, "y"))
        out = unpivot(df, exclude=["TANK"], remove=["note"], field_name="what", value_name="is")
        assert out.columns == ["tank", "what", "is"]
        assert rows(out) == [(3, "fed", "false"), (3, "fish.kind", "carp"), (5, "fed", "true"), (5, "fish.kind", None)]

    def test_one_scan(self, table):
        df = unpivot(table("k int, a int, b int, c int", (1, 2, 3, 4)), exclude=["k"])
        assert df.columns == ["k", "field_name", "value"]
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" in plan and "Union" not in plan

    def test_nothing_left(self, table):
        with pytest.raises(ValueError):
            unpivot(table("k int", 1), exclude=["k"])


class TestDeduplicate:
    def test_last_price(self, table, rows):
        df = table("item string, price int, day int", ("nut", 4, 9), ("bolt", 7, 2), ("nut", 5, 11), ("nut", 6, 3))
        assert rows(deduplicate(df, ["item"], [F.desc_nulls_last("day")])) == [("bolt", 7, 2), ("nut", 5, 11)]

    def test_nulls_sort_last_and_null_keys_group(self, table, rows):
        df = table("k int, v int", (1, None), (1, 5), (None, 3), (None, 2))
        assert rows(deduplicate(df, ["k"], ["v"])) == [(None, 2), (1, 5)]

    def test_limits_rows_before_the_shuffle(self, table):
        df = deduplicate(table("k int, v int", (1, 1)).repartition(3), ["k"], ["v"])
        plan = df._jdf.queryExecution().executedPlan().toString()
        before, _, after = plan.partition("Exchange hashpartitioning(k")
        assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


class TestPivot:
    def test_values_and_quotes(self, table, rows):
        df = table("port string, flag string", ("Kiel", "DE"), ("Kiel", "DE"), ("Kiel", "d'or"), ("Oslo", "NO"), ("Oslo", None))
        assert rows(pivot(df, ["port"], "flag", ["DE", "NO"])) == [("Kiel", 2, 0), ("Oslo", 0, 1)]
        slugged = pivot(df, ["port"], "flag", ["DE", "d'or"], slug_names=True, prefix="Flag ", suffix="-n")
        assert slugged.columns == ["port", "flag_de_n", "flag_dor_n"]
        assert rows(slugged) == [("Kiel", 2, 1), ("Oslo", 0, 0)]

    def test_other_comparisons(self, table, rows):
        df = table("g int, s string", (1, "apple"), (1, "APRICOT"), (1, None), (2, "plum"))
        cells = [
            *pivot_columns("s", ["a%"], cmp="like", prefix="like "),
            *pivot_columns("s", ["a%"], cmp="ilike", prefix="ilike "),
            *pivot_columns("s", [None], cmp="<=>", prefix="is "),
            *pivot_columns("s", [4], cmp=lambda c, n: F.length(c) > n, prefix="longer than "),
        ]
        out = df.groupBy("g").agg(*cells)
        assert out.columns == ["g", "like a%", "ilike a%", "is None", "longer than 4"]
        assert rows(out) == [(1, 1, 2, 1, 2), (2, 0, 0, 0, 0)]

    def test_comparison_cells_and_distinct(self, table, rows):
        df = table("g int, n int, v int", (1, 1, 10), (1, 2, 10), (1, 3, 30))
        cells = [
            *pivot_columns("n", [2], cmp=">=", then_value=F.col("v"), prefix="from_"),
            *pivot_columns("n", [2], cmp="<=", then_value=F.col("v"), else_value=None, distinct=True, prefix="to_"),
        ]
        assert rows(df.groupBy("g").agg(*cells)) == [(1, 40, 10)]
        mean = pivot_columns("n", [9], cmp="<", agg=F.avg, then_value=F.col("v"), else_value=None, distinct=True)
        assert rows(df.groupBy("g").agg(*mean)) == [(1, 20.0)]
        most = pivot_columns("n", [9], cmp="<", agg=F.max, then_value=F.col("v"), distinct=True)
        assert rows(df.groupBy("g").agg(*most)) == [(1, 30)]


def test_star(table, rows):
    df = table("hue string, tone string, weight int", ("r", "dark", 4), ("r", "dark", 5), ("g", "pale", 1), ("g", "dark", 2))
    assert df.select(*star(df, exclude=["WEIGHT"])).columns == ["hue", "tone"]
    renamed = df.alias("t").select(*star(df, prefix="c_", suffix="_x", relation_alias="t"))
    assert renamed.columns == ["c_hue_x", "c_tone_x", "c_weight_x"]
    totals = [("g", "dark", 2), ("g", "pale", 1), ("r", "dark", 9)]
    assert rows(df.groupBy(*star(df, exclude=["weight"])).agg(F.sum("weight"))) == totals
    assert rows(group_by_first(df, 2).agg(F.sum("weight"))) == totals


def test_null_blanks(table, rows):
    df = table("`p.q` string, r string, n int", ("", "x", 7), ("y", "", 8), (" ", None, 9))
    assert null_blanks(df).columns == ["p.q", "r", "n"]
    assert rows(null_blanks(df)) == [(None, "x", 7), (" ", None, 9), ("y", None, 8)]
    assert rows(null_blanks(df, ["r"])) == [("", "x", 7), (" ", None, 9), ("y", None, 8)]


class TestSeries:
    def test_generate_series(self, spark, rows):
        assert rows(generate_series(spark, 3)) == [(1,), (2,), (3,)]
        assert rows(generate_series(spark, None)) == []
        with pytest.raises(ValueError):
            generate_series(spark, 0)

    def test_day_spine_excludes_the_end(self, spark, rows):
        out = rows(date_spine(spark, "day", "2012-02-27", "2012-03-02"))
        assert out == [(DAY(2012, 2, 27),), (DAY(2012, 2, 28),), (DAY(2012, 2, 29),), (DAY(2012, 3, 1),)]

    @pytest.mark.parametrize(
        "part, start, end, expected",
        [
            ("month", DAY(2020, 1, 31), DAY(2020, 4, 30), [DAY(2020, 1, 31), DAY(2020, 2, 29), DAY(2020, 3, 31)]),
            ("month", DAY(2020, 1, 15), DAY(2020, 3, 20), [DAY(2020, 1, 15), DAY(2020, 2, 15), DAY(2020, 3, 15)]),
            ("week", DAY(2020, 1, 1), DAY(2020, 1, 15), [DAY(2020, 1, 1), DAY(2020, 1, 8)]),
            ("quarter", DAY(2020, 1, 1), DAY(2020, 7, 1), [DAY(2020, 1, 1), DAY(2020, 4, 1)]),
            ("year", DAY(2020, 1, 1), DAY(2021, 1, 2), [DAY(2020, 1, 1), DAY(2021, 1, 1)]),
        ],
    )
    def test_parts(self, spark, rows, part, start, end, expected):
        df = date_spine(spark, part, start, end)
        assert df.columns == [f"date_{part}"]
        assert rows(df) == [(d,) for d in expected]

    def test_hours_in_a_zone_with_summer_time(self, spark, rows):
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        try:
            hours = rows(date_spine(spark, "hour", "2024-03-10 00:00:00", "2024-03-11 00:00:00"))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        assert hours == [(datetime.datetime(2024, 3, 10, h),) for h in range(24)]

    def test_empty_and_unknown(self, spark):
        with pytest.raises(ValueError):
            date_spine(spark, "day", "2018-01-10", "2018-01-10")
        with pytest.raises(ValueError):
            date_spine(spark, "fortnight", "2018-01-10", "2018-02-10")

    def test_bounds_and_intervals(self, table, rows):
        df = table("ts string", "2020-01-03 10:00:00", "2020-01-01 23:00:00").select(F.col("ts").cast("timestamp_ntz"))
        assert date_bounds(df, "ts") == (DAY(2020, 1, 1), DAY(2020, 1, 4))
        end = F.lit("2020-01-03 10:30:00").cast("timestamp_ntz")
        assert rows(df.select(intervals_between(F.col("ts"), end, "hour"))) == [(1,), (36,)]


@pytest.fixture(scope="module")
def letters(table):
    birds = "owl owl owl wren wren crow tit".split()
    return table("field string, side string", *zip(birds, ["night", "night", "night", "day", "day", "day", "day"]))


class TestProfile:
    def test_values_by_frequency(self, letters):
        assert [tuple(r) for r in column_values(letters, "field").collect()] == [("owl", 3), ("wren", 2), ("crow", 1), ("tit", 1)]
        assert [r[0] for r in column_values(letters, "field", where="side = 'day'").collect()] == ["wren", "crow", "tit"]
        assert [r[0] for r in column_values(letters, "field", order_by=[F.desc("field")], max_records=2).collect()] == ["wren", "tit"]

    def test_collected_header(self, spark, letters):
        assert collect_values(spark, letters, "field") == ["owl", "wren", "crow", "tit"]
        assert collect_values(spark, letters, "field", max_records=2) == ["owl", "wren"]
        assert collect_values(spark, "no_such_table", "field", 5, default=["x"]) == ["x"]
        with pytest.raises(ValueError):
            collect_values(spark, "no_such_table", "field", 5)

    def test_a_header_is_never_cut(self, spark, letters):
        many = spark.range(150).select(F.col("id").cast("string").alias("v"))
        assert len(collect_values(spark, many, "v")) == 150
        assert len(collect_values(spark, many, "v", bound=150)) == 150
        with pytest.raises(ValueError, match="more than 149"):
            collect_values(spark, many, "v", bound=149)
        assert len(collect_values(spark, many, "v", max_records=149, bound=149)) == 149

    def test_filtered_columns(self, letters):
        assert filtered_columns(letters, ["FIELD"]) == ["side"]

    def test_single_value(self, spark, letters, rows):
        highest = single_value(letters.agg(F.max("field")))
        assert rows(letters.filter(F.col("field") == highest).select("side").distinct()) == [("day",)]
        nothing = single_value(letters.filter("field = 'z'").select("field"), default="none")
        assert rows(spark.range(1).select(nothing)) == [("none",)]
        null = single_value(spark.sql("select cast(null as string) as a, 1 as b"), default="none")
        assert rows(spark.range(1).select(null)) == [(None,)]
        first = single_value(letters.orderBy(F.desc("field"), F.desc("side")).select("side", "field"))
        assert rows(spark.range(1).select(first)) == [("day",)]

    def test_result_arrays(self, table):
        df = table("a int, b string, c boolean", (2, "x", True), (1, None, False), (3, "z", None))
        row = result_arrays(df, ["a"]).first()
        assert (row.a, row.b, row.c) == ([1, 2, 3], [None, "x", "z"], [False, True, None])
        with pytest.raises((PySparkException, Py4JJavaError)):
            result_arrays(df, ["a"], max_rows=2).collect()

    def test_normalize_columns(self, table):
        df = table("`1st One!` int, `Max-Price (EUR)` int", (1, 2))
        assert normalize_columns(df).columns == ["_1st_one", "max_price_eur"]
        with pytest.raises(ValueError):
            normalize_columns(table("`a b` int, `a-b` int", (1, 2)))


def test_deduplicate_keeps_a_column_named_rank(table, rows):
    df = table("k int, _rank int, _RANK_ int", (1, 7, 3), (1, 5, 4), (2, 9, 5))
    assert rows(deduplicate(df, ["k"], [F.asc("_rank")])) == [(1, 5, 4), (2, 9, 5)]
