import datetime
import os
import uuid

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierkit.session import shared_dir
from tierkit.sources import (
    JdbcSource,
    Split,
    bronze_path,
    coerce_bronze,
    create_layers,
    external_table,
    materialize_table,
    materialize_view,
    promote_many,
    promote_to_silver,
    read_seed,
    register_external,
    relations_by_pattern,
    relations_by_prefix,
    replace_table_as,
    sample_table,
    scan_parquet,
    union_tables_matching,
    write_layer,
)
from tierkit.sources.layers import clean_versions, run_concurrently, table_location
from tierkit.sources import extract
from tierkit.sources.extract import (
    balanced,
    bounds_query,
    choose_column,
    literal,
    read_options,
    split_column_query,
    starts_query,
    table_list_query,
)


@pytest.fixture
def layers(spark, tmp_path):
    return create_layers(spark, str(tmp_path), f"t{uuid.uuid4().hex[:8]}_")


class TestCoerce:
    def test_types(self, spark, rows):
        df = spark.sql(
            "select X'0102' as b, cast('1.10' as decimal(9,2)) as d, null as n, array(1, 2) as a, "
            "named_struct('x', 1) as s, map('k', 2) as m, true as t, timestamp_ntz'2020-01-01 00:00:00' as ts, 5L as i"
        )
        out = coerce_bronze(df)
        kinds = dict(out.dtypes)
        assert [kinds[c] for c in "bdnasm"] == ["string"] * 6
        assert (kinds["t"], kinds["ts"], kinds["i"]) == ("boolean", "timestamp_ntz", "bigint")
        assert rows(out.select("b", "d", "n", "a", "s", "m")) == [("AQI=", "1.10", None, "[1,2]", '{"x":1}', '{"k":2}')]
        assert dict(coerce_bronze(df, decimals="keep").dtypes)["d"] == "decimal(9,2)"
        assert dict(coerce_bronze(df, decimals="double").dtypes)["d"] == "double"
        with pytest.raises(ValueError):
            coerce_bronze(df, decimals="float")

    def test_nulls_stay_null(self, table, rows):
        df = table("b binary, s string", (None, None))
        assert rows(coerce_bronze(df)) == [(None, None)]

    def test_sample(self, spark):
        assert sample_table(spark.range(500), 100).count() == 100


class TestLayers:
    def test_write_scan_and_promote(self, spark, tmp_path, layers, rows):
        path = bronze_path(str(tmp_path), "shop", "Sales", "Store")
        assert path.endswith("/bronze/shop/Sales/Store")
        for top in (3, 5):
            write_layer(spark.range(top), path)
            out = promote_to_silver(spark, path, layers["silver"], "Sales", "Store")
            assert out.count() == top
        assert spark.table(f"{layers['silver']}.silver_sales_store").count() == 5
        cleaned = promote_to_silver(spark, path, layers["silver"], "Sales", "Store", clean=lambda df: df.filter("id > 2"))
        assert rows(cleaned) == [(3,), (4,)]

    def test_nested_and_unsigned_types_survive(self, spark, tmp_path):
        import pyarrow as pa
        import pyarrow.parquet as pq

        data = pa.table({
            "u32": pa.array([4_000_000_000], pa.uint32()),
            "u64": pa.array([18_000_000_000_000_000_000], pa.uint64()),
            "i8": pa.array([1], pa.int8()),
            "f": pa.array([1.5], pa.float32()),
            "l": pa.array([[1, 2]], pa.list_(pa.int64())),
            "s": pa.array([{"a": "x"}]),
            "ts": pa.array([0], pa.timestamp("us")),
            "d": pa.array([0], pa.date32()),
        })
        (tmp_path / "raw").mkdir()
        pq.write_table(data, tmp_path / "raw" / "part.parquet")
        df = scan_parquet(spark, str(tmp_path / "raw"))
        assert dict(df.dtypes) == {
            "u32": "bigint",
            "u64": "decimal(20,0)",
            "i8": "tinyint",
            "f": "float",
            "l": "array<bigint>",
            "s": "struct<a:string>",
            "ts": "timestamp_ntz",
            "d": "date",
        }
        assert df.first().u64 == 18_000_000_000_000_000_000
        assert scan_parquet(spark, str(tmp_path / "raw"), "u32 bigint").columns == ["u32"]

    def test_empty_table_keeps_its_schema(self, spark, tmp_path):
        path = str(tmp_path / "empty")
        write_layer(spark.range(0).withColumn("x", F.lit("a")), path)
        assert scan_parquet(spark, path).dtypes == [("id", "bigint"), ("x", "string")]

    def test_external_table(self, spark, tmp_path, layers, rows):
        write_layer(spark.range(2), str(tmp_path / "data"))
        df = external_table(spark, f"{layers['bronze']}.sales_store", str(tmp_path / "data"))
        assert rows(df) == [(0,), (1,)]
        assert relations_by_pattern(spark, layers["bronze"], "%") == {f"{layers['bronze']}.sales_store": "external"}

    def test_replace_reads_its_own_previous_version(self, spark, layers, rows):
        name = f"{layers['gold']}.counts"
        replace_table_as(spark.range(4), name, where="id > 1")
        out = replace_table_as(spark.table(name).withColumn("id", F.col("id") * 10), name)
        assert rows(out) == [(20,), (30,)]

    @pytest.mark.parametrize("change", [False, True])
    def test_an_older_handle_still_reads(self, spark, layers, rows, change):
        name = f"{layers['gold']}.counts"
        before = materialize_table(spark.range(2), name)
        folder = table_location(spark, name)
        new = spark.range(3).withColumn("x", F.lit(1)) if change else spark.range(3)
        assert materialize_table(new, name).count() == 3 == spark.table(name).count()
        assert table_location(spark, name) != folder
        assert rows(before) == [(0,), (1,)]

    def test_versions_are_cleaned_in_a_step_of_its_own(self, spark, layers):
        name = f"{layers['gold']}.counts"
        materialize_table(spark.range(7), f"{name}_more")
        for n in (1, 2, 3):
            materialize_table(spark.range(n), name)
        assert clean_versions(spark, name) == []
        assert len(clean_versions(spark, name, older_than=0)) == 2
        assert clean_versions(spark, name, older_than=0) == []
        assert (spark.table(name).count(), spark.table(f"{name}_more").count()) == (3, 7)

    def test_failed_refresh_leaves_the_table_and_no_folder(self, spark, layers, rows):
        name = f"{layers['gold']}.counts"
        materialize_table(spark.range(2), name)
        home = os.path.dirname(table_location(spark, name)).removeprefix("file:")
        folders = sorted(os.listdir(home))
        with pytest.raises((PySparkException, Py4JJavaError)):
            materialize_table(spark.range(1).select(F.raise_error(F.lit("no")).alias("id")), name)
        assert rows(spark.table(name)) == [(0,), (1,)]
        assert sorted(os.listdir(home)) == folders

    def test_external_table_moves_to_another_folder(self, spark, tmp_path, layers):
        name = f"{layers['bronze']}.moved"
        for n in (1, 2):
            write_layer(spark.range(n), str(tmp_path / f"data{n}"))
            assert external_table(spark, name, str(tmp_path / f"data{n}")).count() == n

    def test_view(self, spark):
        assert materialize_view(spark.range(3), f"v{uuid.uuid4().hex}").count() == 3

    def test_work_is_tried_again(self):
        calls = []

        def work(name):
            calls.append(name)
            if name == "b" and calls.count("b") < 3:
                raise RuntimeError("not yet")
            return name.upper()

        assert run_concurrently(work, [("a",), ("b",)], tries=3, pause=0.0) == ["A", "B"]
        assert calls.count("b") == 3
        with pytest.raises(RuntimeError, match="not yet"):
            calls.clear()
            run_concurrently(work, [("b",)], tries=2, pause=0.0)

    def test_register_and_promote_many(self, spark, tmp_path, layers):
        tables = [("Sales", "Store"), ("Person", "Address")]
        for n, (schema, name) in enumerate(tables, 1):
            write_layer(spark.range(n), bronze_path(str(tmp_path), "shop", schema, name))
        external = register_external(spark, str(tmp_path), "shop", tables, layers["bronze"])
        assert {n: df.count() for n, df in external.items()} == {"sales_store": 1, "person_address": 2}
        silver = promote_many(spark, str(tmp_path), "shop", tables, layers["silver"])
        assert {n: df.count() for n, df in silver.items()} == {"silver_sales_store": 1, "silver_person_address": 2}


class TestSeeds:
    def test_types_and_empty_cells(self, spark, tmp_path, rows):
        (tmp_path / "seed.csv").write_text('id,name,amount,seen\n1,,2.5,2020-01-02\n2,"a,b",,\n')
        df = read_seed(spark, str(tmp_path / "seed.csv"), "id int, name string, amount double, seen date")
        assert [tuple(r) for r in df.select("id", "name", "amount").orderBy("id").collect()] == [(1, None, 2.5), (2, "a,b", None)]
        assert df.first().seen.isoformat() == "2020-01-02"

    def test_malformed_cell_is_an_error(self, spark, tmp_path):
        (tmp_path / "seed.csv").write_text("id\nx\n")
        with pytest.raises((PySparkException, Py4JJavaError)):
            read_seed(spark, str(tmp_path / "seed.csv"), "id int").collect()


class TestCatalog:
    @pytest.fixture
    def meters(self, spark, layers):
        """Readings of three meters, each in a table of its own; column names differ in case only."""
        db = layers["silver"]
        for name, column, values in (("gas", "m3", [7, 9]), ("heat", "M3", [2]), ("water", "m3", [5, 6, 8])):
            materialize_table(spark.createDataFrame([(v,) for v in values], f"{column} int"), f"{db}.meter_{name}")
        materialize_table(spark.range(1), f"{db}.invoice")
        return db

    def test_pattern_and_prefix(self, spark, meters):
        by_pattern = relations_by_pattern(spark, meters.upper(), "METER_%", exclude="%_heat")
        assert by_pattern == {f"{meters}.meter_{n}": "external" for n in ("gas", "water")}
        assert len(relations_by_prefix(spark, meters, "meter_")) == 3
        assert relations_by_prefix(spark, meters, "nothing") == {}

    def test_union_of_matches(self, spark, meters, rows):
        united = union_tables_matching(spark, meters, "meter_%", source_column=None)
        assert rows(united) == [(2,), (5,), (6,), (7,), (8,), (9,)]


class TestExtract:
    def test_options(self, spark):
        spark.conf.set("spark.tierkit.jdbc.user", "reader")
        spark.conf.set("spark.tierkit.jdbc.password", "secret")
        try:
            source = JdbcSource("jdbc:postgresql://db/shop", "shop", driver="a.b.Driver")
            options = read_options(source, spark, "Sales", "Store", Split("StoreID", 1, 900, 8))
        finally:
            spark.conf.unset("spark.tierkit.jdbc.user")
            spark.conf.unset("spark.tierkit.jdbc.password")
        assert options == {
            "url": "jdbc:postgresql://db/shop",
            "driver": "a.b.Driver",
            "fetchsize": "100000",
            "user": "reader",
            "password": "secret",
            "dbtable": '"Sales"."Store"',
            "partitionColumn": '"StoreID"',
            "lowerBound": "1",
            "upperBound": "900",
            "numPartitions": "8",
        }
        assert "secret" not in repr(source)

    def test_queries(self):
        assert "NOT IN ('sys', 'INFORMATION_SCHEMA')" in table_list_query()
        assert "TABLE_TYPE = 'BASE TABLE'" in table_list_query()
        assert "u.ORDINAL_POSITION = 1" in split_column_query() and "c.DATA_TYPE" in split_column_query()

    @pytest.mark.parametrize(
        "url, table, column",
        [
            ("jdbc:sqlserver://h;database=x", "[My Schema].[order]", "[a]]b]"),
            ("jdbc:mysql://h/x", "`My Schema`.`order`", "`a]b`"),
            ("jdbc:h2:mem", '"My Schema"."order"', '"a]b"'),
        ],
    )
    def test_names_are_quoted(self, url, table, column):
        source = JdbcSource(url, "x")
        assert source.table("My Schema", "order") == table
        assert bounds_query(source, "My Schema", "order", "a]b") == (
            f"SELECT MIN({column}) AS lower_bound, MAX({column}) AS upper_bound FROM {table}"
        )

    def test_split_column(self):
        assert choose_column([("note", "nvarchar", 0), ("id", "BIGINT", 1)]) == ("id", True)
        assert choose_column([("code", "uniqueidentifier", 1)]) == ("code", False)
        assert choose_column([("at", "datetime2", 0)]) == ("at", True)
        assert choose_column([]) is None

    def test_hash_split_takes_every_row_once(self):
        dialect = JdbcSource("jdbc:sqlserver://h", "x").dialect
        assert Split("code", None, None, 3).predicates(dialect) == [
            "(ABS(CAST(CHECKSUM([code]) AS BIGINT)) % 3 = 0 OR [code] IS NULL)",
            "ABS(CAST(CHECKSUM([code]) AS BIGINT)) % 3 = 1",
            "ABS(CAST(CHECKSUM([code]) AS BIGINT)) % 3 = 2",
        ]
        assert extract.find_split(None, JdbcSource("jdbc:mysql://h/x", "x"), "s", "t", "c", False, 5) == Split("c", None, None, 5)
        assert extract.find_split(None, JdbcSource("jdbc:h2:mem", "x"), "s", "t", "c", False, 5) is None

    def test_every_table_is_landed(self, spark, tmp_path, monkeypatch):
        """The database is stood in for by DataFrames; no server is reached."""
        data = {("Sales", "Store"): spark.range(3), ("HR", "Staff"): spark.sql("select X'01' as badge, 1.50 as pay")}
        listed = spark.createDataFrame(list(data), "TABLE_SCHEMA string, TABLE_NAME string")
        splits = []

        def read_table(spark, source, schema, table, split):
            splits.append((table, split))
            return data[schema, table]

        monkeypatch.setattr(extract, "list_tables", lambda spark, source: listed)
        keys = spark.createDataFrame([("HR", "Staff", "badge", "varbinary", 1), ("HR", "Staff", "pay", "decimal", 0)], "s string, t string, c string, k string, p int")
        monkeypatch.setattr(extract, "list_split_columns", lambda spark, source: keys)
        monkeypatch.setattr(extract, "find_split", lambda spark, source, schema, table, column, ranges, n: Split(column, 0 if ranges else None, 2, n))
        monkeypatch.setattr(extract, "read_table", read_table)
        source = JdbcSource("jdbc:postgresql://db/shop", "shop")
        tables = extract.extract_database(spark, source, str(tmp_path), {"Sales.Store": "id"}, partitions=2)
        assert tables == [("HR", "Staff"), ("Sales", "Store")]
        assert sorted(splits, key=str) == [("Staff", Split("badge", None, 2, 2)), ("Store", Split("id", 0, 2, 2))]
        assert scan_parquet(spark, bronze_path(str(tmp_path), "shop", "HR", "Staff")).first().asDict() == {
            "badge": "AQ==",
            "pay": "1.50",
        }


class TestSharedDir:
    def test_reads_the_session(self, spark):
        assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

    def test_a_cluster_must_name_its_folder(self):
        class Context:
            master = "spark://host:7077"

            def getCheckpointDir(self):
                return None

        class Session:
            sparkContext = Context()
            conf = {}

        with pytest.raises(ValueError):
            shared_dir(Session())


class TestBalancedSplit:
    SOURCE = JdbcSource("jdbc:mysql://db/shop", "shop")

    def test_question_for_the_starts(self):
        sql = starts_query(self.SOURCE, "sales", "order", "id", 4)
        assert sql == (
            "SELECT share, MIN(`id`) AS start_value FROM (SELECT `id`, NTILE(4) OVER (ORDER BY `id`) AS share "
            "FROM `sales`.`order` WHERE `id` IS NOT NULL) s GROUP BY share"
        )

    @pytest.mark.parametrize("shares", [1, 3, 8])
    def test_every_row_is_read_once(self, spark, shares):
        """Keys with a wide gap, a third of the rows with one key, NULLs, and rows that came later."""
        rows = spark.range(900).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 500 WHEN id < 450 THEN id ELSE id + 1000000000 END AS `a key`"
        ).union(spark.sql("SELECT CAST(NULL AS BIGINT) UNION ALL SELECT -5L"))
        known = rows.filter("`a key` >= 0").selectExpr("*", f"ntile({shares}) OVER (ORDER BY `a key`) AS share")
        starts = [r[0] for r in known.groupBy("share").agg({"a key": "min"}).select("min(a key)").collect()]
        split = balanced("a key", starts)
        parts = [rows.filter(p).count() for p in split.predicates(self.SOURCE.dialect)]
        assert sum(parts) == 902 and len(parts) == split.partitions <= shares
        assert max(parts) < 302 + 2 * 900 / shares

    def test_starts_as_sql(self):
        day, moment = datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 1, 2, 3)
        assert balanced("d", [moment, None]).predicates(self.SOURCE.dialect) == ["1 = 1"]
        assert [literal(v) for v in (7, day, moment, "O'Neil")] == ["7", "'2024-02-29'", "'2024-02-29 01:02:03'", "'O''Neil'"]
        first, last = balanced("d", [day, datetime.date(2024, 3, 1)]).predicates(self.SOURCE.dialect)
        assert last == "`d` >= '2024-03-01'" and first.startswith("(`d` < '2024-02-29' OR `d` IS NULL OR")
        assert balanced("d", []) is None
