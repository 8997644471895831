"""What stored tables leave on the disks."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierkit.llm import near, shared


def tables(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "tierkit-llm").glob("*")}


def shuffled(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for d in dirs for p in Path(d.getPath()).rglob("shuffle_*.data")}


def test_stored_leaves_no_shuffle_files_and_no_setting(spark):
    before, found = spark.conf.get(shared._CLEANUP, None), shuffled(spark)
    table = shared.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    assert sorted(tuple(r) for r in table.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]
    assert not shuffled(spark) - found
    assert spark.conf.get(shared._CLEANUP, None) == before


def test_temporary_tables_go_and_kept_ones_stay(spark):
    start = tables(spark)
    with shared.temporary(spark) as kept:
        one = shared.stored(spark.range(3), "one")
        with shared.temporary(spark) as kept_in_it:
            two = kept_in_it(one.filter("id > 0"), "two")
            shared.stored(two, "three")
        four = kept(two, "four")
    assert {n.partition("-")[0] for n in tables(spark) - start} == {"four"}
    assert sorted(r["id"] for r in four.collect()) == [1, 2]
    with pytest.raises(ZeroDivisionError), shared.temporary(spark):
        shared.stored(spark.range(1), "five")
        1 / 0  # noqa: B018
    assert {n.partition("-")[0] for n in tables(spark) - start} == {"four"}


def test_near_duplicates_removes_its_large_tables(spark, docs, prose, monkeypatch):
    """Texts, sets and pairs go; and texts are stored without a shuffle of all of them."""
    plans, stored, start = {}, near.stored, tables(spark)

    def noted(df, name="step"):
        plans[name] = df._jdf.queryExecution().toString()
        return stored(df, name)

    monkeypatch.setattr(near, "stored", noted)
    text = " ".join(prose(2, 80))
    found = near.near_duplicates(docs(text, text + " more", " ".join(prose(3, 80))), 4)
    assert {n.partition("-")[0] for n in tables(spark) - start} == {"near", "classes", "sized"}
    assert sorted(tuple(r) for r in found.select("doc_id", "component_id").collect()) == [(0, 0), (1, 0), (2, 2)]
    assert "Exchange" in plans["members"] and "Exchange" not in plans["texts"]


def test_near_duplicates_write_few_files(spark, docs, prose, tmp_path, monkeypatch):
    """Of 64 shuffle partitions, which nothing merges, every stored table gets 10 files at most."""
    monkeypatch.setattr(shared, "delete_folder", lambda *a: None)
    monkeypatch.setattr(shared, "_tables", lambda spark: str(tmp_path))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = [" ".join([*prose(g, 60), *prose(100 + i, i)]) for g in range(3) for i in range(0, 40, 2)]
        got = near.near_duplicates(docs(*rows), 2).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len({r["component_id"] for r in got}) < len(rows)
    files = [p.parent for p in tmp_path.rglob("part-*.parquet")]
    assert len({p.name.split("-")[0] for p in files} & {"sets", "classes", "pairs", "found", "links", "near"}) == 6
    assert max(files.count(p) for p in files) <= 10


def test_stars_of_repeated_and_turned_links(spark):
    links = [(1, 2), (2, 1), (2, 2), (2, 3), (2, 3), (9, 3), (None, 3), (5, 6), (7, 7)]
    got = sorted(tuple(r) for r in shared.stars(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == [(2, 1), (3, 1), (6, 5), (9, 1)]
