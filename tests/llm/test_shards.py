"""Shards: whole, gapless, near equal in bytes, groups together, no Python in the plan."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tierkit.llm import shards


def test_shards(docs, prose):
    texts = [" ".join(prose(i, 5 + (i * 13) % 60)) for i in range(3000)]
    rows = [*texts, *["same text"] * 900, *[texts[i] for i in range(0, 300, 3)], None, "", "y" * 3000]
    frame = docs(*rows, (None, "no id"), (5, rows[5]), (5, rows[5]), extra=("_range", "shard", "text_crc32"))
    placed = shards.place(shards.keyed(frame))
    got = placed.collect()
    assert len(got) == len(rows) + 3
    slots, size, group = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        assert r["_size"] == len((r["text"] or "").encode()) + 8
        assert r["_crc"] == zlib.crc32((r["text"] or "").encode())
        slots[r["_shard"]].append(r["_slot"])
        size[r["_shard"]] += r["_size"]
        group[r["text"]].add(r["_shard"])
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / 24
    assert max(size.values()) < 1.08 * mean and min(size.values()) > 0.92 * mean
    assert all(len(s) == 1 for t, s in group.items() if t != "same text")
    again = {(r["doc_id"], r["_shard"], r["_slot"]) for r in shards.place(shards.keyed(frame.repartition(3))).collect()}
    assert again == {(r["doc_id"], r["_shard"], r["_slot"]) for r in got}


def test_hot_group_is_subdivided(docs):
    placed = shards.assign(docs(*["hot"] * 2000, *[f"cold {i}" for i in range(1000)])).filter("text = 'hot'")
    sizes = [r["n"] for r in placed.groupBy("_shard").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 300


def test_small_and_empty_tables(docs):
    assert shards.assign(docs("x").filter("false")).count() == 0
    one = shards.assign(docs("x"))
    assert one.columns == [*docs("x").columns, "_size", "_shard", "_slot"]
    assert 0 <= one.first()["_shard"] < 24 and one.first()["_slot"] == 0


def test_main_path_is_native(docs):
    plan = shards.assign(docs("x", "y"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_binary_search_of_splitters(spark):
    cuts = [-50, -3, 0, 7, 7000]
    keys = spark.createDataFrame([(k,) for k in (-99, -50, -4, -3, -1, 0, 6, 7, 8, 9000)], "_key long")
    got = [r[0] for r in keys.select(shards._place(cuts)).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]


INSIDE = "_key _crc _range _piece _pieces _bytes _rows _offset row shard slot Text_CRC32".split()


def test_columns_of_any_name_are_handed_through(docs):
    """The names used inside are the user's own; one that is added takes the place of the user's."""
    frame = docs(*[f"text {i}" for i in range(50)], extra=[*INSIDE, "_size", "_SHARD", "_slot"])
    own = [c for c in frame.columns if c.lower() not in ("_size", "_shard", "_slot")]
    got = shards.assign(frame)
    assert got.columns == [*own, "_size", "_shard", "_slot"]
    rows = got.collect()
    assert all(r[c] == 2 * r["n_chars"] for r in rows for c in INSIDE)
    assert {r["_size"] for r in rows} == {len(f"text {i}") + 8 for i in (1, 10)}
    renamed = shards.assign(frame, size=None, shard="shard", slot="slot")
    assert renamed.columns == [*(c for c in frame.columns if c not in ("shard", "slot")), "shard", "slot"]
    assert all(r["_size"] == r["_SHARD"] == r["_slot"] == 2 * r["n_chars"] for r in renamed.collect())
