"""Registered queries over whole tables: their SQL, their columns, and the pipeline stage by stage."""

import sys
from pathlib import Path

import pytest

from oracle import connect, difference
from tierkit.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from tierkit.llm import decontaminate, quality  # noqa: E402
from test_curriculum import brute as mix_by_hand  # noqa: E402
from test_near import brute as groups_by_hand  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id item_id item_words edits",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op8": "doc_id size source_size target taken",
    "op9": "doc_id size text_crc32 law shard slot grown_shard",
    "op10": "doc_id n_shingles component_id kept",
    "op11": "doc_id held_out score predicted",
    "op12": "word form root n n_near form_n",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns == COLUMNS[name.split("_")[0]].split()
    if not name.startswith(("op1_", "op12_")):
        assert df.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]
    kept = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    want = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    rows = kept.collect()
    assert kept.columns == docs.columns and {r["doc_id"] for r in rows} == want

    single = corpus_pipeline.near_duplicates(spark, kept, FOLDER)
    groups = groups_by_hand([(r["doc_id"], r["text"]) for r in rows], 5)
    rows = single.collect()
    assert single.columns == docs.columns and sorted(r["doc_id"] for r in rows) == sorted(i for i, g in groups.items() if g[2])

    clean = corpus_pipeline.decontamination(spark, single, FOLDER)
    leaked = {r["doc_id"] for r in decontaminate.leaks(single, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    left = clean.collect()
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in left) == sorted({r["doc_id"] for r in rows} - leaked)

    mixed = corpus_pipeline.mixing(spark, clean, FOLDER)
    taken = {d: (size, taken) for d, size, _, _, taken in mix_by_hand([(r["doc_id"], r["text"], r["source"]) for r in left])}
    copies = {}
    for r in mixed.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert mixed.columns == docs.columns
    assert copies == {d: n // size for d, (size, n) in taken.items() if n}

    sharded = corpus_pipeline.sharding(spark, mixed, FOLDER).collect()
    assert len(sharded) == sum(copies.values())
    for shard in {r["shard"] for r in sharded}:
        slots = sorted(r["slot"] for r in sharded if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_pipeline_run(spark):
    df = corpus_pipeline.run(spark, FOLDER)
    assert df.columns == [*spark.read.parquet(f"{FOLDER}/documents.parquet").columns, "shard", "slot"]
    assert df.count() > 0
