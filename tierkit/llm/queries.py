"""Registered queries of the text operators: each over its whole table, most beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.llm import (
    curriculum,
    decontaminate,
    language,
    near,
    neighbours,
    oracles,
    periodic,
    personal,
    quality,
    secrets,
    shards,
    spans,
    spelling,
    suffix_tree,
)
from tierkit.llm.shared import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op3_quality_rules", oracles.QUALITY)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder)).drop("class_distance", "word_distance")


@query("op10_chosen_path", oracles.NEAR)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(documents(spark, folder), shingle=4)


@query("op1_cgk_decontamination")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query("op8_curriculum", oracles.CURRICULUM)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    planned = curriculum.plan(documents(spark, folder).select("doc_id", "source", "text"))
    return planned.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query("op9_sampled_splitters")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    records = shards.keyed(documents(spark, folder).select("doc_id", "text")).drop("text")
    return shards.place(records).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_de_bruijn", oracles.SPANS)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    kept = spans.remove_repeats(documents(spark, folder))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_suffix_tree")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.score(documents(spark, folder))


@query("op2_cross_parsing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    parser = language.learn(docs.filter(~held_out(4)))
    predicted = language.identify(docs, parser)
    return predicted.select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score")


@query("op4_secret_field")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(documents(spark, folder)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query("op6_personal_field")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return personal.scan(documents(spark, folder)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query("op11_nearest_votes")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    out = neighbours.fold(5) == 0
    scored = neighbours.score(docs, neighbours.learn(docs, labels.filter(~out)))
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op12_spelling_chunks")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(documents(spark, folder), spoil=31))


@query("op13_cover_runs")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.collapse_runs(periodic.with_cycles(documents(spark, folder)))
    best = periodic.strongest(F.col("runs"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    lines = F.concat_ws("", F.transform("runs", line))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return found.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
