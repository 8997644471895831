"""Quality by nearest labelled texts: votes by hand, held-out accuracy, defined results."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierkit.llm import neighbours
from tierkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def labelled(docs, prose, n=40):
    good = [" ".join(prose(i, 60)) for i in range(n)]
    bad = [" ".join(w.upper() + "!!" for w in prose(1000 + i, 60)) for i in range(n)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    return docs(*rows), [(i, int(i < n)) for i in range(2 * n)]


def test_votes_by_hand(spark, docs, prose):
    df, labels = labelled(docs, prose)
    model = neighbours.learn(df, spark.createDataFrame(labels, "doc_id long, label int"))
    texts = pa.array([" ".join(prose(7000 + i, 30)).title() for i in range(20)] + ["A!! B!! c d", "", None])
    *found, rows = neighbours.features(texts)
    placed = model.place(*found, rows)
    assert np.allclose(np.linalg.norm(model.vectors, axis=1), 1, atol=1e-4)
    want = []
    for v in placed:
        near = [round(float(x), 5) for x in model.vectors @ v]
        k = sorted(near)[-4]  # half the root of 80
        power = [x**neighbours.SHARPNESS * c if x >= max(k, 1e-5) else 0 for x, c in zip(near, model.counts)]
        want.append(sum(p * y for p, y in zip(power, model.labels)) / sum(power))
    assert np.allclose(model.score(texts, neighbours.VOTES), want, atol=1e-3)


def test_features_by_hand():
    """Two words, their shapes, the pair of shapes, a word that repeats the one before, the size."""
    doc, at, weight, n = neighbours.features(pa.array(["Ab Cd", "Xy Xy", None]))
    assert n == 3 and sorted(set(doc.tolist())) == [0, 1, 2]
    first, second = (dict(zip(at[doc == d], weight[doc == d])) for d in (0, 1))
    assert len(first) == 5 and sum(round(v * v * 2) for v in first.values()) == 6
    assert len(second) == 5 and sum(round(v * v * 2) for v in second.values()) == 7
    assert len(set(first) & set(second)) == 3  # shape, pair of shapes, size
    assert (doc == 2).sum() == 1


def test_held_out_accuracy(spark):
    got = QUERIES["op11_nearest_votes"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_the_held_out_fold_teaches_nothing(spark, tmp_path):
    """Turning every label of the fold round changes no score."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(str(tmp_path / "labels.parquet"))
    a, b = ({r["doc_id"]: r["score"] for r in QUERIES["op11_nearest_votes"](spark, f).collect()} for f in (FOLDER, str(tmp_path)))
    assert a == pytest.approx(b, abs=2e-3)


def test_copies_are_one_example(spark, docs, prose):
    """Thousands of copies neither fill the sample nor outvote: the model is that of the distinct texts."""
    df, labels = labelled(docs, prose, 20)
    more = spark.range(1000, 4000).select(F.col("id").alias("doc_id"), F.lit(" ".join(prose(0, 60))).alias("text"))
    both = df.select("doc_id", "text").union(more)
    known = spark.createDataFrame(labels, "doc_id long, label int").union(more.select("doc_id", F.lit(1)))
    model = neighbours.learn(both, known, most=30)
    assert len(model.labels) == 40 and model.counts.tolist() == [1.0] * 40


def test_sample_is_bounded_and_weighted(spark, docs, prose):
    df, labels = labelled(docs, prose, 40)
    model = neighbours.learn(df, spark.createDataFrame(labels[:60], "doc_id long, label int"), most=10)
    assert sorted(zip(model.labels, model.counts)) == [(0.0, 2.0)] * 10 + [(1.0, 4.0)] * 10


def test_defined_results(spark, docs, prose):
    df, labels = labelled(docs, prose, 10)
    nulls = [(None, 1), (500, 1), (0, None)]
    model = neighbours.learn(df, spark.createDataFrame(labels + nulls, "doc_id long, label int"))
    odd = docs((1, None), (2, ""), (3, " \n"), (4, "x " * 50_000), (4, "x " * 50_000), (None, "word"), extra=["score", "hash", "label", "place"])
    rows = neighbours.score(odd, model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    same = [r["score"] for r in rows if r["doc_id"] in (1, 2, 3)]
    assert same[0] == same[1] == same[2]
    assert neighbours.score(odd.limit(0), model).collect() == []
    empty = neighbours.learn(odd, spark.createDataFrame([], "doc_id long, label int"))
    assert {r["score"] for r in neighbours.score(odd, empty).collect()} == {0.5}
    again = neighbours.learn(odd, spark.createDataFrame([(4, 1)], "doc_id long, label int"))
    assert len(again.labels) == 1
