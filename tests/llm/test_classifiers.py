"""The classifiers on frames: defined results for odd rows, names that clash, held-out accuracy, and linear time."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconframe.llm import labelled, quality, toxicity
from beaconframe.session import table

SF = "/root/testdata/sf0.01"
ODD = [(1, "plain words here.", "a"), (1, "plain words here.", "a"), (2, None, "b"), (None, "", "c"), (4, "... !!", "d"), (5, "word " * 300_000, "e")]


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    return toxicity.train(docs, labels), quality.train(docs, labels)


def test_scores_of_odd_rows_and_clashing_names(spark, models):
    rows = spark.createDataFrame([(*r, 0.5, "x", "y", "z") for r in ODD], "doc_id bigint, text string, score string, offending double, `__text` string, hash string, `a b` string")
    for module, model in zip((toxicity, quality), models, strict=True):
        out = module.score(rows, model, rows.columns).collect()
        assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out) and {r["__text"] for r in out} == {"x"}
        assert out[0]["score"] == out[1]["score"] and sorted(map(str, (r["doc_id"] for r in out))) == sorted(map(str, (r[0] for r in ODD)))
        assert module.score(rows.limit(0), model, ["doc_id"]).count() == 0
    scores = [r["score"] for r in toxicity.score(rows, models[0], ["doc_id"]).collect()]
    assert scores[2] == scores[3] == scores[4] == 0


def test_filters_keep_columns_and_null_texts(spark, models):
    rows = spark.createDataFrame([(*r, 1, 2) for r in ODD], "doc_id bigint, text string, score string, keep int, model int")
    kept = toxicity.reject_toxic(rows, models[0])
    assert kept.schema == rows.schema and kept.count() == len(ODD)
    good = quality.keep_good(rows, models[1])
    expected = [r["score"] >= quality.THRESHOLD for r in quality.score(rows, models[1], []).collect()]
    assert good.schema == rows.schema and good.count() == sum(expected)
    for empty in (toxicity.reject_toxic(rows.limit(0), models[0]), quality.keep_good(rows.limit(0), models[1])):
        assert empty.count() == 0


def test_sample_is_bounded_and_never_held_out(spark):
    docs = spark.createDataFrame([(k, "x" * 100 if k != 7 else None) for k in range(400)] + [(None, "n")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)] + [(None, 1), (3, None), (5, 0)], "doc_id bigint, toxic int")
    assert len(labelled.sample(docs, labels, "toxic", per_class=50)) == 100
    assert len(labelled.sample(docs, labels, "toxic", per_class=50, chars=1050)) == 20
    assert labelled.sample(docs, labels.limit(0), "toxic") == []
    out = {r[0]: r[1] for r in docs.select("doc_id", labelled.held_out()).collect()}
    import zlib

    assert all(out[k] == (zlib.crc32(str(k).encode()) % 5 == 0) for k in range(400)) and out[None] is False


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    for module, label, at in ((toxicity, "toxic", 0.5), (quality, "quality", quality.THRESHOLD)):
        out = module.score(docs, module.train(docs, labels), ["doc_id"]).where(labelled.held_out()).join(labels, "doc_id").select("score", F.col(label).alias("y")).toPandas()
        assert ((out.score >= at) == (out.y == 1)).mean() > 0.98 and len(out) > 300


def test_fit_is_linear_in_a_long_text():
    rng = np.random.default_rng(0)
    rows = [(" ".join(rng.choice(["good", "fine", "word", "bad" if k % 2 else "ok"], 200)) + ".", k % 2) for k in range(60)]
    took = []
    for n in (20_000, 80_000):
        began = time.perf_counter()
        toxicity.fit([*rows, ("a b. " * n, 0)])
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * max(took[0], 0.2)
