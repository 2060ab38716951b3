"""Clusters and the trained classifier: bounds and invariants."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import plan
from verbatide.operators import classifier as C
from verbatide.operators import clustering as L
from verbatide.operators import evaluation as V
from workload import fixtures as X
from workload import model_queries  # noqa: F401
from workload.registry import QUERIES


def test_clusters(spark, small):
    df = X.scored(spark, small).cache()
    clustered, centers = L.cluster_sentiment_features(df)
    assert clustered.count() == df.count()
    assert {r.cluster for r in clustered.select("cluster").distinct().collect()} == {0, 1, 2}
    rows = centers.collect()
    assert len(rows) == 12
    # A centre, unscaled, is the mean of its cluster.
    means = {r.cluster: r for r in clustered.groupBy("cluster").agg(
        *[F.avg(name).alias(name) for name in L.FEATURES]).collect()}
    for row in rows:
        assert row.unscaled == pytest.approx(means[row.cluster][row.feature], abs=1e-6)


def test_clusters_need_two_features(spark):
    with pytest.raises(ValueError):
        L.cluster_sentiment_features(spark.createDataFrame([(0.5,)], "confidence double"))


@pytest.mark.parametrize("name", ["m1_scaled_features", "m1_cluster_sentiment_features"])
def test_rows_are_scored_once(spark, small, name):
    assert "fantastic" not in plan(QUERIES[name](spark, small))


def test_classifier_learns_and_survives_storage(spark, tmp_path):
    words = {1: "good great lovely", 0: "bad awful broken"}
    rows = [(i, f"{words[i % 2]} filler{i % 7} text", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id int, sentence string, label int")
    train, held_out = df.filter("doc_id % 5 <> 0"), df.filter("doc_id % 5 = 0")
    model = C.train_text_classifier(train, epochs=10, buckets=1 << 10)
    result = V.batched_evaluation(C.add_logits(held_out, model), "doc_id", 8).first()
    assert result.accuracy == 1.0 and result.loss < 1.0
    C.save_model(model, str(tmp_path / "model"))
    loaded = C.load_model(str(tmp_path / "model"))
    before = C.add_logits(held_out, model).collect()
    assert before == C.add_logits(held_out, loaded).collect()
    scored = C.score_with_classifier(df.withColumnRenamed("sentence", "text"), model)
    labels = scored.select("label", "sentiment_result.sentiment").distinct().collect()
    assert {(r.label, r.sentiment) for r in labels} == {(1, "positive"), (0, "negative")}


def test_training_with_gaps(spark):
    rows = [("good fine", 1), ("bad", 0), (None, 1), ("", 0), ("no label", None)] * 3
    train = spark.createDataFrame(rows, "sentence string, label int")
    model = C.train_text_classifier(train, epochs=3)
    assert C.unlabelled_count(train) == 3
    assert C.add_logits(train, model).filter("logit is null").count() == 0


def test_model_serves_a_session_that_observes(spark):
    """Neither order of training and observing keeps the model from the tasks."""
    train = spark.createDataFrame([("good", 1), ("bad", 0)] * 5, "sentence string, label int")
    model = C.train_text_classifier(train, epochs=3)
    counts = Observation()
    train.observe(counts, F.count("*").alias("rows")).collect()
    assert counts.get["rows"] == 10
    for usable in (model, C.train_text_classifier(train, epochs=3)):
        assert C.add_logits(train, usable).filter("(logit > 0) = (label = 1)").count() == 10
