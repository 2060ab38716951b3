"""Scorers: golden rows, plain Python over a whole table, and plans."""

import math

from pyspark.sql import functions as F

from tests.conftest import plan
from verbatide.functions import lexicons as L
from verbatide.functions import scoring as S
from verbatide.operators import sentiment as U
from workload import fixtures as X


def test_keyword_golden(spark):
    rows = spark.createDataFrame(
        [("good great",), ("I dislike this",), ("bad terrible awful hate",), (" ",), (None,)],
        "text_cleaned string",
    )
    scored = rows.transform(U.score_comments, run_ts="2024-01-01").collect()
    assert [(r.sentiment, round(r.confidence, 6)) for r in scored] == [
        ("positive", 0.8), ("neutral", 0.5), ("negative", 0.9), ("unknown", 0.0), ("unknown", 0.0),
    ]
    first = scored[0]
    assert math.isclose(first.negative_prob, 0.1) and math.isclose(first.neutral_prob, 0.2)
    assert (scored[3].positive_prob, scored[3].neutral_prob) == (0.33, 0.34)


def test_rule_golden(spark):
    texts = ["good great", "nothing", "?", "sky", "word " * 51, "word " * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    scored = rows.transform(U.score_rules).collect()
    assert [(r.sentiment_label, r.confidence_score) for r in scored] == [
        ("Positive", 81.0), ("Negative", 77.0), ("Neutral", 55.0), ("Positive", 62.0),
        ("Negative", 58.0), ("Positive", 62.0),
    ]


def test_rules_over_whole_texts(spark, small):
    rows = X.comments(spark, small).filter("text is not null").transform(U.score_rules)
    for row in rows.select("text", "sentiment_label", "confidence_score").toLocalIterator():
        text = row.text.lower()

        def hits(words):
            return sum(word in text for word in words)

        tally = hits(L.RULES.positive) - hits(L.RULES.negative) - hits(L.RULES.negation) / 2
        if abs(tally) > 0.5:
            expected = ("Positive" if tally > 0 else "Negative", min(65 + 8 * abs(tally), 92))
        elif hits(L.RULES.question):
            expected = ("Neutral", 55.0)
        else:
            expected = ("Negative", 58.0) if len(text.split()) > 50 else ("Positive", 62.0)
        assert (row.sentiment_label, row.confidence_score) == expected


def test_logits(spark):
    rows = spark.createDataFrame([(0.0,), (800.0,), (-800.0,), (0.1,)], "x double")
    out = rows.select(S.logit_label("x").alias("l"), S.logit_percent("x").alias("p")).collect()
    assert [tuple(r) for r in out] == [
        ("Negative", 50), ("Positive", 100), ("Negative", 100), ("Positive", 52),
    ]
    pair = spark.createDataFrame([(1.0, 1.0), (900.0, -900.0)], "a double, b double").select(
        S.softmax_label("a", "b").alias("l"), S.softmax_percent("a", "b").alias("p")
    )
    assert [tuple(r) for r in pair.collect()] == [("Negative", 50.0), ("Negative", 100.0)]
    loss = rows.select(S.bce_with_logits("x", F.lit(1)).alias("b")).collect()
    assert math.isclose(loss[0].b, math.log(2)) and loss[1].b == 0.0 and loss[2].b == 800.0


def test_batches_survive_a_failing_text(spark):
    def load():
        def score(texts):
            if "boom" in texts:
                raise ValueError("boom")
            return [("Positive", 70) for _ in texts]

        return score

    rows = spark.createDataFrame([("a",), ("boom",), ("b",)], "text string").coalesce(1)
    scored = rows.transform(U.score_batches, load, out="_model")
    filled = scored.transform(U.fallback_cascade, ["_model"]).select("text", "sentiment_result.*")
    assert {r.text: (r.sentiment, r.model_version) for r in filled.collect()} == {
        "a": ("positive", "bert-sentiment-v1"),
        "b": ("positive", "bert-sentiment-v1"),
        "boom": ("unknown", "fallback"),
    }


def test_predictions_do_not_multiply_comments(spark):
    comments = spark.createDataFrame(
        [("1", None), ("1", None), ("2", None), (None, None)], "id string, sentiment_label string"
    )
    predictions = spark.createDataFrame(
        [("1", "Positive", 80.0), ("1", "Negative", 70.0), (None, "Positive", 99.0)],
        "id string, sentiment_label string, confidence_score double",
    )
    joined = U.attach_predictions(comments, predictions).orderBy("id").collect()
    assert [(r.id, r.sentiment_label) for r in joined] == [
        (None, None), ("1", "Positive"), ("1", "Positive"), ("2", None),
    ]


def test_scoring_stays_in_the_jvm_and_runs_once(spark, small):
    scored = X.cleaned(spark, small).transform(U.score_keywords)
    text = plan(scored.filter("sentiment = 'positive'").select("id", "confidence"))
    assert "Python" not in text and "ArrowEval" not in text
    # The filter must not repeat the substring tests, nor those the cleaning.
    assert text.count("fantastic as int") <= 2
    assert text.count(r"[^a-zA-Z0-9\s]") == 1


def test_nulls_do_not_reach_the_model(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def load():
        def score(texts):
            with open(calls, "a") as log:
                log.write(f"{len(texts)}\n")
            if "fault" in texts:
                raise ValueError
            return [("Positive", 90)] * len(texts)

        return score

    texts = [(None if i % 7 == 0 else f"t{i}",) for i in range(4000)]
    df = spark.createDataFrame(texts, "text string").coalesce(1)
    results = U.score_batches(df, load).collect()
    assert sum(r.sentiment_result is None for r in results) == sum(t is None for t, in texts)
    assert len(open(calls).readlines()) <= 4
    faulty = spark.createDataFrame([("a",), ("fault",), ("b",), ("c",)], "text string").coalesce(1)
    results = {r.text: r.sentiment_result for r in U.score_batches(faulty, load).collect()}
    assert [t for t, r in results.items() if r is None] == ["fault"]
