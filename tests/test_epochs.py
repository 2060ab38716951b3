import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from verbatide.operators import epochs as T
from verbatide.operators.encoding import UNKNOWN
from verbatide.operators.subwords import SubwordEncoder, SubwordEncoderModel, word_pieces


def plain_step(weights, first, second, step, rows, rate):
    """One Adam step over (ids, label) rows, in plain Python."""
    slope = [0.0] * len(weights)
    for ids, label in rows:
        ids = [i for i in ids if i]
        scale = 1 / math.sqrt(max(len(ids), 1))
        logit = weights[-1] + scale * sum(weights[i] for i in ids)
        off = 1 / (1 + math.exp(-logit)) - label
        for i in ids:
            slope[i] += off * scale / len(rows)
        slope[-1] += off / len(rows)
    for i, g in enumerate(slope):
        first[i] = 0.9 * first[i] + 0.1 * g
        second[i] = 0.999 * second[i] + 0.001 * g * g
        a, b = first[i] / (1 - 0.9**step), second[i] / (1 - 0.999**step)
        weights[i] -= rate * a / (math.sqrt(b) + 1e-8)


def plain_epoch(parts, state, batch, steps, rate):
    """One epoch over the workers' rows: steps apart, then the mean of their states."""
    at, step = 0, state[1]
    while any(at < len(p) for p in parts):
        mean, total, reached = [[0.0] * len(state[0][0]) for _ in range(3)], 0, step
        for rows in parts:
            local, done, used = [list(x) for x in state[0]], step, 0
            for s in range(steps):
                some = rows[at + s * batch : min(at + (s + 1) * batch, at + steps * batch)]
                if some:
                    done, used = done + 1, used + len(some)
                    plain_step(*local, done, some, rate)
            if used:
                mean = [[m + used * x for m, x in zip(a, b)] for a, b in zip(mean, local)]
                total, reached = total + used, max(reached, done)
        state, step, at = ([[m / total for m in a] for a in mean], reached), reached, at + steps * batch
    return state


@pytest.mark.parametrize("workers,exchanges", [(1, 1), (2, 2)])
def test_weights_of_a_plain_loop(spark, workers, exchanges):
    rows = [(i, [2, 4 + i % 5, 4 + i % 3, 3, 0], float(i % 5 == i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "key long, input_ids array<int>, label double")
    fitted = T.EpochClassifier(size=9, epochs=2, batch=4, rate=0.1, workers=workers, exchanges=exchanges)
    models = list(fitted.models(df))
    state = ([[0.0] * 10 for _ in range(3)], 0)
    steps = max(1, -(-(-(-40 // workers)) // (4 * exchanges)))
    for epoch, model, seen, _ in models:
        dealt = T.epoch_rows(df, epoch, workers, 0).withColumn("part", F.spark_partition_id()).collect()
        parts = [[(r.input_ids, r.label) for r in dealt if r.part == k] for k in range(workers)]
        state = plain_epoch(parts, state, 4, steps, 0.1)
        found = [*model.getOrDefault("weights"), model.getOrDefault("bias")]
        assert seen == 40
        assert found == pytest.approx(state[0][0], rel=1e-9, abs=1e-12)


def test_best_epoch_is_kept_with_its_pieces(spark, tmp_path):
    words = ["good fine great", "bad poor awful"]
    rows = [(i, f"{words[i % 2]} x{i % 7}", 1 - i % 2) for i in range(60)] + [(90, "no label", None), (91, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, sentence string, label int")
    path = str(tmp_path / "model")
    runs = T.train_by_epochs(df, df, path, epochs=2, batch=8, rate=0.1, words=50, exchanges=1)
    assert [r.rows for r in runs.collect()] == [61, 61]
    chosen = T.saved_epoch(runs).first()
    assert chosen.epoch == max(r.epoch for r in runs.collect() if r.saved)
    model = PipelineModel.load(path)
    scored = {r.doc_id: r.logit for r in model.transform(df).collect()}
    assert all((scored[i] > 0) == (i % 2 == 0) for i in range(60))
    assert math.isfinite(scored[91])


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, sentence string, label int")
    runs = T.train_by_epochs(df, df, str(tmp_path / "none"), epochs=1).collect()
    assert [(r.rows, r.accuracy, r.saved) for r in runs] == [(0, None, False)]


def plain_pieces(word, pieces, first=4):
    ids = {p: i for i, p in enumerate(pieces, first)}
    found, at = [], 0
    while at < len(word):
        ends = [e for e in range(at + 1, len(word) + 1) if ("##" if at else "") + word[at:e] in ids]
        if not ends:
            return [UNKNOWN]
        found.append(ids[("##" if at else "") + word[at : ends[-1]]])
        at = ends[-1]
    return found


def test_longest_match(spark):
    texts = ["the cat concatenates", "The cat, the hat; catcat", None, "", "# ## the#", "é" * 90]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(2)
    model = SubwordEncoder(maxlen=40, words=3).fit(df)
    pieces = model.getOrDefault("pieces")
    assert pieces == word_pieces(df, words=3)
    import re

    for row in model.transform(df).collect():
        body = [i for w in re.findall(r"\w+|[^\w\s]", (row.text or "").lower()) for i in plain_pieces(w, pieces)]
        body = [2, *body[:38], 3]
        assert row.input_ids == body + [0] * (40 - len(body))
        assert row.attention_mask == [int(i != 0) for i in row.input_ids]
        assert UNKNOWN not in row.input_ids


def test_unseen_characters_are_unknown(spark):
    df = spark.createDataFrame([("ab",)], "text string")
    model = SubwordEncoderModel(maxlen=6, pieces=["a", "##b"])
    assert model.transform(df).first().input_ids == [2, 4, 5, 3, 0, 0]
    unseen = spark.createDataFrame([("az a",)], "text string")
    assert model.transform(unseen).first().input_ids == [2, UNKNOWN, 4, 3, 0, 0]


def test_saved_with_settings(spark, tmp_path):
    model = SubwordEncoderModel(maxlen=9, pieces=["a", "##b"], inputCol="words")
    model.write().overwrite().save(str(tmp_path / "encoder"))
    loaded = SubwordEncoderModel.load(str(tmp_path / "encoder"))
    assert loaded.getInputCol() == "words" and loaded.getOrDefault("pieces") == ["a", "##b"]
    df = spark.createDataFrame([("ab b",)], "words string")
    assert loaded.transform(df).first().input_ids == model.transform(df).first().input_ids
