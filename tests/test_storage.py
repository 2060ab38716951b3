"""Sources, sinks, threads, streams and staged runs."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from verbatide.operators.ingest import default_columns
from verbatide.operators.sentiment import attach_predictions
from verbatide.plans import stages as G
from verbatide.plans.integrated import run_integrated
from verbatide.sinks import tables as K
from verbatide.sources import files as S
from verbatide.sources import threads as H
from verbatide.streaming.sentiment import (
    log_batches,
    logged_batches,
    score_raw_comments,
    stream_sentiment,
)
from workload import fixtures as X
from workload import storage_queries  # noqa: F401
from workload.registry import QUERIES


def lines(tmp_path, *rows, name="comments.json"):
    path = tmp_path / name
    path.write_text("\n".join(rows) + "\n", encoding="utf-8")
    return str(path)


def test_jsonl_scan_is_permissive(spark, tmp_path):
    path = lines(tmp_path, '{"id": "1", "text": "x", "score": 3.5}', "", '{"id": "2", "te')
    rows = S.scan_comments(spark, path).collect()
    assert [(r.id, r.text, r.score) for r in rows] == [("1", "x", None), (None, None, None)]
    with pytest.raises(FileNotFoundError):
        S.scan_comments(spark, str(tmp_path / "absent.json"))


def test_bare_texts_are_numbered_by_line(spark, tmp_path):
    folder = tmp_path / "bare"
    folder.mkdir()
    lines(folder, '{"text": "one"}', "  ", '{"text": ', '{"text": "two"}', name="a.json")
    lines(folder, "{}", '{"text": "http x?"}', name="b.json")
    rows = {r.id: r for r in S.scan_bare_texts(spark, str(folder), run_ts="2024-01-01").collect()}
    texts = [rows[f"comment_{i}"].text for i in range(4)]
    assert texts == ["one", "two", "", "http x?"]
    assert rows["comment_3"].contains_url and rows["comment_3"].is_question


def test_bare_texts_are_numbered_without_a_sort(spark, tmp_path, monkeypatch):
    """Blocks of several files, some of them in one partition, and no line is moved."""
    folder = tmp_path / "bare"
    folder.mkdir()
    want = []
    for name in "abc":
        texts = [f"{name}{i} " + "x" * (i % 90) for i in range(400)]
        lines(folder, *[json.dumps({"text": t}) if i % 7 else " " for i, t in enumerate(texts)], name=f"{name}.json")
        want += [t for i, t in enumerate(texts) if i % 7]
    monkeypatch.setattr(type(spark.range(1)), "orderBy", None)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = S.scan_bare_texts(spark, str(folder), run_ts="2024-01-01").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.id: r.text for r in rows} == {f"comment_{i}": t for i, t in enumerate(want)}


def test_bare_lines_are_sorted_in_small_ranges(spark, small, monkeypatch):
    monkeypatch.setattr(X, "RANGE_ROWS", 100)
    monkeypatch.setattr(X, "comments", lambda *_: spark.range(900).selectExpr("'d' || id as id", "'' || id as text"))
    found = X.bare_lines(spark, small)
    assert found.rdd.getNumPartitions() >= 10
    texts = [json.loads(r.value)["text"] for r in found.collect() if r.value.startswith('{"text":"')]
    assert [f"d{t}" for t in texts] == sorted(f"d{i}" for i in range(900))


def test_integrated_run_joins_texts_once(spark, small, tmp_path):
    """What is analysed, saved and returned is read from the joined comments as stored."""
    path = str(tmp_path / "enriched")
    X.comments(spark, small).transform(default_columns, run_ts=X.RUN_TS).write.json(path)
    scored = run_integrated(spark, path, str(tmp_path / "out"))
    assert "Join" not in plan(scored) and "Exchange" not in plan(scored)
    assert scored.count() == X.rule_scored(spark, small).count()


def test_records_are_made_from_stored_rows(spark, small, monkeypatch):
    seen = []
    save = K.save_records
    monkeypatch.setattr(K, "save_records", lambda df, *rest: seen.append(df) or save(df, *rest))
    QUERIES["k7_save_records_csv_json"](spark, small)
    assert "fantastic" not in plan(seen[0])


def test_repeated_ids_are_judged_on_stored_rows(spark, small):
    assert "fantastic" not in plan(QUERIES["k8_repeated_ids"](spark, small))


def test_labelled_round_trip(spark, tmp_path):
    sentences = [('say "hi"', 1), (" spaces ", 0), ("plain", 1), ("tab\tinside", 0)]
    rows = spark.createDataFrame(sentences, "sentence string, label int")
    K.save_labelled(rows, str(tmp_path / "tsv"))
    read = S.scan_labelled(spark, str(tmp_path / "tsv"))
    assert sorted(tuple(r) for r in read.collect()) == sorted(sentences)


def test_formats(spark, tmp_path):
    rows = spark.range(3)
    for file_format in ("parquet", "json"):
        K.save_table(rows, str(tmp_path / file_format), file_format)
        assert S.read_results(spark, str(tmp_path / file_format)).count() == 3
    with pytest.raises(ValueError):
        K.save_table(rows, str(tmp_path / "x"), "xml")
    with pytest.raises(RuntimeError):
        K.save_table(rows, str(tmp_path / "x"), "delta")


def test_stored_sentiment_is_pruned_by_label(spark, small, tmp_path):
    K.save_sentiment(X.scored(spark, small), str(tmp_path / "s"), include_original=False)
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert "text" not in stored.columns
    text = plan(stored.filter("sentiment = 'positive' and text_length >= 20").select("confidence"))
    assert "PartitionFilters: [isnotnull(sentiment" in text
    assert "GreaterThanOrEqual(text_length,20)" in text
    assert "ReadSchema: struct<confidence:double,text_length:int>" in text


def test_bucketed_tables_are_joined_as_they_lie(spark, tmp_path):
    comments = spark.createDataFrame(
        [(None, "n", "x"), *((str(i % 50), f"t{i}", "x") for i in range(120))],
        "id string, text string, sentiment_label string",
    )
    predictions = spark.createDataFrame(
        [(str(i), label, 50.0 + i) for i in range(10, 70) for label in ("Negative", "Positive")],
        "id string, sentiment_label string, confidence_score double",
    )
    K.save_bucketed(comments, "test_comments", str(tmp_path / "c"), 8)
    K.save_bucketed(predictions, "test_predictions", str(tmp_path / "p"), 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = attach_predictions(spark.table("test_comments"), spark.table("test_predictions"))
        text = plan(joined)
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert text.count("Bucketed: true") == 2
        want = attach_predictions(comments, predictions)
        assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))
        assert joined.count() == 121
        K.save_bucketed(comments.limit(0), "test_comments", str(tmp_path / "c"), 8)
        assert spark.table("test_comments").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("test_comments", "test_predictions"):
            spark.sql(f"drop table {name}")


def entry(name, replies="", kind="t1", **fields):
    return {"kind": kind, "data": {"id": name, "body": name.upper(), "replies": replies, **fields}}


def listing(*entries):
    return {"data": {"children": list(entries)}}


def test_threads_of_any_depth(spark):
    opened = ['{"kind":"Listing","data":{"children":[{"kind":"t1","data":{"id":"%d","body":"b","replies":' % i for i in range(20000)]
    document = "".join(opened) + '""' + "}}]}}" * 20000
    spoilt = document[:-1]
    df = spark.createDataFrame([("deep", document), ("spoilt", spoilt)], "thread string, document string")
    rows = H.flatten_threads(df).orderBy("position").collect()
    assert [(r.thread, r.id, r.position) for r in rows] == [("deep", str(i), i) for i in range(20000)]


def test_threads_in_reading_order(spark):
    tree = listing(
        entry("a", listing(entry("b"), entry("x", kind="more"), "junk", entry("c"))),
        entry("d", score=3, depth="deep", author=7),
        {"kind": "t1", "data": None},
        entry("e", score=True, body=None),
    )
    deep = listing(entry("n0"))
    for i in range(1, 150):
        deep = listing(entry(f"n{i}", deep))
    documents = [("t", json.dumps(tree)), ("deep", json.dumps(deep)), ("bad", "{"), ("null", None)]
    df = spark.createDataFrame(documents, "thread string, document string")
    rows = H.flatten_threads(df).collect()
    found = sorted((r for r in rows if r.thread == "t"), key=lambda r: r.position)
    assert [r.id for r in found] == ["a", "b", "c", "d", "e"]
    assert (found[3].score, found[3].depth, found[3].author) == (3.0, None, "")
    assert (found[4].score, found[4].body) == (None, "")
    assert sum(r.thread == "deep" for r in rows) == 150
    assert not any(r.thread in ("bad", "null") for r in rows)
    with pytest.raises(Exception, match="JSON|Expecting"):
        H.flatten_threads(df.filter("thread = 'bad'"), strict=True).collect()


def test_batches_count_what_is_kept_of_threads(spark):
    """A thread's long columns come again with each comment, so fewer go at a time."""
    flatten = H._comments_of(1, False)
    document = json.dumps(listing(*(entry(str(i), author="a" * 100) for i in range(300))))
    batch = pa.record_batch({"thread": ["t" * 100_000], "document": [document]})
    rows = list(flatten([batch]))
    sizes = [b.num_rows for b in rows]
    assert sum(sizes) == 300 and max(b.nbytes for b in rows) <= H.BATCH_BYTES + 200_000


def test_permalinks(spark):
    urls = ["https://h/r/cats/comments/1ab/title/?x=1", "# https://h/r/a/b/c", " ", "https://h/r", "::"]
    rows = H.parse_permalinks(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert [(r.community, r.post_code) for r in rows] == [("cats", "1ab"), (None, None), (None, None)]


def test_export(spark, tmp_path):
    bodies = spark.createDataFrame([("one\ntwo",), ("",), ("three",)], "body string").coalesce(1)
    K.export_texts(bodies, str(tmp_path))
    plain = "".join(p.read_text() for p in (tmp_path / "plain").glob("part-*"))
    assert plain == "one\ntwo\n\n---\n\n\n\n---\n\nthree\n\n---\n\n"
    written = "".join(p.read_text() for p in (tmp_path / "jsonl").glob("part-*.json"))
    assert [json.loads(line)["text"] for line in written.splitlines()] == ["one\ntwo", "", "three"]


def test_report_document(spark, tmp_path):
    report = spark.createDataFrame(
        [("s", "é", None, "m", 1.0, None)],
        "section string, key1 string, key2 string, metric string, value double, note string",
    )
    K.save_report(report, str(tmp_path / "r"))
    document = "".join(p.read_text("utf-8") for p in (tmp_path / "r").glob("part-*"))
    assert json.loads(document) == {"s": [{"key1": "é", "metric": "m", "value": 1.0}]}
    assert "\n  " in document


def test_stream_equals_batch(spark, small, tmp_path):
    source = str(tmp_path / "in")
    X.comment_lines(spark, small).repartition(5).write.text(source)
    query = stream_sentiment(
        spark, source, str(tmp_path / "out"), str(tmp_path / "state"), trigger_interval=None,
        max_files_per_trigger=2, run_ts=X.RUN_TS,
    )
    assert query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = score_raw_comments(S.scan_comments(spark, source), X.RUN_TS).select(streamed.columns)
    assert streamed.count() > 0
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_stream_log(spark, small, tmp_path):
    source, log = tmp_path / "in", str(tmp_path / "log")
    X.comment_lines(spark, small).repartition(5).write.text(str(source))
    options = dict(trigger_interval=None, max_files_per_trigger=2, run_ts=X.RUN_TS)
    paths = [str(tmp_path / name) for name in ("out", "state")]
    log_batches(stream_sentiment(spark, str(source), *paths, **options), log)
    stored = spark.read.parquet(paths[0])
    batches = logged_batches(spark, log).orderBy("batch_id").collect()
    assert [b.batch_id for b in batches] == [0, 1, 2]
    assert sum(b.scored_rows for b in batches) == stored.count()
    assert sum(b.positive for b in batches) == stored.filter("sentiment = 'positive'").count()
    assert sum(b.input_rows for b in batches) > sum(b.scored_rows for b in batches)
    # A restart goes on where the log ends; a batch that is done again counts once.
    (source / "more.txt").write_text('{"id": "n", "text": "good great love and more"}\n')
    log_batches(stream_sentiment(spark, str(source), *paths, **options), log)
    again = spark.read.json(log).filter("batch_id = 1").withColumn("started", F.lit("2999"))
    again.write.mode("append").json(log)
    assert [(b.batch_id, b.started == "2999") for b in logged_batches(spark, log).orderBy("batch_id").collect()] == [
        (0, False), (1, True), (2, False), (3, False)
    ]
    # A query that fails has what it did in the log.
    def broken(rows):
        return rows.withColumn("sentiment", F.raise_error(F.lit("no score"))).withColumn("confidence", F.lit(0.0))

    failing = stream_sentiment(
        spark, str(source), str(tmp_path / "o2"), str(tmp_path / "s2"), scorer=broken, **options
    )
    with pytest.raises(Exception, match="no score"):
        log_batches(failing, str(tmp_path / "log2"))


def test_stages_count_while_writing(spark, small, tmp_path):
    source = str(tmp_path / "comments")
    X.comment_lines(spark, small).write.text(source)
    settings = G.RunSettings(source, str(tmp_path / "run"), create_partitions=False)
    counts = G.ingest_stage(spark, settings, "r", X.RUN_TS)
    stored = spark.read.parquet(settings.path("processed"))
    assert counts["records"] == stored.count()
    assert counts["valid"] == stored.filter("is_valid = 'valid'").count()
    scored = G.score_stage(spark, settings, X.RUN_TS)
    assert scored["records"] == spark.read.parquet(settings.path("sentiment")).count() > 0


def test_staged_run(spark, small, tmp_path):
    source = str(tmp_path / "comments")
    X.comment_lines(spark, small).write.text(source)
    settings = G.RunSettings(source, str(tmp_path / "run"), batch_mode=True, file_pattern="*.txt")
    record = G.run_stages(spark, settings, "run_7", X.RUN_TS)
    assert (record.status, record.errors) == ("SUCCESS", [])
    ingestion, scoring, _ = record.stages
    assert ingestion["records"] > ingestion["valid"] >= scoring["records"] > 0
    stored = spark.read.parquet(settings.path("sentiment"))
    assert stored.count() == scoring["records"]
    assert stored.filter("positive_prob not between 0 and 1").isEmpty()
    failed = G.run_stages(
        spark, G.RunSettings(str(tmp_path / "none"), str(tmp_path / "run")), "run_8"
    )
    assert failed.status == "FAILED" and "no input" in failed.errors[0]
    log = spark.read.schema(G.RUN_SCHEMA).json(settings.path("run_log"))
    assert {r.run_id: r.status for r in log.collect()} == {"run_7": "SUCCESS", "run_8": "FAILED"}
    assert log.filter(F.col("run_id") == "run_7").first().seconds_per_comment > 0
