"""Aggregates, row numbers and reports against pandas and against each other."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from verbatide.operators import encoding as E
from verbatide.operators import evaluation as V
from verbatide.operators import quantiles
from verbatide.operators import statistics as A
from verbatide.operators.quantiles import discrete_quantiles
from verbatide.operators.ordering import with_row_index
from verbatide.plans import report as R
from workload import fixtures as X


@pytest.fixture(scope="module")
def scored(spark, small):
    return X.scored(spark, small).cache()


def test_row_index_is_dense_and_ordered(spark):
    rows = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k")).repartition(9)
    numbered = with_row_index(rows, ["k"], "n", start=1).orderBy("k").toPandas()
    assert numbered["n"].tolist() == list(range(1, 5001))
    assert with_row_index(rows.filter("k < 0"), ["k"], "n").count() == 0


def test_confidence_quartiles_are_exact(spark):
    values = [((i * 37) % 1009) / 1009 for i in range(1009)] + [None]
    rows = spark.createDataFrame([(v,) for v in values], "confidence double").repartition(5)
    stats = A.confidence_stats(rows).first().asDict()
    series = pd.Series(values).dropna().sort_values().reset_index(drop=True)
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        rank = -(-len(series) * share // 1)
        assert stats[name] == round(series[int(rank) - 1], 4)
    assert stats["std_deviation"] == round(series.std(), 4)
    assert stats["average"] == round(series.mean(), 4)


def test_statistics_of_nothing_and_of_one_row(spark):
    schema = "sentiment string, confidence double, text_length int, word_count int, model_version string"
    empty = spark.createDataFrame([], schema)
    one = spark.createDataFrame([("positive", 0.5, 10, 2, "m")], schema)
    assert A.confidence_stats(empty).first().average is None
    assert A.confidence_stats(one).first().std_deviation is None
    report = R.comprehensive_report(empty).filter("section = 'metadata' and metric = 'total_records'")
    assert report.first().value == 0
    usage = R.comprehensive_report(one).filter("metric = 'confidence_stddev'").first()
    assert usage.value == 0


def test_report_agrees_with_single_operators(spark, scored):
    rows = R.comprehensive_report(scored).toPandas()

    def section(name):
        part = rows[rows.section == name]
        return {(r.key1, r.key2, r.metric): r.value for r in part.itertuples()}

    distribution = section("sentiment_distribution")
    for row in A.sentiment_distribution(scored).collect():
        assert distribution[(row.sentiment, None, "count")] == row["count"]
        assert distribution[(row.sentiment, None, "percentage")] == row.percentage
    total = sum(v for (_, _, metric), v in distribution.items() if metric == "count")
    assert total == section("metadata")[(None, None, "total_records")] == scored.count()
    stats = section("confidence_statistics")
    for name, value in A.confidence_stats(scored).first().asDict().items():
        assert stats[(None, None, name)] == value
    correlations = section("correlations")
    for name, value in A.confidence_correlations(scored).first().asDict().items():
        assert correlations[(None, None, name)] == value
    for row in A.length_by_sentiment(scored).collect():
        lengths = section("length_by_sentiment")
        assert lengths[(row.sentiment, None, "stddev_text_length")] == row.stddev_text_length


def test_report_keeps_going_without_columns(spark, scored):
    rows = R.comprehensive_report(scored.select("sentiment", "confidence")).collect()
    errors = {row.section for row in rows if row.metric == "error"}
    assert errors == {
        "text_analysis", "temporal_analysis", "model_performance", "cluster_sentiment"
    }
    assert any(row.section == "confidence_statistics" for row in rows)


def counted(df, seen):
    """The rows as they are; each one read adds one to the accumulator."""

    def pass_on(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(pass_on, df.schema)


def test_report_reads_its_input_once(spark, scored):
    seen = spark.sparkContext.accumulator(0)
    report = R.comprehensive_report(counted(scored, seen))
    report.collect()
    assert seen.value == scored.count()
    # A profile may be long: the only windows are those of a few bounded values a share.
    windows = [line for line in plan(report).splitlines() if "- Window [" in line]
    assert windows and all("[_share" in line for line in windows)


def test_report_sections_fail_alone(spark, scored):
    whole = {tuple(r) for r in R.comprehensive_report(scored).collect()}
    broken = {
        "text_analysis": scored.withColumn("word_count", F.lit("many")),
        "temporal_analysis": scored.withColumn("created_utc", F.lit("yesterday")),
        "cluster_sentiment": scored.withColumn("positive_prob", F.lit("some")),
    }
    for group, rows in broken.items():
        report = R.comprehensive_report(rows).collect()
        assert {r.section for r in report if r.metric == "error"} == {group}
        kept = {tuple(r) for r in report if r.metric != "error"}
        lost = {r[0] for r in whole - kept}
        assert kept <= whole and lost and not any(name.startswith("sentiment_dist") for name in lost)
    arrays = R.comprehensive_report(scored.withColumn("created_utc", F.array(F.lit(1)))).collect()
    assert {r.section for r in arrays if r.metric == "error"} == {"temporal_analysis"}
    few = R.comprehensive_report(scored, clusters=0).filter("section = 'cluster_sentiment'")
    assert few.isEmpty()


def test_quantiles_narrow_to_the_same_values(spark, monkeypatch):
    generator = random.Random(3)
    values = [generator.choice((-1, 1)) * 10 ** generator.uniform(-6, 12) for _ in range(4000)]
    values += [5e-324, -1e308, 1.7e308, float("inf"), 0.0, -0.0, 250.0] + [7.25] * 900
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    histogram = rows.groupBy("v").agg(F.count("*").alias("n"))
    shares = {f"q{i}": i / 20 for i in range(1, 21)}
    ordered = sorted(values)
    expected = {name: ordered[max(0, math.ceil(share * len(values) - 1e-9) - 1)] for name, share in shares.items()}
    assert discrete_quantiles(histogram, shares, "v", "n").first().asDict() == expected
    monkeypatch.setattr(quantiles, "FEW", 10)
    assert discrete_quantiles(histogram, shares, "v", "n").first().asDict() == expected
    assert discrete_quantiles(histogram.filter("v is null"), shares, "v", "n").first().q1 is None
    only = histogram.filter("isnan(v) or v = 250.0")
    assert discrete_quantiles(only, {"m": 0.5}, "v", "n").first().m == 250.0


def test_batches_merge_to_the_whole(spark, small):
    rows = X.ingested(spark, small)
    whole = A.ingestion_stats(rows).first().asDict()
    batches = A.batch_ingestion_stats(rows, "depth").unionByName(A.batch_ingestion_stats(rows.limit(0), "depth"))
    merged = A.merged_ingestion_stats(batches).first().asDict()
    assert abs(merged.pop("unique_authors") - whole.pop("unique_authors")) <= 2
    assert merged == pytest.approx(whole)
    nothing = A.merged_ingestion_stats(A.batch_ingestion_stats(rows.limit(0), "depth")).first()
    assert (nothing.total_records, nothing.length_stddev, nothing.unique_authors) == (0, None, 0)


def test_top_examples_limit_before_the_shuffle(spark, small):
    top = A.top_examples(X.rule_scored(spark, small))
    assert "WindowGroupLimit" in plan(top) and "Partial" in plan(top)
    rows = top.collect()
    assert len(rows) == 6 and all(len(row.text) <= 100 for row in rows)


def test_verdict(spark):
    counts = [("Positive", 2), ("Negative", 2), ("Neutral", 3)]
    rows = spark.createDataFrame(
        [(label,) for label, n in counts for _ in range(n)], "sentiment string"
    )
    assert A.overall_verdict(rows).first().overall == "Neutral"
    more = rows.union(rows.limit(0)).union(spark.createDataFrame([("Positive",)], "sentiment string"))
    assert A.overall_verdict(more).first().overall == "Positive"
    assert A.overall_verdict(more, three_way=True).first().overall == "Neutral"


def test_batched_evaluation(spark):
    logits = [(i, (i % 9) - 4.0, int(i % 3 == 0)) for i in range(100)]
    rows = spark.createDataFrame(logits, "k int, logit double, label int").repartition(6)
    found = V.batched_evaluation(rows, "k", batch_size=32).first()
    frame = pd.DataFrame(logits, columns=["k", "logit", "label"])
    frame["hit"] = ((frame.logit > 0).astype(int) == frame.label).astype(float)
    assert found.batches == 4
    assert found.accuracy == round(frame.groupby(frame.k // 32).hit.mean().mean(), 6)


def test_best_run(spark):
    runs = [("a", 1, 0.5), ("a", 2, 0.7), ("a", 3, 0.7), ("a", 4, 0.6), ("b", 1, 0.0)]
    rows = spark.createDataFrame(runs, "name string, epoch int, accuracy double")
    assert [tuple(r) for r in V.select_best_run(rows, ["name"]).collect()] == [("a", 2, 0.7)]
    assert V.select_best_run(rows.filter("name = 'b'")).count() == 0


def test_encoding(spark):
    rows = spark.createDataFrame(
        [(1, "B a a"), (2, "a"), (3, ""), (4, None), (5, "a b c d e f")], "id int, text string"
    )
    vocabulary = E.build_vocabulary(rows)
    ids = {r.token: r.token_id for r in vocabulary.collect()}
    assert (ids["a"], ids["b"], ids["c"]) == (4, 5, 6)
    encoded = {r.id: r for r in E.encode_tokens(rows, vocabulary, 5).collect()}
    assert encoded[1].input_ids == [2, 5, 4, 4, 3] and encoded[1].attention_mask == [1] * 5
    assert encoded[2].input_ids == [2, 4, 3, 0, 0] and encoded[2].attention_mask == [1, 1, 1, 0, 0]
    assert encoded[3].input_ids == encoded[4].input_ids == [2, 3, 0, 0, 0]
    assert encoded[5].input_ids == [2, 4, 5, 6, 3]
    few = vocabulary.filter("token = 'a'")
    cut = {r.id: r for r in E.encode_tokens(rows, few, 5).collect()}
    assert cut[1].input_ids == [2, 1, 4, 4, 3]


def test_encoding_reads_texts_once(spark, tmp_path):
    many = spark.range(0, 3000, 1, 40).selectExpr("id", "concat('a b w', id % 300) text")
    many.write.parquet(str(tmp_path / "texts"))
    rows = spark.read.parquet(str(tmp_path / "texts"))
    vocabulary = E.build_vocabulary(rows)
    encoded = E.encode_tokens(rows, vocabulary, 5)
    encoded.collect()
    final = plan(encoded).split("Initial Plan")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_encoding_has_no_longest_length(spark):
    rows = spark.createDataFrame([(1, "a " * 20000)], "id int, text string")
    encoded = E.encode_tokens(rows, E.build_vocabulary(rows), 15000).first()
    assert encoded.input_ids == [2, *[4] * 14998, 3]


def test_encoding_finds_rare_and_long_tokens(spark, monkeypatch):
    monkeypatch.setattr(E, "HEAD_TOKENS", 1)
    long = "x" * 200
    rows = spark.createDataFrame([(1, f"a a {long} a b"), (2, f"{long} c")], "id int, text string")
    vocabulary = E.build_vocabulary(rows)
    ids = {r.token: r.token_id for r in vocabulary.collect()}
    encoded = {r.id: r.input_ids for r in E.encode_tokens(rows, vocabulary, 7).collect()}
    assert encoded[1] == [2, ids["a"], ids["a"], ids[long], ids["a"], ids["b"], 3]
    assert encoded[2] == [2, ids[long], ids["c"], 3, 0, 0, 0]


def test_row_index_divides_a_hot_key(spark):
    # A third of the rows share one key.
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    rows = spark.range(0, 30000).select(hot.alias("k"), F.col("id").alias("v"))
    numbered = with_row_index(rows, ["k"], "n").withColumn("part", F.spark_partition_id())
    assert numbered.agg(F.count_distinct("n"), F.max("n")).first()[:] == (30000, 29999)
    in_order = numbered.filter("k = -1").agg(F.max("n")).first()[0]
    assert in_order == 9999
