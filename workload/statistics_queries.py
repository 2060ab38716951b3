"""Aggregates, reports, top-k, evaluation (A, T, O3)."""

from pyspark.sql import functions as F

from verbatide.functions.text import truncate_example
from verbatide.operators import evaluation as V
from verbatide.operators import preprocess as P
from verbatide.operators import statistics as A
from verbatide.plans import report as R
from verbatide.storage import scratch_path
from workload import fixtures as X
from workload import reports_sql as sql
from workload.oracle import using
from workload.registry import query


@query(
    "a1_sentiment_distribution",
    using(
        "scored",
        """select sentiment, count(*) as count,
        round(count(*) * 100.0::double / (select count(*) from scored), 2) as percentage
        from scored group by sentiment order by count desc""",
    ),
)
def a1(spark, sf_dir):
    return A.sentiment_distribution(X.scored(spark, sf_dir))


@query(
    "a2_confidence_stats",
    using(
        "scored",
        """select round(avg(confidence), 4) as average, round(min(confidence), 4) as minimum,
        round(max(confidence), 4) as maximum, round(stddev_samp(confidence), 4) as std_deviation,
        round(quantile_disc(confidence, 0.5), 4) as median,
        round(quantile_disc(confidence, 0.25), 4) as q1,
        round(quantile_disc(confidence, 0.75), 4) as q3 from scored""",
    ),
)
def a2(spark, sf_dir):
    return A.confidence_stats(X.scored(spark, sf_dir))


@query(
    "a2_wide_values",
    """select round(avg(v), 4) as average, round(min(v), 4) as minimum, round(max(v), 4) as maximum,
    round(stddev_samp(v), 4) as std_deviation, quantile_disc(r, 0.5) as median,
    quantile_disc(r, 0.25) as q1, quantile_disc(r, 0.75) as q3
    from (select value as v, round(value, 4) as r from events)""",
)
def a2_wide(spark, sf_dir):
    return A.confidence_stats(X.table(spark, sf_dir, "events"), "value")


@query(
    "a3_length_stats",
    using(
        "scored",
        """select round(avg(text_length), 2) as average, min(text_length) as minimum,
        max(text_length) as maximum, round(stddev_samp(text_length), 2) as std_deviation
        from scored""",
    ),
)
def a3(spark, sf_dir):
    return A.length_stats(X.scored(spark, sf_dir))


@query(
    "a4_sentiment_by_confidence_range",
    using(
        "scored",
        """select sentiment, case when confidence >= 0.8 then 'High (0.8+)'
        when confidence >= 0.6 then 'Medium (0.6-0.8)' when confidence >= 0.4
        then 'Low (0.4-0.6)' else 'Very Low (<0.4)' end as confidence_range, count(*) as count
        from scored group by all order by sentiment, count desc""",
    ),
)
def a4(spark, sf_dir):
    return A.sentiment_by_confidence_range(X.scored(spark, sf_dir))


@query(
    "a5_avg_confidence_by_sentiment",
    using(
        "scored",
        """select sentiment, round(avg(confidence), 4) as average_confidence,
        count(*) as sample_size from scored group by sentiment""",
    ),
)
def a5(spark, sf_dir):
    return A.avg_confidence_by_sentiment(X.scored(spark, sf_dir))


@query(
    "a6_length_by_sentiment",
    using(
        "scored",
        """select sentiment, round(avg(text_length), 2) as avg_text_length,
        round(avg(word_count), 2) as avg_word_count, min(text_length) as min_text_length,
        max(text_length) as max_text_length, round(stddev_samp(text_length), 2)
          as stddev_text_length from scored group by sentiment""",
    ),
)
def a6(spark, sf_dir):
    return A.length_by_sentiment(X.scored(spark, sf_dir))


@query(
    "a7_confidence_correlations",
    using(
        "scored",
        """select round(corr(text_length, confidence), 4) as text_length_confidence,
        round(corr(word_count, confidence), 4) as word_count_confidence from scored""",
    ),
)
def a7(spark, sf_dir):
    return A.confidence_correlations(X.scored(spark, sf_dir))


@query(
    "a7_constant",
    using(
        "scored",
        """select null::double as text_length_confidence,
        null::double as word_count_confidence from (select count(*) from scored)""",
    ),
)
def a7_constant(spark, sf_dir):
    # One confidence for all: no correlation, and no division by zero.
    return A.confidence_correlations(X.scored(spark, sf_dir).withColumn("confidence", F.lit(0.5)))


HOURLY = """select hour(created_utc)::int as hour, sentiment, count(*) as count
    from scored group by all order by 1, 2"""


@query("a8_hourly_sentiment", using("scored", HOURLY))
def a8(spark, sf_dir):
    return A.hourly_sentiment(X.scored(spark, sf_dir))


@query(
    "a9_dow_sentiment",
    using(
        "scored",
        """select (dayofweek(created_utc) + 1)::int as day_of_week, sentiment, count(*) as count
        from scored group by all order by 1, 2""",
    ),
)
def a9(spark, sf_dir):
    return A.dow_sentiment(X.scored(spark, sf_dir))


@query(
    "a11_model_usage",
    using(
        "scored",
        """select model_version, count(*) as usage_count,
        round(avg(confidence), 4) as average_confidence,
        round(coalesce(stddev_samp(confidence), 0), 4) as confidence_stddev
        from scored group by model_version""",
    ),
)
def a11(spark, sf_dir):
    return A.model_usage(X.scored(spark, sf_dir))


@query(
    "a12_model_by_sentiment",
    using(
        "scored",
        """select model_version, sentiment, count(*) as count,
        round(avg(confidence), 4) as avg_confidence from scored group by all""",
    ),
)
def a12(spark, sf_dir):
    return A.model_by_sentiment(X.scored(spark, sf_dir))


@query(
    "a13_dashboard_metrics",
    using(
        "scored",
        """select count(*) as total_comments,
        round(coalesce(avg(confidence), 0), 4) as average_confidence from scored""",
    ),
)
def a13(spark, sf_dir):
    return A.dashboard_metrics(X.scored(spark, sf_dir))


@query(
    "a14_sentiment_counts",
    using("scored", "select sentiment, count(*) as count from scored group by sentiment"),
)
def a14(spark, sf_dir):
    return A.sentiment_counts(X.scored(spark, sf_dir))


@query(
    "a15_confidence_histogram",
    using(
        "scored",
        """select trunc(confidence * 10)::int / 10.0::double as bucket, count(*) as count
        from scored group by all order by 1""",
    ),
)
def a15(spark, sf_dir):
    return A.confidence_histogram(X.scored(spark, sf_dir))


@query("a16_hourly_trend", using("scored", HOURLY))
def a16(spark, sf_dir):
    return A.hourly_trend(X.scored(spark, sf_dir))


@query(
    "a17_ingestion_stats",
    using(
        "ingested",
        """select count(*) as total_records, count(*) filter (is_valid = 'valid') as valid_records,
        count(comment_length) as length_count, round(avg(comment_length), 4) as length_mean,
        round(stddev_samp(comment_length), 4) as length_stddev, min(comment_length) as length_min,
        max(comment_length) as length_max,
        count(distinct author) + max((author is null)::int) as unique_authors,
        count(score) as score_count, round(avg(score), 4) as score_mean,
        round(stddev_samp(score), 4) as score_stddev, min(score) as score_min,
        max(score) as score_max from ingested""",
    ),
)
def a17(spark, sf_dir):
    stats = A.ingestion_stats(X.ingested(spark, sf_dir))
    means = ("length_mean", "length_stddev", "score_mean", "score_stddev")
    return stats.withColumns({name: F.round(name, 4) for name in means})


@query(
    "a17_batches",
    using(
        "ingested",
        """select 7::bigint as batches, count(*) as total_records,
        count(*) filter (is_valid = 'valid') as valid_records,
        count(comment_length) as length_count, round(avg(comment_length), 4) as length_mean,
        round(stddev_samp(comment_length), 4) as length_stddev, min(comment_length) as length_min,
        max(comment_length) as length_max, count(score) as score_count,
        round(avg(score), 4) as score_mean, round(stddev_samp(score), 4) as score_stddev,
        min(score) as score_min, max(score) as score_max, true as authors_within_3_percent
        from ingested""",
    ),
)
def a17_batches(spark, sf_dir):
    """Seven batches are stored as statistics and merged; no comment is read for that."""
    rows = X.ingested(spark, sf_dir)
    path = scratch_path(spark, "batches")
    batch = (F.pmod(F.xxhash64("id"), F.lit(7))).alias("batch")
    A.batch_ingestion_stats(rows, batch).write.parquet(path)
    stored = spark.read.parquet(path)
    exact = rows.agg(
        (F.count_distinct("author") + F.max(F.col("author").isNull().cast("int"))).alias("exact")
    )
    means = ("length_mean", "length_stddev", "score_mean", "score_stddev")
    # One row each.
    return (
        A.merged_ingestion_stats(stored)
        .crossJoin(exact)
        .crossJoin(stored.agg(F.count("*").alias("batches")))
        .withColumns({name: F.round(name, 4) for name in means})
        .withColumn(
            "authors_within_3_percent",
            F.abs(F.col("unique_authors") - F.col("exact")) <= 0.03 * F.col("exact"),
        )
        .drop("unique_authors", "exact")
    )


def exact_values(report):
    """Extremes come unrounded; both sides are rounded for comparison."""
    return report.withColumn("value", F.round("value", 6))


@query(
    "a18_sentiment_summary",
    using(
        "scored",
        f"select * replace (round(value, 6) as value) from ({sql.summary('scored')})",
    ),
)
def a18(spark, sf_dir):
    return exact_values(R.sentiment_summary(X.scored(spark, sf_dir)))


@query(
    "a19_text_statistics",
    using(
        "rule_scored",
        """select round(coalesce(avg(comment_length), 0), 4) as avg_length,
        round(coalesce(stddev_samp(comment_length), 0), 4) as std_length,
        round(coalesce(avg(word_count), 0), 4) as avg_words,
        round(coalesce(avg(score), 0), 4) as avg_score from rule_scored""",
    ),
)
def a19(spark, sf_dir):
    return A.text_statistics(X.rule_scored(spark, sf_dir))


@query("a20_total_rows", using("rule_scored", "select count(*) as total from rule_scored"))
def a20(spark, sf_dir):
    return A.total_rows(X.rule_scored(spark, sf_dir))


@query(
    "a21_accuracy_from_logits",
    using("hits", "select round(avg(hit), 6) as accuracy from hits"),
)
def a21(spark, sf_dir):
    return V.accuracy_from_logits(X.logits(spark, sf_dir))


@query(
    "a22_batched_evaluation",
    using(
        "hits",
        """select round(avg(accuracy), 6) as accuracy, round(sum(loss), 6) as loss,
        count(*) as batches from (select avg(hit) as accuracy, avg(loss) as loss from
          (select *, (row_number() over (order by event_id) - 1) // 32 as batch from hits)
          group by batch)""",
    ),
)
def a22(spark, sf_dir):
    return V.batched_evaluation(X.logits(spark, sf_dir), "event_id")


REPORT_COLUMNS = [
    "id", "author", "score", "depth", "created_utc", "subreddit", "post_id",
    "processing_timestamp", "comment_length", "record_id", "text", "is_valid", "text_cleaned",
    "word_count", "text_length", "sentiment", "confidence", "positive_prob", "negative_prob",
    "neutral_prob", "model_version",
]


def over_clusters(report):
    """The report with its clusters' counts added up by sentiment."""
    clustered = F.col("section") == "cluster_sentiment"
    summed = report.filter(clustered).groupBy("section", "key2", "metric", "note").agg(
        F.sum("value").alias("value"), F.lit(None).cast("string").alias("key1")
    )
    return report.filter(~clustered).unionByName(summed)


def with_long_texts(df):
    return df.withColumn("text_length", F.col("text_length") + F.lit(1_000_000_000))


@query(
    "a23_large_lengths",
    using(
        "scored",
        "select * from (with long as (select * replace (text_length + 1000000000 as text_length) "
        "from scored) " + sql.comprehensive("long", REPORT_COLUMNS) + ")",
    ),
)
def a23_large(spark, sf_dir):
    return over_clusters(R.comprehensive_report(with_long_texts(X.scored(spark, sf_dir))))


@query("a23_comprehensive_report", using("scored", sql.comprehensive("scored", REPORT_COLUMNS)))
def a23(spark, sf_dir):
    return over_clusters(R.comprehensive_report(X.scored(spark, sf_dir)))


@query(
    "a23_failing_section",
    using(
        "scored",
        "select * from (" + sql.comprehensive("scored", REPORT_COLUMNS) + """)
        where section not in ('text_length_statistics', 'length_by_sentiment', 'correlations')
        union all select 'text_analysis', null, null, 'error', null,
        'text_length, word_count or confidence holds no number in some rows'""",
    ),
)
def a23_failing(spark, sf_dir):
    words = F.when(F.col("word_count") % 2 == 0, F.lit("many")).otherwise(F.col("word_count").cast("string"))
    return over_clusters(R.comprehensive_report(X.scored(spark, sf_dir).withColumn("word_count", words)))


@query("a24_dashboard", using("scored", sql.dashboard("scored")))
def a24(spark, sf_dir):
    return R.dashboard(X.scored(spark, sf_dir))


TOP = """select sentiment_label, id, confidence_score, {example} as text, rank::int as rank
    from (select *, row_number() over (partition by sentiment_label
      order by confidence_score desc, id) as rank from rule_scored
      where sentiment_label in ('Positive', 'Negative')) where rank <= 3"""
MARKED = "case when length(text) > 100 then substring(text, 1, 100) || '...' else text end"


@query("t1_top_examples", using("rule_scored", TOP.format(example="substring(text, 1, 100)")))
def t1(spark, sf_dir):
    return A.top_examples(X.rule_scored(spark, sf_dir))


@query("t1_top_examples_marked", using("rule_scored", TOP.format(example=MARKED)))
def t1_marked(spark, sf_dir):
    return A.top_examples(X.rule_scored(spark, sf_dir), example=truncate_example("text"))


@query(
    "t2_ordered_groups",
    using(
        "comments",
        """select subreddit, count(*) as count from comments
        group by subreddit order by count desc, subreddit""",
    ),
)
def t2(spark, sf_dir):
    return A.ordered_groups(X.comments(spark, sf_dir), "subreddit")


@query(
    "t3_sample_rows",
    using("scored", "select id, sentiment, confidence from scored order by id limit 10"),
)
def t3(spark, sf_dir):
    return P.sample_rows(X.scored(spark, sf_dir), 10, ["id", "sentiment", "confidence"])


@query(
    "t4_select_best_run",
    using(
        "hits",
        """select user_id, epoch, accuracy from (select *, row_number() over
          (partition by user_id order by accuracy desc, epoch) as rank from
          (select user_id, day(ts)::int as epoch, round(avg(hit), 6) as accuracy
           from hits join events using (event_id) group by all)
          where accuracy > 0) where rank = 1""",
    ),
)
def t4(spark, sf_dir):
    return V.select_best_run(X.runs(spark, sf_dir), ["user_id"])


@query(
    "o3_analyze_results_v2",
    using("rule_scored", sql.analysis("rule_scored", "substring(text, 1, 100)")),
)
def o3(spark, sf_dir):
    return R.results_analysis(X.rule_scored(spark, sf_dir))
