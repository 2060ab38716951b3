"""Descriptive statistics. All are hash aggregates with map-side partials, so a
label, author or hour that holds most of the rows still arrives pre-aggregated."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbatide.functions import measures as M
from verbatide.functions.text import as_column
from verbatide.operators.quantiles import discrete_quantiles
from verbatide.storage import cut_lineage


def rounded(column, places: int) -> Column:
    return F.round(as_column(column), places)


def sentiment_counts(df: DataFrame, label: str = "sentiment") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))


def sentiment_distribution(df: DataFrame, label: str = "sentiment") -> DataFrame:
    """Count and percentage per label, most frequent first."""
    # The window sees one row per label.
    total = F.sum("count").over(Window.partitionBy())
    return (
        sentiment_counts(df, label)
        .withColumn("percentage", rounded(F.col("count") * 100.0 / total, 2))
        .orderBy(F.desc("count"), F.asc(label))
    )


def distribution_percent(counts: DataFrame, label: str, count: str = "count") -> DataFrame:
    """Share of each label in a table of counts; 0 where the total is 0."""
    total = F.sum(count).over(Window.partitionBy())
    share = F.when(total != 0, F.col(count) * 100.0 / total).otherwise(F.lit(0.0))
    return counts.select(label, count, rounded(share, 2).alias("percentage"))


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def value_histogram(df: DataFrame, value: str, places: int = 4) -> DataFrame:
    """Rows per value rounded to report precision, with their mean and the sum of squared
    distances from it."""
    return df.groupBy(F.round(value, places).alias("_value")).agg(
        F.count(value).alias("_n"),
        F.avg(value).alias("_mean"),
        (F.count(value) * F.var_pop(value)).alias("_spread"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )


QUARTILES = {"median": 0.5, "q1": 0.25, "q3": 0.75}


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are known; null if either is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    known = [F.when(both, F.col(name)) for name in (x, y)]
    # Merged partial results leave a constant with a deviation just above zero.
    varies = (F.min(known[0]) < F.max(known[0])) & (F.min(known[1]) < F.max(known[1]))
    deviations = F.nullif(F.stddev_pop(known[0]) * F.stddev_pop(known[1]), F.lit(0.0))
    return F.when(varies, F.covar_pop(x, y) / deviations)


def confidence_stats(df: DataFrame, value: str = "confidence", places: int = 4) -> DataFrame:
    """Mean, extremes, sample deviation and quartiles of the confidence, in one pass.

    The table is first reduced to one row per value at report precision, which is stored:
    at most 10^places + 1 rows for confidences in [0, 1], and for wider values as many as
    there are. Rounding keeps the order, so a quartile of the rounded values is the
    exact quartile, rounded. No sketch accuracy to tune, and no task sees all values.
    """
    histogram = cut_lineage(value_histogram(df.filter(F.col(value).isNotNull()), value, places))
    # Distances from the overall mean: sums of raw squares would lose them.
    centre = histogram.agg((F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("_centre"))
    spread = F.sum(F.col("_spread") + F.col("_n") * F.pow(F.col("_mean") - F.col("_centre"), 2))
    # All three have one row.
    return (
        histogram.crossJoin(F.broadcast(centre))
        .agg(
            rounded(F.first("_centre"), places).alias("average"),
            rounded(F.min("_min"), places).alias("minimum"),
            rounded(F.max("_max"), places).alias("maximum"),
            rounded(
                F.when(F.sum("_n") > 1, F.sqrt(spread / (F.sum("_n") - 1))), places
            ).alias("std_deviation"),
        )
        .crossJoin(F.broadcast(discrete_quantiles(histogram, QUARTILES)))
    )


def length_stats(df: DataFrame, length: str = "text_length") -> DataFrame:
    return df.agg(
        rounded(F.avg(length), 2).alias("average"),
        F.min(length).alias("minimum"),
        F.max(length).alias("maximum"),
        rounded(F.stddev(length), 2).alias("std_deviation"),
    )


def sentiment_by_confidence_range(df: DataFrame, bands=M.CONFIDENCE_BANDS) -> DataFrame:
    return (
        df.groupBy("sentiment", M.confidence_range("confidence", bands).alias("confidence_range"))
        .agg(F.count("*").alias("count"))
        .orderBy("sentiment", F.desc("count"), "confidence_range")
    )


def avg_confidence_by_sentiment(
    df: DataFrame, label: str = "sentiment", confidence: str = "confidence"
) -> DataFrame:
    return df.groupBy(label).agg(
        rounded(F.avg(confidence), 4).alias("average_confidence"),
        F.count("*").alias("sample_size"),
    )


def length_by_sentiment(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment").agg(
        rounded(F.avg("text_length"), 2).alias("avg_text_length"),
        rounded(F.avg("word_count"), 2).alias("avg_word_count"),
        F.min("text_length").alias("min_text_length"),
        F.max("text_length").alias("max_text_length"),
        rounded(F.stddev("text_length"), 2).alias("stddev_text_length"),
    )


def confidence_correlations(df: DataFrame) -> DataFrame:
    return df.agg(
        rounded(correlation("text_length", "confidence"), 4).alias("text_length_confidence"),
        rounded(correlation("word_count", "confidence"), 4).alias("word_count_confidence"),
    )


def sentiment_by_time_part(df: DataFrame, part: str, time_col: str) -> DataFrame:
    """Rows per (part, sentiment), where part is a key of ``time_parts``."""
    return (
        df.groupBy(M.time_parts(time_col)[part].alias(part), "sentiment")
        .agg(F.count("*").alias("count"))
        .orderBy(part, "sentiment")
    )


def hourly_sentiment(df: DataFrame, time_col: str = "created_utc") -> DataFrame:
    return sentiment_by_time_part(df, "hour", time_col)


def dow_sentiment(df: DataFrame, time_col: str = "created_utc") -> DataFrame:
    return sentiment_by_time_part(df, "day_of_week", time_col)


def hourly_trend(df: DataFrame, time_col: str = "created_utc") -> DataFrame:
    """As :func:`hourly_sentiment`, but empty where there is no time column."""
    if time_col not in df.columns:
        return df.sparkSession.createDataFrame([], "hour int, sentiment string, count bigint")
    return hourly_sentiment(df, time_col)


def model_usage(df: DataFrame) -> DataFrame:
    return df.groupBy("model_version").agg(
        F.count("*").alias("usage_count"),
        rounded(F.avg("confidence"), 4).alias("average_confidence"),
        rounded(F.coalesce(F.stddev("confidence"), F.lit(0.0)), 4).alias("confidence_stddev"),
    )


def model_by_sentiment(df: DataFrame) -> DataFrame:
    return df.groupBy("model_version", "sentiment").agg(
        F.count("*").alias("count"),
        rounded(F.avg("confidence"), 4).alias("avg_confidence"),
    )


def dashboard_metrics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_comments"),
        rounded(F.coalesce(F.avg("confidence"), F.lit(0.0)), 4).alias("average_confidence"),
    )


def confidence_histogram(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(M.confidence_bucket("confidence").alias("bucket"))
        .agg(F.count("*").alias("count"))
        .orderBy("bucket")
    )


def describe_columns(value: str, prefix: str) -> list:
    """The five describe() statistics as aggregates, so several share one pass."""
    return [
        F.count(value).alias(f"{prefix}_count"),
        F.avg(value).alias(f"{prefix}_mean"),
        F.stddev(value).alias(f"{prefix}_stddev"),
        F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
    ]


def ingestion_stats(df: DataFrame, approximate_authors: bool = False) -> DataFrame:
    """Totals, lengths, distinct authors (null counts as one) and scores at once."""
    authors = F.approx_count_distinct if approximate_authors else F.count_distinct
    has_null_author = F.coalesce(F.max(F.col("author").isNull().cast("int")), F.lit(0))
    aggregates = [
        F.count("*").alias("total_records"),
        F.count_if(F.col("is_valid") == "valid").alias("valid_records"),
        *describe_columns("comment_length", "length"),
        (authors("author") + has_null_author).alias("unique_authors"),
    ]
    if "score" in df.columns:
        aggregates += describe_columns("score", "score")
    return df.agg(*aggregates)


# Registers of the authors' sketches, as a power of two: standard error 0.8 %, 16 KB each.
AUTHOR_BITS = 14


def batch_ingestion_stats(df: DataFrame, *batch) -> DataFrame:
    """Statistics that can be merged later, one row in all or for each value of ``batch``.

    Authors are kept as a sketch, of fixed size for any number of them, so a table of past
    batches tells how many there are in all without reading any comment again.
    """
    measures = ["comment_length", *(["score"] if "score" in df.columns else [])]
    return df.groupBy(*batch).agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("is_valid") == "valid").alias("valid_records"),
        F.hll_sketch_agg("author", AUTHOR_BITS).alias("authors"),
        F.coalesce(F.max(F.col("author").isNull()), F.lit(False)).alias("null_author"),
        *[
            piece
            for name in measures
            for piece in (
                F.count(name).alias(f"{name}_n"),
                F.avg(name).alias(f"{name}_mean"),
                (F.count(name) * F.var_pop(name)).alias(f"{name}_spread"),
                F.min(name).alias(f"{name}_min"),
                F.max(name).alias(f"{name}_max"),
            )
        ],
    )


def merged_ingestion_stats(batches: DataFrame) -> DataFrame:
    """As ingestion_stats, with estimated authors, from stored batch_ingestion_stats."""
    measures = {"comment_length": "length", "score": "score"}
    measures = {name: short for name, short in measures.items() if f"{name}_n" in batches.columns}

    def weighted(name):
        return F.sum(F.col(f"{name}_n") * F.col(f"{name}_mean"))

    # One row.
    centres = batches.agg(
        *[
            (weighted(name) / F.nullif(F.sum(f"{name}_n"), F.lit(0))).alias(f"{name}_centre")
            for name in measures
        ]
    )
    described = []
    for name, short in measures.items():
        rows, off = F.sum(f"{name}_n"), F.col(f"{name}_mean") - F.col(f"{name}_centre")
        spread = F.sum(F.col(f"{name}_spread") + F.col(f"{name}_n") * off * off)
        described += [
            F.coalesce(rows, F.lit(0)).alias(f"{short}_count"),
            F.first(f"{name}_centre").alias(f"{short}_mean"),
            F.when(rows > 1, F.sqrt(spread / F.nullif(rows - 1, F.lit(0)))).alias(f"{short}_stddev"),
            F.min(f"{name}_min").alias(f"{short}_min"),
            F.max(f"{name}_max").alias(f"{short}_max"),
        ]
    null_author = F.coalesce(F.max(F.col("null_author").cast("int")), F.lit(0))
    return batches.crossJoin(F.broadcast(centres)).agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("valid_records"), F.lit(0)).alias("valid_records"),
        *described,
        (F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("authors")), F.lit(0)) + null_author).alias(
            "unique_authors"
        ),
    )


def scan_counts(df: DataFrame) -> DataFrame:
    """Total rows and rows with a text that is neither null nor empty."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("text").isNotNull() & (F.col("text") != "")).alias("non_empty_text"),
    )


def text_statistics(df: DataFrame) -> DataFrame:
    """Means of length, words and score and the deviation of length; null becomes 0."""

    def or_zero(column):
        return F.coalesce(column, F.lit(0.0))

    return df.agg(
        rounded(or_zero(F.avg("comment_length")), 4).alias("avg_length"),
        rounded(or_zero(F.stddev("comment_length")), 4).alias("std_length"),
        rounded(or_zero(F.avg("word_count")), 4).alias("avg_words"),
        rounded(or_zero(F.avg("score")), 4).alias("avg_score"),
    )


def overall_verdict(df: DataFrame, label: str = "sentiment", three_way: bool = False) -> DataFrame:
    """The label that leads strictly, else Neutral.

    Two-way compares positive with negative only; three-way also needs the
    leader to beat neutral.
    """
    name = F.lower(F.col(label))
    counted = df.agg(
        *[F.count_if(name == side).alias(side) for side in ("positive", "negative", "neutral")]
    )
    positive, negative, neutral = (F.col(c) for c in ("positive", "negative", "neutral"))
    ahead, behind = positive > negative, negative > positive
    if three_way:
        ahead, behind = ahead & (positive > neutral), behind & (negative > neutral)
    return counted.withColumn(
        "overall", F.when(ahead, "Positive").when(behind, "Negative").otherwise("Neutral")
    )


def top_examples(
    df: DataFrame,
    k: int = 3,
    labels=("Positive", "Negative"),
    label: str = "sentiment_label",
    confidence: str = "confidence_score",
    example=None,
) -> DataFrame:
    """The k most confident examples of each label; ties go to the smaller id.

    The text is cut to the example before ranking, so only short rows are
    sorted; Spark limits each partition to k rows per label before its shuffle.
    """
    example = F.substring("text", 1, 100) if example is None else example
    ranking = Window.partitionBy(label).orderBy(F.desc(confidence), F.asc("id"))
    return (
        df.filter(F.col(label).isin(*labels))
        .select(label, "id", F.col(confidence), example.alias("text"))
        .withColumn("rank", F.row_number().over(ranking))
        .filter(F.col("rank") <= k)
    )


def ordered_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group, the largest first, ties by key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), *keys)
