"""From raw comments to flagged, comparable ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.functions import text as T
from verbatide.operators.once import with_columns_once


def run_timestamp(run_ts=None) -> Column:
    """The run's time: the value given, else the time the query starts."""
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(run_ts).cast("timestamp")


def add_metadata(df: DataFrame, run_ts=None) -> DataFrame:
    """processing_timestamp, a unique record_id, and the raw text's length.

    record_id is unique, not dense, and differs between runs. Streams go
    without: such numbers would start again with every micro-batch.
    """
    columns = {
        "processing_timestamp": run_timestamp(run_ts),
        "comment_length": F.length("text"),
    }
    if not df.isStreaming:
        columns["record_id"] = F.monotonically_increasing_id()
    return df.withColumns(columns)


def normalize_comments(df: DataFrame) -> DataFrame:
    return with_columns_once(df, {"text": T.normalize_text("text")})


def flag_valid(df: DataFrame) -> DataFrame:
    return df.withColumn("is_valid", T.validity_flag("text"))


def ingest(df: DataFrame, run_ts=None) -> DataFrame:
    """Metadata first (it measures the raw text), then normalising and flagging."""
    return df.transform(add_metadata, run_ts).transform(normalize_comments).transform(flag_valid)


def filter_valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_valid") == "valid")


def retention_counts(df: DataFrame) -> DataFrame:
    """Retained and total rows of a flagged frame, in one pass."""
    return df.agg(
        F.count_if(F.col("is_valid") == "valid").alias("retained"),
        F.count("*").alias("total"),
    )


def default_columns(
    df: DataFrame,
    run_ts=None,
    author: str = "unknown",
    score: int = 1,
    subreddit: str = "unknown",
    post_id: str = "extracted",
) -> DataFrame:
    """Bring rows that have at least (id, text) into the enriched schema.

    Missing columns and null values get the defaults; label and confidence are
    null placeholders until something scores the rows.
    """
    now = run_timestamp(run_ts)
    text = F.coalesce(F.col("text"), F.lit(""))
    defaults = {
        "author": (F.lit(author), "string"),
        "score": (F.lit(score), "int"),
        "created_utc": (now.cast("double"), "double"),
        "subreddit": (F.lit(subreddit), "string"),
        "post_id": (F.lit(post_id), "string"),
        "extraction_timestamp": (F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"), "string"),
        "comment_length": (F.length(text), "int"),
        "word_count": (T.word_count(text), "int"),
        "contains_url": (T.contains_url(text), "boolean"),
        "is_question": (T.is_question(text), "boolean"),
        "sentiment_label": (F.lit(None), "string"),
        "confidence_score": (F.lit(None), "double"),
    }

    def filled(name):
        value, kind = defaults[name]
        value = value.cast(kind)
        return F.coalesce(F.col(name).cast(kind), value) if name in df.columns else value

    return df.select(
        F.col("id").cast("string").alias("id"),
        filled("author").alias("author"),
        text.alias("text"),
        *[filled(name).alias(name) for name in list(defaults)[1:]],
    )


def derive_flags(df: DataFrame) -> DataFrame:
    """Length, word count, and whether the text holds a link or a question mark."""
    return df.withColumns(
        {
            "comment_length": F.length("text"),
            "word_count": T.word_count("text"),
            "contains_url": T.contains_url("text"),
            "is_question": T.is_question("text"),
        }
    )
