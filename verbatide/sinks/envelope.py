"""Results with numbered comments and a summary around them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.operators.ingest import run_timestamp
from verbatide.operators.ordering import with_row_index
from verbatide.storage import cut_lineage


def envelope_details(df: DataFrame, order_by="id", run_ts=None) -> DataFrame:
    """All comments numbered from 1 in the order of a key: nulls first, ties by a hash.

    Rows are stored before they are sorted, as sorting by ranges samples its input and
    would score texts for that as well. Whatever ids are missing or repeated, there is
    one row for each that came in.
    """
    columns = dict.fromkeys([order_by, "text", "sentiment", "confidence"])
    stored = cut_lineage(df.select(*columns))
    return with_row_index(stored, [order_by], "comment_id", start=1).select(
        "comment_id",
        F.col("text").alias("comment"),
        "sentiment",
        "confidence",
        run_timestamp(run_ts).alias("timestamp"),
    )


def envelope_summary(df: DataFrame, seconds: float, run_ts=None) -> DataFrame:
    """One row: when, how many, how long, and the count of each label."""
    counts = df.groupBy("sentiment").agg(F.count("*").alias("count"))
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_comments"),
        F.sort_array(F.collect_list(F.struct("sentiment", "count"))).alias(
            "sentiment_distribution"
        ),
    ).select(
        run_timestamp(run_ts).alias("analysis_timestamp"),
        "total_comments",
        F.lit(float(seconds)).alias("processing_time_seconds"),
        "sentiment_distribution",
    )
