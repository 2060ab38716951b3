"""Sentiment of comments as their files arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verbatide.operators.ingest import filter_valid, ingest
from verbatide.operators.preprocess import preprocess_text
from verbatide.operators.sentiment import score_comments
from verbatide.sinks.tables import result_columns
from verbatide.sources.files import stream_comments


# The labels that are counted by name.
LABELS = ("positive", "negative", "neutral")

BATCH_SCHEMA = (
    "query_id string, run_id string, batch_id bigint, started string, seconds double, "
    "input_rows bigint, scored_rows bigint, "
    + ", ".join(f"{label} bigint" for label in (*LABELS, "other"))
)


def score_raw_comments(comments: DataFrame, run_ts=None, scorer=None) -> DataFrame:
    """Raw comments, batch or stream, to scored ones. Row by row: no state, no shuffle.

    ``scorer`` takes cleaned comments and adds the result columns; by default
    keywords decide.
    """
    cleaned = comments.transform(ingest, run_ts).transform(filter_valid).transform(preprocess_text)
    scored = scorer(cleaned) if scorer is not None else score_comments(cleaned, run_ts=run_ts)
    return result_columns(scored)


def start_sink(
    scored: DataFrame, output: str, checkpoint: str, trigger_interval: str | None = None
) -> StreamingQuery:
    """Append to Parquet by sentiment, exactly once per input file.

    Without an interval, what is there now is processed, in several batches if
    need be, and the query ends. Each batch counts its labels as it writes them; see
    log_batches.
    """
    labels = [F.count_if(F.col("sentiment") == label).alias(label) for label in LABELS]
    scored = scored.observe("scored", F.count("*").alias("rows"), *labels)
    trigger = (
        {"availableNow": True} if trigger_interval is None else {"processingTime": trigger_interval}
    )
    return (
        scored.writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .partitionBy("sentiment")
        .trigger(**trigger)
        .start()
    )


def stream_sentiment(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    trigger_interval: str | None = "30 seconds",
    max_files_per_trigger: int | None = 10,
    run_ts=None,
    scorer=None,
) -> StreamingQuery:
    """Score a folder's comment files as they arrive. The caller awaits the query."""
    comments = stream_comments(spark, source, max_files_per_trigger)
    return start_sink(
        score_raw_comments(comments, run_ts, scorer), output, checkpoint, trigger_interval
    )


def _batch_row(progress) -> tuple:
    """One entry of the log, from what a micro-batch reports."""
    counts = progress.observedMetrics.get("scored")
    rows = counts.asDict() if counts is not None else {}
    named = [rows.get(label) for label in LABELS]
    other = rows["rows"] - sum(named) if rows else None
    return (
        str(progress.id), str(progress.runId), progress.batchId, progress.timestamp,
        progress.batchDuration / 1000, progress.numInputRows, rows.get("rows"), *named, other,
    )


def log_batches(query: StreamingQuery, path: str, every: float = 10.0) -> None:
    """Await the query; add a row to the log at ``path`` for each micro-batch that is done.

    The rows come from what the batches report of themselves: nothing is counted again.
    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` reports (100), so
    ``every`` should be shorter than so many batches take. If the query fails, what it had
    done is logged before its error is raised.
    """
    session, logged = SparkSession.getActiveSession(), set()

    def add_new():
        # Without data there is a report now and then, but no batch.
        done = [p for p in query.recentProgress if "addBatch" in p.durationMs]
        rows = [_batch_row(p) for p in done if p.batchId not in logged]
        if rows:
            session.createDataFrame(rows, BATCH_SCHEMA).coalesce(1).write.mode("append").json(path)
            logged.update(p.batchId for p in done)

    try:
        while not query.awaitTermination(every):
            add_new()
    finally:
        add_new()


def logged_batches(spark: SparkSession, path: str) -> DataFrame:
    """The log with one row per batch: if it was done again after a restart, the last."""
    rows = spark.read.schema(BATCH_SCHEMA).json(path)
    rest = [name for name in rows.columns if name not in ("query_id", "batch_id")]
    latest = F.max(F.struct("started", *[name for name in rest if name != "started"]))
    return rows.groupBy("query_id", "batch_id").agg(latest.alias("_row")).select(
        "query_id", "batch_id", *[F.col(f"_row.{name}").alias(name) for name in rest]
    )
