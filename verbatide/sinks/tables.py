"""Writers. All of them write from the tasks; nothing passes through the driver."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from verbatide.functions.text import date_key
from verbatide.operators.preprocess import project_available

# Column order of stored sentiment results.
RESULT_COLUMNS = (
    "id", "created_utc", "text", "text_cleaned", "sentiment", "confidence",
    "positive_prob", "negative_prob", "neutral_prob", "text_length", "word_count",
    "model_version", "processing_timestamp",
)
TEXT_COLUMNS = ("text", "text_cleaned")

# Fixed value: what stands between two texts of a plain text export.
TEXT_SEPARATOR = "\n\n---\n\n"


def save_table(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Overwrite ``path`` as parquet, json or (with its package installed) delta."""
    file_format = file_format.lower()
    if file_format not in ("parquet", "json", "delta"):
        raise ValueError(f"unsupported format: {file_format}")
    writer = df.write.mode("overwrite").format(file_format)
    try:
        writer.save(path)
    except Exception as error:
        if file_format == "delta" and "DATA_SOURCE_NOT_FOUND" in str(error):
            raise RuntimeError("the delta format needs the Delta Lake package") from error
        raise


def save_partitioned(
    df: DataFrame, path: str, partition_cols=None, time_col: str = "processing_timestamp",
    compact: bool | None = None,
) -> None:
    """Parquet in one folder per partition value, by default per day of ``time_col``.

    ``compact``, the default for days, first rebalances by the values: few files per
    folder, and adaptive execution splits a value that holds too much. Without it,
    each task writes a file per value it holds, and nothing is shuffled.
    """
    if compact is None:
        compact = partition_cols is None
    if partition_cols is None:
        df = df.withColumn("processing_date", date_key(time_col))
        partition_cols = ["processing_date"]
    if compact:
        df = df.hint("rebalance", *partition_cols)
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)


def result_columns(df: DataFrame, include_original: bool = True) -> DataFrame:
    wanted = [c for c in RESULT_COLUMNS if include_original or c not in TEXT_COLUMNS]
    return project_available(df, wanted)


def save_sentiment(
    df: DataFrame, path: str, include_original: bool = True, counts: Observation | None = None
) -> None:
    """Scored comments as Parquet by sentiment, with or without their texts. ``counts``
    tells the ``records`` as they were written."""
    rows = result_columns(df, include_original)
    if counts is not None:
        rows = rows.observe(counts, F.count("*").alias("records"))
    rows.write.mode("overwrite").partitionBy("sentiment").parquet(path)


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "id") -> None:
    """Parquet below ``path`` in ``buckets`` buckets of ``key``, each sorted by it, as
    ``table`` of the catalog.

    Tables with equal buckets are joined and grouped by the key without a shuffle, as
    often as they are read. A bucket is read by one task and never divided: choose as
    many as make each a task's share, and a key that repeats little, such as an id.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option(
        "path", path
    ).saveAsTable(table, format="parquet")


def save_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON lines; ``single_file`` is for results known to be small."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


def save_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes are doubled and white space is kept."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False, emptyValue='""', lineSep="\n",
    ).csv(path)


def save_records(
    df: DataFrame, summary: DataFrame, path: str, detailed: bool = True, with_summary: bool = True
) -> None:
    """Details as JSON records and CSV, and the summary as JSON, each below ``path``."""
    if detailed:
        save_json(df, f"{path}/detailed_results")
        save_csv(df, f"{path}/results_csv")
    if with_summary:
        save_json(summary, f"{path}/analytics_summary")


def save_labelled(df: DataFrame, path: str) -> None:
    """(sentence, label) as tab-separated lines with a header."""
    df.select("sentence", "label").write.mode("overwrite").options(
        sep="\t", header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def export_texts(df: DataFrame, path: str, text: str = "body") -> None:
    """Texts as JSON lines, and as plain text with separator lines in between."""
    texts = df.select(F.col(text).alias("text"))
    texts.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/jsonl")
    texts.select(F.coalesce("text", F.lit(""))).write.mode("overwrite").option(
        "lineSep", TEXT_SEPARATOR
    ).text(f"{path}/plain")


def append_run(run: DataFrame, path: str) -> None:
    """Add one finished or failed run to the run log."""
    run.write.mode("append").json(path)


def save_report(report: DataFrame, path: str) -> None:
    """A report table as one indented JSON document, one section per field.

    A report has one row per group it describes, so it fits into one task.
    """
    entry = F.struct("key1", "key2", "metric", "value", "note")
    sections = report.groupBy("section").agg(F.sort_array(F.collect_list(entry)).alias("rows"))
    document = sections.agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("section", "rows")))
        ).alias("report")
    )
    document.select(F.to_json("report", {"pretty": "true"})).coalesce(1).write.mode(
        "overwrite"
    ).option("encoding", "UTF-8").text(path)
