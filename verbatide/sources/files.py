"""Readers of comment files. Every schema is declared; nothing is inferred from
data except in :func:`read_results`, if it is given no schema for JSON."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verbatide.functions.text import is_blank
from verbatide.operators.ingest import default_columns
from verbatide.operators.statistics import scan_counts
from verbatide.schemas import ENRICHED_COMMENT, LABELLED_SENTENCE, RAW_COMMENT
from verbatide.storage import cut_lineage


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def _load(path: str, read):
    try:
        return read(path)
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(f"no input at {path}") from error
        raise


def scan_comments(spark: SparkSession, path: str, text_fallback: bool = False) -> DataFrame:
    """Comments in JSON lines. A malformed line becomes an all-null row.

    With ``text_fallback``, a typed read without any row is replaced by reading
    the lines as text and taking just their ``text`` field.
    """
    df = _load(path, spark.read.schema(RAW_COMMENT).json)
    if text_fallback and df.isEmpty():
        return parse_text_lines(spark.read.text(path))
    return df


def parse_text_lines(lines: DataFrame) -> DataFrame:
    """Lines of JSON text (column ``value``) to a ``text`` column, null if malformed."""
    return lines.select(F.from_json("value", "text string").alias("data")).select("data.*")


def scan_batch(
    spark: SparkSession, directory: str, batch_id: str, pattern: str = "*.json"
) -> DataFrame:
    """All files of a directory that match the pattern, with batch and file name."""
    reader = spark.read.schema(RAW_COMMENT).option("pathGlobFilter", pattern)
    return _load(directory, reader.json).select(
        "*",
        F.lit(batch_id).alias("batch_id"),
        F.col("_metadata.file_name").alias("source_file"),
    )


def scan_enriched(spark: SparkSession, path: str) -> DataFrame:
    return _load(path, spark.read.schema(ENRICHED_COMMENT).json)


def enriched_scan_counts(spark: SparkSession, path: str) -> DataFrame:
    return scan_counts(scan_enriched(spark, path))


def decodable_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines and lines that are no JSON object; parse ``text`` of the rest."""
    parsed = F.from_json(
        "value",
        "text string, _bad string",
        {"columnNameOfCorruptRecord": "_bad"},
    )
    return (
        lines.filter(~is_blank("value"))
        .withColumn("_parsed", parsed)
        .filter(F.col("_parsed._bad").isNull())
        .withColumn("text", F.coalesce("_parsed.text", F.lit("")))
        .drop("_parsed", "value")
    )


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines (text, _file, _block) as they were read, numbered from 0 as ``_index``."""
    # Stored: partitions and the places in them must not change between the two uses below.
    placed = cut_lineage(lines).withColumn("_place", F.monotonically_increasing_id())
    # One row per block, which lies in one partition as a whole: a window in one task is fine.
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy("_file", "_block")
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first"))
        .select("_file", "_block", "_offset")
    )
    return placed.join(F.broadcast(blocks), ["_file", "_block"]).select(
        "text", (F.col("_place") + F.col("_offset")).alias("_index")
    )


def scan_bare_texts(spark: SparkSession, path: str, run_ts=None, **defaults) -> DataFrame:
    """Lines of ``{"text": ...}`` in the enriched schema, ids ``comment_0``, ...

    The number is the line's place among the kept lines, files in name order.
    Within one block of a file, Spark numbers rows in the order of the lines;
    so each line's place in its block is shifted by the lines of all earlier blocks, and
    no line is sorted.
    """
    lines = _load(path, spark.read.text).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    numbered = _numbered_lines(decodable_lines(lines))
    return numbered.select(
        F.concat(F.lit("comment_"), F.col("_index")).alias("id"), "text"
    ).transform(default_columns, run_ts=run_ts, **defaults)


def read_results(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A directory of Parquet results, else the same path read as JSON.

    JSON is read where there is no ``*.parquet`` file at all. Without a schema, both
    forms tell their own, which for JSON takes a pass over the data.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    stored = _load(path, names.option("pathGlobFilter", "*.parquet").load)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if stored.select("path").isEmpty():
        return reader.json(path)
    return reader.option("pathGlobFilter", "*.parquet").parquet(path)


def read_processed_or_raw(spark: SparkSession, processed: str, raw: str) -> DataFrame:
    """Processed Parquet where it exists, else raw JSON with its text's length."""
    try:
        return spark.read.parquet(processed)
    except AnalysisException as error:
        if not _missing(error):
            raise
    texts = _load(raw, spark.read.schema("text string").json)
    return texts.select("text", F.length("text").alias("comment_length"))


def scan_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (sentence, label) with a header; quotes are doubled inside."""
    reader = spark.read.schema(LABELLED_SENTENCE).options(
        sep="\t", header=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False
    )
    return _load(path, reader.csv)


def nonblank_line_count(spark: SparkSession, path: str) -> DataFrame:
    lines = _load(path, spark.read.text)
    return lines.filter(~is_blank("value")).agg(F.count("*").alias("lines"))


def stream_comments(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = 10
) -> DataFrame:
    """The JSON lines files of a directory, as they arrive."""
    reader = spark.readStream.schema(RAW_COMMENT)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(directory)
