"""The staged run: ingest, score, analyse; each stage ends in a stored table."""

import time
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from verbatide.operators.ingest import filter_valid, ingest
from verbatide.operators.preprocess import preprocess_text
from verbatide.operators.sentiment import score_comments
from verbatide.operators.statistics import ingestion_stats
from verbatide.plans.report import comprehensive_report, dashboard, sentiment_summary
from verbatide.schemas import RAW_COMMENT
from verbatide.sinks.tables import (
    append_run,
    result_columns,
    save_json,
    save_partitioned,
    save_report,
    save_sentiment,
    save_table,
)
from verbatide.sources.files import read_results, scan_batch, scan_comments

RUN_SCHEMA = (
    "run_id string, start_time string, end_time string, status string, "
    "stages array<struct<stage: string, duration_seconds: double, records: bigint, valid: bigint>>, "
    "errors array<string>, seconds_per_comment double"
)


@dataclass(frozen=True)
class RunSettings:
    """Where a run reads and writes, and how."""

    comments: str
    output: str
    batch_mode: bool = False
    file_pattern: str = "*.json"
    create_partitions: bool = True
    include_original_text: bool = True
    min_words: int = 2
    min_text_length: int = 10
    max_text_length: int | None = None
    time_col: str = "created_utc"

    def path(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"


@dataclass
class RunRecord:
    run_id: str
    start_time: str = ""
    end_time: str = ""
    status: str = "RUNNING"
    stages: list = field(default_factory=list)
    errors: list = field(default_factory=list)
    seconds_per_comment: float | None = None


def ingest_stage(spark: SparkSession, settings: RunSettings, run_id: str, run_ts=None) -> dict:
    """Stage 1: parse the raw files once and keep every row, by validity.

    Later stages read the valid folder only. The statistics cover all rows;
    they come from the few columns they need of the stored table. Rows are counted while
    they are written.
    """
    if settings.batch_mode:
        raw = scan_batch(spark, settings.comments, run_id, settings.file_pattern)
    else:
        raw = scan_comments(spark, settings.comments, text_fallback=True)
    counts = Observation("ingested")
    rows = ingest(raw, run_ts).observe(
        counts, F.count("*").alias("records"), F.count_if(F.col("is_valid") == "valid").alias("valid")
    )
    save_partitioned(rows, settings.path("processed"), ["is_valid"])
    stored = _processed(spark, settings)
    save_json(ingestion_stats(stored), settings.path("ingestion_statistics"), single_file=True)
    if settings.create_partitions:
        save_partitioned(filter_valid(stored), settings.path("processed_partitioned"))
    return {name: counts.get[name] for name in ("records", "valid")}


def _processed(spark: SparkSession, settings: RunSettings) -> DataFrame:
    """What stage 1 stored. The schema is stated, as an empty run stores no file."""
    schema = ingest(spark.createDataFrame([], RAW_COMMENT)).schema
    if settings.batch_mode:
        schema = schema.add("batch_id", "string").add("source_file", "string")
    return spark.read.schema(schema).parquet(settings.path("processed"))


def _scored(processed: DataFrame, settings: RunSettings, scorer, run_ts=None) -> DataFrame:
    cleaned = processed.transform(filter_valid).transform(
        preprocess_text,
        min_words=settings.min_words,
        min_length=settings.min_text_length,
        max_length=settings.max_text_length,
    )
    return scorer(cleaned) if scorer is not None else score_comments(cleaned, run_ts=run_ts)


def _stored_scores(spark: SparkSession, settings: RunSettings, scorer) -> DataFrame:
    scored = _scored(_processed(spark, settings), settings, scorer)
    schema = result_columns(scored, settings.include_original_text).schema
    return read_results(spark, settings.path("sentiment"), schema)


def score_stage(spark: SparkSession, settings: RunSettings, run_ts=None, scorer=None) -> dict:
    """Stage 2: the scored table, and a summary of it."""
    scored = _scored(_processed(spark, settings), settings, scorer, run_ts)
    counts = Observation("scored")
    save_sentiment(scored, settings.path("sentiment"), settings.include_original_text, counts)
    stored = _stored_scores(spark, settings, scorer)
    save_report(sentiment_summary(stored), settings.path("summary_report"))
    return {"records": counts.get["records"], "valid": None}


def analytics_stage(spark: SparkSession, settings: RunSettings, scorer=None) -> dict:
    """Stage 3. Reports are small tables; they are also saved as JSON documents."""
    scored = _stored_scores(spark, settings, scorer)
    save_table(comprehensive_report(scored, settings.time_col), settings.path("report"))
    save_table(dashboard(scored, settings.time_col), settings.path("dashboard"))
    report = spark.read.parquet(settings.path("report"))
    save_report(report, settings.path("analytics_report"))
    save_report(spark.read.parquet(settings.path("dashboard")), settings.path("dashboard_report"))
    sections = report.agg(F.count_distinct("section").alias("records")).first()
    return {"records": sections["records"], "valid": None}


def run_record(spark: SparkSession, record: RunRecord) -> DataFrame:
    return spark.createDataFrame([asdict(record)], RUN_SCHEMA)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def run_stages(
    spark: SparkSession, settings: RunSettings, run_id: str, run_ts=None, scorer=None
) -> RunRecord:
    """All three stages; the run is logged whether it succeeds or fails.

    ``scorer`` takes cleaned comments and adds the result columns; by default
    keywords decide.
    """
    record = RunRecord(run_id, start_time=_now())
    started = time.monotonic()
    stages = (
        ("data_ingestion", lambda: ingest_stage(spark, settings, run_id, run_ts)),
        ("sentiment_processing", lambda: score_stage(spark, settings, run_ts, scorer)),
        ("analytics_processing", lambda: analytics_stage(spark, settings, scorer)),
    )
    try:
        for name, stage in stages:
            stage_started = time.monotonic()
            counts = stage()
            record.stages.append(
                {"stage": name, "duration_seconds": time.monotonic() - stage_started, **counts}
            )
        record.status = "SUCCESS"
        comments = record.stages[0]["records"]
        if comments:
            record.seconds_per_comment = (time.monotonic() - started) / comments
    except Exception as error:
        record.status = "FAILED"
        record.errors.append(f"{name}: {error}")
    record.end_time = _now()
    append_run(run_record(spark, record), settings.path("run_log"))
    return record
