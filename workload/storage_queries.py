"""Sources, sinks, stream, staged run (S, K, R, O1). Each writes its input or
result to a new scratch path with Spark and reads it back through the operator."""

from pyspark.sql import functions as F

from verbatide.operators import ingest as I
from verbatide.operators import sentiment as U
from verbatide.operators.statistics import scan_counts
from verbatide.plans import report as R
from verbatide.plans import stages as G
from verbatide.plans.integrated import run_integrated
from verbatide.sinks import envelope as N
from verbatide.sinks import tables as K
from verbatide.sources import files as S
from verbatide.sources import threads as H
from verbatide.storage import cut_lineage, scratch_path
from verbatide.streaming.sentiment import log_batches, logged_batches, stream_sentiment
from workload import fixtures as X
from workload import reports_sql as sql
from workload.oracle import using
from workload.registry import query
from workload.statistics_queries import over_clusters


def written_lines(spark, sf_dir, name="comments.json", blanks=("",)):
    path = f"{scratch_path(spark, 'lines')}/{name}"
    X.comment_lines(spark, sf_dir, blanks).write.text(path)
    return path


def naive(column="created_utc"):
    """Timestamps are compared without a time zone."""
    return F.col(column).cast("timestamp_ntz").alias(column)


@query(
    "s1_jsonl_scan",
    using(
        "ingested",
        """select id, author, text, score, depth, created_utc, subreddit, post_id,
        comment_length, is_valid from ingested
        union all select null, null, null, null, null, null, null, null, null, 'invalid'
        from labels""",
    ),
)
def s1(spark, sf_dir):
    raw = S.scan_comments(spark, written_lines(spark, sf_dir))
    return raw.transform(I.ingest, X.RUN_TS).select(
        "id", "author", "text", "score", "depth", naive(), "subreddit", "post_id",
        "comment_length", "is_valid",
    )


@query(
    "s2_jsonl_text_fallback",
    using(
        "comments",
        """select text, count(*) as lines from (select text from comments
        union all select null from labels union all select null from labels)
        group by text""",
    ),
)
def s2(spark, sf_dir):
    texts = S.parse_text_lines(spark.read.text(written_lines(spark, sf_dir)))
    return texts.groupBy("text").agg(F.count("*").alias("lines"))


@query(
    "s3_batch_scan",
    using(
        "comments",
        """select id, text, score, 'batch_1' as batch_id, true as right_file from comments
        union all select null, null, null, 'batch_1', true from labels""",
    ),
)
def s3(spark, sf_dir):
    directory = scratch_path(spark, "batch")
    lines = X.comment_lines(spark, sf_dir)
    lines.write.option("compression", "none").text(directory)
    # The files end in .txt; the same lines as .json.gz are the ones not to be read.
    lines.write.mode("append").format("json").option("compression", "gzip").save(directory)
    return S.scan_batch(spark, directory, "batch_1", "*.txt").select(
        "id", "text", "score", "batch_id", F.col("source_file").endswith(".txt").alias("right_file")
    )


@query(
    "s4_enriched_scan",
    using(
        "features",
        """select count(*) as total_rows, count(*) filter (text <> '') as non_empty_text
        from features""",
    ),
)
def s4(spark, sf_dir):
    path = scratch_path(spark, "enriched")
    X.comments(spark, sf_dir).transform(I.default_columns, run_ts=X.RUN_TS).write.json(path)
    return scan_counts(S.scan_enriched(spark, path))


@query(
    "s5_bare_text_scan",
    using(
        "comments",
        """select 'comment_' || (row_number() over (order by id) - 1) as id,
        coalesce(text, '') as text, 'unknown' as author, 1::int as score, 'group' as subreddit,
        length(coalesce(text, ''))::int as comment_length,
        contains(coalesce(text, ''), 'http') as contains_url,
        contains(coalesce(text, ''), '?') as is_question from comments""",
    ),
)
def s5(spark, sf_dir):
    path = scratch_path(spark, "bare")
    X.bare_lines(spark, sf_dir).write.text(path)
    return S.scan_bare_texts(spark, path, run_ts=X.RUN_TS, subreddit="group").select(
        "id", "text", "author", "score", "subreddit", "comment_length", "contains_url",
        "is_question",
    )


@query("s6_result_scan", using("scored", "select id, sentiment, confidence from scored"))
def s6(spark, sf_dir):
    path = scratch_path(spark, "results")
    K.save_sentiment(X.scored(spark, sf_dir), path)
    return S.read_results(spark, path).select("id", "sentiment", "confidence")


@query("s6_result_scan_json", using("scored", "select id, sentiment, confidence from scored"))
def s6_json(spark, sf_dir):
    path = scratch_path(spark, "results")
    K.save_json(X.scored(spark, sf_dir).select("id", "sentiment", "confidence"), path)
    return S.read_results(spark, path).select("id", "sentiment", "confidence")


RAW_TEXTS = """select text, length(text)::int as comment_length, count(*) as lines from
    (select text from comments union all select null from labels) group by all"""


@query("s7_parquet_or_json_scan", using("comments", RAW_TEXTS))
def s7(spark, sf_dir):
    raw = written_lines(spark, sf_dir)
    absent = scratch_path(spark, "absent")
    df = S.read_processed_or_raw(spark, absent, raw)
    return df.groupBy("text", "comment_length").agg(F.count("*").alias("lines"))


@query(
    "s7_parquet_scan",
    using("valid", "select id, text, comment_length from valid"),
)
def s7_parquet(spark, sf_dir):
    path = scratch_path(spark, "processed")
    K.save_table(X.valid(spark, sf_dir), path)
    df = S.read_processed_or_raw(spark, path, scratch_path(spark, "absent"))
    return df.select("id", "text", "comment_length")


STREAMED = """select id, sentiment, round(confidence, 6) as confidence, word_count, text_length,
    model_version from keyword_scored where regexp_matches(text_cleaned, '[^ ]')
    union all select id, 'unknown', 0, word_count, text_length, 'empty' from cleaned
    where not regexp_matches(text_cleaned, '[^ ]')"""


def drained(spark, sf_dir, files_per_trigger, scorer=None):
    source = written_lines(spark, sf_dir, "stream_in")
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    running = stream_sentiment(
        spark, source, output, checkpoint, trigger_interval=None,
        max_files_per_trigger=files_per_trigger, run_ts=X.RUN_TS, scorer=scorer,
    )
    running.awaitTermination()
    return spark.read.parquet(output)


def streamed_columns(df):
    return df.select(
        "id", "sentiment", F.round("confidence", 6).alias("confidence"), "word_count",
        "text_length", "model_version",
    )


@query(
    "s8_stream_scan",
    using(
        "comments",
        """select id, text, score from comments union all select null, null, null from labels""",
    ),
)
def s8(spark, sf_dir):
    source = written_lines(spark, sf_dir, "stream_in")
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    comments = S.stream_comments(spark, source, max_files_per_trigger=4)
    comments.select("id", "text", "score").writeStream.trigger(availableNow=True).option(
        "checkpointLocation", checkpoint
    ).format("parquet").start(output).awaitTermination()
    return spark.read.parquet(output)


LABELLED = r"""with labelled as (select doc_id,
    case when text = '' then null
      else trim(regexp_replace(text, '[\r\n\t]+', ' ', 'g'), ' ') end as sentence,
    quality as label from documents join labels using (doc_id))
    """


@query("s9_labelled_tsv_scan", LABELLED + "select sentence, label from labelled")
def s9(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    K.save_labelled(X.labelled(spark, sf_dir), path)
    return S.scan_labelled(spark, path)


@query(
    "s10_flatten_thread",
    """with t as (select conv_id || '-' || turn as thread, * from conversations)
    select thread, 0 as position, thread || '-a' as id, role as author, text as body,
      (turn * 2)::double as score, turn::double as depth from t
    union all select thread, 1, thread || '-b', role, upper(role), length(text)::double,
      (turn + 1)::double from t
    union all select thread, 2, thread || '-c', role, role, null, (turn + 2)::double from t
    union all select thread, 3, thread || '-d', role, 'bye', 1::double, turn::double from t""",
)
def s10(spark, sf_dir):
    return H.flatten_threads(X.threads(spark, sf_dir))


@query(
    "s10_deep_thread",
    """select conv_id::varchar as thread, (row_number() over (partition by conv_id order by turn)
      - 1)::int as position, conv_id || '-' || turn as id, role as author, text as body
    from conversations""",
)
def s10_deep(spark, sf_dir):
    return H.flatten_threads(X.deep_threads(spark, sf_dir)).drop("score", "depth")


@query(
    "s11_parse_permalink",
    r"""with urls as (select url from pages union all
      select 'https://forum.example.com/r/group' || (page_id % 9) || '/comments/' || page_id
        || '/some_title/?utm_source=share' from pages),
    parts as (select url, list_filter(string_split(
      regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') as p from urls)
    select url, p[2] as community, p[4] as post_code from parts""",
)
def s11(spark, sf_dir):
    return H.parse_permalinks(X.permalinks(spark, sf_dir))


@query(
    "s12_nonblank_line_count",
    using(
        "comments",
        """select (select count(*) from comments) + (select count(*) from labels) as lines""",
    ),
)
def s12(spark, sf_dir):
    return S.nonblank_line_count(spark, written_lines(spark, sf_dir, blanks=X.ODD_BLANKS))


@query("f6_skip_bad_lines", using("comments", "select coalesce(text, '') as text from comments"))
def f6(spark, sf_dir):
    lines = written_lines(spark, sf_dir, blanks=X.ODD_BLANKS)
    return S.decodable_lines(spark.read.text(lines))


@query(
    "k1_save_table",
    using("valid", "select id, text, created_utc, comment_length from valid"),
)
def k1(spark, sf_dir):
    path = scratch_path(spark, "table")
    K.save_table(X.valid(spark, sf_dir), path)
    return spark.read.parquet(path).select("id", "text", naive(), "comment_length")


@query("k1_save_table_json", using("valid", "select id, text, comment_length from valid"))
def k1_json(spark, sf_dir):
    path = scratch_path(spark, "table")
    K.save_table(X.valid(spark, sf_dir), path, "json")
    return S.scan_comments(spark, path).select("id", "text", "comment_length")


@query(
    "k2_save_partitioned",
    using(
        "valid",
        """select id, comment_length, strftime(created_utc, '%Y-%m-%d') as processing_date
        from valid""",
    ),
)
def k2(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    K.save_partitioned(X.valid(spark, sf_dir), path, time_col="created_utc", compact=True)
    schema = "id string, comment_length int, processing_date string"
    return spark.read.schema(schema).parquet(path)


@query(
    "k3_save_sentiment",
    using(
        "scored",
        """select id, created_utc, text, text_cleaned, sentiment, round(confidence, 6)
        as confidence, text_length, word_count, model_version from scored""",
    ),
)
def k3(spark, sf_dir):
    path = scratch_path(spark, "sentiment")
    K.save_sentiment(X.scored(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "id", naive(), "text", "text_cleaned", "sentiment",
        F.round("confidence", 6).alias("confidence"), "text_length", "word_count",
        "model_version",
    )


@query(
    "k3_save_sentiment_no_text",
    using(
        "scored",
        "select id, sentiment, text_length, word_count from scored",
    ),
)
def k3_no_text(spark, sf_dir):
    path = scratch_path(spark, "sentiment")
    K.save_sentiment(X.scored(spark, sf_dir), path, include_original=False)
    kept = spark.read.parquet(path)
    return kept.select(
        *[c for c in kept.columns if c in ("id", "text", "sentiment", "text_length", "word_count")]
    )


@query("k4_stream_sink", using("keyword_scored", f"select sentiment, count(*) as count from ({STREAMED}) group by 1"))
def k4(spark, sf_dir):
    return drained(spark, sf_dir, None).groupBy("sentiment").agg(F.count("*").alias("count"))


@query("r1_stream_sentiment", using("keyword_scored", STREAMED))
def r1(spark, sf_dir):
    return streamed_columns(drained(spark, sf_dir, 3))


REPORT_ROWS = (
    "map<string, array<struct<key1: string, key2: string, metric: string, value: double, "
    "note: string>>>"
)


def read_report(spark, path):
    document = spark.read.text(path, wholetext=True)
    return (
        document.select(F.explode(F.from_json("value", REPORT_ROWS)).alias("section", "rows"))
        .select("section", F.explode("rows").alias("row"))
        .select("section", "row.*")
    )


@query("k5_save_report", using("scored", sql.dashboard("scored")))
def k5(spark, sf_dir):
    path = scratch_path(spark, "report")
    K.save_report(R.dashboard(X.scored(spark, sf_dir)), path)
    return read_report(spark, path)


COUNTS = "select sentiment, count(*) as count from scored group by sentiment"


@query("k6_save_single_json", using("scored", COUNTS))
def k6(spark, sf_dir):
    path = scratch_path(spark, "single")
    counts = X.scored(spark, sf_dir).groupBy("sentiment").agg(F.count("*").alias("count"))
    K.save_json(counts, path, single_file=True)
    return spark.read.schema("sentiment string, count bigint").json(path)


@query(
    "k7_save_records_csv_json",
    using(
        "rule_scored",
        """select 'csv' as source, id, sentiment_label, confidence_score, word_count
        from rule_scored union all
        select 'json', id, sentiment_label, confidence_score, word_count from rule_scored
        union all select 'summary', null, sentiment_label, null, count(*) from rule_scored
        group by sentiment_label""",
    ),
)
def k7(spark, sf_dir):
    path = scratch_path(spark, "records")
    # Stored: three files are made of it.
    df = cut_lineage(
        X.rule_scored(spark, sf_dir).select("id", "sentiment_label", "confidence_score", "word_count")
    )
    summary = df.groupBy("sentiment_label").agg(F.count("*").alias("word_count"))
    K.save_records(df, summary, path)
    schema = "id string, sentiment_label string, confidence_score double, word_count bigint"
    parts = {
        "csv": spark.read.schema(schema).options(header=True, escape='"').csv(f"{path}/results_csv"),
        "json": spark.read.schema(schema).json(f"{path}/detailed_results"),
        "summary": spark.read.schema(schema).json(f"{path}/analytics_summary"),
    }
    read = [part.select(F.lit(name).alias("source"), "*") for name, part in parts.items()]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query(
    "k8_results_envelope",
    using(
        "scored",
        """select row_number() over (order by id) as comment_id, text as comment, sentiment,
        confidence, timestamp '2024-03-01 12:00:00' as timestamp from scored""",
    ),
)
def k8(spark, sf_dir):
    details = N.envelope_details(X.scored(spark, sf_dir), run_ts=X.RUN_TS)
    return details.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "k8_repeated_ids",
    using(
        "scored",
        """select count(*) as rows, count(*) as numbers, 1::bigint as first, count(*) as last,
        count(text) as comments, count(distinct text) as texts, 0::bigint as misplaced from scored""",
    ),
)
def k8_repeated(spark, sf_dir):
    """A third of the rows has one id, another none: each is numbered once, in order."""
    number = F.regexp_extract(F.col("id").cast("string"), "([0-9]+)$", 1).cast("long") % 3
    torn = F.when(number == 0, "same").when(number == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    # Stored: rows are looked at three times.
    rows = cut_lineage(
        X.scored(spark, sf_dir).select(torn.alias("id"), "text", "sentiment", "confidence")
    )
    details = N.envelope_details(rows, run_ts=X.RUN_TS)
    missing = rows.filter("id is null").count()
    # Rows without id come first, so no later number can belong to one.
    early = rows.filter("id is null").select("text").distinct().withColumn("early", F.lit(True))
    judged = details.join(early, details["comment"].eqNullSafe(early["text"]), "left")
    return judged.agg(
        F.count("*").alias("rows"),
        F.count_distinct("comment_id").alias("numbers"),
        F.min("comment_id").alias("first"),
        F.max("comment_id").alias("last"),
        F.count("comment").alias("comments"),
        F.count_distinct("comment").alias("texts"),
        F.count_if((F.col("comment_id") <= missing) & F.col("early").isNull()).alias("misplaced"),
    )


@query(
    "k8_envelope_summary",
    using(
        "scored",
        """select (select count(*) from scored) as total_comments,
        1.5::double as processing_time_seconds, sentiment, count(*) as count
        from scored group by sentiment""",
    ),
)
def k8_summary(spark, sf_dir):
    summary = N.envelope_summary(X.scored(spark, sf_dir), 1.5, X.RUN_TS)
    return summary.select(
        "total_comments", "processing_time_seconds", F.inline("sentiment_distribution")
    )


def staged_run(spark, sf_dir, lines=None, scorer=None):
    lines = lines or written_lines(spark, sf_dir)
    settings = G.RunSettings(lines, scratch_path(spark, "run"))
    record = G.run_stages(spark, settings, "run_1", X.RUN_TS, scorer)
    if record.status != "SUCCESS":
        raise RuntimeError(record.errors)
    return settings


@query(
    "k9_run_log",
    using(
        "cleaned",
        """select 'run_1' as run_id, 'SUCCESS' as status, 'data_ingestion' as stage,
        (select count(*) from ingested) + (select count(*) from labels) as records,
        (select count(*) from valid) as valid
        union all select 'run_1', 'SUCCESS', 'sentiment_processing', count(*), null from cleaned
        union all select 'run_1', 'SUCCESS', 'analytics_processing', 13, null""",
    ),
)
def k9(spark, sf_dir):
    settings = staged_run(spark, sf_dir)
    runs = spark.read.schema(G.RUN_SCHEMA).json(settings.path("run_log"))
    return runs.select("run_id", "status", F.explode("stages").alias("s")).select(
        "run_id", "status", "s.stage", "s.records", "s.valid"
    )


@query(
    "k9_stream_log",
    using(
        "keyword_scored",
        f"""select count(*) as scored_rows, count(*) filter (sentiment = 'positive') as positive,
        count(*) filter (sentiment = 'negative') as negative,
        count(*) filter (sentiment = 'neutral') as neutral,
        count(*) filter (sentiment not in ('positive', 'negative', 'neutral')) as other,
        true as without_gaps from ({STREAMED})""",
    ),
)
def k9_stream(spark, sf_dir):
    """What the batches' log entries, read as a whole, say of the stream."""
    source = written_lines(spark, sf_dir, "stream_in")
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    log = scratch_path(spark, "stream-log")
    running = stream_sentiment(
        spark, source, output, checkpoint, trigger_interval=None, max_files_per_trigger=3, run_ts=X.RUN_TS
    )
    log_batches(running, log)
    counts = ("scored_rows", "positive", "negative", "neutral", "other")
    return logged_batches(spark, log).agg(
        *[F.sum(name).alias(name) for name in counts],
        (F.count("*") == F.max("batch_id") + 1).alias("without_gaps"),
    )


@query(
    "k10_export_text",
    "select 'json' as source, text from conversations union all select 'plain', text from conversations",
)
def k10(spark, sf_dir):
    path = scratch_path(spark, "export")
    bodies = X.table(spark, sf_dir, "conversations").select(F.col("text").alias("body"))
    K.export_texts(bodies, path)
    lines = spark.read.schema("text string").json(f"{path}/jsonl")
    plain = spark.read.option("lineSep", K.TEXT_SEPARATOR).text(f"{path}/plain")
    return lines.select(F.lit("json").alias("source"), "text").unionAll(
        plain.select(F.lit("plain"), "value")
    )


STAGED_COLUMNS = [
    "id", "created_utc", "text", "text_cleaned", "confidence", "positive_prob", "negative_prob",
    "neutral_prob", "text_length", "word_count", "model_version", "processing_timestamp",
    "sentiment",
]
STAGED = f"""staged as (select created_utc, text_length, word_count, sentiment, confidence,
    model_version from keyword_scored where regexp_matches(text_cleaned, '[^ ]') union all
    select created_utc, text_length, word_count, 'unknown', 0, 'empty' from cleaned
    where not regexp_matches(text_cleaned, '[^ ]'))"""


@query(
    "o1_batch_run",
    using(
        "keyword_scored",
        "select * from (with " + STAGED + sql.comprehensive("staged", STAGED_COLUMNS) + ")",
    ),
)
def o1(spark, sf_dir):
    settings = staged_run(spark, sf_dir)
    return over_clusters(spark.read.parquet(settings.path("report")))


# A stand-in for a model: by length, nothing for some texts, an error for others.
MODEL_SQL = """case when contains(text_cleaned, 'nothing works') or contains(text_cleaned, 'awful')
    then null else text_cleaned end"""


def stand_in(df, out, text_col="text_cleaned"):
    # Defined here, so that workers get it by value.
    def load():
        def score(texts):
            if any("nothing works" in text for text in texts):
                raise ValueError("no result")
            return [
                None if "awful" in text else ("Positive" if len(text) % 2 else "Negative", 50 + len(text) % 50)
                for text in texts
            ]

        return score

    return U.score_batches(df, load, text_col, out)


CASCADE = f"""select id, case when m is not null
      then case when length(m) % 2 = 1 then 'positive' else 'negative' end
      when not regexp_matches(text_cleaned, '[^ ]') then 'unknown' else k end as sentiment,
    case when m is not null then 'bert-sentiment-v1'
      when not regexp_matches(text_cleaned, '[^ ]') then 'empty' else 'simple-keyword' end
      as model_version from (select *, sentiment as k, {MODEL_SQL} as m from keyword_scored)"""


@query("o1_classifier_run", using("keyword_scored", CASCADE))
def o1_classifier(spark, sf_dir):
    settings = staged_run(spark, sf_dir, scorer=U.classifier_scorer(stand_in, run_ts=X.RUN_TS))
    scored = S.read_results(spark, settings.path("sentiment"))
    return scored.select("id", "sentiment", "model_version")


@query("r1_stream_classifier", using("keyword_scored", CASCADE))
def r1_classifier(spark, sf_dir):
    scorer = U.classifier_scorer(stand_in, run_ts=X.RUN_TS)
    return drained(spark, sf_dir, 3, scorer).select("id", "sentiment", "model_version")


@query(
    "u5_cascade_in_batches",
    using(
        "cleaned",
        f"""select id, case when m is null then 'neutral' when length(m) % 2 = 1 then 'positive'
          else 'negative' end as sentiment,
        case when m is null then 'none' else 'bert-sentiment-v1' end as model_version,
        case when m is null then 0.5::double else (50 + length(m) % 50) / 100.0::double end
          as confidence from (select *, {MODEL_SQL} as m from cleaned)""",
    ),
)
def u5_batches(spark, sf_dir):
    return (
        stand_in(X.cleaned(spark, sf_dir), "_model")
        .transform(U.fallback_cascade, ["_model"], default=("Neutral", 50.0, "none"))
        .select("id", "sentiment_result.sentiment", "sentiment_result.model_version", "sentiment_result.confidence")
    )


@query(
    "o1_empty_run",
    using(
        "comments",
        """select * from (with empty as (select * from comments where text is null or trim(text, ' ') = '')
        select 'SUCCESS' as status, 'data_ingestion' as stage, count(*) as records, 0::bigint as valid
        from empty union all select 'SUCCESS', 'sentiment_processing', 0, null)""",
    ),
)
def o1_empty(spark, sf_dir):
    lines = f"{scratch_path(spark, 'lines')}/comments.json"
    blank = X.comments(spark, sf_dir).filter(F.col("text").isNull() | (F.trim("text") == ""))
    blank.select(F.to_json(F.struct("*"), X.JSON_TIME).alias("value")).write.text(lines)
    settings = staged_run(spark, sf_dir, lines)
    runs = spark.read.schema(G.RUN_SCHEMA).json(settings.path("run_log"))
    return (
        runs.select("status", F.explode("stages").alias("s"))
        .select("status", "s.stage", "s.records", "s.valid")
        .filter("stage <> 'analytics_processing'")
    )


@query(
    "o1_integrated_run",
    using("rule_scored", "select id, sentiment_label, confidence_score from rule_scored"),
)
def o1_integrated(spark, sf_dir):
    path, output = scratch_path(spark, "enriched"), scratch_path(spark, "integrated")
    X.comments(spark, sf_dir).transform(I.default_columns, run_ts=X.RUN_TS).write.json(path)
    run_integrated(spark, path, output)
    schema = "id string, sentiment_label string, confidence_score double"
    return spark.read.schema(schema).json(f"{output}/detailed_results")
