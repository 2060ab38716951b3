"""Inputs of the registered queries, derived by Spark from the given tables.

Every table is used whole: no row, text or part of a text is left out. Since
the tables hold almost no sentiment words, links or markers, phrases are added
around the texts by row number; and every event becomes a short comment, many
of them of the kinds a reader has to sort out (null, empty, blank, markers).
``workload.oracle`` states the same in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatide.functions import scoring as S
from verbatide.operators import ingest as I
from verbatide.operators import preprocess as P
from verbatide.operators import sentiment as U

RUN_TS = "2024-03-01 12:00:00"
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *keys) -> DataFrame:
    # The given files have one row group each; text work should use all cores.
    return table(spark, sf_dir, name).repartition(*keys)


def _number(column) -> F.Column:
    return F.col(column).cast("string")


def _case(number: str, texts) -> str:
    return f"case {number} " + " ".join(f"when {i} then {t}" for i, t in enumerate(texts)) + " end"


LONG_TEXTS = [
    "text",
    "concat(text, ' good great love https://x.example/a?b=1 @bob #tag')",
    "concat('this is bad and awful, ', text)",
    "concat(text, ' what a great, excellent, amazing and fantastic day')",
    "concat(text, ' I can\\'t like this, why?')",
    "concat('worst: ', text, ' [removed] it')",
]
SHORT_TEXTS = [
    "cast(null as string)",
    "''",
    "'   '",
    "'[deleted]'",
    "'[removed]'",
    "'ok'",
    "'I dislike this but why?'",
    "concat('good great #win ', event_type)",
    "concat('bad terrible awful hate ', props)",
    "concat(event_type, ' was fantastic, thanks @user_', user_id)",
    "concat('nothing works, see http://x.example/', event_id)",
    "concat(event_type, '\\t\\r\\n', props)",
]


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = texts(spark, sf_dir, "documents", "doc_id")
    events = table(spark, sf_dir, "events")
    about_event = [
        "cast(floor(value) as int) as score",
        "cast(event_id % 6 as int) as depth",
        "cast(ts as timestamp) as created_utc",
    ]
    of_event = events.selectExpr("event_id as doc_id", "user_id", *about_event)
    long_texts = documents.join(of_event, "doc_id", "left").selectExpr(
        "concat('d', doc_id) as id",
        "concat('user_', user_id) as author",
        f"{_case('doc_id % 6', LONG_TEXTS)} as text",
        "score",
        "depth",
        "created_utc",
        "source as subreddit",
        "concat('p', doc_id % 100) as post_id",
    )
    short_texts = events.selectExpr(
        "concat('e', event_id) as id",
        "case when event_id % 50 <> 0 then concat('user_', user_id) end as author",
        f"{_case('event_id % 12', SHORT_TEXTS)} as text",
        *about_event,
        "event_type as subreddit",
        "concat('p', event_id % 100) as post_id",
    )
    return long_texts.unionAll(short_texts)


def ingested(spark, sf_dir) -> DataFrame:
    return comments(spark, sf_dir).transform(I.ingest, RUN_TS)


def valid(spark, sf_dir) -> DataFrame:
    return ingested(spark, sf_dir).transform(I.filter_valid)


def cleaned(spark, sf_dir) -> DataFrame:
    return valid(spark, sf_dir).transform(P.preprocess_text)


def keyword_scored(spark, sf_dir) -> DataFrame:
    """As the staged run scores: one scorer for all."""
    return cleaned(spark, sf_dir).transform(U.score_comments, run_ts=RUN_TS)


def scored(spark, sf_dir) -> DataFrame:
    """Two scorers, so that reports by model have something to compare."""
    even = F.substring("id", 2, 20).cast("bigint") % 2 == 0
    return (
        cleaned(spark, sf_dir)
        .transform(U.keyword_struct, out="_keyword")
        .transform(U.rule_struct, out="_rule")
        .withColumn("sentiment_result", F.when(even, F.col("_keyword")).otherwise(F.col("_rule")))
        .drop("_keyword", "_rule")
        .transform(U.flatten_struct)
    )


def flagged_features(spark, sf_dir) -> DataFrame:
    """Comments in the enriched form, before any filter."""
    return comments(spark, sf_dir).transform(I.derive_flags)


def rule_scored(spark, sf_dir) -> DataFrame:
    """As the integrated run scores: exact marker filter, features, rule scorer."""
    return (
        flagged_features(spark, sf_dir)
        .transform(P.preprocess_enriched, right_closed=True)
        .transform(U.score_rules)
    )


# Lines that are sorted in one task.
RANGE_ROWS = 10_000

# What Python calls white space, but Spark's trim() does not.
ODD_BLANKS = ("", "\t", " \t ", "\x0b", "\u00a0", "\u2003 ")


def _blank(blanks):
    return F.element_at(F.array(*map(F.lit, blanks)), (F.col("doc_id") % len(blanks) + 1).cast("int"))


def comment_lines(spark, sf_dir, blanks=("",)) -> DataFrame:
    """Comments as JSON lines; one broken and one blank line per labelled document."""
    lines = comments(spark, sf_dir).select(
        F.to_json(F.struct("*"), JSON_TIME).alias("value")
    )
    labels = table(spark, sf_dir, "labels")
    broken = labels.select(
        F.concat(F.lit('{"id": "broken_'), _number("doc_id"), F.lit('", "text": "cut o')).alias(
            "value"
        )
    )
    blank = labels.select(_blank(blanks).alias("value"))
    return lines.unionByName(broken).unionByName(blank)


def bare_lines(spark, sf_dir) -> DataFrame:
    """``{"text": ...}`` lines in the order of the comments' ids, then broken and blank ones."""
    lines = comments(spark, sf_dir).select(
        "id", F.to_json(F.struct("text")).alias("value")
    )
    labels = table(spark, sf_dir, "labels")
    broken = labels.select(
        F.concat(F.lit("x"), _number("doc_id")).alias("id"), F.lit('{"text": "cut o').alias("value")
    )
    blank = labels.select(F.concat(F.lit("y"), _number("doc_id")), _blank(ODD_BLANKS))
    # Sorted as orderBy would, in as many ranges as keep each of them small.
    rows = table(spark, sf_dir, "documents").count() + table(spark, sf_dir, "events").count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))
    ordered = lines.unionByName(broken).union(blank).repartitionByRange(ranges, "id")
    return ordered.sortWithinPartitions("id").select("value")


def labelled(spark, sf_dir) -> DataFrame:
    documents = texts(spark, sf_dir, "documents", "doc_id")
    labels = table(spark, sf_dir, "labels")
    return (
        documents.join(labels, "doc_id")
        .transform(I.normalize_comments)
        .select("doc_id", F.col("text").alias("sentence"), F.col("quality").alias("label"))
    )


def logits(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") / 100 - 0.5).alias("logit"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )


def two_logits(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") / 100).alias("negative_logit"),
        ((F.col("event_id") % 7).cast("double") / 3).alias("positive_logit"),
    )


def runs(spark, sf_dir) -> DataFrame:
    """Accuracy per user and day, as if each user had trained a model for some epochs."""
    rows = table(spark, sf_dir, "events").select(
        "user_id",
        F.dayofmonth("ts").alias("epoch"),
        S.logit_correct(
            F.col("value") / 100 - 0.5, (F.col("event_type") == "purchase").cast("int")
        ).alias("hit"),
    )
    return rows.groupBy("user_id", "epoch").agg(F.round(F.avg("hit"), 6).alias("accuracy"))


def threads(spark, sf_dir) -> DataFrame:
    """A nested listing per conversation turn.

    The turn is the top comment; it has a reply with a reply of its own, and a
    sibling. Entries of kind ``more`` lie in between and have to be dropped.
    """
    key = F.concat_ws("-", _number("conv_id"), _number("turn"))

    def node(suffix, author, body, score, depth):
        fields = F.struct(
            F.concat(key, F.lit(suffix)).alias("id"),
            author.alias("author"),
            body.alias("body"),
            score.alias("score"),
            depth.alias("depth"),
        )
        return F.regexp_replace(F.to_json(fields), r"\}$", "")

    def entry(fields, replies):
        return F.concat(
            F.lit('{"kind":"t1","data":'), fields, F.lit(',"replies":'), replies, F.lit("}}")
        )

    def listing(*entries):
        return F.concat(
            F.lit('{"kind":"Listing","data":{"children":['),
            F.concat_ws(",", *entries),
            F.lit("]}}"),
        )

    more = F.lit('{"kind":"more","data":{"id":"more","body":"drop me"}}')
    none = F.lit('""')
    text, turn, role = F.col("text"), F.col("turn"), F.col("role")
    deepest = entry(node("-c", role, role, F.lit(None).cast("int"), turn + 2), none)
    reply = entry(
        node("-b", role, F.upper("role"), F.length("text"), turn + 1), listing(more, deepest)
    )
    top = entry(node("-a", role, text, turn * 2, turn), listing(reply, more))
    sibling = entry(node("-d", role, F.lit("bye"), F.lit(1), turn), none)
    return texts(spark, sf_dir, "conversations", "conv_id", "turn").select(
        key.alias("thread"), listing(top, sibling).alias("document")
    )


def deep_threads(spark, sf_dir) -> DataFrame:
    """A listing per conversation, in which each turn is the reply to the one before."""
    fields = F.struct(
        F.concat_ws("-", _number("conv_id"), _number("turn")).alias("id"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
    )
    opened = F.concat(
        F.lit('{"kind":"Listing","data":{"children":[{"kind":"t1","data":'),
        F.regexp_replace(F.to_json(fields), r"\}$", ""),
        F.lit(',"replies":'),
    )
    turns = F.array_sort(F.collect_list(F.struct("turn", opened.alias("opened"))))
    listed = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    return listed.select(
        _number("conv_id").alias("thread"),
        F.concat(
            F.array_join("turns.opened", ""), F.lit('""'), F.repeat(F.lit("}}]}}"), F.size("turns"))
        ).alias("document"),
    )


def permalinks(spark, sf_dir) -> DataFrame:
    """Page addresses, discussion addresses made of them, and lines to be skipped."""
    pages = table(spark, sf_dir, "pages")
    number = _number("page_id")
    made = F.concat(
        F.lit("https://forum.example.com/r/group"),
        (F.col("page_id") % 9).cast("string"),
        F.lit("/comments/"),
        number,
        F.lit("/some_title/?utm_source=share"),
    )
    return (
        pages.select("url")
        .unionAll(pages.select(made))
        .unionAll(pages.select(F.concat(F.lit("# "), F.col("url"))))
        .unionAll(pages.select(F.lit("  ")))
    )
