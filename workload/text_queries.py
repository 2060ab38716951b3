"""Projections, filters and scorers (P, F, U, J, O2)."""

import uuid

from pyspark.sql import functions as F

from verbatide.functions import measures as M
from verbatide.functions import scoring as S
from verbatide.functions import text as T
from verbatide.operators import encoding as E
from verbatide.operators.subwords import SubwordEncoder
from verbatide.operators import ingest as I
from verbatide.operators import preprocess as P
from verbatide.operators import sentiment as U
from verbatide.operators import statistics as A
from verbatide.sinks.tables import save_bucketed
from verbatide.storage import scratch_path
from workload import fixtures as X
from workload.oracle import using, words
from workload.registry import query


def rounded(*names, places=6):
    return [F.round(name, places).alias(name) for name in names]


def rounded_sql(*names, places=6):
    return ", ".join(f"round({name}, {places}) as {name}" for name in names)


PROBABILITIES = ("confidence", "positive_prob", "negative_prob", "neutral_prob")


@query(
    "p1_add_metadata",
    using(
        "comments",
        """select id, length(text)::int as comment_length, '2024-03-01 12:00:00' as processed,
        (select count(*) from comments) as rows, (select count(*) from comments) as record_ids
        from comments""",
    ),
)
def p1(spark, sf_dir):
    # record_id is only promised to be unique, so the number of distinct ids is compared.
    df = X.comments(spark, sf_dir).transform(I.add_metadata, X.RUN_TS)
    numbers = df.agg(
        F.count("*").alias("rows"), F.count_distinct("record_id").alias("record_ids")
    )
    return df.select(
        "id",
        "comment_length",
        F.date_format("processing_timestamp", "yyyy-MM-dd HH:mm:ss").alias("processed"),
        numbers.select("rows").scalar().alias("rows"),
        numbers.select("record_ids").scalar().alias("record_ids"),
    )


@query("p2_normalize_text", using("ingested", "select id, text from ingested"))
def p2(spark, sf_dir):
    return X.comments(spark, sf_dir).transform(I.normalize_comments).select("id", "text")


@query("p3_flag_valid", using("ingested", "select id, is_valid from ingested"))
def p3(spark, sf_dir):
    return X.ingested(spark, sf_dir).select("id", "is_valid")


@query("p4_clean_text", using("clean_all", "select id, text_cleaned from clean_all"))
def p4(spark, sf_dir):
    return X.valid(spark, sf_dir).transform(P.clean_comments).select("id", "text_cleaned")


@query("p5_text_stats", using("clean_all", "select id, word_count, text_length from clean_all"))
def p5(spark, sf_dir):
    return X.valid(spark, sf_dir).transform(P.clean_comments).select(
        "id", "word_count", "text_length"
    )


@query(
    "p6_length_category",
    using(
        "features",
        """select id, case when comment_length < 50 then 'short' when comment_length < 200
        then 'medium' else 'long' end as text_length_category from features""",
    ),
)
def p6(spark, sf_dir):
    return X.flagged_features(spark, sf_dir).select(
        "id", T.length_category("comment_length").alias("text_length_category")
    )


@query(
    "p7_length_category_cut",
    using(
        "features",
        """select id, case when comment_length between 1 and 50 then 'short'
        when comment_length between 51 and 200 then 'medium'
        when comment_length > 200 then 'long' end as text_length_category from features""",
    ),
)
def p7(spark, sf_dir):
    return X.flagged_features(spark, sf_dir).select(
        "id", T.length_category_cut("comment_length").alias("text_length_category")
    )


@query(
    "p8_engagement_score",
    using(
        "features",
        "select id, round(score + 0.1::double * word_count, 6) as engagement_score from features",
    ),
)
def p8(spark, sf_dir):
    return X.flagged_features(spark, sf_dir).select(
        "id", F.round(T.engagement_score("score", "word_count"), 6).alias("engagement_score")
    )


@query(
    "p9_derive_flags",
    using("features", "select id, comment_length, word_count, contains_url, is_question from features"),
)
def p9(spark, sf_dir):
    return X.flagged_features(spark, sf_dir).select(
        "id", "comment_length", "word_count", "contains_url", "is_question"
    )


@query(
    "p10_default_columns",
    using(
        "comments",
        f"""select id, 'unknown' as author, coalesce(text, '') as text, 1::int as score,
        epoch(timestamp '2024-03-01 12:00:00') as created_utc, 'unknown' as subreddit,
        'extracted' as post_id, '2024-03-01T12:00:00' as extraction_timestamp,
        length(coalesce(text, ''))::int as comment_length, {words("coalesce(text, '')")} as word_count,
        contains(coalesce(text, ''), 'http') as contains_url,
        contains(coalesce(text, ''), '?') as is_question,
        null::varchar as sentiment_label, null::double as confidence_score from comments""",
    ),
)
def p10(spark, sf_dir):
    run_ts = F.lit(f"{X.RUN_TS} {spark.conf.get('spark.sql.session.timeZone')}").cast("timestamp")
    epoch = F.unix_timestamp(F.lit(f"{X.RUN_TS} UTC").cast("timestamp")).cast("double")
    df = X.comments(spark, sf_dir).select("id", "text", epoch.alias("created_utc"))
    return df.transform(I.default_columns, run_ts=run_ts)


@query(
    "p11_confidence_range",
    using(
        "scored",
        """select id, case when confidence >= 0.8 then 'High (0.8+)' when confidence >= 0.6
        then 'Medium (0.6-0.8)' when confidence >= 0.4 then 'Low (0.4-0.6)'
        else 'Very Low (<0.4)' end as confidence_range from scored""",
    ),
)
def p11(spark, sf_dir):
    return X.scored(spark, sf_dir).select(
        "id", M.confidence_range("confidence").alias("confidence_range")
    )


@query(
    "p12_confidence_bucket",
    using(
        "scored",
        "select id, trunc(confidence * 10)::int / 10.0::double as confidence_bucket from scored",
    ),
)
def p12(spark, sf_dir):
    return X.scored(spark, sf_dir).select(
        "id", M.confidence_bucket("confidence").alias("confidence_bucket")
    )


@query(
    "p13_time_parts",
    """select event_id, hour(ts)::int as hour, (dayofweek(ts) + 1)::int as day_of_week,
    month(ts)::int as month, year(ts)::int as year from events""",
)
def p13(spark, sf_dir):
    parts = M.time_parts("ts")
    return X.table(spark, sf_dir, "events").select(
        "event_id", *[column.alias(name) for name, column in parts.items()]
    )


@query("p14_date_key", "select event_id, strftime(ts, '%Y-%m-%d') as processing_date from events")
def p14(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        "event_id", T.date_key("ts").alias("processing_date")
    )


@query(
    "p15_flatten_struct",
    using(
        "keyword_scored",
        f"select id, sentiment, {rounded_sql(*PROBABILITIES)}, model_version from keyword_scored",
    ),
)
def p15(spark, sf_dir):
    structs = X.cleaned(spark, sf_dir).transform(U.keyword_struct)
    return (
        structs.select("id", "sentiment_result")
        .transform(U.flatten_struct)
        .select("id", "sentiment", *rounded(*PROBABILITIES), "model_version")
    )


@query("p16_project_available", using("comments", "select id, score, depth from comments"))
def p16(spark, sf_dir):
    return X.comments(spark, sf_dir).transform(
        P.project_available, ["id", "not_there", "score", "depth", "text_cleaned"]
    )


@query(
    "p17_truncate_example",
    using(
        "comments",
        """select id, case when length(text) > 100 then substring(text, 1, 100) || '...'
        else text end as marked, substring(text, 1, 100) as plain from comments""",
    ),
)
def p17(spark, sf_dir):
    return X.comments(spark, sf_dir).select(
        "id",
        T.truncate_example("text").alias("marked"),
        T.truncate_example("text", ellipsis="").alias("plain"),
    )


@query(
    "p18_numeric_or_default",
    """select event_id, coalesce(try_cast(case when event_id % 3 = 0 then 'n/a'
    when event_id % 3 = 1 then null else value::varchar end as double), 50) as confidence
    from events""",
)
def p18(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, "n/a").when(
        F.col("event_id") % 3 == 2, F.col("value").cast("string")
    )
    return X.table(spark, sf_dir, "events").select(
        "event_id", T.number_or_default(raw).alias("confidence")
    )


@query(
    "p19_round_report",
    """select event_type, round(avg(value), 2) as average, round(stddev_samp(value), 4) as deviation
    from events group by event_type""",
)
def p19(spark, sf_dir):
    return (
        X.table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            A.rounded(F.avg("value"), 2).alias("average"),
            A.rounded(F.stddev("value"), 4).alias("deviation"),
        )
    )


@query(
    "p20_logit_to_label",
    using(
        "logits",
        """select event_id, case when p > 0.5 then 'Positive' else 'Negative' end as sentiment,
        trunc(case when p > 0.5 then p * 100 else 100 - p * 100 end)::int as percent
        from (select *, 1 / (1 + exp(-logit)) as p from logits)""",
    ),
)
def p20(spark, sf_dir):
    return X.logits(spark, sf_dir).select(
        "event_id",
        S.logit_label("logit").alias("sentiment"),
        S.logit_percent("logit").alias("percent"),
    )


@query(
    "p21_softmax_to_label",
    """select event_id, case when l1 > l0 then 'Positive' else 'Negative' end as sentiment_label,
    round(100 * greatest(exp(l0 - m), exp(l1 - m)) / (exp(l0 - m) + exp(l1 - m)), 6)
      as confidence_score
    from (select *, greatest(l0, l1) as m from (select event_id, value / 100 as l0,
      (event_id % 7)::double / 3 as l1 from events))""",
)
def p21(spark, sf_dir):
    pair = ("negative_logit", "positive_logit")
    return X.two_logits(spark, sf_dir).select(
        "event_id",
        S.softmax_label(*pair).alias("sentiment_label"),
        F.round(S.softmax_percent(*pair), 6).alias("confidence_score"),
    )


@query(
    "p22_expand_probabilities",
    using(
        "rule_scored",
        """select id, lower(sentiment_label) as sentiment, confidence_score / 100 as confidence,
        case when sentiment_label = 'Positive' then confidence_score / 100
          else (100 - confidence_score) / 100 end as positive_prob,
        case when sentiment_label = 'Negative' then confidence_score / 100
          else (100 - confidence_score) / 100 end as negative_prob,
        0.1::double as neutral_prob, 'bert-sentiment-v1' as model_version from rule_scored""",
    ),
)
def p22(spark, sf_dir):
    return (
        X.rule_scored(spark, sf_dir)
        .withColumn("result", S.expand_probabilities("sentiment_label", "confidence_score"))
        .select("id", "result.*")
    )


@query(
    "p23_encode_tokens",
    r"""with words as (
      select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\p{L}\p{N}\s\x{B}]') as t
      from documents),
    counted as (select token, count(*) as n from (select unnest(t) as token from words)
      group by token),
    vocabulary as (select token, row_number() over (order by n desc, token) + 3 as token_id
      from counted),
    placed as (select doc_id, unnest(t[1:48]) as token,
      generate_subscripts(t[1:48], 1) as pos from words),
    bodies as (select doc_id, list(token_id order by pos) as ids
      from placed join vocabulary using (token) group by doc_id),
    encoded as (select doc_id, [2] || coalesce(ids, []) || [3] as ids
      from words left join bodies using (doc_id))
    select doc_id, array_to_string(ids || list_resize([]::bigint[], 50 - len(ids), 0), ',')
        as input_ids,
      array_to_string(list_resize([]::int[], len(ids), 1)
        || list_resize([]::int[], 50 - len(ids), 0), ',') as attention_mask
    from encoded""",
)
def p23(spark, sf_dir):
    documents = X.texts(spark, sf_dir, "documents", "doc_id")
    vocabulary = E.build_vocabulary(documents)
    return E.encode_tokens(documents, vocabulary, 50, key="doc_id").select(
        "doc_id",
        F.array_join("input_ids", ",").alias("input_ids"),
        F.array_join("attention_mask", ",").alias("attention_mask"),
    )


PIECE_WORDS = 500


@query(
    "p23_subword_encode",
    rf"""with recursive words as (
      select doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s\x{{B}}]') as t
      from documents),
    counted as (select token, count(*) as n from (select unnest(t) as token from words)
      group by token),
    ranked as (select token, row_number() over (order by n desc, token) as r from counted),
    head as (select token, row_number() over (order by r) - 1 as i from ranked
      where r <= {PIECE_WORDS} and length(token) <= 64),
    rare as (select c, row_number() over (order by c) - 1 as i from (
      select distinct unnest(string_split(token, '')) as c from counted
      except select token from head)),
    sizes as (select (select count(*) from head) as h, (select count(*) from rare) as k),
    pieces as (
      select token as piece, 4 + i as id, true as starts from head
      union all select token, 4 + h + i, false from head, sizes
      union all select c, 4 + 2 * h + i, true from rare, sizes
      union all select c, 4 + 2 * h + k + i, false from rare, sizes),
    used as (select distinct unnest(t[1:48]) as token from words),
    spans as (select token, p, l, substring(token, p, l) as piece, p = 1 as starts from used,
      range(1, length(token) + 1) a(p), range(1, least(66, length(token) - p + 1) + 1) b(l)),
    best as (select token, p, max(l) as l, arg_max(id, l) as id
      from spans join pieces using (piece, starts) group by token, p),
    walk as (
      select token, 1::bigint as p, []::bigint[] as ids from used
      union all
      select w.token, w.p + b.l, list_append(w.ids, b.id) from walk w join best b
      on w.token = b.token and w.p = b.p),
    encoded as (select token, ids from walk where p > length(token)),
    placed as (select doc_id, unnest(t[1:48]) as token,
      generate_subscripts(t[1:48], 1) as pos from words),
    bodies as (select doc_id, flatten(list(ids order by pos))[1:48] as ids
      from placed join encoded using (token) group by doc_id),
    listed as (select doc_id, [2] || coalesce(ids, []) || [3] as ids
      from words left join bodies using (doc_id))
    select doc_id, array_to_string(ids || list_resize([]::bigint[], 50 - len(ids), 0), ',')
      as input_ids, len(ids)::bigint as attended from listed""",
)
def p23_subwords(spark, sf_dir):
    documents = X.texts(spark, sf_dir, "documents", "doc_id")
    encoder = SubwordEncoder(inputCol="text", maxlen=50, words=PIECE_WORDS).fit(documents)
    return encoder.transform(documents).select(
        "doc_id",
        F.array_join("input_ids", ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("attended"),
    )


LONG_LENGTH = 5000


@query(
    "p23_encode_long",
    r"""with words as (
      select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+|[^\p{L}\p{N}\s\x{B}]') as t
      from documents)
    select doc_id, 5000 as ids, least(len(t), 4998)::bigint + 2 as attended, 0::bigint as unknown
    from words""",
)
def p23_long(spark, sf_dir):
    documents = X.texts(spark, sf_dir, "documents", "doc_id")
    encoded = E.encode_tokens(documents, E.build_vocabulary(documents), LONG_LENGTH, key="doc_id")
    attended = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x)
    return encoded.select(
        "doc_id",
        F.size("input_ids").alias("ids"),
        attended.alias("attended"),
        F.size(F.filter("input_ids", lambda i: i == E.UNKNOWN)).cast("long").alias("unknown"),
    )


VERDICT = """select count(*) filter (lower({label}) = 'positive') as positive,
    count(*) filter (lower({label}) = 'negative') as negative,
    count(*) filter (lower({label}) = 'neutral') as neutral,
    case when positive > negative {and_pos} then 'Positive'
      when negative > positive {and_neg} then 'Negative' else 'Neutral' end as overall
    from {source}"""


@query(
    "p24_overall_verdict",
    using(
        "rule_scored",
        VERDICT.format(label="sentiment_label", source="rule_scored", and_pos="", and_neg=""),
    ),
)
def p24(spark, sf_dir):
    return A.overall_verdict(X.rule_scored(spark, sf_dir), "sentiment_label")


@query(
    "p24_overall_verdict_three_way",
    using(
        "scored",
        VERDICT.format(
            label="sentiment", source="scored",
            and_pos="and positive > neutral", and_neg="and negative > neutral",
        ),
    ),
)
def p24_three_way(spark, sf_dir):
    return A.overall_verdict(X.scored(spark, sf_dir), three_way=True)


@query(
    "p25_distribution_percent",
    using(
        "rule_scored",
        """select sentiment_label, count(*) as count,
        round(count(*) * 100.0::double / (select count(*) from rule_scored), 2) as percentage
        from rule_scored group by sentiment_label""",
    ),
)
def p25(spark, sf_dir):
    counts = A.sentiment_counts(X.rule_scored(spark, sf_dir), "sentiment_label")
    return A.distribution_percent(counts, "sentiment_label")


@query("f1_filter_valid", using("valid", "select id, text, comment_length from valid"))
def f1(spark, sf_dir):
    return X.valid(spark, sf_dir).select("id", "text", "comment_length")


@query(
    "f1_retention_counts",
    using(
        "ingested",
        "select count(*) filter (is_valid = 'valid') as retained, count(*) as total from ingested",
    ),
)
def f1_counts(spark, sf_dir):
    return I.retention_counts(X.ingested(spark, sf_dir))


@query("f2_filter_min_size", using("cleaned", "select id, word_count, text_length from cleaned"))
def f2(spark, sf_dir):
    return X.cleaned(spark, sf_dir).select("id", "word_count", "text_length")


@query(
    "f2_filter_max_size",
    using(
        "cleaned", "select id, word_count, text_length from cleaned where text_length <= 5000"
    ),
)
def f2_max(spark, sf_dir):
    return X.valid(spark, sf_dir).transform(P.preprocess_text, max_length=5000).select(
        "id", "word_count", "text_length"
    )


@query("f3_filter_markers_exact", using("enriched", "select id, text from enriched"))
def f3(spark, sf_dir):
    return X.comments(spark, sf_dir).transform(P.filter_markers_exact).select("id", "text")


@query("f4_filter_non_empty", using("comments", "select id, text from comments where text <> ''"))
def f4(spark, sf_dir):
    return X.comments(spark, sf_dir).transform(P.filter_non_empty).select("id", "text")


@query(
    "f5_filter_label",
    using("scored", "select id, confidence from scored where sentiment = 'positive'"),
)
def f5(spark, sf_dir):
    return X.scored(spark, sf_dir).transform(P.filter_label, "positive").select("id", "confidence")


@query(
    "f7_confidence_threshold",
    using("rule_scored", "select id, confidence_score from rule_scored where confidence_score >= 60"),
)
def f7(spark, sf_dir):
    return (
        X.rule_scored(spark, sf_dir)
        .transform(P.filter_confidence, 60, "confidence_score")
        .select("id", "confidence_score")
    )


SCORED_COLUMNS = f"select id, sentiment, {rounded_sql(*PROBABILITIES)}, model_version from"


@query("u1_score_lexicon_v1", using("keyword_scored", f"{SCORED_COLUMNS} keyword_scored"))
def u1(spark, sf_dir):
    return (
        X.cleaned(spark, sf_dir)
        .transform(U.score_keywords)
        .select("id", "sentiment", *rounded(*PROBABILITIES), "model_version")
    )


@query(
    "u2_score_lexicon_v2",
    using("rule_scored", "select id, sentiment_label, confidence_score from rule_scored"),
)
def u2(spark, sf_dir):
    return X.rule_scored(spark, sf_dir).select("id", "sentiment_label", "confidence_score")


@query(
    "u3_score_struct",
    using(
        "keyword_scored",
        f"""{SCORED_COLUMNS} keyword_scored where regexp_matches(text_cleaned, '[^ ]')
        union all select id, 'unknown', 0, 0.33, 0.33, 0.34, 'empty' from cleaned
        where not regexp_matches(text_cleaned, '[^ ]')""",
    ),
)
def u3(spark, sf_dir):
    return X.keyword_scored(spark, sf_dir).select(
        "id", "sentiment", *rounded(*PROBABILITIES), "model_version"
    )


@query(
    "u4_score_batches",
    using(
        "comments",
        """select id, case when text is null then null when length(text) % 2 = 1
        then 'positive' else 'negative' end as sentiment,
        (50 + length(text) % 50) / 100.0::double as confidence from comments""",
    ),
)
def u4(spark, sf_dir):
    # A stand-in for a model: label and percentage depend on the text's length.
    # Defined here, so that workers get it by value.
    def load():
        def score(texts):
            return [
                ("Positive" if len(text) % 2 else "Negative", 50 + len(text) % 50)
                for text in texts
            ]

        return score

    return (
        X.comments(spark, sf_dir)
        .select("id", "text")
        .transform(U.score_batches, load)
        .select("id", "sentiment_result.sentiment", "sentiment_result.confidence")
    )


@query(
    "u5_fallback_cascade",
    using(
        "keyword_balance",
        """select id, case when n % 3 = 0 then 'positive' when n % 3 = 2 then 'unknown'
          when balance > 0 then 'positive' when balance < 0 then 'negative' else 'neutral' end
          as sentiment,
        case when n % 3 = 0 then 'bert-sentiment-v1' when n % 3 = 2 then 'fallback'
          else 'simple-keyword' end as model_version,
        case when n % 3 = 0 then 0.77::double when n % 3 = 2 then 0::double
          when balance = 0 then 0.5::double
          else round(least(0.6::double + abs(balance) * 0.1::double, 0.9::double), 6) end
          as confidence
        from (select *, substring(id, 2)::bigint as n from keyword_balance)""",
    ),
)
def u5(spark, sf_dir):
    # A model that scores every third row and a lexicon that misses another third.
    third = F.substring("id", 2, 20).cast("bigint") % 3
    return (
        X.cleaned(spark, sf_dir)
        .withColumn(
            "_model", F.when(third == 0, S.expand_probabilities(F.lit("Positive"), F.lit(77)))
        )
        .transform(U.keyword_struct, out="_lexicon")
        .withColumn("_lexicon", F.when(third != 2, F.col("_lexicon")))
        .transform(U.fallback_cascade, ["_model", "_lexicon"])
        .select(
            "id",
            "sentiment_result.sentiment",
            "sentiment_result.model_version",
            F.round("sentiment_result.confidence", 6).alias("confidence"),
        )
    )


@query(
    "j1_attach_predictions",
    using(
        "rule_scored",
        """select c.id, c.text, p.sentiment_label, p.confidence_score from comments c
        left join rule_scored p on c.id = p.id""",
    ),
)
def j1(spark, sf_dir):
    comments = X.comments(spark, sf_dir)
    made = X.rule_scored(spark, sf_dir).select("id", "sentiment_label", "confidence_score")
    # Each prediction twice, the second one less certain.
    repeated = made.unionByName(made.withColumn("confidence_score", F.lit(1.0)))
    return U.attach_predictions(comments, repeated).select(
        "id", "text", "sentiment_label", "confidence_score"
    )


@query(
    "j1_bucketed",
    using(
        "rule_scored",
        """select c.id, c.text, p.sentiment_label, p.confidence_score from comments c
        left join rule_scored p on c.id = p.id""",
    ),
)
def j1_bucketed(spark, sf_dir):
    """Both sides stored in buckets of the id, then joined as they lie."""
    made = X.rule_scored(spark, sf_dir).select("id", "sentiment_label", "confidence_score")
    stored = []
    for name, rows in (("comments", X.comments(spark, sf_dir)), ("predictions", made)):
        table = f"{name}_{uuid.uuid4().hex}"
        save_bucketed(rows, table, scratch_path(spark, "bucketed"), 16)
        stored.append(spark.table(table))
    return U.attach_predictions(*stored).select(
        "id", "text", "sentiment_label", "confidence_score"
    )


@query(
    "o2_preprocess_v2",
    using(
        "enriched",
        """select id, category as text_length_category, category_cut,
        round(engagement_score, 6) as engagement_score from enriched""",
    ),
)
def o2(spark, sf_dir):
    return (
        X.flagged_features(spark, sf_dir)
        .transform(P.preprocess_enriched)
        .select(
            "id",
            "text_length_category",
            T.length_category_cut("comment_length").alias("category_cut"),
            *rounded("engagement_score"),
        )
    )
