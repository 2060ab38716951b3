"""Oracle SQL of the report tables: one statement per section, put together."""

STDDEV = "round(stddev_samp({}), {})"


def entry(section, metric, value, source, key1="null", key2="null", group="", note="null") -> str:
    return (
        f"select '{section}' as section, {key1}::varchar as key1, {key2}::varchar as key2, "
        f"'{metric}' as metric, ({value})::double as value, {note}::varchar as note "
        f"from {source} {group}"
    )


def block(section, source, keys, metrics) -> list:
    group = "group by " + ", ".join(keys) if keys else ""
    key1 = keys[0] if keys else "null"
    key2 = keys[1] if len(keys) > 1 else "null"
    return [entry(section, m, v, source, key1, key2, group) for m, v in metrics.items()]


def comprehensive(source: str, columns, absent=()) -> str:
    dow = "(dayofweek(created_utc) + 1)"
    band = (
        "case when confidence >= 0.8 then 'High (0.8+)' when confidence >= 0.6 then "
        "'Medium (0.6-0.8)' when confidence >= 0.4 then 'Low (0.4-0.6)' else 'Very Low (<0.4)' end"
    )
    selects = block("metadata", source, [], {"total_records": "count(*)"})
    selects += [
        f"select 'metadata', '{name}', null, 'data_column', {i}::double, null"
        for i, name in enumerate(columns)
    ]
    selects += block(
        "sentiment_distribution", source, ["sentiment"],
        {
            "count": "count(*)",
            "percentage": f"round(count(*) * 100.0::double / (select count(*) from {source}), 2)",
        },
    )
    selects += block(
        "confidence_statistics", source, [],
        {
            "average": "round(avg(confidence), 4)",
            "minimum": "round(min(confidence), 4)",
            "maximum": "round(max(confidence), 4)",
            "std_deviation": STDDEV.format("confidence", 4),
            "median": "round(quantile_disc(confidence, 0.5), 4)",
            "q1": "round(quantile_disc(confidence, 0.25), 4)",
            "q3": "round(quantile_disc(confidence, 0.75), 4)",
        },
    )
    selects += block(
        "confidence_range_distribution", source, ["sentiment", band], {"count": "count(*)"}
    )
    selects += block(
        "average_confidence_by_sentiment", source, ["sentiment"],
        {"average_confidence": "round(avg(confidence), 4)", "sample_size": "count(*)"},
    )
    selects += block(
        "text_length_statistics", source, [],
        {
            "average": "round(avg(text_length), 2)",
            "minimum": "min(text_length)",
            "maximum": "max(text_length)",
            "std_deviation": STDDEV.format("text_length", 2),
        },
    )
    selects += block(
        "length_by_sentiment", source, ["sentiment"],
        {
            "avg_text_length": "round(avg(text_length), 2)",
            "avg_word_count": "round(avg(word_count), 2)",
            "min_text_length": "min(text_length)",
            "max_text_length": "max(text_length)",
            "stddev_text_length": STDDEV.format("text_length", 2),
        },
    )
    selects += block(
        "correlations", source, [],
        {
            "text_length_confidence": "round(corr(text_length, confidence), 4)",
            "word_count_confidence": "round(corr(word_count, confidence), 4)",
        },
    )
    selects += block(
        "hourly_sentiment_distribution", source, ["sentiment", "hour(created_utc)"],
        {"count": "count(*)"},
    )
    selects += block(
        "daily_sentiment_distribution", source, ["sentiment", dow], {"count": "count(*)"}
    )
    selects += block(
        "model_usage_statistics", source, ["model_version"],
        {
            "usage_count": "count(*)",
            "average_confidence": "round(avg(confidence), 4)",
            "confidence_stddev": "round(coalesce(stddev_samp(confidence), 0), 4)",
        },
    )
    selects += block(
        "model_sentiment_performance", source, ["sentiment", "model_version"],
        {"count": "count(*)", "avg_confidence": "round(avg(confidence), 4)"},
    )
    # Which cluster a row is in depends on the fit; over all clusters, rows by sentiment.
    selects.append(
        entry("cluster_sentiment", "count", "count(*)", source, key2="sentiment", group="group by sentiment")
    )
    return "\nunion all\n".join(selects)


def dashboard(source: str) -> str:
    selects = block(
        "summary_metrics", source, [],
        {
            "total_comments": "count(*)",
            "average_confidence": "round(coalesce(avg(confidence), 0), 4)",
        },
    )
    selects += block("sentiment_distribution", source, ["sentiment"], {"count": "count(*)"})
    selects += block(
        "confidence_histogram", source, ["(trunc(confidence * 10)::int / 10.0::double)"],
        {"count": "count(*)"},
    )
    selects += block(
        "hourly_trends", source, ["sentiment", "hour(created_utc)"], {"count": "count(*)"}
    )
    return "\nunion all\n".join(selects)


def summary(source: str) -> str:
    selects = block("total_processed", source, [], {"count": "count(*)"})
    selects += block("sentiment_distribution", source, ["sentiment"], {"count": "count(*)"})
    selects += block(
        "confidence_statistics", source, [],
        {
            "count": "count(confidence)",
            "mean": "round(avg(confidence), 4)",
            "stddev": STDDEV.format("confidence", 4),
            "min": "min(confidence)",
            "max": "max(confidence)",
        },
    )
    selects += block("model_usage", source, ["model_version"], {"count": "count(*)"})
    selects += block(
        "length_sentiment_correlation", source, ["sentiment"],
        {
            "avg_text_length": "round(avg(text_length), 2)",
            "avg_word_count": "round(avg(word_count), 2)",
        },
    )
    return "\nunion all\n".join(selects)


def analysis(source: str, example: str) -> str:
    selects = block("pipeline_metadata", source, [], {"total_comments": "count(*)"})
    selects += block("sentiment_distribution", source, ["sentiment_label"], {"count": "count(*)"})
    selects += block(
        "average_confidence", source, ["sentiment_label"],
        {"mean": "round(avg(confidence_score), 4)"},
    )
    selects += block(
        "text_statistics", source, [],
        {
            "avg_length": "round(coalesce(avg(comment_length), 0), 4)",
            "std_length": "round(coalesce(stddev_samp(comment_length), 0), 4)",
            "avg_words": "round(coalesce(avg(word_count), 0), 4)",
            "avg_score": "round(coalesce(avg(score), 0), 4)",
        },
    )
    ranked = (
        f"(select *, row_number() over (partition by sentiment_label "
        f"order by confidence_score desc, id) as rank from {source} "
        f"where sentiment_label in ('Positive', 'Negative'))"
    )
    selects.append(
        entry(
            "top_examples", "confidence", "confidence_score", ranked, "sentiment_label",
            "rank", "where rank <= 3", example,
        )
    )
    return "\nunion all\n".join(selects)
