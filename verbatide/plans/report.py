"""Reports: many statistics of one scored table, from a single pass over it.

Each statistic alone is an operator in ``verbatide.operators.statistics``. A
report would read its input once for each of them. Here the table is reduced
once, to mergeable sums at the finest grain a report needs; that profile has
a few thousand rows however large the table is, and grouping sets over it give
all sections.

Fixed values: the names of sections and metrics.

A report is a long table (section, key1, key2, metric, value, note). Sections
whose columns the input lacks, or holds in a form that cannot be read, have one row with
metric ``error``; the others are not affected.
"""

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions import measures as M
from verbatide.operators.clustering import FEATURES, available_features, fit_profile
from verbatide.operators.quantiles import discrete_quantiles
from verbatide.operators.statistics import QUARTILES, top_examples
from verbatide.storage import cut_lineage

NOTE_SCHEMA = (
    "section string, key1 string, key2 string, metric string, value double, note string"
)

# Report precision: places of confidences and correlations, and of the rest.
FINE, COARSE = 4, 2


# --- pieces of SQL: sums to be merged, and what is computed from them ---------


def _sums(value: str, where: str | None = None, name: str | None = None) -> dict:
    """Count, mean and sum of squared distances from it, optionally only where a
    condition holds."""
    name = name or value
    value = f"cast({value} as double)"
    if where is not None:
        value = f"case when {where} then {value} end"
    return {
        f"{name}_n": f"count({value})",
        f"{name}_mean": f"avg({value})",
        f"{name}_spread": f"count({value}) * var_pop({value})",
    }


def _products(x: str, y: str, name: str) -> dict:
    """Of rows that know both values: what _sums tells, and the sum of products of their
    distances from the means."""
    return {
        **_sums(x, f"{y} is not null", f"{name}_{x}"),
        **_sums(y, f"{x} is not null", f"{name}_{y}"),
        f"{name}_product": f"count({name}_both) * covar_pop({x}, {y})".replace(
            f"{name}_both", f"case when {x} is not null and {y} is not null then 1 end"
        ),
    }


def _summed(additive: dict) -> list:
    return [n.removesuffix("_mean") for n in additive if n.endswith("_mean")]


def _centres(additive: dict) -> dict:
    """SQL of the whole table's means, over a profile's rows."""
    return {
        f"{n}_centre": f"sum({n}_n * {n}_mean) {{over}} / nullif(sum({n}_n) {{over}}, 0)"
        for n in _summed(additive)
    }


def _centred(profile: DataFrame, additive: dict, centres: DataFrame | None = None) -> DataFrame:
    """Turn means and spreads into sums that can be added up over any rows.

    Distances are taken from the table's mean, which the profile's few rows tell (or
    ``centres``, one row), and not from zero: raw sums of squares lose the digits a small
    deviation needs.
    """
    names = _summed(additive)
    if centres is None:
        sqls = _centres(additive).items()
        profile = profile.withColumns({n: F.expr(sql.format(over="over ()")) for n, sql in sqls})
    else:
        profile = profile.crossJoin(F.broadcast(centres))
    off = {n: f"({n}_mean - {n}_centre)" for n in names}
    made = {f"{n}_sum": f"{n}_n * {off[n]}" for n in names}
    made |= {f"{n}_square": f"{n}_spread + {n}_n * {off[n]} * {off[n]}" for n in names}
    for cross in [n.removesuffix("_product") for n in additive if n.endswith("_product")]:
        x, y = [n for n in names if n.startswith(f"{cross}_")]
        made[f"{cross}_cross"] = f"{cross}_product + {x}_n * {off[x]} * {off[y]}"
    return profile.withColumns({n: F.expr(sql) for n, sql in made.items()})


def _merges(additive: dict) -> list:
    """Sums over a profile's centred rows; centres are the same in all of them."""
    sums = []
    for name in additive:
        stem, _, kind = name.rpartition("_")
        sums.append({"mean": f"{stem}_sum", "spread": f"{stem}_square"}.get(kind, name))
        if kind == "product":
            sums[-1] = f"{stem}_cross"
    return _merged(sums) + [F.max(f"{n}_centre").alias(f"{n}_centre") for n in _summed(additive)]


def _mean(name: str) -> str:
    return f"{name}_centre + {name}_sum / nullif({name}_n, 0)"


def _spread(name: str) -> str:
    """Sum of squared distances from the mean."""
    return f"greatest({name}_square - {name}_sum * {name}_sum / nullif({name}_n, 0), 0.0D)"


def _stddev(name: str) -> str:
    """Sample standard deviation; null below two rows."""
    return f"sqrt({_spread(name)} / nullif(greatest({name}_n - 1, 0), 0))"


def _correlation(x: str, y: str, cross: str) -> str:
    """Pearson correlation from sums over the rows where both values are known."""
    covariance = f"({cross} - {x}_sum * {y}_sum / nullif({x}_n, 0))"
    # What rounding leaves of a constant's spread counts as none.
    varies = " and ".join(
        f"{_spread(n)} > 1e-26D * {n}_n * {n}_centre * {n}_centre" for n in (x, y)
    )
    deviations = f"nullif(sqrt({_spread(x)}) * sqrt({_spread(y)}), 0.0D)"
    return f"case when {varies} then {covariance} / {deviations} end"


def _round(value: str, places: int = FINE) -> str:
    return f"round({value}, {places})"


def _or_zero(value: str) -> str:
    return f"coalesce({value}, 0.0D)"


def _aggregates(sqls: dict) -> list:
    return [F.expr(sql).alias(name) for name, sql in sqls.items()]


def _merged(names) -> list:
    return _aggregates({name: f"sum({name})" for name in names})


# --- grouping sets and the sections made from them ----------------------------


def _group_by_sets(df: DataFrame, keys, sets):
    columns = {name: F.col(name) for name in keys}
    return df.groupingSets([[columns[name] for name in kept] for kept in sets], *columns.values())


def _never_empty(profile: DataFrame) -> DataFrame:
    """Add a row without values, so that an empty table has its totals reported too."""
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in profile.schema]
    return profile.unionAll(profile.sparkSession.range(1).select(*blank))


def _known_groups(grouped: DataFrame, keys) -> DataFrame:
    """Groups that have rows, and the whole table even if it has none."""
    counted = grouped.withColumn("rows", F.coalesce("rows", F.lit(0)))
    return counted.filter(f"rows > 0 or _set = {_set_number(keys, ())}")


def _set_number(keys, kept) -> int:
    """grouping_id() of a grouping set: one bit per key, 1 if it is left out."""
    return reduce(lambda bits, name: bits * 2 + (name not in kept), keys, 0)


def _entry(section, key1="null", key2="null", metric="error", value="null", note="null") -> str:
    return (
        f"named_struct('section', '{section}', 'key1', cast({key1} as string), "
        f"'key2', cast({key2} as string), 'metric', '{metric}', "
        f"'value', cast({value} as double), 'note', cast({note} as string))"
    )


def _report_rows(grouped: DataFrame, keys, sections, failures=()) -> DataFrame:
    """Rows of a grouping set (numbered in ``_set``) to the sections that use the set.

    ``sections`` holds (section, kept keys, {metric: SQL}[, group]), ``failures`` (group,
    SQL of a condition, note): where it holds, an error row stands for the group's sections.
    """
    failing = {group: condition for group, condition, _ in failures}
    arrays = []
    for section, kept, metrics, *group in sections:
        key1, key2 = [*kept, "null", "null"][:2]
        rows = [_entry(section, key1, key2, metric, value) for metric, value in metrics.items()]
        shown = f"_set = {_set_number(keys, kept)}"
        if group and group[0] in failing:
            shown += f" and not ({failing[group[0]]})"
        arrays.append(f"case when {shown} then array({', '.join(rows)}) end")
    for group, condition, note in failures:
        shown = f"_set = {_set_number(keys, ())} and ({condition})"
        entry = _entry(group, note=f"'{note}'")
        arrays.append(f"case when {shown} then array({entry}) end")
    filled = f"flatten(array_compact(array({', '.join(arrays)})))"
    return grouped.select(F.inline(F.expr(filled)))


def _readable(df: DataFrame, name: str, kind: str):
    """The column as a number or timestamp, null where it cannot be read; None where the
    input has no such column, or one of a type that has no such values."""
    if name not in df.columns:
        return None
    value = F.col(name).try_cast(kind)
    try:
        df.select(value)
    except PySparkException:
        return None
    return value


def comprehensive_report(
    df: DataFrame, time_col: str = "created_utc", bands=M.CONFIDENCE_BANDS, clusters: int = 3
) -> DataFrame:
    """Distribution, confidence, lengths, correlations, times, models and clusters of
    scored comments.

    The input is read once, when this is called: to a stored profile, from which all else
    comes, the fit of the clusters included (none with ``clusters=0``). Numbers and times
    that cannot be read make the sections that need them fail, and no others.
    """
    wanted = {
        "conf": ("confidence", "double"),
        "length": ("text_length", "double"),
        "words": ("word_count", "double"),
        "time": (time_col, "timestamp"),
    }
    found = {name: _readable(df, *spec) for name, spec in wanted.items()}
    has_conf, has_length, has_time = (found[n] is not None for n in ("conf", "length", "time"))
    has_words = has_length and found["words"] is not None
    has_model = "model_version" in df.columns
    scores = {name: _readable(df, name, "double") for name in FEATURES}
    scores = {name: value for name, value in scores.items() if value is not None and clusters}
    if len(scores) < 2:
        scores = {}
    time_bad = F.col(time_col).isNotNull() & found["time"].isNull() if has_time else F.lit(False)

    def number(name):
        value = found[name]
        return F.lit(None).cast("double") if value is None else value

    def unread(name):
        value = found[name]
        return F.lit(False) if value is None else F.col(wanted[name][0]).isNotNull() & value.isNull()

    def part(name):
        return M.time_parts(found["time"])[name] if has_time else F.lit(None).cast("int")

    keys = ("sentiment", "confidence_range", "model_version", "hour", "day_of_week")
    narrow = df.select(
        "sentiment",
        M.confidence_range(number("conf"), bands).alias("confidence_range"),
        (F.col("model_version") if has_model else F.lit(None)).cast("string").alias("model_version"),
        part("hour").alias("hour"),
        part("day_of_week").alias("day_of_week"),
        F.round(number("conf"), FINE).alias("_value"),
        number("conf").alias("conf"),
        number("length").alias("length"),
        (number("words") if has_words else F.lit(None).cast("double")).alias("words"),
        *[value.alias(f"_score_{name}") for name, value in scores.items()],
        unread("conf").alias("_conf_unread"),
        (unread("length") | (unread("words") if has_words else F.lit(False))).alias("_text_unread"),
        time_bad.alias("_time_unread"),
        reduce(
            lambda some, name: some | (F.col(name).isNotNull() & scores[name].isNull()),
            scores,
            F.lit(False),
        ).alias("_scores_unread"),
    )

    # The profile: per combination of keys, per confidence value (for the quartiles), and
    # per combination of scores (for the clusters). Three short rows leave each input
    # row, and they are combined before the only shuffle that grows with the input at all.
    additive = {
        "rows": "count(1)",
        **_sums("conf"),
        **_sums("length"),
        **_sums("words"),
        # For the correlations: rows where both values are known.
        **_products("conf", "length", "lc"),
        **_products("conf", "words", "wc"),
    }
    extremes = {
        f"{name}_{end}": f"{end}({name})" for name in ("conf", "length") for end in ("min", "max")
    }
    unreads = [f"_{name}_unread" for name in ("conf", "text", "time", "scores")]
    score_keys = [f"_score_{name}" for name in scores]
    all_keys = (*keys, "_value", *score_keys)
    sets = [keys, ("_value",), *([("sentiment", *score_keys)] if scores else [])]
    stored = cut_lineage(
        _group_by_sets(narrow, all_keys, sets).agg(
            F.grouping_id().alias("_kind"),
            *_aggregates({**additive, **extremes}),
            *_aggregates({name: f"count_if({name})" for name in unreads}),
        )
    )

    # From here on all rows are those of the profile.
    by_keys, by_value = (
        stored.filter(F.col("_kind") == _set_number(all_keys, kept)) for kept in sets[:2]
    )
    # One row each: they are broadcast.
    centres = by_keys.agg(*_aggregates({n: q.format(over="") for n, q in _centres(additive).items()}))
    totals = by_keys.agg(F.sum("rows").alias("_everything"), *_merged(unreads))
    quartiles = discrete_quantiles(by_value, QUARTILES, count="conf_n")
    sets = [
        (),
        ("sentiment",),
        ("sentiment", "confidence_range"),
        ("sentiment", "hour"),
        ("sentiment", "day_of_week"),
        ("model_version",),
        ("sentiment", "model_version"),
    ]
    grouped = (
        _group_by_sets(_never_empty(_centred(by_keys, additive, centres)), keys, sets)
        .agg(
            F.grouping_id().alias("_set"),
            *_merges(additive),
            *_aggregates({name: f"{name[-3:]}({name})" for name in extremes}),
        )
        .transform(_known_groups, keys)
        .crossJoin(F.broadcast(totals))
        .crossJoin(F.broadcast(quartiles))
    )

    mean_confidence = _round(_mean("conf"))
    mean_length, length_stddev = _round(_mean("length"), COARSE), _round(_stddev("length"), COARSE)
    count = {"count": "rows"}
    sections = [
        ("metadata", (), {"total_records": "rows"}),
        (
            "sentiment_distribution",
            ("sentiment",),
            {**count, "percentage": _round("rows * 100.0D / _everything", COARSE)},
        ),
    ]
    missing = []
    if has_conf:
        described = {
            "average": mean_confidence,
            "minimum": _round("conf_min"),
            "maximum": _round("conf_max"),
            "std_deviation": _round(_stddev("conf")),
            "median": "median",
            "q1": "q1",
            "q3": "q3",
        }
        by_label = {"average_confidence": mean_confidence, "sample_size": "rows"}
        group = "confidence_analysis"
        sections.append(("confidence_statistics", (), described, group))
        sections.append(
            ("confidence_range_distribution", ("sentiment", "confidence_range"), count, group)
        )
        sections.append(("average_confidence_by_sentiment", ("sentiment",), by_label, group))
    else:
        missing.append(("confidence_analysis", "no numbers in confidence"))
    if has_length:
        lengths = {
            "average": mean_length,
            "minimum": "length_min",
            "maximum": "length_max",
            "std_deviation": length_stddev,
        }
        sections.append(("text_length_statistics", (), lengths, "text_analysis"))
    if has_words:
        by_label = {
            "avg_text_length": mean_length,
            "avg_word_count": _round(_mean("words"), COARSE),
            "min_text_length": "length_min",
            "max_text_length": "length_max",
            "stddev_text_length": length_stddev,
        }
        correlations = {
            "text_length_confidence": _round(_correlation("lc_conf", "lc_length", "lc_cross")),
            "word_count_confidence": _round(_correlation("wc_conf", "wc_words", "wc_cross")),
        }
        sections.append(("length_by_sentiment", ("sentiment",), by_label, "text_analysis"))
        sections.append(("correlations", (), correlations, "text_analysis"))
    else:
        missing.append(("text_analysis", "text_length or word_count not found"))
    if has_time:
        hourly, daily = ("sentiment", "hour"), ("sentiment", "day_of_week")
        sections.append(("hourly_sentiment_distribution", hourly, count, "temporal_analysis"))
        sections.append(("daily_sentiment_distribution", daily, count, "temporal_analysis"))
    else:
        missing.append(("temporal_analysis", f"{time_col} not found"))
    if has_model:
        usage = {
            "usage_count": "rows",
            "average_confidence": mean_confidence,
            "confidence_stddev": _round(_or_zero(_stddev("conf"))),
        }
        performance = {**count, "avg_confidence": mean_confidence}
        by_model = ("sentiment", "model_version")
        sections.append(("model_usage_statistics", ("model_version",), usage, "model_performance"))
        sections.append(("model_sentiment_performance", by_model, performance, "model_performance"))
    else:
        missing.append(("model_performance", "model_version not found"))
    lost = {section for section, _ in missing}
    failures = [
        (group, condition, note)
        for group, condition, note in (
            ("confidence_analysis", "_conf_unread > 0", "confidence holds no number in some rows"),
            (
                "text_analysis",
                "_text_unread + _conf_unread > 0",
                "text_length, word_count or confidence holds no number in some rows",
            ),
            ("temporal_analysis", "_time_unread > 0", "the time holds no timestamp in some rows"),
            ("model_performance", "_conf_unread > 0", "confidence holds no number in some rows"),
        )
        if group not in lost
    ]

    known = [
        ("metadata", name, None, "data_column", float(i), None)
        for i, name in enumerate(df.columns)
    ] + [(section, None, None, "error", None, note) for section, note in missing]
    report = _report_rows(grouped, keys, sections, failures).unionByName(
        df.sparkSession.createDataFrame(known, NOTE_SCHEMA)
    )
    if not clusters:
        return report
    by_scores = stored.filter(F.col("_kind") == _set_number(all_keys, ("sentiment", *score_keys)))
    return report.unionByName(_cluster_section(by_scores, list(scores), clusters))


def _cluster_section(by_scores: DataFrame, features, k: int) -> DataFrame:
    """Rows by cluster of the scores and sentiment, from the profile's rows by scores; an
    error row where nothing can be clustered, whatever the cause."""
    try:
        available_features(by_scores.withColumnsRenamed({f"_score_{n}": n for n in features}), features)
        profile = by_scores.select(
            "sentiment", "rows", *[F.col(f"_score_{name}").alias(name) for name in features]
        )
        if not by_scores.filter("_scores_unread > 0").isEmpty():
            raise ValueError("some scores are no numbers")
        counts = fit_profile(profile.dropna(subset=features), features, k).counts()
    except (ValueError, PySparkException) as error:
        rows = [("cluster_sentiment", None, None, "error", None, str(error))]
        return by_scores.sparkSession.createDataFrame(rows, NOTE_SCHEMA)
    return counts.select(
        F.lit("cluster_sentiment").alias("section"),
        F.col("cluster").cast("string").alias("key1"),
        F.col("sentiment").alias("key2"),
        F.lit("count").alias("metric"),
        F.col("count").cast("double").alias("value"),
        F.lit(None).cast("string").alias("note"),
    )


def _summed_report(df: DataFrame, keys, sets, additive: dict, extremes: dict, sections):
    """A report from one pass: reduce to the keys' combinations, then to each set."""
    profile = df.groupBy(*keys).agg(*_aggregates({**additive, **extremes}))
    names = profile.columns[: len(keys)]
    grouped = _group_by_sets(_never_empty(_centred(profile, additive)), names, sets).agg(
        F.grouping_id().alias("_set"),
        *_merges(additive),
        *_aggregates({name: f"{name[-3:]}({name})" for name in extremes}),
    )
    return _report_rows(_known_groups(grouped, names), names, sections)


def dashboard(df: DataFrame, time_col: str = "created_utc") -> DataFrame:
    """Totals, label counts, confidence histogram and hourly trend, in one pass."""
    keys = ["sentiment", M.confidence_bucket("confidence").alias("bucket")]
    sets = [(), ("sentiment",), ("bucket",)]
    totals = {"total_comments": "rows", "average_confidence": _round(_or_zero(_mean("confidence")))}
    count = {"count": "rows"}
    sections = [
        ("summary_metrics", (), totals),
        ("sentiment_distribution", ("sentiment",), count),
        ("confidence_histogram", ("bucket",), count),
    ]
    if time_col in df.columns:
        keys.append(M.time_parts(time_col)["hour"].alias("hour"))
        sets.append(("sentiment", "hour"))
        sections.append(("hourly_trends", ("sentiment", "hour"), count))
    additive = {"rows": "count(1)", **_sums("confidence")}
    return _summed_report(df, keys, sets, additive, {}, sections)


def sentiment_summary(df: DataFrame) -> DataFrame:
    """Counts by label and model, confidence described, mean lengths by label, total."""
    names = ("confidence", "text_length", "word_count")
    additive = {"rows": "count(1)"}
    for name in names:
        additive.update(_sums(name))
    described = {
        "count": "coalesce(confidence_n, 0)",
        "mean": _round(_mean("confidence")),
        "stddev": _round(_stddev("confidence")),
        "min": "confidence_min",
        "max": "confidence_max",
    }
    lengths = {
        "avg_text_length": _round(_mean("text_length"), COARSE),
        "avg_word_count": _round(_mean("word_count"), COARSE),
    }
    count = {"count": "rows"}
    sections = [
        ("total_processed", (), count),
        ("sentiment_distribution", ("sentiment",), count),
        ("confidence_statistics", (), described),
        ("model_usage", ("model_version",), count),
        ("length_sentiment_correlation", ("sentiment",), lengths),
    ]
    return _summed_report(
        df,
        ("sentiment", "model_version"),
        [(), ("sentiment",), ("model_version",)],
        additive,
        {"confidence_min": "min(confidence)", "confidence_max": "max(confidence)"},
        sections,
    )


def results_analysis(df: DataFrame, example=None) -> DataFrame:
    """Report of the integrated run: label counts, mean confidences, text statistics
    and the three most confident examples of Positive and Negative.

    The statistics come from one pass. The examples come from a second one,
    as they need whole rows, of which each task keeps three per label.
    """
    additive = {"rows": "count(1)"}
    for name in ("confidence_score", "comment_length", "word_count", "score"):
        additive.update(_sums(name))
    statistics = {
        "avg_length": _round(_or_zero(_mean("comment_length"))),
        "std_length": _round(_or_zero(_stddev("comment_length"))),
        "avg_words": _round(_or_zero(_mean("word_count"))),
        "avg_score": _round(_or_zero(_mean("score"))),
    }
    label = ("sentiment_label",)
    sections = [
        ("pipeline_metadata", (), {"total_comments": "rows"}),
        ("sentiment_distribution", label, {"count": "rows"}),
        ("average_confidence", label, {"mean": _round(_mean("confidence_score"))}),
        ("text_statistics", (), statistics),
    ]
    examples = top_examples(df, example=example).select(
        F.lit("top_examples").alias("section"),
        F.col("sentiment_label").alias("key1"),
        F.col("rank").cast("string").alias("key2"),
        F.lit("confidence").alias("metric"),
        F.col("confidence_score").alias("value"),
        F.col("text").alias("note"),
    )
    return _summed_report(df, label, [(), label], additive, {}, sections).unionByName(examples)
