"""Scorers. Lexicon scoring is native column work: no Python worker takes part.

Each scorer first puts its word counts into columns of their own and only then
derives label and probabilities from them, so that the substring tests of a
row run once however many results are derived from them.
"""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions import lexicons
from verbatide.functions import scoring as S
from verbatide.functions import text as T
from verbatide.operators.ingest import run_timestamp
from verbatide.operators.once import with_columns_once
from verbatide.schemas import SENTIMENT_RESULT


def keyword_struct(
    df: DataFrame,
    text_col: str = "text_cleaned",
    out: str = "sentiment_result",
    lexicon: lexicons.Lexicon = lexicons.KEYWORDS,
    model: str = lexicons.KEYWORD_MODEL,
    blank_as_unknown: bool = False,
) -> DataFrame:
    """Keyword scorer; its result goes into one struct column.

    With ``blank_as_unknown``, texts that are null or blank get the unknown
    result instead of a neutral one.
    """
    result = S.keyword_result("_balance", model)
    if blank_as_unknown:
        result = F.when(
            F.col("_blank"), S.unknown_result(lexicons.EMPTY_MODEL)
        ).otherwise(result)
    return (
        df.withColumn("_lowered", F.lower(F.coalesce(F.col(text_col), F.lit(""))))
        .withColumns(
            {
                "_balance": S.keyword_hits("_lowered", lexicon.positive)
                - S.keyword_hits("_lowered", lexicon.negative),
                "_blank": T.is_blank("_lowered"),
            }
        )
        .transform(with_columns_once, {out: result})
        .drop("_lowered", "_balance", "_blank")
    )


def flatten_struct(df: DataFrame, column: str = "sentiment_result") -> DataFrame:
    """The struct's fields as columns of their own, replacing any of the same name."""
    fields = df.schema[column].dataType.fieldNames()
    return df.withColumns({name: F.col(column)[name] for name in fields}).drop(column)


def score_keywords(df: DataFrame, text_col: str = "text_cleaned", **options) -> DataFrame:
    return df.transform(keyword_struct, text_col, **options).transform(flatten_struct)


def score_comments(df: DataFrame, text_col: str = "text_cleaned", run_ts=None) -> DataFrame:
    """The staged run's scorer: blank texts unknown, others by keyword, time stamped."""
    return (
        df.transform(keyword_struct, text_col, blank_as_unknown=True)
        .transform(flatten_struct)
        .withColumn("processing_timestamp", run_timestamp(run_ts))
    )


def classifier_scorer(score, default: tuple | None = None, run_ts=None):
    """A scorer for runs and streams: ``score`` (a frame and the name of its result
    column, to a frame) where it has a result, by keyword elsewhere, else the default.
    """

    def scorer(df: DataFrame, text_col: str = "text_cleaned") -> DataFrame:
        return (
            score(df, "_model")
            .transform(keyword_struct, text_col, out="_lexicon", blank_as_unknown=True)
            .transform(fallback_cascade, ["_model", "_lexicon"], default=default)
            .transform(flatten_struct)
            .withColumn("processing_timestamp", run_timestamp(run_ts))
        )

    return scorer


def score_rules(
    df: DataFrame,
    text_col: str = "text",
    label_col: str = "sentiment_label",
    confidence_col: str = "confidence_score",
    lexicon: lexicons.Lexicon = lexicons.RULES,
) -> DataFrame:
    """Rule scorer: words, negation cues, then question cues and length for the rest."""
    evidence = ("_tally", "_question", "_long")
    undecided = (F.abs("_tally") <= 0.5) & ~F.col("_question")
    return (
        df.withColumn("_lowered", F.lower(F.coalesce(F.col(text_col), F.lit(""))))
        .withColumns(
            {
                "_tally": S.keyword_hits("_lowered", lexicon.positive)
                - S.keyword_hits("_lowered", lexicon.negative)
                - S.keyword_hits("_lowered", lexicon.negation) * F.lit(0.5),
                "_question": S.keyword_hits("_lowered", lexicon.question) > 0,
            }
        )
        # Words are counted only where nothing else decides.
        .withColumn("_long", F.when(undecided, T.word_count("_lowered") > 50))
        .transform(
            with_columns_once,
            {
                label_col: S.rule_label(*evidence),
                confidence_col: S.rule_confidence(*evidence),
            },
        )
        .drop("_lowered", *evidence)
    )


def rule_struct(df: DataFrame, text_col: str = "text", out: str = "sentiment_result") -> DataFrame:
    """Rule scorer in the common result shape (confidence as a share)."""
    return (
        df.transform(score_rules, text_col, "_label", "_percent")
        .withColumn(out, S.expand_probabilities("_label", "_percent", lexicons.RULE_MODEL))
        .drop("_label", "_percent")
    )


def score_batches(
    df: DataFrame,
    load_scorer: Callable[[], Callable],
    text_col: str = "text",
    out: str = "sentiment_result",
    model: str = lexicons.CLASSIFIER_MODEL,
) -> DataFrame:
    """Score by a Python model, one Arrow batch at a time.

    ``load_scorer`` runs once per task and returns a function from a list of
    texts to a list of (label, percentage) pairs, None where a text failed.
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` sets the batch size. Null texts
    do not reach the model. Rows without a result get a null struct, for
    :func:`fallback_cascade` to fill.
    """
    import pandas as pd

    # The function below travels to the workers by value, with nothing in it
    # that needs this package there.
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        score = load_scorer()

        def results(texts):
            """A failed batch is halved, until only the texts at fault have none."""
            if not texts:
                return []
            try:
                return list(score(texts))
            except Exception:
                if len(texts) == 1:
                    return [None]
                half = len(texts) // 2
                return results(texts[:half]) + results(texts[half:])

        for texts in batches:
            known = texts.notna()
            found = iter(results(texts[known].tolist()))
            pairs = [next(found) if there else None for there in known]
            yield pd.DataFrame(
                {
                    "label": [pair and pair[0] for pair in pairs],
                    "percent": [None if pair is None else float(pair[1]) for pair in pairs],
                }
            )

    score_udf = F.pandas_udf(scored, "label string, percent double")
    return (
        df.withColumn("_pair", score_udf(F.col(text_col)))
        .withColumn(
            out,
            F.when(
                F.col("_pair.label").isNotNull(),
                S.expand_probabilities("_pair.label", "_pair.percent", model),
            ),
        )
        .drop("_pair")
    )


def fallback_cascade(
    df: DataFrame, candidates, out: str = "sentiment_result", default: tuple | None = None
) -> DataFrame:
    """The first non-null result of several scorers, else the unknown result, or that of
    a ``default`` (label, percentage, model)."""
    if default is None:
        last = S.unknown_result()
    else:
        label, percent, model = default
        last = S.expand_probabilities(F.lit(label), F.lit(percent), model)
    chosen = F.coalesce(*[F.col(name) for name in candidates], last)
    dropped = [name for name in candidates if name != out]
    return df.withColumn(out, chosen.cast(SENTIMENT_RESULT)).drop(*dropped)


def attach_predictions(
    comments: DataFrame,
    predictions: DataFrame,
    key: str = "id",
    placeholders=("sentiment_label", "confidence_score"),
) -> DataFrame:
    """Left join of separately made predictions; comments without one keep nulls.

    Placeholder columns of the comments go first, so names stay unambiguous.
    Predictions are reduced to one row per key (the largest confidence, then
    the largest label), with partial aggregation, so that repeated keys cannot
    multiply comments. What remains skewed is the comments' side, which
    adaptive execution splits in a left join. If ``save_bucketed`` stored both sides by
    the key, neither is shuffled.
    """
    label, confidence = placeholders
    best = (
        predictions.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(confidence, label)).alias("_best"))
        .select(key, F.col(f"_best.{label}"), F.col(f"_best.{confidence}"))
    )
    return comments.drop(*placeholders).join(best, key, "left")
