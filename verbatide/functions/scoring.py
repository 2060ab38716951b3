"""Column expressions that turn word counts, logits and percentages into labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from verbatide.functions import lexicons
from verbatide.functions.text import as_column


def keyword_hits(lowered_text: str, words) -> Column:
    """How many of ``words`` occur as substrings of a column; each counts at most once."""
    tests = [
        "cast(contains({}, '{}') as int)".format(lowered_text, word.replace("'", "\\'"))
        for word in words
    ]
    return F.expr(" + ".join(tests) or "0")


def result_struct(sentiment, confidence, positive, negative, neutral, model) -> Column:
    return F.struct(
        sentiment.alias("sentiment"),
        confidence.cast("double").alias("confidence"),
        positive.cast("double").alias("positive_prob"),
        negative.cast("double").alias("negative_prob"),
        neutral.cast("double").alias("neutral_prob"),
        model.alias("model_version"),
    )


def unknown_result(model: str = lexicons.FALLBACK_MODEL) -> Column:
    return result_struct(
        F.lit(lexicons.UNKNOWN_SENTIMENT),
        F.lit(lexicons.UNKNOWN_CONFIDENCE),
        F.lit(lexicons.UNKNOWN_POSITIVE),
        F.lit(lexicons.UNKNOWN_NEGATIVE),
        F.lit(lexicons.UNKNOWN_NEUTRAL),
        F.lit(model),
    )


def keyword_result(balance, model: str = lexicons.KEYWORD_MODEL) -> Column:
    """Result of the keyword scorer from ``positive hits - negative hits``.

    A winner gets 0.6 plus 0.1 per word ahead, at most 0.9; a tie is neutral
    at 0.5. The other polar side gets half of the rest.
    """
    balance = as_column(balance)
    sentiment = (
        F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")
    )
    confidence = F.when(
        balance != 0, F.least(F.lit(0.6) + F.abs(balance) * F.lit(0.1), F.lit(0.9))
    ).otherwise(F.lit(0.5))
    rest = F.lit(1.0) - confidence
    return result_struct(
        sentiment,
        confidence,
        F.when(balance > 0, confidence).otherwise(rest / 2),
        F.when(balance < 0, confidence).otherwise(rest / 2),
        F.when(balance == 0, confidence).otherwise(rest),
        F.lit(model),
    )


def rule_label(tally, has_question, is_long) -> Column:
    """Label of the rule scorer. ``tally`` is positive - negative - negation / 2.

    ``is_long`` (more than 50 words) matters only where neither words nor
    question cues decide.
    """
    tally = as_column(tally)
    return (
        F.when(tally > 0.5, "Positive")
        .when(tally < -0.5, "Negative")
        .when(as_column(has_question), "Neutral")
        .when(as_column(is_long), "Negative")
        .otherwise("Positive")
    )


def rule_confidence(tally, has_question, is_long) -> Column:
    """Percentage that goes with :func:`rule_label`."""
    tally = as_column(tally)
    decided = F.least(F.lit(65.0) + F.abs(tally) * F.lit(8.0), F.lit(92.0))
    return (
        F.when(F.abs(tally) > 0.5, decided)
        .when(as_column(has_question), F.lit(55.0))
        .when(as_column(is_long), F.lit(58.0))
        .otherwise(F.lit(62.0))
    )


def expand_probabilities(label, percent, model: str = lexicons.CLASSIFIER_MODEL) -> Column:
    """Full result from a two-class (label, percentage) pair; neutral is constant 0.1."""
    sentiment = F.lower(as_column(label))
    percent = as_column(percent).cast("double")
    confidence = percent / F.lit(100.0)
    other = (F.lit(100.0) - percent) / F.lit(100.0)
    return result_struct(
        sentiment,
        confidence,
        F.when(sentiment == "positive", confidence).otherwise(other),
        F.when(sentiment == "negative", confidence).otherwise(other),
        F.lit(0.1),
        F.lit(model),
    )


def sigmoid(logit) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_column(logit)))


def logit_label(logit) -> Column:
    return F.when(sigmoid(logit) > 0.5, "Positive").otherwise("Negative")


def logit_percent(logit) -> Column:
    """Whole per cent for the chosen label, cut off rather than rounded."""
    percent = sigmoid(logit) * F.lit(100.0)
    return F.when(sigmoid(logit) > 0.5, percent).otherwise(F.lit(100.0) - percent).cast("int")


def softmax_label(negative_logit, positive_logit) -> Column:
    return F.when(
        as_column(positive_logit) > as_column(negative_logit), "Positive"
    ).otherwise("Negative")


def softmax_percent(negative_logit, positive_logit) -> Column:
    """100 times the larger of two softmax probabilities, safe for large logits."""
    gap = F.abs(as_column(positive_logit) - as_column(negative_logit))
    return F.lit(100.0) / (F.lit(1.0) + F.exp(-gap))


def bce_with_logits(logit, label) -> Column:
    """Binary cross-entropy of one row, in the form that cannot overflow."""
    logit, label = as_column(logit), as_column(label).cast("double")
    return (
        F.greatest(logit, F.lit(0.0))
        - logit * label
        + F.log1p(F.exp(-F.abs(logit)))
    )


def logit_correct(logit, label) -> Column:
    """1 where thresholding the probability at one half gives the label, else 0."""
    predicted = (sigmoid(logit) > 0.5).cast("int")
    return (predicted == as_column(label).cast("int")).cast("int")
