"""Cleaning and filtering before scoring. No operator here triggers a job,
so all of them work on streams as well."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions import text as T
from verbatide.operators.once import with_columns_once


def filter_min_size(
    df: DataFrame, min_words: int = 2, min_length: int = 10, max_length: int | None = None
) -> DataFrame:
    """Keep texts of enough words and characters, optionally of at most max_length."""
    kept = df.filter(F.col("text_length") >= min_length)
    if max_length is not None:
        kept = kept.filter(F.col("text_length") <= max_length)
    return kept.filter(F.col("word_count") >= min_words)


def clean_text(df: DataFrame, text: str = "text", out: str = "text_cleaned") -> DataFrame:
    """Without links, then mentions and tags, then all that is no letter, digit or space.

    Steps are columns of their own, since each step looks at its input twice.
    """
    return (
        df.withColumn("_unlinked", T.without_links(text))
        .withColumn("_unmentioned", T.without_mentions("_unlinked"))
        .transform(with_columns_once, {out: T.only_alphanumeric("_unmentioned")})
        .drop("_unlinked", "_unmentioned")
    )


def clean_comments(df: DataFrame) -> DataFrame:
    """text_cleaned, word_count over it, and text_length of the raw text."""
    return df.transform(clean_text).withColumns(
        {
            "word_count": T.space_separated_count("text_cleaned"),
            "text_length": F.col("comment_length"),
        }
    )


def preprocess_text(df: DataFrame, **limits) -> DataFrame:
    return df.transform(clean_comments).transform(filter_min_size, **limits)


def filter_non_empty(df: DataFrame) -> DataFrame:
    return df.filter(F.col("text") != "")


def filter_markers_exact(df: DataFrame) -> DataFrame:
    """Drop null, empty, and texts that *are* a marker (not those containing one)."""
    return df.filter(
        F.col("text").isNotNull()
        & ~F.col("text").isin("", T.DELETED_MARKER, T.REMOVED_MARKER)
    )


def add_features(df: DataFrame, right_closed: bool = False) -> DataFrame:
    """Length category (either definition) and engagement score."""
    category = T.length_category_cut if right_closed else T.length_category
    return df.withColumns(
        {
            "text_length_category": category("comment_length"),
            "engagement_score": T.engagement_score("score", "word_count"),
        }
    )


def preprocess_enriched(df: DataFrame, right_closed: bool = False) -> DataFrame:
    return df.transform(filter_markers_exact).transform(add_features, right_closed)


def filter_label(df: DataFrame, label: str, column: str = "sentiment") -> DataFrame:
    return df.filter(F.col(column) == label)


def filter_confidence(
    df: DataFrame, threshold: float = 0.5, column: str = "confidence"
) -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def project_available(df: DataFrame, wanted) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def sample_rows(df: DataFrame, n: int, columns, order_by: str = "id") -> DataFrame:
    """The first n rows by a stable key."""
    return df.select(*columns).orderBy(order_by).limit(n)
