"""Declared schemas, so that no reader has to infer one from the data.

Fixed values: the names, types and order of the fields, as the files have them.
"""

from pyspark.sql import types as T

# One raw comment as it lies in a JSON lines file.
RAW_COMMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("created_utc", T.TimestampType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("processing_timestamp", T.TimestampType()),
        T.StructField("comment_length", T.IntegerType()),
        T.StructField("is_valid", T.StringType()),
    ]
)

# A comment with derived features; created_utc is epoch seconds here.
ENRICHED_COMMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.IntegerType()),
        T.StructField("created_utc", T.DoubleType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("post_id", T.StringType()),
        T.StructField("extraction_timestamp", T.StringType()),
        T.StructField("comment_length", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("contains_url", T.BooleanType()),
        T.StructField("is_question", T.BooleanType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
    ]
)

# What a scorer returns for one text.
SENTIMENT_RESULT = T.StructType(
    [
        T.StructField("sentiment", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("positive_prob", T.DoubleType()),
        T.StructField("negative_prob", T.DoubleType()),
        T.StructField("neutral_prob", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)

# A scored comment at rest, stored partitioned by sentiment.
SENTIMENT_RECORD = T.StructType(
    [T.StructField("text", T.StringType())]
    + SENTIMENT_RESULT.fields[:5]
    + [
        T.StructField("processing_timestamp", T.TimestampType()),
        SENTIMENT_RESULT["model_version"],
        T.StructField("text_length", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
    ]
)

# A labelled training sentence (tab separated, with a header line).
LABELLED_SENTENCE = T.StructType(
    [
        T.StructField("sentence", T.StringType()),
        T.StructField("label", T.IntegerType()),
    ]
)

# One comment taken out of a nested thread document. Scores and depths are
# JSON numbers, hence doubles.
THREAD_COMMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("depth", T.DoubleType()),
    ]
)
