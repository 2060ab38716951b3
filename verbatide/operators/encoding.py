"""Fixed-length token ids over a vocabulary counted from the texts themselves."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.functions.text import as_column
from verbatide.operators.once import with_columns_once
from verbatide.operators.ordering import with_row_index

# Ids of the special tokens; words follow.
PAD, UNKNOWN, CLASSIFY, SEPARATOR = 0, 1, 2, 3
FIRST_WORD_ID = 4

# A word (letters and digits) or one sign.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"

# Ids are ints, so place and id of a token share a long.
_ID_BITS = 32

# The vocabulary's head is broadcast. These two bounds make its size certain:
# at most 50,000 keys of at most 65 characters.
HEAD_TOKENS = 50_000
HEAD_KEY_LENGTH = 64


def tokens(text) -> Column:
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(TOKEN), F.lit(0))


def build_vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """(token, count, token_id): most frequent first, then by token.

    Frequent tokens are combined before the shuffle, so none is hot.
    """
    counted = (
        df.select(F.explode(tokens(text)).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("count"))
    )
    return with_row_index(
        counted, [F.desc("count"), F.asc("token")], "token_id", start=FIRST_WORD_ID
    )


def _head_key(token) -> Column:
    """The token, or a digest of a long one. A sign is a token of its own, so no
    token starts with # and goes on."""
    token = as_column(token)
    digest = F.concat(F.lit("#"), F.sha2(token, 256))
    return F.when(F.length(token) > HEAD_KEY_LENGTH, digest).otherwise(token)


def encode_tokens(
    df: DataFrame, vocabulary: DataFrame, maxlen: int, key: str = "id", text: str = "text"
) -> DataFrame:
    """input_ids and attention_mask of length maxlen for each (unique) key.

    A text's tokens are cut to what fits, and (key, position, token) rows are shuffled
    by key once; all that follows starts from that exchange. Head tokens, the frequent
    ones, are looked up in a broadcast table of bounded size. The others go through a
    shuffle join by token, in one row for each key and token; adaptive execution splits
    a token outside the vocabulary that many keys share. Such tokens are UNKNOWN.
    """
    room = maxlen - 2
    placed = df.select(
        key, F.posexplode_outer(F.slice(tokens(text), 1, room)).alias("_pos", "token")
    ).repartition(key)
    in_head = F.col("token_id") < FIRST_WORD_ID + HEAD_TOKENS
    head = vocabulary.filter(in_head).select(_head_key("token").alias("_key"), "token_id")
    every = (
        placed.withColumn("_key", _head_key("token"))
        .join(F.broadcast(head), "_key", "left")
        .drop("_key")
    )
    # Once: a condition on token that moved below the exchange would make it two.
    every = every.transform(
        with_columns_once, {"_settled": F.col("token_id").isNotNull() | F.col("token").isNull()}
    )
    tail = vocabulary.filter(~in_head).select("token", "token_id")
    rare = (
        every.filter(~F.col("_settled"))
        .groupBy(key, "token")
        .agg(F.collect_list("_pos").alias("_places"))
        .join(tail, "token", "left")
        .select(key, F.explode("_places").alias("_pos"), "token", "token_id")
    )
    every = every.filter("_settled").select(key, "_pos", "token", "token_id").unionByName(rare)
    every = every.withColumn("token_id", F.coalesce("token_id", F.lit(UNKNOWN)))

    # At most maxlen - 2 entries per key, each one long: the place above, the id below.
    entry = F.shiftleft(F.col("_pos").cast("long"), _ID_BITS).bitwiseOR(F.col("token_id").cast("long"))
    in_order = F.sort_array(F.collect_list(F.when(F.col("token").isNotNull(), entry)))
    body = F.transform(in_order, lambda e: e.bitwiseAND((1 << _ID_BITS) - 1).cast("int"))
    unpadded = F.concat(F.array(F.lit(CLASSIFY)), F.col("_body"), F.array(F.lit(SEPARATOR)))
    return (
        every.groupBy(key)
        .agg(body.alias("_body"))
        .withColumn(
            "input_ids",
            F.concat(unpadded, F.array_repeat(F.lit(PAD), F.lit(room) - F.size("_body"))),
        )
        .select(
            key,
            "input_ids",
            F.transform("input_ids", lambda i: (i != PAD).cast("int")).alias("attention_mask"),
        )
    )
