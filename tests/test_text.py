"""Golden rows of the text rules, and the rules against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from verbatide.functions import text as T
from verbatide.operators import encoding as E
from verbatide.operators import ingest as I
from verbatide.operators import preprocess as P


def column_of(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in rows.select("i", build("x").alias("y")).orderBy("i").collect()]


def test_normalize(spark):
    texts = [None, "", "  ", "a\r\n\tb", "\tx y\n"]
    assert column_of(spark, texts, T.normalize_text) == [None, None, "", "a b", "x y"]


def test_validity(spark):
    texts = [None, "ok", "see [removed] note", "fine", "[deleted]", "abc"]
    assert column_of(spark, texts, T.validity_flag) == [
        "invalid", "invalid", "invalid", "valid", "invalid", "valid",
    ]


TEXTS = [
    "Hi @bob, it's https://x.y/z #a",
    "",
    "wwwhat #tag@me http",
    "été  naïve x y",
    " lead and  trail ",
    "a\tb\x0bc\n\nd",
    "plain words, only: (punctuation)!",
    "@a#b http://@c #http",
]


def python_clean(text):
    for pattern in (r"http\S+|www\S+", r"@\w+|#\w+", r"[^a-zA-Z0-9\s]"):
        text = re.sub(pattern, "", text, flags=re.ASCII)
    return re.sub(r"\s+", " ", text, flags=re.ASCII)


def test_clean(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    cleaned = rows.transform(P.clean_text).orderBy("i").collect()
    assert [row.text_cleaned for row in cleaned] == [python_clean(t) for t in TEXTS]
    assert cleaned[0].text_cleaned == "Hi its "


def test_characters_are_looked_up_before_the_class_is_tried(spark):
    """What the table lets by is just what the class drops, and both are in the plan."""
    texts = [f"a{chr(i)}z" for i in range(1, 1500)] + ["\u3000\u200b\U0001F600 k", None]
    assert column_of(spark, texts, T.only_alphanumeric) == [
        t and re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z0-9\s]", "", t, flags=re.ASCII), flags=re.ASCII)
        for t in texts
    ]
    rows = spark.createDataFrame([("a",)], "text string").select(T.only_alphanumeric("text"))
    assert "(?=[^abcdefghij" in plan(rows)


def test_space_separated_count(spark):
    texts = ["Hi its ", "", " ", "a b", None]
    counts = column_of(spark, texts, T.space_separated_count)
    assert counts == [len(t.split(" ")) if t is not None else None for t in texts]


def test_word_count_splits_as_python_does(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    texts = [*TEXTS, *[f"a{c}b" for c in spaces], "a​b", "a\x00b", "\U0001f600 x", spaces]
    assert column_of(spark, texts, T.word_count) == [len(t.split()) for t in texts]
    blank = [None, "", "  ", spaces, "x"]
    assert column_of(spark, blank, T.is_blank) == [True, True, True, True, False]


@pytest.mark.parametrize(
    "rule, lengths, expected",
    [
        (T.length_category, [None, 49, 50, 199, 200], ["long", "short", "medium", "medium", "long"]),
        (
            T.length_category_cut,
            [None, 0, 50, 51, 200, 201],
            [None, None, "short", "medium", "medium", "long"],
        ),
    ],
)
def test_length_categories(spark, rule, lengths, expected):
    assert column_of(spark, lengths, rule, "int") == expected


def test_number_or_default(spark):
    assert column_of(spark, ["1.5", "x", None, "7"], T.number_or_default) == [1.5, 50.0, 50.0, 7.0]


def test_truncate(spark):
    texts = ["x" * 100, "y" * 101]
    assert column_of(spark, texts, T.truncate_example) == ["x" * 100, "y" * 100 + "..."]


def test_exact_marker_filter_keeps_embedded_markers(spark):
    texts = [None, "", "[deleted]", "[removed]", "see [removed] note"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    kept = rows.transform(P.filter_markers_exact).collect()
    assert [row.text for row in kept] == ["see [removed] note"]


def test_size_filter(spark):
    rows = spark.createDataFrame(
        [("one", 20), ("two words", 9), ("two words", 10), ("two words", 300)],
        "text string, comment_length int",
    )
    assert rows.transform(P.preprocess_text).count() == 2
    assert rows.transform(P.preprocess_text, max_length=100).count() == 1


def test_record_ids_are_unique(spark):
    rows = spark.range(1000).repartition(7).select(F.lit("x").alias("text"))
    ids = rows.transform(I.add_metadata, "2024-01-01").agg(F.count_distinct("record_id")).first()
    assert ids[0] == 1000


def test_default_columns_fill_only_gaps(spark):
    rows = spark.createDataFrame([("1", None, 5), ("2", "why?", None)], "id string, text string, score int")
    first, second = rows.transform(I.default_columns, run_ts="2024-01-01").orderBy("id").collect()
    assert (first.text, first.score, first.author, first.word_count) == ("", 5, "unknown", 0)
    assert (second.score, second.is_question, second.sentiment_label) == (1, True, None)


def test_places_and_ids_travel_as_one_number(spark):
    """Gathered by key, a token is a long, not a row of its own; order and ids stay."""
    rows = spark.createDataFrame([(1, "b a b c"), (2, None), (3, "zz b")], "id int, text string")
    known = spark.createDataFrame([("b", 4), ("a", 5), ("c", 50_010)], "token string, token_id int")
    encoded = E.encode_tokens(rows, known, 6)
    assert "_pos, _pos" not in plan(encoded) and "named_struct" not in plan(encoded)
    assert {r.id: r.input_ids for r in encoded.collect()} == {
        1: [2, 4, 5, 4, 50_010, 3], 2: [2, 3, 0, 0, 0, 0], 3: [2, 1, 4, 3, 0, 0],
    }
