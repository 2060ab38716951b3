"""Column expressions on comment text. All of them stay in the JVM."""

from functools import reduce
from operator import or_
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers that stand in for withdrawn comments.
DELETED_MARKER = "[deleted]"
REMOVED_MARKER = "[removed]"

# Fixed value: every character but those that str.split() without arguments
# splits on. Stated by what it contains, most frequent first: matching stops at
# the first range that holds.
NON_SPACE = (
    r"[!-~\x{A1}-\x{167F}\x{0}-\x{8}\x{E}-\x{1B}\x{7F}-\x{84}\x{86}-\x{9F}\x{1681}-\x{1FFF}"
    r"\x{200B}-\x{2027}\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]"
)

# What clean_text removes, in this order, and the texts without
# which there is nothing to remove.
URL = r"http\S+|www\S+"
URL_STARTS = ("http", "www")
MENTION_OR_TAG = r"@\w+|#\w+"
MENTION_OR_TAG_STARTS = ("@", "#")
NOT_ALPHANUMERIC = r"[^a-zA-Z0-9\s]"

# The same, for speed: characters stated one by one are looked up in a table, while ranges
# and \s are tried in turn, so only what is not in the table is put to them.
NOT_IN_TABLE = f"(?=[^{ascii_letters}{digits} " + r"\t\n\x0B\f\r])"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def normalize_text(text) -> Column:
    """Null and empty stay null; runs of line breaks and tabs become one space."""
    text = as_column(text)
    return F.when(
        text != "", F.trim(F.regexp_replace(text, r"[\r\n\t]+", " "))
    )


def validity_flag(text) -> Column:
    """``invalid`` for null, fewer than 3 characters, or a marker anywhere inside."""
    text = as_column(text)
    usable = (
        (F.length(text) >= 3)
        & ~text.contains(DELETED_MARKER)
        & ~text.contains(REMOVED_MARKER)
    )
    return F.when(usable, "valid").otherwise("invalid")


def remove_where_found(text, pattern: str, starts) -> Column:
    """Remove a pattern, running it only on texts that hold one of its beginnings."""
    text = as_column(text)
    found = reduce(or_, [text.contains(start) for start in starts])
    return F.when(found, F.regexp_replace(text, pattern, "")).otherwise(text)


def without_links(text) -> Column:
    return remove_where_found(text, URL, URL_STARTS)


def without_mentions(text) -> Column:
    return remove_where_found(text, MENTION_OR_TAG, MENTION_OR_TAG_STARTS)


def only_alphanumeric(text) -> Column:
    """Drop what is no ASCII letter, digit or white space; collapse white space.

    Neither trimmed nor lower-cased; letters outside a-z vanish.
    """
    kept = F.regexp_replace(as_column(text), NOT_IN_TABLE + NOT_ALPHANUMERIC, "")
    return F.regexp_replace(kept, r"\s+", " ")


def space_separated_count(text) -> Column:
    """Pieces between single spaces; leading and trailing empty pieces count.

    That is one more than there are spaces, so nothing has to be split.
    """
    text = as_column(text)
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def word_count(text) -> Column:
    """Words between white space, without empty ones."""
    return F.regexp_count(as_column(text), F.lit(f"{NON_SPACE}+"))


def is_blank(text) -> Column:
    """Null, empty, or white space only."""
    text = as_column(text)
    return F.coalesce(~text.rlike(NON_SPACE), F.lit(True))


def contains_url(text) -> Column:
    return as_column(text).contains("http")


def is_question(text) -> Column:
    return as_column(text).contains("?")


def length_category(length) -> Column:
    """Below 50 short, below 200 medium, all else (null too) long."""
    length = as_column(length)
    return F.when(length < 50, "short").when(length < 200, "medium").otherwise("long")


def length_category_cut(length) -> Column:
    """Bins closed on the right: (0,50] short, (50,200] medium, above long, else null."""
    length = as_column(length)
    return (
        F.when((length > 0) & (length <= 50), "short")
        .when((length > 50) & (length <= 200), "medium")
        .when(length > 200, "long")
    )


def engagement_score(score, words) -> Column:
    return as_column(score) + as_column(words) * F.lit(0.1)


def date_key(timestamp) -> Column:
    return F.date_format(as_column(timestamp), "yyyy-MM-dd")


def truncate_example(text, size: int = 100, ellipsis: str = "...") -> Column:
    """The first ``size`` characters, marked with ``ellipsis`` where cut."""
    text = as_column(text)
    head = F.substring(text, 1, size)
    return F.when(F.length(text) > size, F.concat(head, F.lit(ellipsis))).otherwise(text)


def number_or_default(value, default: float = 50.0) -> Column:
    """The value as a double; ``default`` where it is null or not a number."""
    return F.coalesce(as_column(value).try_cast("double"), F.lit(default))
