"""Column expressions used by reports: bands, buckets, parts of a timestamp."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from verbatide.functions.text import as_column

# Lower bounds of the confidence bands and their names.
CONFIDENCE_BANDS = (
    (0.8, "High (0.8+)"),
    (0.6, "Medium (0.6-0.8)"),
    (0.4, "Low (0.4-0.6)"),
)
LOWEST_BAND = "Very Low (<0.4)"


def confidence_range(confidence, bands=CONFIDENCE_BANDS, lowest=LOWEST_BAND) -> Column:
    """The first band whose lower bound the confidence reaches."""
    confidence = as_column(confidence)
    (first_bound, first_name), *others = bands
    banded = F.when(confidence >= first_bound, first_name)
    for bound, name in others:
        banded = banded.when(confidence >= bound, name)
    return banded.otherwise(lowest)


def confidence_bucket(confidence) -> Column:
    """Tenths, cut off: 0.29 lies in 0.2."""
    return (as_column(confidence) * 10).cast("int") / F.lit(10.0)


def time_parts(timestamp) -> dict:
    """hour, day_of_week (Sunday is 1), month and year of a timestamp."""
    timestamp = as_column(timestamp)
    return {
        "hour": F.hour(timestamp),
        "day_of_week": F.dayofweek(timestamp),
        "month": F.month(timestamp),
        "year": F.year(timestamp),
    }
