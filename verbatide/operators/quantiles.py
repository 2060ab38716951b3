"""Exact quantiles of values of any range, without a sort of all of them in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets a unit of the logarithm, and those of an equal division.
PER_UNIT, EQUAL = 64, 65_536
# So many distinct values go through one window.
FEW = 65_536
_LARGEST = 1e300


def _by_magnitude(value: Column) -> Column:
    """Number of the bucket by sign and logarithm: at most 90,000 for all doubles there are.

    It never falls as the value grows; what is not finite goes to the outermost ones.
    """
    size = F.log1p(F.least(F.abs(value), F.lit(_LARGEST)) * 1e4)
    bucket = F.floor(F.signum(value) * size * PER_UNIT)
    return F.when(F.isnan(value), F.lit(1 << 40)).otherwise(bucket)


def _by_place(value: Column) -> Column:
    """Number of the equal part of [_low, _high] that holds the value."""
    finite = (F.col("_low") >= -_LARGEST) & (F.col("_high") <= _LARGEST)
    wide = finite & (F.col("_high") > F.col("_low"))
    share = (value / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
    return F.when(wide, F.floor(share * EQUAL)).otherwise(F.lit(0))


def _crossing(buckets: DataFrame) -> DataFrame:
    """Of rows (_share, _before, _target, _bucket, _low, _high, _n), for each share the
    bucket in which the target is reached, and the rows before it."""
    running = Window.partitionBy("_share").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    reached = buckets.withColumn("_reached", F.col("_before") + F.sum("_n").over(running))
    crossed = (F.col("_reached") >= F.col("_target")) & (F.col("_reached") - F.col("_n") < F.col("_target"))
    return reached.filter(crossed).select(
        "_share", "_target", (F.col("_reached") - F.col("_n")).alias("_before"), "_low", "_high"
    )


def discrete_quantiles(histogram: DataFrame, shares: dict, value="_value", count="_n") -> DataFrame:
    """One row: for each name in ``shares`` the smallest value whose cumulated count
    reaches that share of all (all null where nothing is counted).

    ``histogram`` has distinct values and their counts, and should be stored: it is read
    up to five times. Few values go through one window. Of many, the buckets in which the
    targets lie are narrowed: by magnitude (90,000 buckets at most), twice by 65,536
    equal parts, and only the values of what is left are sorted. At each step a window
    sees as many rows as there are buckets, however many values there are; by calculation
    one last bucket has some 33,000 doubles at most. That bound does not hold for distinct
    values within 2e-6 of zero, which rounding to four places leaves none of.
    """
    known = histogram.filter(F.col(value).isNotNull() & (F.col(count) > 0)).select(
        F.col(value).cast("double").alias("_v"), F.col(count).alias("_n")
    )
    ends = known.agg(F.count("*").alias("rows"), F.sum("_n").alias("total")).first()
    names = list(shares)
    if not ends.rows:
        return histogram.sparkSession.range(1).select(
            *[F.lit(None).cast("double").alias(name) for name in names]
        )
    targets = F.array(
        *[
            F.struct(F.lit(name).alias("_share"), (F.lit(float(share)) * ends.total).alias("_target"))
            for name, share in shares.items()
        ]
    )
    if ends.rows > FEW:
        buckets = known.groupBy(_by_magnitude(F.col("_v")).alias("_bucket")).agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        )
        # One row for each share and bucket; from here on, one row for each share.
        wanted = _crossing(
            buckets.select("*", F.lit(0).alias("_before"), F.inline(targets))
        )
        for _ in range(2):
            wanted = _crossing(
                _inside(known, wanted)
                .groupBy("_share", "_target", "_before", _by_place(F.col("_v")).alias("_bucket"))
                .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
            )
        rest = _inside(known, wanted).select("_share", "_target", "_before", "_v", "_n")
    else:
        rest = known.select("_v", "_n", F.lit(0).alias("_before"), F.inline(targets))
    found = _crossing(
        rest.select("*", F.col("_v").alias("_bucket"), F.col("_v").alias("_low"), F.col("_v").alias("_high"))
    )
    return found.agg(*[F.max(F.when(F.col("_share") == name, F.col("_low"))).alias(name) for name in names])


def _inside(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values in the bounds of each share, of which there are as many as names."""
    return known.join(
        F.broadcast(wanted), (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
    )
