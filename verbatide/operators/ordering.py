"""Dense numbers over a whole table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbatide.storage import cut_lineage

# monotonically_increasing_id(): partition number above, row in partition below.
_ROW_BITS = 33


def with_row_index(df: DataFrame, order_by, name: str, start: int = 0) -> DataFrame:
    """Number the rows start, start + 1, ... in the given total order.

    ``row_number()`` over an unpartitioned window would move every row into one
    task. Here Spark sorts by ranges, the sorted rows are checkpointed (their
    partitions must not change between the two uses below), and each row's
    place in its partition is shifted by the rows of all earlier partitions.
    The offsets table has one row per partition, so it is safe to broadcast.

    The order should be total. Ties are ordered by a hash of the row, so that
    the number depends on content only, and a key that many rows share is
    still divided between partitions.
    """
    ordered = cut_lineage(df.orderBy(*order_by, F.xxhash64(*df.columns)))
    placed = (
        ordered.withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
        .withColumn("_place", F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1))
    )
    # One row per partition: a window in one task is fine.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + F.lit(start))
        .drop("_part", "_place", "_offset")
    )

