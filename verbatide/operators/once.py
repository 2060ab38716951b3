"""Columns that are computed once per row, whatever is built on top of them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict) -> DataFrame:
    """As ``withColumns``, but filters on the new columns do not repeat the work.

    Catalyst pushes a filter below the projection that computes its column, by
    copying the column's expression into the filter. For chains of regular
    expressions and dozens of substring tests that means doing them several
    times per row, and plans that grow with every step. As outputs of a
    generator (which yields exactly one row here) the columns are plain
    attributes to everything above, while filters on other columns still move
    down to the scan.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [name for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.array(row)))
