"""Consecutive surrogate keys without moving all rows into one task.

``row_number() over (order by k)`` with no partition would sort the whole
input in one task.  Instead the rows are dealt into ranges of the order column
and sorted inside each; a row's place in its range comes with the scan, and a
small table (one row per range) holds how many rows stand in the ranges before.
The dealt rows are checkpointed, so a re-run task cannot number them otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# monotonically_increasing_id: the partition above these bits, the row within it below
_ROW_BITS = 33


def with_consecutive_ids(df: DataFrame, order_col: str, id_col: str, start: int = 0) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... in ``order_col`` order (NULLs first)."""
    dealt = cut_lineage(df.repartitionByRange(order_col).sortWithinPartitions(order_col)
                        .withColumn("_place", F.monotonically_increasing_id()))
    dealt = (dealt.withColumn("_range", F.shiftright("_place", _ROW_BITS))
             .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("_range").count()
               .select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")))
    return (dealt.join(offsets, "_range")
            .withColumn(id_col, (F.col("_offset") + F.col("_row") + F.lit(start + 1)).cast("bigint"))
            .drop("_range", "_offset", "_row", "_place"))
