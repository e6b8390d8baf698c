"""Carry values along ordered rows without putting a whole sequence into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a block in units of the ordering column (bytes of a file).
BLOCK = 4 << 20


def carry_last(rows: DataFrame, keys: list[str], order: str, value: Column, to: str, block: int = BLOCK, inclusive: bool = True) -> DataFrame:
    """Add ``to``: the last non-null ``value`` at or before each row (``inclusive``), else before it.

    Rows are windowed inside blocks of ``order``; the last value of each block goes to the next
    ones by a window over blocks, of which a sequence has few. The blocks come from one aggregate
    over the keys, the order and the value alone. Null keys are keys of their own.
    """
    width = rows.withColumn("__v", value).withColumn("__b", F.floor(F.coalesce(F.col(order), F.lit(0)) / block))
    frame = Window.partitionBy(*keys, "__b").orderBy(order)
    frame = frame.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    inside = width.withColumn("__own", F.last("__v", ignorenulls=True).over(frame))
    blocks = width.groupBy(*keys, "__b").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.coalesce(F.col(order), F.lit(0)))).alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("__in", F.last("__end", ignorenulls=True).over(before)).where("__in is not null").drop("__end")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"e.{k}")) for k in (*keys, "__b")]
    joined = inside.alias("p").join(carried.alias("e"), same, "left")
    return joined.select("p.*", F.coalesce("p.__own", "e.__in").alias(to)).drop("__v", "__b", "__own")
