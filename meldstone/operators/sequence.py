"""Global numbering of rows without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meldstone.sources.storage import materialise

# monotonically_increasing_id keeps the partition number above these bits.
_ROW_BITS = 33


def sequential_ids(df: DataFrame, keys: Sequence[str], name: str = "row_id") -> DataFrame:
    """Number rows 1..n in ascending order of ``keys``.

    Rows are range-partitioned and sorted within partitions, their position is
    written down once, and each partition is then shifted by the rows before it.
    Only one count per partition is broadcast, never data. ``keys`` must identify
    a row, otherwise the order of ties is arbitrary.
    """
    position = F.monotonically_increasing_id()
    placed = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_position", position),
        "sequence",
    )
    part = F.shiftright("_position", _ROW_BITS)
    row = F.col("_position") - F.shiftleft(part, _ROW_BITS)
    # One row per range partition: small enough for a window without partitioning.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg((F.max(row) + 1).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (row + F.col("_offset") + 1).cast("bigint"))
        .drop("_position", "_part", "_offset")
    )
