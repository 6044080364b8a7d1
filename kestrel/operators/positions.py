"""Row positions in a total order, without a window over the whole table.

The rows are range-partitioned and sorted, each task numbers its own rows, and
the rows of the earlier partitions are added. Only the row counts per
partition come together: as many numbers as there are shuffle partitions,
whatever the size of the table.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize

PART, ROW, BASE = "_position_part", "_position_row", "_position_base"


def with_positions(df: DataFrame, *order: Column | str, column: str = "position") -> DataFrame:
    """``df`` with the place (long, from 1) of each row in ``order``.

    ``order`` should end in a tie-break: rows equal in all of it are numbered
    in no particular order and, in bulk, share a partition. Nulls stand where
    Spark's sort puts them. The rows are written once to the shared folder, so
    a repeated task cannot number them differently for two readers."""
    numbered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumns({PART: F.spark_partition_id(),
                              # The low 33 bits count the rows of a partition.
                              ROW: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    numbered = materialize(numbered, "positions")
    sizes = sorted(tuple(r) for r in numbered.groupBy(PART).agg((F.max(ROW) + 1).alias("n")).collect())
    bases = list(zip((part for part, _ in sizes), accumulate((n for _, n in sizes), initial=0)))
    # One row per shuffle partition: safe to broadcast at any table size.
    before = df.sparkSession.createDataFrame(bases, f"{PART} int, {BASE} long")
    placed = numbered.join(F.broadcast(before), PART)
    return placed.withColumn(column, F.col(BASE) + F.col(ROW) + 1).drop(PART, ROW, BASE)


def with_group_positions(df: DataFrame, group: str, *order: Column | str, column: str = "position",
                         size_column: str = "group_size") -> DataFrame:
    """``df`` with the place (from 1) of each row within its ``group`` (a null
    group is one of its own) and the rows of the group. A group of any size is
    spread over the range partitions; joined in are its first place and size."""
    placed = with_positions(df, F.col(group), *order, column="_place")
    groups = materialize(placed.groupBy(F.col(group).alias("_group")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias(size_column)), "position-groups")
    return (placed.join(groups, F.col(group).eqNullSafe(F.col("_group")))
            .withColumn(column, F.col("_place") - F.col("_first") + 1).drop("_place", "_first", "_group"))
