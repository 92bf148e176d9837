"""Dense running numbers over a global order, without one global sort of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.sources.staging import stage


def running_offsets(rows: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """``keys`` (unique, in their sort order) with ``first_id``: the sum of ``count`` before them.

    Only the narrow columns move. They are range-partitioned and written once, so
    a row's slot cannot change between the two passes; the slots' totals (one row
    per partition) give each slot its base, and a window inside the slot the rest.
    The same window finds repeated keys, which would make the ids ambiguous.
    """
    ranged = stage(
        rows.select(*keys, F.col(count).cast("bigint").alias("_count"))
        .repartitionByRange(*keys)
        .withColumn("_slot", F.spark_partition_id()),
        "offsets",
    )
    # One row per partition, so a window without a partition key is small here.
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranged.groupBy("_slot")
        .agg(F.sum("_count").alias("_total"))
        .select("_slot", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    ordered = Window.partitionBy("_slot").orderBy(*keys)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_count").over(earlier), F.lit(0))
    key = F.struct(*keys)
    repeated = F.raise_error(F.lit(f"the keys {list(keys)} must be unique, add a column to them"))
    within = F.when(F.lag(key).over(ordered) == key, repeated.cast("bigint")).otherwise(within)
    # At most as many rows as shuffle partitions: small whatever the data's size.
    return ranged.withColumn("_within", within).join(F.broadcast(bases), "_slot").select(
        *keys, (F.col("_base") + F.col("_within")).alias("first_id")
    )


def dense_numbers(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the order of ``keys`` of any type, nulls first, repeated keys in any order.

    Rows are range-partitioned by the keys and, where these repeat, by a number of their own, so rows that share a key may
    lie in several partitions. They are written once with their slot; the slots' counts give each its base.
    """
    slot, own = (c + "_" * sum(x.startswith(c) for x in df.columns) for c in ("_slot", "_own"))
    ranged = stage(
        df.withColumn(own, F.monotonically_increasing_id()).repartitionByRange(*keys, own).withColumn(slot, F.spark_partition_id()),
        "numbered",
    )
    # One row per partition.
    before = Window.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy(slot).agg(F.count(F.lit(1)).alias("_n")).select(
        slot, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    place = F.row_number().over(Window.partitionBy(slot).orderBy(*keys, own))
    return ranged.join(F.broadcast(bases), slot).withColumn(name, F.col("_base") + place - 1).drop("_base", slot, own)
