"""Row filters that leave costly columns alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """``where`` on columns that are costly to compute.

    A plain filter would be moved below the projection that computes them, with all
    their expressions copied into it; a generated column stops that.
    """
    kept = F.explode_outer(F.when(condition, F.array(F.lit(True))))
    return df.select("*", kept.alias("_kept")).where(F.col("_kept").isNotNull()).drop("_kept")
