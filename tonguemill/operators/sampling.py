"""The first rows of every split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.sources.corpus import CONFIG, ROW, SPLIT

_FAN_IN = 64


def _ranked(df: DataFrame, n: int, order_by: Sequence[str], *extra: str) -> DataFrame:
    first = Window.partitionBy(CONFIG, SPLIT, *extra).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).drop("_rank")


def first_rows(df: DataFrame, n: int, order_by: Sequence[str] = (ROW,)) -> DataFrame:
    """The first `n` rows of each split in the given order; whole splits where they are shorter.

    Every task keeps its own first `n` rows per split, groups of tasks merge theirs, and only those
    survivors meet in the last ranking, so no task sees more of a large split than 64 * n rows in the end.
    Among rows that tie at the n-th place any may be taken, but always `n` of them.
    """
    if n < 1:
        raise ValueError("a sample needs at least one row per split")
    # The task number only decides which tasks merge first: any grouping yields the same rows.
    grouped = df.withColumn("_group", F.spark_partition_id() % _FAN_IN)
    return _ranked(_ranked(grouped, n, order_by, "_group").drop("_group"), n, order_by)


def smoke_rows(df: DataFrame, order_by: Sequence[str] = (ROW,)) -> DataFrame:
    """The smoke-test subset: at most ten rows of each split of the first config."""
    first_config = df.agg(F.min(CONFIG).alias("_first"))
    subset = df.join(first_config, df[CONFIG] == first_config["_first"], "left_semi")
    return first_rows(subset, 10, order_by)
