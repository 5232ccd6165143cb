"""Row positions within a split, without ever sorting a split in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.session import materialize
from tonguemill.sources.corpus import CONFIG, ROW, SPLIT

BY = (CONFIG, SPLIT)


def _join(left: DataFrame, right: DataFrame, on: Sequence[str], nullable: Sequence[str] = ()) -> DataFrame:
    """Inner equi-join on `on`, and on `nullable` columns where nulls match too; keeps the left's keys."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in (*on, *nullable)})
    matched = [left[c] == renamed[f"_r_{c}"] for c in on]
    matched += [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in nullable]
    return left.join(renamed, matched).drop(*[f"_r_{c}" for c in (*on, *nullable)])


def _rows_before(counts: DataFrame, piece: str) -> DataFrame:
    """`n_before`: rows in earlier pieces of the same split. One input row per split and piece."""
    earlier = Window.partitionBy(*BY).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("n_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def position_by_key(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add `row_idx`: 0, 1, 2, ... within each split in the order of `order_by`.

    `order_by` must identify a row within its split, which is checked. Only the key columns are
    sorted: they are range partitioned on the whole key, so a split holding most rows still spreads
    over all tasks, and written once. Counts per range give the offsets; the positions then join back
    on the key.
    """
    key = [*BY, *order_by]
    rank = F.monotonically_increasing_id()
    ranged = materialize(
        df.select(*key)
        .repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .select(*key, F.shiftright(rank, 33).alias("_range"), rank.alias("_rank")),
        "positions",
    )
    if not ranged.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"{list(order_by)} do not identify a row within its split")
    counts = ranged.groupBy(*BY, "_range").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("_first"))
    shifts = _rows_before(counts, "_range").select(
        *BY, "_range", (F.col("n_before") - F.col("_first")).alias("_shift")
    )
    positions = ranged.join(shifts, [*BY, "_range"]).select(
        *key, (F.col("_rank") + F.col("_shift")).alias(ROW)
    )
    return _join(df, positions, BY, order_by)


def position_in_files(df: DataFrame) -> DataFrame:
    """Add `row_idx` from the order rows already have in their Parquet files.

    For a corpus whose files hold one split each. Only per-file counts are shuffled: a row's position
    is its index in its file plus the rows of the split's earlier files (by path). The table of files
    is written first, so that Spark knows the size of its join. Where rows were filtered out, those left
    are ranked within their file, by file and index alone, so positions have no gaps then either.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    counts = at.groupBy(*BY, "_file").agg(F.count(F.lit(1)).alias("n"), (F.max("_index") + 1).alias("n_whole"))
    files = materialize(_rows_before(counts, "_file"), "files")
    whole = files.where("n <> n_whole").isEmpty()
    placed = _join(at, files.drop("n", "n_whole"), [*BY, "_file"])
    if whole:
        return placed.withColumn(ROW, F.col("_index") + F.col("n_before")).drop("_file", "_index", "n_before")
    in_file = Window.partitionBy(*BY, "_file").orderBy("_index")
    ranks = at.select(*BY, "_file", "_index", (F.row_number().over(in_file) - 1).cast("bigint").alias("_nth"))
    ranked = _join(placed, ranks, [*BY, "_file", "_index"])
    return ranked.withColumn(ROW, F.col("_nth") + F.col("n_before")).drop("_file", "_index", "n_before", "_nth")


def assign_chunks(df: DataFrame, chunk_size: int) -> DataFrame:
    """Add `chunk_id`: the number of the fixed-size position range a row falls into."""
    return df.withColumn("chunk_id", F.floor(F.col(ROW) / F.lit(chunk_size)).cast("bigint"))


def plan_chunks(df: DataFrame, chunk_size: int) -> DataFrame:
    """One row per chunk with its bounds [row_start, row_end)."""
    return (
        assign_chunks(df.select(*BY, ROW), chunk_size)
        .groupBy(*BY, "chunk_id")
        .agg(
            F.min(ROW).alias("row_start"),
            (F.max(ROW) + 1).alias("row_end"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
