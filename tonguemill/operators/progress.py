"""Which chunks of a run are done, and which remain."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonguemill.operators.memo import scope_of
from tonguemill.operators.projection import Roles
from tonguemill.operators.translate import Settings
from tonguemill.operators.translator import FAILED
from tonguemill.sources.corpus import CONFIG, ROW, SPLIT
from tonguemill.sources.positions import assign_chunks

CHUNK = (CONFIG, SPLIT, "chunk_id")

# A row is a range of neighbouring chunks without failures, or one chunk with some.
SCHEMA = (
    "attempt string, fingerprint string, config string, split string, chunk_start bigint, chunk_end bigint, chunk_size bigint, "
    "row_start bigint, row_end bigint, n_rows bigint, n_failed bigint, finished_at timestamp"
)
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
DONE, DONE_WITH_FAILURES = "done", "done_with_failures"


def run_fingerprint(settings: Settings, roles: Roles, chunk_size: int) -> str:
    """Identifies everything that changes a run's output. Resuming with another one is refused."""
    shaping = (
        scope_of(settings.translator, settings.policy),
        sorted(roles.items()),
        chunk_size,
        settings.batching,
        settings.null_conversation,
    )
    return hashlib.sha256(repr(shaping).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class ProgressTable:
    """Parquet rows for finished chunks, appended after their data is committed.

    Neighbouring chunks of an append are one row, so the state of a run grows with its waves and failures, not with its chunks.
    """

    path: str

    def ranges(self, spark: SparkSession) -> DataFrame:
        """The rows as they are stored."""
        try:
            return spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], SCHEMA)

    def ranges_of_run(self, spark: SparkSession, fingerprint: str) -> DataFrame:
        state = self.ranges(spark)
        if not state.where(F.col("fingerprint") != fingerprint).isEmpty():
            raise ValueError("the recorded progress belongs to a run with other settings")
        return state

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per finished chunk."""
        return chunks_of(self.ranges(spark))

    def read_run(self, spark: SparkSession, fingerprint: str) -> DataFrame:
        return chunks_of(self.ranges_of_run(spark, fingerprint))

    def append(self, finished: DataFrame, fingerprint: str, attempt: str, chunk_size: int) -> None:
        rows = neighbours(finished, chunk_size).withColumns({
            "fingerprint": F.lit(fingerprint),
            "attempt": F.lit(attempt),
            "finished_at": F.current_timestamp(),
        })
        # The ranges of a wave in one file: an append is seen whole or not at all.
        rows.select(*NAMES).coalesce(1).write.mode("append").parquet(self.path)


def neighbours(chunks: DataFrame, chunk_size: int) -> DataFrame:
    """Chunk rows as ranges: runs of neighbouring chunks that are gap-free and without failures become one row."""
    by_chunk = Window.partitionBy(CONFIG, SPLIT).orderBy("chunk_id")
    plain = (F.col("n_failed") == 0) & (F.col("n_rows") == F.col("row_end") - F.col("row_start"))
    marked = chunks.withColumn("_plain", plain)
    goes_on = F.col("_plain") & F.lag("_plain").over(by_chunk) & (F.lag("row_end").over(by_chunk) == F.col("row_start"))
    marked = marked.withColumn("_starts", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    island = F.sum("_starts").over(by_chunk.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_island", island)
        .groupBy(CONFIG, SPLIT, "_island")
        .agg(
            F.min("chunk_id").alias("chunk_start"),
            (F.max("chunk_id") + 1).alias("chunk_end"),
            F.min("row_start").alias("row_start"),
            F.max("row_end").alias("row_end"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_failed").alias("n_failed"),
        )
        .withColumn("chunk_size", F.lit(chunk_size).cast("bigint"))
        .drop("_island")
    )


def chunks_of(ranges: DataFrame) -> DataFrame:
    """The chunks that ranges stand for: the inverse of `neighbours`."""
    each = ranges.withColumn("chunk_id", F.explode(F.sequence(F.col("chunk_start"), F.col("chunk_end") - 1)))
    start = F.greatest("row_start", F.col("chunk_id") * F.col("chunk_size"))
    end = F.least("row_end", (F.col("chunk_id") + 1) * F.col("chunk_size"))
    one = F.col("chunk_end") == F.col("chunk_start") + 1
    return each.select(
        "attempt", "fingerprint", CONFIG, SPLIT, "chunk_id", start.alias("row_start"), end.alias("row_end"),
        F.when(one, F.col("n_rows")).otherwise(end - start).alias("n_rows"), "n_failed",
        F.when(F.col("n_failed") > 0, DONE_WITH_FAILURES).otherwise(DONE).alias("status"), "finished_at",
    )


def finished_ranges(ranges: DataFrame) -> DataFrame:
    """Per split the union of ranges [row_start, row_end), as disjoint ranges that do not touch, with their number of rows.

    A range starts anew where none of the earlier ones reaches.
    """
    in_order = Window.partitionBy(CONFIG, SPLIT).orderBy("row_start", "row_end")
    reach = F.max("row_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(F.coalesce(F.col("row_start") <= reach, F.lit(False)), 0).otherwise(1)
    island = F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("_starts", starts)
        .withColumn("_island", island)
        .groupBy(CONFIG, SPLIT, "_island")
        .agg(F.min("row_start").alias("row_start"), F.max("row_end").alias("row_end"))
        .withColumn("n_positions", F.col("row_end") - F.col("row_start"))
        .drop("_island")
    )


def outside(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows whose position lies in none of the ranges of their split, which are as few as the run's waves."""
    done = ranges.select(
        F.col(CONFIG).alias("_config"), F.col(SPLIT).alias("_split"), F.col("row_start").alias("_from"), F.col("row_end").alias("_to")
    )
    inside = (F.col(ROW) >= F.col("_from")) & (F.col(ROW) < F.col("_to"))
    return rows.join(done, (F.col(CONFIG) == F.col("_config")) & (F.col(SPLIT) == F.col("_split")) & inside, "left_anti")


def chunk_progress(translated: DataFrame, chunk_size: int, columns: Sequence[str]) -> DataFrame:
    """State of the chunks in `translated`, which holds `<column>_status` for each column."""
    failed = F.lit(False)
    for c in columns:
        failed = failed | (F.col(f"{c}_status") == FAILED)
    return (
        assign_chunks(translated.select(CONFIG, SPLIT, ROW, failed.alias("failed")), chunk_size)
        .groupBy(*CHUNK)
        .agg(
            F.min(ROW).alias("row_start"),
            (F.max(ROW) + 1).alias("row_end"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if("failed").alias("n_failed"),
        )
        .withColumn("status", F.when(F.col("n_failed") > 0, DONE_WITH_FAILURES).otherwise(DONE))
    )


def pending_chunks(chunks: DataFrame, state: DataFrame) -> DataFrame:
    """Chunks of the plan that no state row reports as finished."""
    return chunks.join(state.select(*CHUNK), [*CHUNK], "left_anti")


def split_progress(chunks: DataFrame, state: DataFrame) -> DataFrame:
    """Per split: planned and finished chunks and rows, and whether the split may be finalised.

    A split is complete when every planned chunk is finished with exactly its planned rows.
    """
    done = state.select(*CHUNK, F.col("n_rows").alias("rows_done"))
    return (
        chunks.join(done, [*CHUNK], "left")
        .groupBy(CONFIG, SPLIT)
        .agg(
            F.count(F.lit(1)).alias("n_chunks"),
            F.count("rows_done").alias("chunks_done"),
            F.sum("n_rows").alias("n_rows"),
            F.coalesce(F.sum("rows_done"), F.lit(0)).alias("rows_done"),
            F.coalesce(F.bool_and(F.col("rows_done") == F.col("n_rows")), F.lit(False)).alias("_exact"),
        )
        .withColumn("complete", F.col("_exact") & (F.col("chunks_done") == F.col("n_chunks")))
        .drop("_exact")
    )
