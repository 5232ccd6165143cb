"""Packing short texts of neighbouring rows into one request, and taking the reply apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.functions.text import split_literal, strip_text
from tonguemill.operators.projection import SYSTEM
from tonguemill.operators.segments import MAX_BYTES
from tonguemill.sources.corpus import CONFIG, ROW, SPLIT
from tonguemill.sources.positions import assign_chunks

# The mark between texts of one request, the longest text packed, and rows per map batch.
DELIMITER = " |||TRANS-SPLIT||| "
MAX_PACKED_CHARS = 1_500
MAP_ROWS = 64

BATCH = (CONFIG, SPLIT, "col", "chunk_id", "map_batch")
GROUP = (*BATCH, "group_id")


@dataclass(frozen=True)
class Batching:
    batch_size: int = 5
    chunk_size: int = 100
    max_chars: int = MAX_PACKED_CHARS
    limit: int = MAX_BYTES


def _in_map_batches(cells: DataFrame, chunk_size: int) -> DataFrame:
    """Add chunk_id and map_batch: a chunk is worked off in batches of at most 64 rows."""
    map_batch = F.floor((F.col(ROW) % chunk_size) / F.lit(min(MAP_ROWS, chunk_size))).cast("bigint")
    return assign_chunks(cells, chunk_size).withColumn("map_batch", map_batch)


def group_cells(cells: DataFrame, batching: Batching = Batching()) -> DataFrame:
    """Add the group each text is sent in, null for texts that go alone; drop what is never sent.

    `cells` has (config, split, row_idx, col, role, text), nulls included. Groups are `batch_size`
    consecutive non-empty texts and restart in every map batch, so each window holds at most 64 rows.
    A map batch with a single non-null text is not packed, nor one whose system prompts are all equal.
    """
    batch = Window.partitionBy(*BATCH)
    up_to_here = batch.orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    sent = F.when(F.col("text") != "", 1)
    uniform = (
        (F.col("role") == SYSTEM)
        & (F.col("_non_null") == F.col("_rows"))
        & (F.min("text").over(batch) == F.max("text").over(batch))
    )
    return (
        _in_map_batches(cells, batching.chunk_size)
        .withColumn("_nth", F.count(sent).over(up_to_here))  # the ordered window first: one sort serves both
        .withColumns({"_rows": F.count(F.lit(1)).over(batch), "_non_null": F.count("text").over(batch)})
        .withColumn("_packed", (F.col("_non_null") > 1) & ~uniform)
        .where(F.col("text") != "")
        .withColumn(
            "group_id",
            F.when(F.col("_packed"), F.floor((F.col("_nth") - 1) / F.lit(batching.batch_size)).cast("bigint")),
        )
        .drop("_rows", "_non_null", "_nth", "_packed")
    )


def pack_groups(grouped: DataFrame, batching: Batching = Batching()) -> DataFrame:
    """One row per group: its members, the combined text, its size, and whether it may be one request.

    A group has at most `batch_size` members. A group of one has no delimiter and goes alone.
    """
    members = F.array_sort(F.collect_list(F.struct(ROW, "text")))
    n_bytes = F.sum(F.octet_length("text")) + len(DELIMITER.encode()) * (F.count(F.lit(1)) - 1)
    return (
        grouped.where(F.col("group_id").isNotNull())
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n"),
            n_bytes.alias("n_bytes"),
            F.max(F.length("text")).alias("max_chars"),
            members.alias("members"),
        )
        .withColumn(
            "eligible",
            (F.col("n") > 1) & (F.col("max_chars") <= batching.max_chars) & (F.col("n_bytes") <= batching.limit),
        )
        .withColumn("combined", F.array_join(F.transform("members", lambda m: m["text"]), DELIMITER))
        .drop("max_chars")
    )


def unpack_replies(packed: DataFrame, reply: str = "reply") -> DataFrame:
    """Add `parts`, the stripped texts of a reply, or null where their number is not the group's."""
    parts = F.transform(split_literal(reply, DELIMITER), strip_text)
    return packed.withColumn("parts", F.when(F.col("eligible") & (F.size(parts) == F.col("n")), parts))


def unpacked_cells(unpacked: DataFrame, *carried: str) -> DataFrame:
    """One row per text of the groups that came apart as they went in."""
    pairs = F.arrays_zip(F.col("members"), F.col("parts"))
    return unpacked.where(F.col("parts").isNotNull()).select(
        CONFIG, SPLIT, "col", F.explode(pairs).alias("p"), *carried
    ).select(CONFIG, SPLIT, "col", F.col(f"p.members.{ROW}").alias(ROW), F.col("p.parts").alias("text"), *carried)


def returned_cells(unpacked: DataFrame) -> DataFrame:
    """One row per text of the groups that must be translated one by one."""
    return unpacked.where(F.col("parts").isNull()).select(
        CONFIG, SPLIT, "col", F.inline("members")
    )


def uniform_batches(cells: DataFrame, chunk_size: int = 100) -> DataFrame:
    """Per map batch: rows, and whether all of its texts are equal and not empty (nulls count as empty)."""
    text = F.coalesce("text", F.lit(""))
    return (
        _in_map_batches(cells, chunk_size)
        .groupBy(CONFIG, SPLIT, "chunk_id", "map_batch")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            ((F.min(text) == F.max(text)) & (F.min(text) != "")).alias("uniform"),
        )
    )
