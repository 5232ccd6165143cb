"""A corpus pipeline: each stage works on what the one before it kept, written as Parquet and read again.

In every stage a null text is an empty one, ids may be null or repeat, rows that repeat are rows of their own unless the stage is
about copies, very long texts are read whole, and columns beyond those of documents are carried along.  An empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tonguemill.llm import decontamination, mixing, near_dedup, secrets, toxicity
from tonguemill.llm.common import table
from tonguemill.session import remove, scratch_area, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon rejects go: those with a score of 0.7 or more.  Copies share their score; texts without
    words stay."""
    lexicon = toxicity.learn(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays, the one with the smallest id, and one row of it.  Rows without an id are
    grouped like others; texts without words are nobody's copies and stay."""
    return near_dedup.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; without items none do."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in their texts, where they overlap as one; no document goes.  n_chars follows the text."""
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per draw of the mix, with its shard, its place in it and the words it takes; columns named mix_shard, mix_order or
    mix_words are replaced.  Documents that are not drawn, as those without words, have no row."""
    return mixing.mixed_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: The stages learn, hash and draw, which SQL does not express; tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn.  A stage's own tables go when its result is written, and a result goes when the next one is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage_{name}")
        with scratch_area(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.mode("error").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
