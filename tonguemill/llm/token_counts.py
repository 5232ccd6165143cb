"""Token counts as an exact length histogram.

Documents are counted by encoded length.  Suffix sums over the lengths answer, for every context limit, how many documents
reach it, how many tokens all of them hold together, and how many tokens are left when each is cut at the limit; running counts answer quantiles.
"""

from __future__ import annotations

import base64
import importlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.llm.common import table
from tonguemill.session import materialize

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
STRIP = 1024  # lengths in a strip of the two-level sums


@dataclass(frozen=True)
class BytePairs:
    """A byte-level BPE vocabulary given as ranks, and the pattern that cuts texts into pieces before it."""

    path: str = VOCABULARY
    pattern: str = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
    remembered: int = 500_000

    def counter(self) -> PieceCounter:
        return PieceCounter(self)


class PieceCounter:
    """Tokens of a text: pieces are encoded one by one, so each one's count is remembered."""

    def __init__(self, how: BytePairs) -> None:
        tiktoken = importlib.import_module("tiktoken")
        with open(how.path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.encoding = tiktoken.Encoding("own", pat_str=how.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(how.pattern).findall
        self.known: dict[str, int] = {}
        self.most = how.remembered

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for piece in self.pieces(text):
            n = known.get(piece)
            if n is None:
                n = len(self.encoding.encode_ordinary(piece))
                if len(known) >= self.most:
                    known.clear()
                known[piece] = n
            total += n
        return total


def lengths(docs: DataFrame, how: BytePairs = BytePairs()) -> DataFrame:
    """n_tokens and docs: the histogram.  Tasks count before anything is shuffled.

    Null and empty texts have no tokens; rows that repeat count each, ids and other columns take no part.  A very long text is
    counted whole, piece by piece.  No rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = how.counter(), {}
        for batch in batches:
            for text in batch.column(0):
                n = counter.count(text.as_py())
                seen[n] = seen.get(n, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["n_tokens", "docs"])

    return docs.select("text").mapInArrow(run, "n_tokens long, docs long").groupBy("n_tokens").agg(F.sum("docs").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length: docs, docs_at_least, tokens_at_least, truncated_total (all documents cut at it), quantile (share no longer).

    Sums run within strips of lengths and over the strips' totals, of which there are few: no longer than the longest text.
    """
    rows = materialize(histogram.withColumn("strip", F.expr(f"n_tokens div {STRIP}")).withColumn("tokens", F.col("n_tokens") * F.col("docs")), "histogram")
    strips = rows.groupBy("strip").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    up = Window.orderBy(F.desc("strip")).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    above = strips.select("strip", zero(F.sum("d").over(up)).alias("docs_above"), zero(F.sum("t").over(up)).alias("tokens_above"))
    total = Window.partitionBy()
    above = above.join(strips, "strip").withColumn("all_docs", F.sum("d").over(total)).withColumn("all_tokens", F.sum("t").over(total))
    inside = Window.partitionBy("strip").orderBy(F.desc("n_tokens"))
    summed = rows.join(above, "strip").withColumn("docs_at_least", F.sum("docs").over(inside) + F.col("docs_above"))
    summed = summed.withColumn("tokens_at_least", F.sum("tokens").over(inside) + F.col("tokens_above"))
    truncated = F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    share = (F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")
    return summed.select("n_tokens", "docs", "docs_at_least", "tokens_at_least", truncated.alias("truncated_total"), share.alias("quantile"))


def totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For any context limits: documents over them, tokens left after the cut, tokens lost; one row per limit, from one pass."""
    over = [F.min(F.when(F.col("n_tokens") > limit, F.struct("n_tokens", "docs_at_least", "tokens_at_least"))) for limit in limits]
    found = [F.struct(F.lit(int(limit)).cast("long").alias("limit"), x.alias("over")) for limit, x in zip(limits, over)]
    whole = F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("all_tokens")
    each = sums.agg(whole, F.array(*found).alias("found")).select("all_tokens", F.inline("found"))
    lost = F.coalesce(F.col("over.tokens_at_least") - F.col("limit") * F.col("over.docs_at_least"), F.lit(0))
    return each.select("limit", F.coalesce("over.docs_at_least", F.lit(0)).alias("docs_over"), (F.col("all_tokens") - lost).alias("truncated_total"), lost.alias("tokens_lost"))


def token_lengths(spark, sf_dir: str) -> DataFrame:
    return suffix_sums(lengths(table(spark, sf_dir, "documents")))
