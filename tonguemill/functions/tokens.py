"""Token counters. Each takes a string column and returns a bigint column."""

from __future__ import annotations

from base64 import b64decode
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonguemill.functions.text import _col, char_length, word_count

Tokenizer = Callable[[Column], Column]

# Fixed value: the byte-pair vocabulary both jobs name.
BPE_ENCODING = "cl100k_base"


def words075(c: Column | str) -> Column:
    """int(words / 0.75), written as integer arithmetic."""
    return F.floor(word_count(c) * 4 / F.lit(3)).cast("bigint")


def chars4(c: Column | str) -> Column:
    """One token per four characters, rounded down."""
    return F.floor(char_length(c) / F.lit(4)).cast("bigint")


def encoded_length(encoder, text: str) -> int:
    try:
        return len(encoder.encode(text))
    except ValueError:
        return len(text.split()) * 4 // 3


@dataclass(frozen=True)
class Vocabulary:
    """Byte-pair ranks from a named file (a line of base64 token and rank each), and the pattern that cuts texts before.

    `ship` sends the file to all executors with the job; without it, `path` must be one that every executor can open.
    """

    path: str
    # Fixed value: the pattern of the public 50k byte-pair vocabulary.
    pattern: str = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

    def ship(self, spark: SparkSession) -> Vocabulary:
        spark.sparkContext.addFile(self.path)
        return self

    def open(self):
        """The encoder of this worker, built once for all its tasks."""
        return _encoder(self)


@lru_cache(maxsize=4)
def _encoder(vocabulary: Vocabulary):
    import tiktoken

    shipped = SparkFiles.get(Path(vocabulary.path).name)
    with open(shipped if Path(shipped).exists() else vocabulary.path, "rb") as lines:
        ranks = {b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("named file", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


def bpe(encoding: str | Vocabulary = BPE_ENCODING) -> Tokenizer:
    """Byte-pair counts, by a vocabulary file or by the name of an encoding that tiktoken finds on every worker.

    A text that the encoder refuses (it may spell a special token of a named encoding) counts int(words / 0.75), and only that
    text. Nulls stay null.
    """

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if isinstance(encoding, Vocabulary):
            encoder = encoding.open()
        else:
            import tiktoken

            encoder = tiktoken.get_encoding(encoding)  # once per Python worker task, not per row
        for texts in batches:
            yield pd.Series([None if t is None else encoded_length(encoder, t) for t in texts], dtype="Int64")

    return lambda c: count(_col(c))


TOKENIZERS: dict[str, Tokenizer] = {"words075": words075, "chars4": chars4}


def tokenizer(name_or_fn: str | Tokenizer) -> Tokenizer:
    if callable(name_or_fn):
        return name_or_fn
    if name_or_fn == "bpe":
        return bpe()
    return TOKENIZERS[name_or_fn]
