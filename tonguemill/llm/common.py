"""What the operators of this package share: reading tables, words of a text as bytes, document keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words when words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased.  Bytes of
#: multi-byte characters are never below 0x80, so whole UTF-8 texts can be cut as bytes.
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
LETTER_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))
#: Lower-cases A-Z and nothing else; words are then what `bytes.split()` yields, which splits at 0x20 and 0x09-0x0D.
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letter_words(text: bytes | None) -> list[bytes]:
    """Words of letters and digits, A-Z lower-cased; null has none."""
    return text.translate(LETTER_WORDS).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between blanks, A-Z lower-cased; null has none."""
    return text.translate(LOWER).split() if text else []


def utf8(column: str | Column) -> Column:
    """The text as bytes, so that Python workers need not decode it."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


def text_key(column: str | Column) -> Column:
    """64 bits of the text; together with the doc_id they tell documents apart even if ids repeat or are null."""
    return F.xxhash64(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))
