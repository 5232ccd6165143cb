"""Column expressions over text. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as white space.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java pattern; the Unicode flag covers all but the four separators U+001C..U+001F.
PY_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
PY_WORD = r"(?U)[^\s\x1c-\x1f]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_length(c: Column | str) -> Column:
    """Length in code points."""
    return F.length(_col(c)).cast("bigint")


def byte_length(c: Column | str) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(_col(c)).cast("bigint")


def strip_text(c: Column | str) -> Column:
    """Remove Unicode white space at both ends (Spark's plain trim removes spaces only)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def words(c: Column | str) -> Column:
    """White-space separated words, without empty strings."""
    return F.filter(F.split(_col(c), PY_WHITESPACE_RUN), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """Counts the runs between white space, without building the words."""
    return F.regexp_count(_col(c), F.lit(PY_WORD)).cast("bigint")


def split_literal(c: Column | str, separator: str) -> Column:
    """Split on a literal separator, keeping empty parts."""
    return F.split(_col(c), r"\Q" + separator + r"\E", -1)


def sentences(c: Column | str) -> Column:
    """Paragraphs, then sentences: stripped, blanks dropped, each ended with a period.

    The period is added to every sentence, also to one that already ends with a period.
    """
    parts = F.flatten(F.transform(split_literal(c, "\n\n"), lambda p: split_literal(p, ". ")))
    stripped = F.transform(parts, strip_text)
    return F.transform(F.filter(stripped, lambda s: s != ""), lambda s: F.concat(s, F.lit(".")))


def fixed_slices(c: Column | str, width: int) -> Column:
    """Consecutive slices of `width` code points; the last may be shorter; none for an empty string."""
    return F.regexp_extract_all(_col(c), F.lit("(?s).{1,%d}" % width), F.lit(0))


def text_digest(c: Column | str) -> Column:
    """Identity of a text in 32 bytes. Shuffling this instead of the text keeps exchanges narrow."""
    return F.unhex(F.sha2(_col(c), 256))
