"""Splitting long texts into pieces a translator accepts, and joining the replies.

A text becomes an array of pieces (seg, sub, piece, cut): replies of one `seg` join without a
separator in order of `sub`, segments join with the policy's separator in order of `seg`. `cut` tells
how the piece came about: whole text, segment of sentences, fixed slice, or hard cut of one sentence.

A policy that preserves separators cuts the text where sentences and paragraphs end without changing it. Its pieces also
carry the white space that stood before and after them (`before`, `after`), so replies join to a text with the layout of the original.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonguemill.functions.text import byte_length, char_length, fixed_slices, sentences, strip_text

# Limits of one request.
MAX_BYTES = 9_900
MAX_CHARS = 8_000
MAX_TOKENS = 127_000


@dataclass(frozen=True)
class Policy:
    """How texts are cut, sent and retried. Every field that changes a result is part of `fingerprint`."""

    kind: str
    limit: int
    separator: str
    strip_reply: bool  # strip a reply, and take an empty one for an error
    backoff: float  # seconds to wait after attempt k: backoff ** k
    max_retries: int = 3
    max_tokens: int | None = None
    prompt_tokens: int = 0
    tokens: str = "chars4"
    preserve_separators: bool = False

    @property
    def fingerprint(self) -> str:
        shaping = {k: v for k, v in asdict(self).items() if k not in ("backoff", "max_retries")}
        if not self.preserve_separators:  # replies and runs from before there was a choice stay valid
            del shaping["preserve_separators"]
        return ";".join(f"{k}={v}" for k, v in sorted(shaping.items()))


def bytes_policy(limit: int = MAX_BYTES, **changes) -> Policy:
    """Requests limited in bytes: sentences are packed greedily and rejoined with one space."""
    return Policy("bytes", limit, " ", strip_reply=False, backoff=1.5, **changes)


# Fixed value: the instruction sent with each chat request; its tokens count against the limit.
CHAT_INSTRUCTION = (
    "You are a professional translator. Translate the following text from {source} to {target}. "
    "Preserve formatting, markdown, and special characters. "
    "Only return the translated text without explanations."
)


def chars_policy(limit: int = MAX_CHARS, source: str = "en", target: str = "es", **changes) -> Policy:
    """Requests limited in characters: fixed slices, rejoined without a separator."""
    settings = {
        "max_tokens": MAX_TOKENS,
        "prompt_tokens": len(CHAT_INSTRUCTION.format(source=source, target=target)) // 4,
        **changes,
    }
    return Policy("chars", limit, "", strip_reply=True, backoff=2.0, **settings)


WHOLE, SEGMENT, SLICE, HARD_CUT = "whole", "segment", "slice", "hard_cut"


def _piece(seg: Column, sub: Column, piece: Column, cut: str) -> Column:
    return F.struct(
        seg.cast("int").alias("seg"), sub.cast("int").alias("sub"), piece.alias("piece"), F.lit(cut).alias("cut")
    )


def _single(text: Column, cut: str) -> Column:
    return F.array(_piece(F.lit(0), F.lit(0), text, cut))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value computed once. Inside a lambda Spark would otherwise compute it at every use."""
    return F.transform(F.array(value), body)[0]


def _segment_starts(sizes: Column, limit: int) -> Column:
    """Where segments start when sentences are packed greedily, each with one byte for a space.

    The fold carries positions and byte counts, never text, so its cost is linear in the text.
    """
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("filled"), F.array().cast("array<int>").alias("starts")
    )

    def add(state: Column, size: Column) -> Column:
        fits = (state["at"] > 0) & (state["filled"] + size + 1 <= limit)
        return F.struct(
            (state["at"] + 1).alias("at"),
            (F.when(fits, state["filled"]).otherwise(0) + size + 1).alias("filled"),
            F.when(fits, state["starts"]).otherwise(F.array_append(state["starts"], state["at"])).alias("starts"),
        )

    return F.aggregate(sizes, start, add, lambda state: state["starts"])


def _packed(parts: Column, limit: int) -> Column:
    """Sentences to segment texts."""

    def assemble(starts: Column) -> Column:
        def segment(start: Column, i: Column) -> Column:
            end = F.when(i + 1 < F.size(starts), F.get(starts, i + 1)).otherwise(F.size(parts))
            return F.array_join(F.slice(parts, start + 1, end - start), " ")

        return F.transform(starts, segment)

    return _bind(_segment_starts(F.transform(parts, lambda s: F.octet_length(s)), limit), assemble)


def _fitted(segment: Column, seg: Column, limit: int) -> Column:
    """The pieces of one segment. A sentence over the limit has nowhere left to split and is cut into
    slices that always fit, a code point taking four bytes at most. Packing leaves it alone in its segment.
    """
    slices = F.transform(fixed_slices(segment, limit // 4), lambda s, i: _piece(seg, i, s, HARD_CUT))
    return F.when(byte_length(segment) > limit, slices).otherwise(F.array(_piece(seg, F.lit(0), segment, SEGMENT)))


# A sentence or paragraph with what ends it; the last one of a text may have no end. Nothing is left out.
UNIT = r"(?s)(?:.*?(?:\. |\n\n)|.+\z)"


def _whole_units(column: Column, limit: int) -> Column:
    """The text as strings of whole units that fit the limit, where a unit does."""

    def pack(units: Column) -> Column:
        sizes = F.transform(units, lambda u: F.octet_length(u) - 1)  # no space is put between them

        def assemble(starts: Column) -> Column:
            def segment(start: Column, i: Column) -> Column:
                end = F.when(i + 1 < F.size(starts), F.get(starts, i + 1)).otherwise(F.size(units))
                return F.array_join(F.slice(units, start + 1, end - start), "")

            return F.transform(starts, segment)

        return _bind(_segment_starts(sizes, limit), assemble)

    return _bind(F.regexp_extract_all(column, F.lit(UNIT), F.lit(0)), pack)


def _kept_pieces(column: Column, policy: Policy) -> Column:
    """Pieces that with their white space make up the text exactly."""

    def piece(seg: Column, sub: Column, part: Column, cut: Column) -> Column:
        def split(core: Column) -> Column:
            blank = core == ""
            lead = F.when(blank, part).otherwise(F.left(part, F.position(core, part) - 1))
            rest = F.length(part) - F.length(lead) - F.length(core)
            return F.struct(
                seg.cast("int").alias("seg"), sub.cast("int").alias("sub"), core.alias("piece"), cut.alias("cut"),
                lead.alias("before"), F.when(blank | (rest == 0), "").otherwise(F.right(part, rest)).alias("after"),
            )

        return _bind(strip_text(part), split)

    zero = F.lit(0)
    if policy.kind == "chars":
        short = char_length(column) <= policy.limit
        cut = F.transform(fixed_slices(column, policy.limit), lambda s, i: piece(i, zero, s, F.lit(SLICE)))
    else:
        short = byte_length(column) <= policy.limit

        def fitted(part: Column, seg: Column) -> Column:
            slices = F.transform(fixed_slices(part, policy.limit // 4), lambda s, i: piece(seg, i, s, F.lit(HARD_CUT)))
            alone = F.array(piece(seg, zero, part, F.lit(SEGMENT)))
            return F.when(byte_length(strip_text(part)) > policy.limit, slices).otherwise(alone)

        cut = F.flatten(F.transform(_whole_units(column, policy.limit), fitted))
    return F.when(short, F.array(piece(zero, zero, column, F.lit(WHOLE)))).otherwise(cut)


def pieces_of(text: Column | str, policy: Policy) -> Column:
    """The pieces of a text. A long text without any sentence yields one empty piece."""
    column = F.col(text) if isinstance(text, str) else text
    if policy.preserve_separators:
        return _kept_pieces(column, policy)
    if policy.kind == "chars":
        slices = F.transform(
            fixed_slices(column, policy.limit), lambda s, i: _piece(i, F.lit(0), s, SLICE)
        )
        return F.when(char_length(column) <= policy.limit, _single(column, WHOLE)).otherwise(slices)

    def fitted(parts: Column) -> Column:
        cut = F.transform(_packed(parts, policy.limit), lambda segment, i: _fitted(segment, i, policy.limit))
        return F.when(F.size(parts) == 0, _single(F.lit(""), SEGMENT)).otherwise(F.flatten(cut))

    short = byte_length(column) <= policy.limit
    return F.when(short, _single(column, WHOLE)).otherwise(_bind(sentences(column), fitted))


def explode_pieces(df: DataFrame, keys: Sequence[str], text: str, policy: Policy) -> DataFrame:
    """One row per piece: (keys, seg, sub, piece, cut), and (before, after) where separators are preserved."""
    return df.select(*keys, F.inline(pieces_of(text, policy)))


def piece_fields(policy: Policy) -> list[str]:
    """What `joined_text` needs of a piece besides its value."""
    return ["seg", "sub", "cut", *(("before", "after") if policy.preserve_separators else ())]


def joined_text(pieces: Column, policy: Policy, value: str = "piece") -> Column:
    """Join an array of (piece_fields, <value>) structs in order. Under bytes a split text is stripped."""
    if policy.preserve_separators:
        return F.array_join(F.transform(F.array_sort(pieces), lambda p: F.concat(p["before"], p[value], p["after"])), "")

    def glue(p: Column) -> Column:
        starts_segment = (p["seg"] > 0) & (p["sub"] == 0)
        return F.concat(F.when(starts_segment, policy.separator).otherwise(""), p[value])

    def join(ordered: Column) -> Column:
        text = F.array_join(F.transform(ordered, glue), "")
        if policy.kind != "bytes":
            return text
        return F.when(ordered[0]["cut"] == WHOLE, text).otherwise(strip_text(text))

    return _bind(F.array_sort(pieces), join)


def rejoin_pieces(pieces: DataFrame, keys: Sequence[str], policy: Policy, value: str = "piece") -> DataFrame:
    """Texts from their pieces. A group is the pieces of one text, so it stays as small as a text."""
    parts = F.collect_list(F.struct(*piece_fields(policy), value))
    return pieces.groupBy(*keys).agg(joined_text(parts, policy, value).alias("text"))
