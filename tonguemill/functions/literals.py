"""Conversations stored as Python literals, and Python's str() for typed columns.

Parsing and printing a Python literal has no Spark expression, so these are the only
per-cell Python functions of the measuring side. They run on Arrow batches.
"""

from __future__ import annotations

import ast

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonguemill.functions.text import _col

_TURNS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("value", T.StringType())]))
_TURNS_ARROW = pa.list_(pa.struct([("pos", pa.int32()), ("value", pa.string())]))


def _parse(text: str | None) -> list | None:
    """The list a literal stands for, or None where it is no literal or no list."""
    try:
        parsed = None if text is None else ast.literal_eval(text)
    except Exception:  # noqa: BLE001 - every unreadable cell is handled alike, deep nesting included
        return None
    return parsed if isinstance(parsed, list) else None


def _spoken(turn: object) -> object:
    """The truthy `value` of a turn, or None."""
    return (turn.get("value") or None) if isinstance(turn, dict) else None


def _sendable(value: object) -> bool:
    """Whether a value is a string that UTF-8 can carry (a literal may spell a lone surrogate)."""
    try:
        return isinstance(value, str) and value.encode() is not None
    except UnicodeEncodeError:
        return False


@F.arrow_udf(T.LongType())
def _value_chars(texts: pa.Array) -> pa.Array:
    def measure(text: str | None) -> int | None:
        turns = _parse(text)
        if turns is None:
            return None
        return sum(len(str(value)) for value in map(_spoken, turns) if value is not None)

    return pa.array([measure(t) for t in texts.to_pylist()], pa.int64())


def conversation_value_chars(c: Column | str) -> Column:
    """Characters of all `value` fields; the whole string's length where it cannot be read."""
    return F.coalesce(_value_chars(_col(c)), F.length(_col(c)).cast("bigint"))


@F.arrow_udf(_TURNS)
def _values(texts: pa.Array) -> pa.Array:
    def extract(text: str | None) -> list | None:
        turns = _parse(text)
        if turns is None:
            return None
        return [{"pos": i, "value": v} for i, v in enumerate(map(_spoken, turns)) if _sendable(v)]

    return pa.array([extract(t) for t in texts.to_pylist()], _TURNS_ARROW)


def conversation_values(c: Column | str) -> Column:
    """Translatable `value` strings with their turn position; null where unreadable."""
    return _values(_col(c))


@F.arrow_udf(T.StringType())
def _rebuild(texts: pa.Array, replies: pa.Array) -> pa.Array:
    def rebuild(text: str | None, reply: list | None) -> str | None:
        turns = _parse(text) if reply else None
        if turns is None:
            return text
        changed = [p for p in reply if p["value"] is not None and p["value"] != turns[p["pos"]]["value"]]
        for part in changed:
            turns[part["pos"]]["value"] = part["value"]
        return str(turns) if changed else text

    pairs = zip(texts.to_pylist(), replies.to_pylist())
    return pa.array([rebuild(t, r) for t, r in pairs], pa.string())


def rebuild_conversation(original: Column | str, replies: Column | str) -> Column:
    """Put replies (array of pos, value) into the literal; the original text where nothing changed."""
    return _rebuild(_col(original), _col(replies))


def _plain(value, kind: pa.DataType):
    """The Python value a reader of the table would hold: maps as dicts, at any depth."""
    if value is None:
        return None
    if pa.types.is_map(kind):
        return {_plain(k, kind.key_type): _plain(v, kind.item_type) for k, v in value}
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return [_plain(v, kind.value_type) for v in value]
    if pa.types.is_struct(kind):
        return {f.name: _plain(value[f.name], f.type) for f in kind}
    return value


@F.arrow_udf(T.StringType())
def _render(values: pa.Array) -> pa.Array:
    plain = (_plain(v, values.type) for v in values.to_pylist())
    return pa.array([None if v is None else str(v) for v in plain], pa.string())


def py_str(c: Column | str, dtype: T.DataType) -> Column:
    """Python's str() of a column: a plain cast where Spark agrees, else an Arrow function."""
    if isinstance(dtype, T.StringType):
        return _col(c)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return _col(c).cast("string")
    if isinstance(dtype, T.BooleanType):
        return F.when(_col(c), "True").when(~_col(c), "False")
    return _render(_col(c))
