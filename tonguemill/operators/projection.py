"""Column roles, projections and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonguemill.functions.literals import py_str
from tonguemill.sources.corpus import CONFIG, ROW, SPLIT, data_columns, present_columns

SYSTEM, CONVERSATION, TEXT = "system", "conversation", "text"

# Column names that carry a role. The two jobs differ in the singular.
COST_ROLES = {"system": SYSTEM, "conversations": CONVERSATION}
TRANSLATION_ROLES = {"system": SYSTEM, "conversation": CONVERSATION, "conversations": CONVERSATION}

Roles = Mapping[str, str]


def roles_by_name(columns: Sequence[str], named: Roles) -> dict[str, str]:
    """Role of each column by its name; plain text for the rest."""
    return {c: named.get(c, TEXT) for c in columns}


def cost_roles(df: DataFrame, roles: Roles | Sequence[str] | None = None) -> dict[str, str]:
    """Roles for measuring: an explicit map, or wanted columns with roles by name. Absent ones are dropped."""
    return _resolve(df, roles, COST_ROLES)


def translation_roles(df: DataFrame, roles: Roles | Sequence[str] | None = None) -> dict[str, str]:
    """Roles for translating. Columns that are not strings have no text to translate and pass through."""
    resolved = _resolve(df, roles, TRANSLATION_ROLES)
    return {
        c: role
        for c, role in resolved.items()
        if role == CONVERSATION or isinstance(df.schema[c].dataType, T.StringType)
    }


def _resolve(df: DataFrame, roles: Roles | Sequence[str] | None, named: Roles) -> dict[str, str]:
    wanted = list(roles) if roles else None
    present = present_columns(df, wanted)
    if isinstance(roles, Mapping):
        return {c: roles[c] for c in present}
    return roles_by_name(present, named)


def select_columns(df: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """The wanted columns a table has, next to its config, split and position."""
    index = [c for c in (CONFIG, SPLIT, ROW) if c in df.columns]
    return df.select(*index, *present_columns(df, wanted))


def stringify(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns as Python would print them."""
    wanted = columns or data_columns(df)
    return df.withColumns({c: py_str(c, df.schema[c].dataType) for c in wanted})


def unpivot_values(df: DataFrame, keys: Sequence[str], roles: Roles) -> DataFrame:
    """One row per key and column: (keys, col, role, value as string)."""
    entries = [
        F.struct(F.lit(c).alias("col"), F.lit(role).alias("role"), py_str(c, df.schema[c].dataType).alias("value"))
        for c, role in roles.items()
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def non_null_values(df: DataFrame, keys: Sequence[str], roles: Roles) -> DataFrame:
    """Values the cost scan measures. Empty strings stay (they count as zero)."""
    return unpivot_values(df, keys, roles).where(F.col("value").isNotNull())


def translatable(value: Column | str) -> Column:
    """Whether a value reaches the translator: not null and not empty."""
    column = F.col(value) if isinstance(value, str) else value
    return column.isNotNull() & (column != "")


def role_counts(df: DataFrame, roles: Roles) -> DataFrame:
    """Values, translatable values and characters per column and its role, in one pass."""
    values = non_null_values(df, [], roles)
    return values.groupBy("col", "role").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(translatable("value")).alias("n_translatable"),
        F.sum(F.length("value")).alias("n_chars"),
    )
