"""Counting characters and tokens by column role, and pricing them.

Only sums leave a task. The one set a single-machine scan has to keep, the system prompts seen so far,
becomes a grouping on the prompt's digest: with n occurrences of a prompt of t tokens, t are regular
input and (n - 1) * t are cached, whichever occurrence comes first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonguemill.functions.literals import conversation_value_chars, conversation_values, py_str
from tonguemill.functions.text import char_length, text_digest
from tonguemill.functions.tokens import Tokenizer, tokenizer
from tonguemill.operators.projection import CONVERSATION, SYSTEM, Roles, cost_roles
from tonguemill.operators.sampling import first_rows
from tonguemill.sources.corpus import CONFIG, SPLIT, split_counts

COUNTERS = (
    "total_chars", "system_unique_chars", "system_unique_prompts", "conversation_chars", "other_chars",
    "total_tokens", "regular_input_tokens", "cached_input_tokens", "output_tokens",
)


@dataclass(frozen=True)
class Prices:
    """List prices in US dollars as of 2025-04-03."""

    per_million_chars: float = 15.00
    free_chars: int = 2_000_000
    per_million_input_tokens: float = 0.150
    per_million_cached_tokens: float = 0.075
    per_million_output_tokens: float = 0.600


# Fixed value: share of a conversation's tokens taken as input, rounded down per row.
CONVERSATION_INPUT_SHARE = 0.33


def _measure(value: Column, role: str, count_tokens: Tokenizer) -> Column:
    """The numbers of one cell, with the digest that identifies a system prompt."""
    chars, tokens, zero = char_length(value), count_tokens(value), F.lit(0).cast("bigint")
    digest = F.lit(None).cast("binary")
    system_chars = conversation_chars = other_chars = system_tokens = plain_tokens = turn_tokens = zero
    if role == SYSTEM:
        digest, system_chars, system_tokens = text_digest(value), chars, tokens
    elif role == CONVERSATION:
        # Characters count the values only, tokens the whole string.
        conversation_chars, turn_tokens = conversation_value_chars(value), tokens
    else:
        other_chars, plain_tokens = chars, tokens
    return F.struct(
        value.isNotNull().alias("present"),
        digest.alias("prompt"),
        system_chars.alias("system_chars"),
        system_tokens.alias("system_tokens"),
        conversation_chars.alias("conversation_chars"),
        turn_tokens.alias("turn_tokens"),
        other_chars.alias("other_chars"),
        plain_tokens.alias("plain_tokens"),
    )


def measure_cells(df: DataFrame, roles: Roles, count_tokens: Tokenizer) -> DataFrame:
    """One narrow row of numbers per cell that is not null; the text itself goes no further."""
    cells = [_measure(py_str(c, df.schema[c].dataType), role, count_tokens) for c, role in roles.items()]
    return df.select(CONFIG, SPLIT, F.inline(F.array(*cells))).where("present").drop("present")


def _per_prompt(cells: DataFrame, *by: str) -> DataFrame:
    """Sums per system prompt. All other cells share the null prompt, summed in each task first."""
    input_tokens = F.floor(F.col("turn_tokens") * F.lit(CONVERSATION_INPUT_SHARE)).cast("bigint")
    return cells.groupBy("prompt", *by).agg(
        F.sum("system_chars").alias("system_chars"),
        F.sum("system_tokens").alias("system_tokens"),
        F.max("system_chars").alias("once_chars"),
        F.max("system_tokens").alias("once_tokens"),
        F.sum("conversation_chars").alias("conversation_chars"),
        F.sum("other_chars").alias("other_chars"),
        F.sum("plain_tokens").alias("plain_tokens"),
        F.sum("turn_tokens").alias("turn_tokens"),
        F.sum(input_tokens).alias("turn_input_tokens"),
    )


def _counters(first: Column) -> list[Column]:
    """Counter sums over per-prompt rows. `first` marks the row that holds a prompt's first occurrence."""

    def total(*columns: str) -> Column:
        parts = [F.coalesce(F.sum(c), F.lit(0)) for c in columns]
        return reduce(lambda a, b: a + b, parts)

    once_chars = F.coalesce(F.sum(F.when(first, F.col("once_chars"))), F.lit(0))
    once_tokens = F.coalesce(F.sum(F.when(first, F.col("once_tokens"))), F.lit(0))
    exact = {
        "total_chars": total("system_chars", "conversation_chars", "other_chars"),
        "system_unique_chars": once_chars,
        "system_unique_prompts": F.count_if(first & F.col("prompt").isNotNull()),
        "conversation_chars": total("conversation_chars"),
        "other_chars": total("other_chars"),
        "total_tokens": total("system_tokens", "turn_tokens", "plain_tokens"),
        "regular_input_tokens": once_tokens + total("turn_input_tokens", "plain_tokens"),
        "cached_input_tokens": total("system_tokens") - once_tokens,
        "output_tokens": total("turn_tokens") - total("turn_input_tokens"),
    }
    return [column.cast("bigint").alias(name) for name, column in exact.items()]


def cost_counters(df: DataFrame, roles=None, tokens: str | Tokenizer = "words075") -> DataFrame:
    """All counters of a corpus as one row, from one scan."""
    cells = measure_cells(df, cost_roles(df, roles), tokenizer(tokens))
    return _per_prompt(cells).agg(*_counters(F.lit(True)))


def split_counters(df: DataFrame, roles=None, tokens: str | Tokenizer = "words075") -> DataFrame:
    """The counters per split; they add up to `cost_counters`.

    A prompt's first occurrence belongs to the first split, by config and name, that holds it. The
    second grouping sees one row per prompt and split, however often the prompt occurs.
    """
    cells = measure_cells(df, cost_roles(df, roles), tokenizer(tokens))
    per_prompt = _per_prompt(cells, CONFIG, SPLIT)
    owner = F.min(F.struct(CONFIG, SPLIT)).over(Window.partitionBy("prompt"))
    owned = per_prompt.withColumn("_first", owner == F.struct(CONFIG, SPLIT))
    return owned.groupBy(CONFIG, SPLIT).agg(*_counters(F.col("_first")))


def unique_prompts(df: DataFrame, roles=None) -> DataFrame:
    """Number and characters of distinct system prompts over all configs and splits."""
    resolved = cost_roles(df, roles)
    systems = {c: role for c, role in resolved.items() if role == SYSTEM}
    cells = measure_cells(df, systems, lambda c: F.lit(0).cast("bigint"))
    return _per_prompt(cells).agg(*_counters(F.lit(True))).select("system_unique_prompts", "system_unique_chars")


def value_tokens(df: DataFrame, keys, column: str, tokens: str | Tokenizer = "words075") -> DataFrame:
    """Tokens of a conversation's values alone, per row; `total_tokens` counts the whole string instead.

    `keys` identify a row, so a group is the turns of one conversation.
    """
    turns = df.select(*keys, F.inline(conversation_values(column)))
    return turns.groupBy(*keys).agg(F.sum(tokenizer(tokens)("value")).alias("value_tokens"))


def price(counters: DataFrame, prices: Prices = Prices()) -> DataFrame:
    """Add billable characters and the cost under both services."""
    million = F.lit(1_000_000.0)

    def tokens_cost(counter: str, rate: float) -> Column:
        return F.col(counter) / million * F.lit(rate)

    billable = F.greatest(F.lit(0).cast("bigint"), F.col("total_chars") - F.lit(prices.free_chars).cast("bigint"))
    chat = (
        tokens_cost("regular_input_tokens", prices.per_million_input_tokens)
        + tokens_cost("cached_input_tokens", prices.per_million_cached_tokens)
        + tokens_cost("output_tokens", prices.per_million_output_tokens)
    )
    return counters.withColumn("billable_chars", billable).withColumns({
        "aws_cost": F.col("billable_chars") / million * F.lit(prices.per_million_chars),
        "openai_cost": chat,
    })


def estimate_cost(
    df: DataFrame,
    roles=None,
    tokens: str | Tokenizer = "words075",
    prices: Prices = Prices(),
    sample: int | None = None,
    order_by=("row_idx",),
) -> DataFrame:
    """Counters and costs of a corpus, or of the first `sample` rows of each split, as one row."""
    measured = df if sample is None else first_rows(df, sample, order_by)
    return price(cost_counters(measured, roles, tokens), prices)


def verdict(costs: DataFrame, aws: str = "aws_cost", openai: str = "openai_cost") -> DataFrame:
    """Add which service is cheaper, by how much, and the savings in percent of the dearer one."""
    a, o = F.col(aws), F.col(openai)
    dearer = F.greatest(a, o)
    return costs.withColumns({
        "cheaper": F.when(a == o, "equal").when(a < o, "aws").otherwise("openai"),
        "cost_diff": F.abs(a - o),
        "savings_pct": F.when(dearer > 0, F.abs(a - o) / F.nullif(dearer, F.lit(0.0)) * F.lit(100.0)).otherwise(0.0),
    })


def extrapolate_cost(
    df: DataFrame,
    sample: int,
    roles=None,
    tokens: str | Tokenizer = "words075",
    prices: Prices = Prices(),
    order_by=("row_idx",),
    mode: str = "corrected",
) -> DataFrame:
    """Cost of the whole corpus from the first `sample` rows of each split.

    `reference` multiplies the sample's costs (free tier already taken off) by all rows / sample, once
    for all splits. `corrected` scales each split's counters by its own rows / sampled rows, then takes
    off the free tier and prices. Either way a sample no smaller than the corpus is not scaled.
    """
    sampled = first_rows(df, sample, order_by)
    in_sample = F.least(F.col("n_rows"), F.lit(sample))
    sizes = split_counts(df)
    if mode == "reference":
        rows = sizes.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
        # Each side is one row; the maximum over both puts them side by side.
        both = cost_counters(sampled, roles, tokens).unionByName(rows, allowMissingColumns=True)
        costs = price(both.agg(*[F.max(c).alias(c) for c in both.columns]), prices)
        factor = F.when(F.col("n_rows") > sample, F.col("n_rows") / F.lit(sample)).otherwise(1.0)
        costs = costs.withColumn("factor", factor).withColumns({
            "aws_cost": F.col("aws_cost") * F.col("factor"),
            "openai_cost": F.col("openai_cost") * F.col("factor"),
        })
    elif mode == "corrected":
        scaled = {c: F.sum(F.col(c) * F.col("n_rows") / in_sample) for c in COUNTERS}
        totals = sizes.join(split_counters(sampled, roles, tokens), [CONFIG, SPLIT], "left").agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
            (F.sum("n_rows") / F.sum(in_sample)).alias("factor"),
            *[F.round(F.coalesce(c, F.lit(0.0))).cast("bigint").alias(name) for name, c in scaled.items()],
        )
        costs = price(totals, prices)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return verdict(costs.select("n_rows", "factor", "aws_cost", "openai_cost"))
