"""Translating columns: cut, look up, call, rejoin."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonguemill.functions.literals import conversation_values, py_str, rebuild_conversation
from tonguemill.operators.batching import (
    GROUP,
    Batching,
    group_cells,
    pack_groups,
    returned_cells,
    unpack_replies,
    unpacked_cells,
)
from tonguemill.operators.memo import HOT_SHARE, Memo, answer, hot_texts, look_up, with_digest
from tonguemill.operators.projection import CONVERSATION, Roles, translatable, translation_roles
from tonguemill.operators.segments import Policy, bytes_policy, explode_pieces, joined_text, piece_fields
from tonguemill.operators.translator import TRANSLATED, UNCHANGED, Translator
from tonguemill.session import materialize, materialize_at, scratch_path
from tonguemill.sources.corpus import CONFIG, ROW, SPLIT


@dataclass(frozen=True)
class Settings:
    """What a translation run needs besides the rows."""

    translator: Translator
    policy: Policy = field(default_factory=bytes_policy)
    memo: Memo | None = None
    batching: Batching | None = None
    concurrency: int | None = None
    memo_slices: int = 1
    null_conversation: str = "keep"  # or "empty": a missing conversation becomes an empty string
    hot_share: float = HOT_SHARE
    hot_min_rows: int = 1
    in_flight: int = 1  # calls at a time in each task
    share_replies: bool = True  # False: every piece is sent by itself, and nothing is kept for later calls

    def with_memo(self, spark) -> Settings:
        if self.share_replies:
            return self if self.memo else replace(self, memo=Memo.temporary(spark))
        return replace(self, memo=Memo.temporary(spark))


def translate_cells(
    cells: DataFrame, keys: Sequence[str], settings: Settings, place_by: Sequence[str] | None = None
) -> DataFrame:
    """Translate (keys, text) rows of non-empty text: (keys, translated, status).

    Only digests and positions travel with the keys; texts go through `distinct` to the translator and
    come back from the memo. The pieces are written before any call is made: texts are cut once, and
    the calls, the hot-text count and the join all see the same pieces.
    """
    spark = cells.sparkSession
    settings = settings.with_memo(spark)
    policy = settings.policy
    places = () if settings.share_replies else (*keys, "seg", "sub")
    pieces = with_digest(explode_pieces(cells, keys, "text", policy), places).withColumn("blank", F.col("piece") == "")
    stored = scratch_path(spark, "pieces")
    pieces = materialize_at(pieces, stored)
    index = pieces.drop("piece")
    answers = answer(
        pieces, settings.translator, policy, settings.memo, settings.concurrency, settings.memo_slices, settings.in_flight, stored
    )
    replies = answers.read(spark).drop("attempts")
    hot = hot_texts(index, settings.hot_share, settings.hot_min_rows)
    found = look_up(index, replies, [*keys, "seg", "sub"], hot)
    # Only the empty piece of a blank text has no reply; any other that is missing must not become an empty text.
    lost = F.raise_error(F.lit("the memo has no reply for a piece that was sent")).cast("string")
    reply = F.when(F.col("blank"), F.coalesce("translated", F.lit(""))).otherwise(F.coalesce("translated", lost))
    parts = F.collect_list(F.struct(*piece_fields(policy), reply.alias("reply")))
    # The worst outcome comes first in the alphabet: failed, skipped_tokens, translated.
    status = F.coalesce(F.min("status"), F.lit(TRANSLATED))
    # Placing pieces by the row's key once serves this grouping and the caller's join back to the row.
    placed = found.repartition(*(place_by or keys))
    return placed.groupBy(*keys).agg(
        joined_text(parts, policy, "reply").alias("translated"), status.alias("status")
    )


def translate_packed(cells: DataFrame, settings: Settings) -> DataFrame:
    """Translate (config, split, row_idx, col, role, text) cells, packing short neighbours.

    First the combined texts, then one by one whatever was not packed or did not come apart again.
    """
    settings = settings.with_memo(cells.sparkSession)
    # A packed request must be a single one, so it may not exceed the limit at which the policy cuts.
    batching = replace(settings.batching, limit=min(settings.batching.limit, settings.policy.limit))
    grouped = materialize(group_cells(cells, batching), "grouped")
    packed = pack_groups(grouped, batching)
    sent = materialize(packed.drop("n_bytes"), "packed")
    combined = sent.where("eligible").select(*GROUP, F.col("combined").alias("text"))
    replies = translate_cells(combined, GROUP, settings).withColumnRenamed("translated", "reply")
    unpacked = materialize(unpack_replies(sent.drop("combined").join(replies, [*GROUP], "left")), "unpacked")
    one_by_one = returned_cells(unpacked).unionByName(
        grouped.where(F.col("group_id").isNull()).select(CONFIG, SPLIT, "col", ROW, "text")
    )
    key = (CONFIG, SPLIT, ROW, "col")
    alone = translate_cells(one_by_one, key, settings)
    together = unpacked_cells(unpacked, "status").withColumnRenamed("text", "translated")
    return alone.unionByName(together)


def _text_cells(df: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("col"), F.lit(role).alias("role"), F.col(c).alias("text"))
        for c, role in columns.items()
    ]
    return df.select(*keys, F.inline(F.array(*entries)))


def _turn_cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per spoken value of every conversation: (keys, col, pos, text)."""
    entries = [F.struct(F.lit(c).alias("col"), conversation_values(c).alias("turns")) for c in columns]
    return df.select(*keys, F.inline(F.array(*entries))).select(
        *keys, "col", F.inline("turns").alias("pos", "text")
    )


def _nulls_in_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any key holds a null. Keys that two rows share are refused, before any call is made."""
    null = F.lit(False)
    for key in keys:
        null = null | F.col(key).isNull()
    each = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = each.agg(F.max("_n").alias("most"), F.bool_or(null).alias("nulls")).first()
    if (found.most or 0) > 1:
        raise ValueError(f"{list(keys)} do not identify a row")
    return bool(found.nulls)


def _with_news(source: DataFrame, news: DataFrame, keys: Sequence[str], nulls: bool) -> DataFrame:
    """Left join on the keys; where they hold nulls, these match too."""
    if not nulls:  # a plain join reuses the exchange of the grouping
        return source.join(news, list(keys), "left")
    renamed = news.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [source[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys]
    return source.join(renamed, same, "left")


def translate_columns(
    df: DataFrame,
    keys: Sequence[str],
    settings: Settings,
    roles: Roles | Sequence[str] | None = None,
    with_status: bool = False,
) -> DataFrame:
    """Replace the chosen columns by their translation; every row and every other column stays.

    `keys` identify a row, which is checked; they may be null. Nulls, empty strings and whatever could not be translated keep their
    value. Conversations have only their `value` strings translated. With `with_status` each
    translated column gets a `<column>_status`.
    """
    settings = settings.with_memo(df.sparkSession)
    chosen = translation_roles(df, roles)
    spoken = [c for c, role in chosen.items() if role == CONVERSATION]
    texts = {c: role for c, role in chosen.items() if role != CONVERSATION}
    key = list(keys)
    nulls = _nulls_in_keys(df, key) if chosen else False
    source = df.withColumns({c: py_str(c, df.schema[c].dataType) for c in spoken}) if spoken else df
    if settings.null_conversation == "empty":
        source = source.withColumns({c: F.coalesce(c, F.lit("")) for c in spoken})

    cells = []
    results = []
    if texts and settings.batching and settings.policy.kind == "bytes":
        if not {CONFIG, SPLIT, ROW} == set(key):
            raise ValueError("packing needs rows identified by config, split and row_idx")
        results.append(translate_packed(_text_cells(source, key, texts), settings).withColumn("pos", F.lit(-1)))
    elif texts:
        plain = _text_cells(source, key, texts).where(translatable("text"))
        cells.append(plain.select(*key, "col", F.lit(-1).alias("pos"), "text"))
    if spoken:
        # Parsing literals is the dear part of this path; do it once.
        turns = materialize(_turn_cells(source, key, spoken), "turns")
        cells.append(turns.where(translatable("text")))
    if cells:
        together = cells[0] if len(cells) == 1 else cells[0].unionByName(cells[1])
        results.append(translate_cells(together, [*key, "col", "pos"], settings, place_by=key))
    if not results:
        return df
    found = results[0] if len(results) == 1 else results[0].unionByName(results[1])

    def mine(column: str, value: Column) -> Column:
        return F.when(F.col("col") == column, value)

    turn = F.struct("pos", F.col("translated").alias("value"))
    news = [F.max(mine(c, F.col("translated"))).alias(f"_new_{c}") for c in texts]
    news += [F.array_sort(F.collect_list(mine(c, turn))).alias(f"_new_{c}") for c in spoken]
    states = [F.min(mine(c, F.col("status"))).alias(f"_status_{c}") for c in chosen]
    # Of a text that was sent, only that it was travels to the join; nulls and empty texts go as they are.
    sent = {f"_sent_{c}": F.coalesce(translatable(c), F.lit(False)) for c in texts}
    light = source.withColumns(sent).withColumns({c: F.when(~F.col(f"_sent_{c}"), F.col(c)) for c in texts})
    joined = _with_news(light, found.groupBy(*key).agg(*news, *states), key, nulls)
    lost = F.raise_error(F.lit("a text that was sent has no result")).cast("string")
    replaced = {
        c: F.when(F.col(f"_sent_{c}"), F.coalesce(f"_new_{c}", lost)).otherwise(F.coalesce(f"_new_{c}", c)) for c in texts
    }
    replaced |= {c: rebuild_conversation(c, f"_new_{c}") for c in spoken}
    reported = {f"{c}_status": F.coalesce(f"_status_{c}", F.lit(UNCHANGED)) for c in chosen if with_status}
    return joined.withColumns(replaced | reported).select(*df.columns, *reported)
