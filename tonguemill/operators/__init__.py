from tonguemill.operators.batching import Batching, group_cells, pack_groups, uniform_batches, unpack_replies
from tonguemill.operators.cost import (
    Prices,
    cost_counters,
    estimate_cost,
    extrapolate_cost,
    price,
    split_counters,
    unique_prompts,
    value_tokens,
    verdict,
)
from tonguemill.operators.memo import Memo, fill_memo, hot_texts, look_up, read_replies
from tonguemill.operators.progress import (
    ProgressTable,
    chunk_progress,
    finished_ranges,
    outside,
    pending_chunks,
    split_progress,
)
from tonguemill.operators.projection import (
    cost_roles,
    non_null_values,
    role_counts,
    select_columns,
    stringify,
    translatable,
    translation_roles,
)
from tonguemill.operators.sampling import first_rows, smoke_rows
from tonguemill.operators.segments import Policy, bytes_policy, chars_policy, explode_pieces, rejoin_pieces
from tonguemill.operators.translate import Settings, translate_cells, translate_columns, translate_packed
from tonguemill.operators.translator import FunctionTranslator, Translator

__all__ = [
    "Batching", "FunctionTranslator", "Memo", "Policy", "Prices", "ProgressTable", "Settings", "Translator",
    "bytes_policy", "chars_policy", "chunk_progress", "cost_counters", "cost_roles", "estimate_cost",
    "explode_pieces", "extrapolate_cost", "fill_memo", "finished_ranges", "first_rows", "group_cells", "hot_texts", "look_up",
    "non_null_values", "outside", "pack_groups", "pending_chunks", "price", "read_replies", "rejoin_pieces", "role_counts", "select_columns",
    "smoke_rows", "split_counters", "split_progress", "stringify", "translatable", "translate_cells",
    "translate_columns", "translate_packed", "translation_roles", "uniform_batches", "unique_prompts",
    "unpack_replies", "value_tokens", "verdict",
]
