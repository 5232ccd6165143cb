"""The same queries as plain SQL for DuckDB, written from the semantics and not from the Spark plans."""

from __future__ import annotations

# Python's white space as SQL text and as a regular-expression class.
_WS = "||".join(f"chr({ord(c)})" for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0     　")
_WS += "||" + "||".join(f"chr({c})" for c in range(0x2000, 0x200B))
_WS_RUN = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

_DOCS = """docs AS (
    SELECT coalesce(lang, 'default') AS config, coalesce(source, 'train') AS split, doc_id, text, source FROM documents
)"""
_LANGUAGES = """placed AS (
    SELECT coalesce(lang, 'default') AS config, 'train' AS split, doc_id, text,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS row_idx FROM documents
)"""
_TURNS = """placed AS (
    SELECT 'default' AS config, role AS split, text,
           row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS row_idx FROM conversations
)"""


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _words(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, '{_WS_RUN}'), lambda w: w <> ''))"


def _sentences(source: str) -> str:
    """(k0, k, x) for rows (k0, text): sentences with their period, numbered from 1."""
    return f"""parts AS (
    SELECT k0, unnest(found) AS s, generate_subscripts(found, 1) AS i FROM (
        SELECT k0, flatten(list_transform(string_split(text, chr(10)||chr(10)), lambda p: string_split(p, '. ')))
                   AS found FROM {source})
), sents AS (
    SELECT k0, row_number() OVER (PARTITION BY k0 ORDER BY i) AS k, {_strip('s')} || '.' AS x
    FROM parts WHERE {_strip('s')} <> ''
)"""


def _byte_pieces(base: str) -> str:
    """WITH list whose last table is pieces(k0, seg, sub, piece, cut) for the SELECT `base` of (k0, text)."""
    return f"""RECURSIVE base AS ({base}),
longs AS (SELECT * FROM base WHERE strlen(text) > 9900),
{_sentences('longs')},
packed AS (
    SELECT k0, k, 0::BIGINT AS seg, strlen(x) + 1 AS filled FROM sents WHERE k = 1
    UNION ALL
    SELECT n.k0, n.k,
           CASE WHEN p.filled + strlen(n.x) + 1 <= 9900 THEN p.seg ELSE p.seg + 1 END,
           CASE WHEN p.filled + strlen(n.x) + 1 <= 9900 THEN p.filled ELSE 0 END + strlen(n.x) + 1
    FROM packed p JOIN sents n ON n.k0 = p.k0 AND n.k = p.k + 1
),
segs AS (
    SELECT p.k0, p.seg, string_agg(s.x, ' ' ORDER BY p.k) AS piece
    FROM packed p JOIN sents s ON s.k0 = p.k0 AND s.k = p.k GROUP BY p.k0, p.seg
),
pieces AS (
    SELECT k0, 0::BIGINT AS seg, 0::BIGINT AS sub, text AS piece, 'whole' AS cut FROM base WHERE strlen(text) <= 9900
    UNION ALL
    SELECT k0, 0, 0, '', 'segment' FROM longs WHERE k0 NOT IN (SELECT k0 FROM sents)
    UNION ALL
    SELECT k0, seg, 0, piece, 'segment' FROM segs WHERE strlen(piece) <= 9900
    UNION ALL
    SELECT k0, seg, i, substr(piece, i * 2475 + 1, 2475), 'hard_cut'
    FROM (SELECT *, unnest(range(0, ceil(length(piece) / 2475)::BIGINT)) AS i FROM segs WHERE strlen(piece) > 9900)
)"""


def _rejoin(reply: str) -> str:
    glue = "CASE WHEN seg > 0 AND sub = 0 THEN ' ' ELSE '' END"
    joined = f"string_agg({glue} || {reply}, '' ORDER BY seg, sub)"
    return f"CASE WHEN any_value(cut) = 'whole' THEN {joined} ELSE {_strip(joined)} END"


_TAGGED = "CASE WHEN piece = '' THEN '' ELSE '[es] ' || piece END"

_CHAR_PIECES = """slices AS (
    SELECT doc_id, i AS seg, substr(text, i * 8000 + 1, 8000) AS piece FROM (
        SELECT doc_id, text, unnest(range(0, greatest(1, ceil(length(text) / 8000))::BIGINT)) AS i FROM documents)
)"""


def _counters(rows: str, by: str = "") -> str:
    """Counter columns over rows(prompt, system_chars, system_tokens, other_chars, plain_tokens, turn_*)."""
    return f"""SELECT {by} coalesce(sum(system_chars + conversation_chars + other_chars), 0)::BIGINT AS total_chars,
        coalesce(sum(once_chars), 0)::BIGINT AS system_unique_chars,
        coalesce(sum(once), 0)::BIGINT AS system_unique_prompts,
        coalesce(sum(conversation_chars), 0)::BIGINT AS conversation_chars,
        coalesce(sum(other_chars), 0)::BIGINT AS other_chars,
        coalesce(sum(system_tokens + plain_tokens + turn_tokens), 0)::BIGINT AS total_tokens,
        coalesce(sum(once_tokens + plain_tokens + turn_tokens * 33 // 100), 0)::BIGINT AS regular_input_tokens,
        coalesce(sum(system_tokens - once_tokens), 0)::BIGINT AS cached_input_tokens,
        coalesce(sum(turn_tokens - turn_tokens * 33 // 100), 0)::BIGINT AS output_tokens
    FROM {rows}"""


def _measured(source: str, text_role: str = "text") -> str:
    """Per document: its numbers, and its source's once if it is the source's first document in split order."""
    plain = text_role == "text"
    return f"""(
    SELECT config, split, length(source) AS system_chars, {_words('source')} * 4 // 3 AS system_tokens,
           {'0' if plain else 'length(text)'} AS conversation_chars, {'length(text)' if plain else '0'} AS other_chars,
           {_words('text') + ' * 4 // 3' if plain else '0'} AS plain_tokens,
           {'0' if plain else _words('text') + ' * 4 // 3'} AS turn_tokens,
           CASE WHEN nth = 1 THEN 1 ELSE 0 END AS once,
           CASE WHEN nth = 1 THEN length(source) ELSE 0 END AS once_chars,
           CASE WHEN nth = 1 THEN {_words('source')} * 4 // 3 ELSE 0 END AS once_tokens
    FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY config, split, doc_id) AS nth FROM {source}))"""


_PRICED = """greatest(0, total_chars - 2000000)::BIGINT AS billable_chars,
    greatest(0, total_chars - 2000000)::DOUBLE / 1000000::DOUBLE * 15::DOUBLE AS aws,
    regular_input_tokens / 1000000::DOUBLE * 0.15::DOUBLE + cached_input_tokens / 1000000::DOUBLE * 0.075::DOUBLE
        + output_tokens / 1000000::DOUBLE * 0.6::DOUBLE AS openai"""
_VERDICT = """CASE WHEN aws = openai THEN 'equal' WHEN aws < openai THEN 'aws' ELSE 'openai' END AS cheaper,
    round(aws, 6) AS aws_cost, round(openai, 6) AS openai_cost, round(abs(aws - openai), 6) AS cost_diff,
    round(CASE WHEN greatest(aws, openai) > 0 THEN abs(aws - openai) / greatest(aws, openai) * 100 ELSE 0 END, 6)
        AS savings_pct"""

_SAMPLED = """sampled AS (
    SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY config, split ORDER BY doc_id) <= 5
), sizes AS (SELECT config, split, count(*) AS n_rows FROM docs GROUP BY ALL)"""


def _groups(placed: str) -> str:
    """groups(...): packed requests over placed(config, split, row_idx, text); members(...) its texts."""
    return f"""{placed},
batches AS (
    SELECT *, row_idx // 100 AS chunk_id, row_idx % 100 // 64 AS map_batch,
           count(text) OVER (PARTITION BY config, split, row_idx // 100, row_idx % 100 // 64) AS n_texts
    FROM placed
), members AS (
    SELECT *, (row_number() OVER (PARTITION BY config, split, chunk_id, map_batch ORDER BY row_idx) - 1) // 5
              AS group_id FROM batches WHERE n_texts > 1 AND text <> ''
), groups AS (
    SELECT config, split, chunk_id, map_batch, group_id, count(*) AS n,
           (sum(strlen(text)) + 19 * (count(*) - 1))::BIGINT AS n_bytes,
           count(*) > 1 AND max(length(text)) <= 1500 AND sum(strlen(text)) + 19 * (count(*) - 1) <= 9900 AS eligible,
           string_agg(text, ' |||TRANS-SPLIT||| ' ORDER BY row_idx) AS combined
    FROM members GROUP BY ALL
)"""


_CHUNKS = f"""WITH {_LANGUAGES}
    SELECT config, split, row_idx // 100 AS chunk_id, min(row_idx) AS row_start, max(row_idx) + 1 AS row_end,
           count(*) AS n_rows"""
_TRANSLATED_DOCS = f"""WITH {_byte_pieces('SELECT doc_id AS k0, text FROM documents')},
done AS (SELECT k0 AS doc_id, {_rejoin(_TAGGED)} AS text FROM pieces GROUP BY k0)"""

_GAPS = """holed AS (
    SELECT coalesce(lang, 'default') AS config, coalesce(source, 'train') AS split, doc_id,
           CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS text,
           CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE source END AS source FROM documents
)"""
# A conversation as a Python literal: only blanks matter for its words, so which quotes stand round a value does not.
_LITERALS = r"""literals AS (
    SELECT conv_id, '[' || string_agg('{''from'': ''' || role || ''', ''value'': ''' ||
        replace(replace(replace(text, chr(10), '\n'), chr(9), '\t'), chr(13), '\r') || '''}', ', ' ORDER BY turn) || ']' AS line
    FROM conversations GROUP BY conv_id
)"""

ORACLE: dict[str, str] = {
    "corpus_scan": f"WITH {_DOCS} SELECT config, split, doc_id, text FROM docs",
    "config_select": f"WITH {_DOCS} SELECT config, split, doc_id FROM docs WHERE config IN ('en', 'es')",
    "split_list": f"WITH {_DOCS} SELECT DISTINCT config, split FROM docs",
    "column_list": f"""WITH {_DOCS}
        SELECT config, split, 0::BIGINT AS ordinal, 'doc_id' AS "column", count(doc_id) AS n_values FROM docs GROUP BY 1, 2
        UNION ALL
        SELECT config, split, 1, 'text', count(text) FROM docs GROUP BY 1, 2""",
    "split_counts": f"WITH {_DOCS} SELECT config, split, count(*) AS n_rows FROM docs GROUP BY 1, 2",
    "chunk_stage": f"""WITH {_LANGUAGES}
        SELECT config, split, row_idx // 100 AS chunk_id, row_idx, doc_id, text FROM placed""",
    "manifest": f"""WITH {_LANGUAGES}
        SELECT config, split, count(*) AS n_rows, sum(strlen(text))::BIGINT AS n_bytes,
               'data/config=' || config || '/split=' || split AS path FROM placed GROUP BY 1, 2""",
    "column_select": f"WITH {_DOCS} SELECT config, split, text, source FROM docs",
    "non_null_values": """
        SELECT doc_id, 'source' AS col, 'system' AS role, source AS value FROM documents WHERE source IS NOT NULL
        UNION ALL
        SELECT doc_id, 'text', 'text', text FROM documents WHERE text IS NOT NULL""",
    "translatable_rows": f"WITH {_DOCS} SELECT config, split, doc_id, text FROM docs WHERE text <> ''",
    "stringify_values": """
        SELECT doc_id::VARCHAR AS doc_id, n_chars::VARCHAR AS n_chars, text FROM documents""",
    "chunk_assign": f"""WITH {_DOCS}, placed AS (
            SELECT *, row_number() OVER (PARTITION BY config, split ORDER BY doc_id) - 1 AS row_idx FROM docs)
        SELECT config, split, doc_id, row_idx, row_idx // 10 AS chunk_id FROM placed""",
    "role_counts": """
        SELECT 'source' AS col, 'system' AS role, count(source) AS n_values,
               count(*) FILTER (source <> '') AS n_translatable, sum(length(source))::BIGINT AS n_chars FROM documents
        UNION ALL
        SELECT 'text', 'text', count(text), count(*) FILTER (text <> ''), sum(length(text))::BIGINT FROM documents""",
    "text_lengths": "SELECT doc_id, length(text) AS n_chars, strlen(text) AS n_bytes FROM documents",
    "token_counts": f"""
        SELECT doc_id, {_words('text')}::BIGINT AS n_words, ({_words('text')} * 4 // 3)::BIGINT AS words075,
               (length(text) // 4)::BIGINT AS chars4 FROM documents""",
    "conv_value_chars": """
        SELECT conv_id, sum(length(text))::BIGINT AS value_chars FROM conversations GROUP BY 1""",
    "conv_value_tokens": f"""
        SELECT conv_id, sum({_words('text')} * 4 // 3)::BIGINT AS value_tokens
        FROM conversations WHERE text <> '' GROUP BY 1""",
    "strip_text": f"""
        SELECT doc_id, (unnest(range(1, len(parts) + 1)) - 1)::BIGINT AS k, {_strip('unnest(parts)')} AS stripped
        FROM (SELECT doc_id, string_split(text, '.') AS parts FROM documents)""",
    "sentence_split": f"""WITH base AS (SELECT doc_id AS k0, text FROM documents), {_sentences('base')}
        SELECT k0 AS doc_id, k - 1 AS k, x AS sentence FROM sents""",
    "byte_segments": f"""WITH {_byte_pieces('SELECT doc_id AS k0, text FROM documents')}
        SELECT k0 AS doc_id, seg, sub, piece, cut FROM pieces""",
    "char_slices": f"WITH {_CHAR_PIECES} SELECT doc_id, seg, piece FROM slices",
    "segment_rejoin": f"""WITH {_byte_pieces('SELECT doc_id AS k0, text FROM documents')}
        SELECT k0 AS doc_id, {_rejoin('piece')} AS text FROM pieces GROUP BY k0""",
    "cost_chars": f"""WITH {_DOCS}, counted AS ({_counters(_measured('docs'))})
        SELECT total_chars, conversation_chars, other_chars FROM counted""",
    "cost_system_unique": """
        SELECT count(DISTINCT source) AS system_unique_prompts,
               (SELECT sum(length(source)) FROM (SELECT DISTINCT source FROM documents))::BIGINT AS system_unique_chars
        FROM documents""",
    "cost_conversation_chars": """
        SELECT sum(length(text))::BIGINT AS total_chars, sum(length(text))::BIGINT AS conversation_chars
        FROM conversations""",
    "cost_tokens": f"""WITH {_DOCS}, counted AS (
            SELECT 'text' AS text_role, * FROM ({_counters(_measured('docs'))})
            UNION ALL
            SELECT 'conversation', * FROM ({_counters(_measured('docs', 'conversation'))}))
        SELECT text_role, total_tokens, regular_input_tokens, cached_input_tokens, output_tokens FROM counted""",
    "cost_estimate": f"""WITH {_DOCS}, counted AS ({_counters(_measured('docs'))}), priced AS (
            SELECT *, {_PRICED} FROM counted)
        SELECT * EXCLUDE (aws, openai), round(aws, 6) AS aws_cost, round(openai, 6) AS openai_cost FROM priced""",
    "cost_verdict": f"""WITH {_DOCS}, counted AS ({_counters(_measured('docs'))}), priced AS (
            SELECT *, {_PRICED} FROM counted)
        SELECT {_VERDICT} FROM priced""",
    "cost_by_split": f"""WITH {_DOCS}
        {_counters(_measured('docs'), 'config, split,')} GROUP BY config, split""",
    "cost_extrapolated": f"""WITH {_DOCS}, {_SAMPLED},
        whole AS ({_counters(_measured('sampled'))}),
        per_split AS ({_counters(_measured('sampled'), 'config, split,')} GROUP BY config, split),
        total AS (SELECT sum(n_rows)::BIGINT AS n_rows, sum(n_rows) / sum(least(n_rows, 5)) AS factor FROM sizes),
        scaled AS (
            SELECT round(sum(total_chars * n_rows / least(n_rows, 5)))::BIGINT AS total_chars,
                   round(sum(regular_input_tokens * n_rows / least(n_rows, 5)))::BIGINT AS regular_input_tokens,
                   round(sum(cached_input_tokens * n_rows / least(n_rows, 5)))::BIGINT AS cached_input_tokens,
                   round(sum(output_tokens * n_rows / least(n_rows, 5)))::BIGINT AS output_tokens
            FROM per_split JOIN sizes USING (config, split)),
        costs AS (
            SELECT 'reference' AS mode, n_rows, f AS factor, aws * f AS aws, openai * f AS openai FROM (
                SELECT {_PRICED}, n_rows, CASE WHEN n_rows > 5 THEN n_rows / 5 ELSE 1 END AS f FROM whole, total)
            UNION ALL
            SELECT 'corrected', n_rows, factor, aws, openai FROM (SELECT {_PRICED}, n_rows, factor FROM scaled, total))
        SELECT mode, n_rows, round(factor, 6) AS factor, {_VERDICT} FROM costs""",
    "sample_first_n": f"WITH {_DOCS}, {_SAMPLED} SELECT config, split, doc_id FROM sampled",
    "memo_join": f"""WITH {_byte_pieces('''
            SELECT {'doc_id': doc_id, 'col': 'source'} AS k0, source AS text FROM documents
            UNION ALL SELECT {'doc_id': doc_id, 'col': 'text'}, text FROM documents''')}
        SELECT k0.doc_id AS doc_id, k0.col AS col, seg, sub, '[es] ' || piece AS translated, 'translated' AS status
        FROM pieces""",
    "translate_text_column": f"""{_TRANSLATED_DOCS}
        SELECT coalesce(lang, 'default') AS config, coalesce(source, 'train') AS split, d.doc_id, done.text,
               'translated' AS text_status FROM documents d JOIN done USING (doc_id)""",
    "token_guard": f"""WITH {_CHAR_PIECES}, guarded AS (
            SELECT *, 46 + length(piece) // 4 > 600 AS skipped FROM slices)
        SELECT doc_id,
               string_agg(CASE WHEN skipped THEN piece ELSE {_strip("'[es] ' || piece")} END, '' ORDER BY seg) AS text,
               CASE WHEN bool_or(skipped) THEN 'skipped_tokens' ELSE 'translated' END AS text_status
        FROM guarded GROUP BY doc_id""",
    "translate_conversation": f"""WITH {_byte_pieces(
            "SELECT {'conv_id': conv_id, 'turn': turn} AS k0, text FROM conversations WHERE text <> ''")}
        SELECT k0.conv_id AS conv_id, k0.turn AS pos, {_rejoin(_TAGGED)} AS value
        FROM pieces GROUP BY k0""",
    "batch_groups": f"WITH {_groups(_TURNS)} SELECT * FROM groups",
    "batch_roundtrip": f"""WITH {_groups(_TURNS)}
        SELECT config, split, row_idx,
               CASE WHEN eligible THEN {_strip("'[es] ' || text")} ELSE '[es] ' || text END AS translated,
               'translated' AS status
        FROM members JOIN groups USING (config, split, chunk_id, map_batch, group_id)
        UNION ALL
        SELECT config, split, row_idx, '[es] ' || text, 'translated' FROM batches WHERE n_texts = 1 AND text <> ''""",
    "uniform_batches": """WITH placed AS (
            SELECT coalesce(lang, 'default') AS config, 'train' AS split, source,
                   row_number() OVER (PARTITION BY lang ORDER BY source, doc_id) - 1 AS row_idx FROM documents)
        SELECT config, split, row_idx // 20 AS chunk_id, 0::BIGINT AS map_batch, count(*) AS n_rows,
               count(DISTINCT source) = 1 AND min(source) <> '' AS uniform FROM placed GROUP BY 1, 2, 3""",
    "chunk_progress": f"{_CHUNKS}, 0::BIGINT AS n_failed, 'done' AS status FROM placed GROUP BY 1, 2, 3",
    "pending_chunks": f"{_CHUNKS} FROM placed GROUP BY 1, 2, 3 HAVING row_idx // 100 >= 4",
    "finalize_split": f"""{_TRANSLATED_DOCS}, {_LANGUAGES}
        SELECT config, split, row_idx, doc_id, done.text FROM placed JOIN done USING (doc_id)""",
    "resume_to_end": f"""{_TRANSLATED_DOCS}, {_LANGUAGES}
        SELECT config, split, row_idx, doc_id, done.text FROM placed JOIN done USING (doc_id)""",
    "smoke_run": f"""{_TRANSLATED_DOCS}, {_LANGUAGES}
        SELECT config, split, row_idx, doc_id, done.text FROM placed JOIN done USING (doc_id)
        WHERE config = (SELECT min(config) FROM placed) AND row_idx < 10""",
    "failed_rows": f"""WITH {_LANGUAGES}
        SELECT config, split, row_idx, 'text' AS "column", 'failed' AS status FROM placed WHERE contains(text, '7')""",
    "retry_attempts": f"""WITH {_byte_pieces('SELECT doc_id AS k0, text FROM documents')}
        SELECT CASE WHEN contains(piece, '7') THEN 'failed' ELSE 'translated' END AS status,
               CASE WHEN contains(piece, '7') THEN 3 ELSE 1 END::BIGINT AS attempts, count(DISTINCT piece) AS n_pieces
        FROM pieces WHERE piece <> '' GROUP BY 1, 2""",
    "config_list": f"WITH {_DOCS} SELECT DISTINCT config FROM docs",
    "incremental_translate": f"{_TRANSLATED_DOCS} SELECT doc_id, text, 'translated' AS text_status FROM done",
    "non_null_values_with_gaps": f"""WITH {_GAPS}
        SELECT doc_id, 'source' AS col, 'system' AS role, source AS value FROM holed WHERE source IS NOT NULL
        UNION ALL SELECT doc_id, 'text', 'text', text FROM holed WHERE text IS NOT NULL""",
    "translatable_with_gaps": f"WITH {_GAPS} SELECT config, split, doc_id, text FROM holed WHERE text <> ''",
    "translate_with_gaps": f"""{_TRANSLATED_DOCS}, {_GAPS}
        SELECT h.doc_id, CASE WHEN h.text <> '' THEN done.text ELSE h.text END AS text,
               CASE WHEN h.source <> '' THEN '[es] ' || h.source ELSE h.source END AS source,
               CASE WHEN h.text <> '' THEN 'translated' ELSE 'unchanged' END AS text_status,
               CASE WHEN h.source <> '' THEN 'translated' ELSE 'unchanged' END AS source_status
        FROM holed h LEFT JOIN done USING (doc_id)""",
    "positions_in_files": f"WITH {_LANGUAGES} SELECT config, split, row_idx, doc_id FROM placed",
    "unreadable_files": """
        SELECT coalesce(lang, 'default') AS lang, 'readable' AS status, count(*) AS n_rows FROM documents GROUP BY 1
        UNION ALL SELECT 'broken', 'unreadable', 0 UNION ALL SELECT '', 'rows', count(*) FROM documents""",
    "cost_conversation_tokens": f"""WITH {_LITERALS}, counted AS (SELECT {_words('line')} * 4 // 3 AS t FROM literals)
        SELECT sum(t)::BIGINT AS total_tokens, sum(t * 33 // 100)::BIGINT AS regular_input_tokens,
               0::BIGINT AS cached_input_tokens, sum(t - t * 33 // 100)::BIGINT AS output_tokens FROM counted""",
    "preserved_separators": "SELECT doc_id, text, true AS fits FROM documents",
    "calls_without_memo": f"""WITH {_byte_pieces(
            "SELECT {'conv_id': conv_id, 'turn': turn} AS k0, text FROM conversations WHERE text <> ''")}
        SELECT true AS shared, count(DISTINCT piece) AS n_calls FROM pieces WHERE piece <> ''
        UNION ALL SELECT false, count(*) FROM pieces WHERE piece <> ''""",
    "memo_hits": f"""WITH {_byte_pieces('SELECT doc_id AS k0, text FROM documents')}
        SELECT k0 AS doc_id, seg, sub, piece <> '' AND piece IN (SELECT piece FROM pieces WHERE k0 % 2 = 1) AS known
        FROM pieces WHERE k0 % 2 = 0""",
    "calls_in_flight": """WITH c AS (SELECT count(DISTINCT text) AS n FROM conversations WHERE text <> '')
        SELECT 1::BIGINT AS in_flight, n AS n_calls, true AS within, false AS overlapped FROM c
        UNION ALL SELECT 10, n, true, true FROM c""",
    "finished_ranges": f"""WITH {_LANGUAGES}, done AS (
            SELECT config, split, row_idx, row_idx - row_number() OVER (PARTITION BY config, split ORDER BY row_idx) AS island
            FROM placed WHERE row_idx // 10 % 3 <> 2 OR row_idx // 15 % 4 = 1)
        SELECT config, split, min(row_idx) AS row_start, max(row_idx) + 1 AS row_end, count(*) AS n_positions
        FROM done GROUP BY config, split, island""",
    "published_snapshot": f"""{_TRANSLATED_DOCS}, {_LANGUAGES}, sized AS (
            SELECT *, count(*) OVER (PARTITION BY config, split) AS n FROM placed)
        SELECT config, split, row_idx, doc_id, done.text FROM sized JOIN done USING (doc_id) WHERE n <= 100""",
    "stream_once_per_key": f"{_TRANSLATED_DOCS} SELECT doc_id, text, 'translated' AS text_status FROM done",
}
