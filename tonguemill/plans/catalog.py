"""The queries of the driver contract: each operator over the whole of the driver's tables."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tonguemill import functions as fn
from tonguemill.operators import batching, cost, memo, progress, projection, sampling, segments
from tonguemill.operators.translate import Settings, translate_columns, translate_packed
from tonguemill.operators.translator import FunctionTranslator
from tonguemill.plans.translation_run import TranslationRun
from tonguemill.session import materialize, scratch_path
from tonguemill.sources import corpus, positions, sinks
from tonguemill.sources.corpus import CONFIG, RANGE, ROW, SPLIT
from tonguemill.streaming.incremental import once_per_key, read_new_files, translate_stream

Query = Callable[[SparkSession, str], DataFrame]

COST_ROLES = {"source": projection.SYSTEM, "text": projection.TEXT}
SAMPLE_ROWS = 5
CHUNK_ROWS = 100
CHUNKS_PER_FOLDER = 4
CHUNKS_PER_WAVE = 40
GUARD_TOKENS = 600
TAG = "[es] "
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _tag(text: str) -> str:
    return TAG + text


def _tag_each(text: str) -> str:
    """Tags every text of a packed request, as a translator would translate each of them."""
    return TAG + text.replace(batching.DELIMITER, batching.DELIMITER + TAG)


def _refuse_sevens(text: str) -> str:
    if "7" in text:
        raise ValueError("a service that refuses texts with a seven")
    return TAG + text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one split per language and source."""
    return corpus.as_corpus(table(spark, sf_dir, "documents"), "lang", "source").drop("lang", "n_chars")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one split per language, most rows in one of them, and stored positions."""
    docs = corpus.as_corpus(table(spark, sf_dir, "documents"), "lang").select(CONFIG, SPLIT, "doc_id", "text")
    return positions.position_by_key(docs, ["doc_id"])


def turn_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as short texts, one split per role, in reading order."""
    turns = corpus.as_corpus(table(spark, sf_dir, "conversations"), split="role")
    return positions.position_by_key(turns, ["conv_id", "turn"])


def conversation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as Python literals, a whole one in each cell, as rows of a chat corpus hold them."""
    turn = F.struct("turn", F.struct(F.col("role").alias("from"), F.col("text").alias("value")).alias("said"))
    cells = (
        corpus.as_corpus(table(spark, sf_dir, "conversations"))
        .groupBy(CONFIG, SPLIT, "conv_id")
        .agg(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["said"]).alias("conversations"))
    )
    return projection.stringify(cells, ["conversations"])


def _text_cells(rows: DataFrame) -> DataFrame:
    return rows.select(
        CONFIG, SPLIT, ROW, F.lit("text").alias("col"), F.lit(projection.TEXT).alias("role"), "text"
    )


def _numbered_parts(df: DataFrame, parts, name: str) -> DataFrame:
    return df.select("doc_id", F.posexplode(parts).alias("k", name)).withColumn("k", F.col("k").cast("bigint"))


# Sources and sinks


def corpus_scan(spark, sf_dir):
    return documents(spark, sf_dir).select(CONFIG, SPLIT, "doc_id", "text")


def config_select(spark, sf_dir):
    chosen = corpus.select_configs(documents(spark, sf_dir), corpus.name_list("en,es", trim=False))
    return chosen.select(CONFIG, SPLIT, "doc_id")


def config_list(spark, sf_dir):
    return corpus.list_configs(documents(spark, sf_dir))


def split_list(spark, sf_dir):
    return corpus.list_splits(documents(spark, sf_dir))


def column_list(spark, sf_dir):
    return corpus.list_columns(documents(spark, sf_dir).select(CONFIG, SPLIT, "doc_id", "text"))


def split_counts(spark, sf_dir):
    return corpus.split_counts(documents(spark, sf_dir))


def chunk_stage(spark, sf_dir):
    path = scratch_path(spark, "staging")
    sinks.stage_chunks(languages(spark, sf_dir), path, CHUNK_ROWS, chunks_per_folder=CHUNKS_PER_FOLDER)
    return corpus.read_corpus(spark, path).select(CONFIG, SPLIT, "chunk_id", ROW, "doc_id", "text")


def manifest(spark, sf_dir):
    path = scratch_path(spark, "data")
    sinks.write_splits(languages(spark, sf_dir), path)
    return sinks.manifest(corpus.read_corpus(spark, path), ["text"])


# Projections and predicates


def column_select(spark, sf_dir):
    wanted = corpus.name_list("text, source, no_such_column")
    return projection.select_columns(documents(spark, sf_dir), wanted)


def non_null_values(spark, sf_dir):
    return projection.non_null_values(documents(spark, sf_dir), ["doc_id"], COST_ROLES)


def translatable_rows(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.where(projection.translatable("text")).select(CONFIG, SPLIT, "doc_id", "text")


def stringify_values(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    return projection.stringify(docs, ["doc_id", "n_chars", "text"])


def chunk_assign(spark, sf_dir):
    placed = positions.position_by_key(documents(spark, sf_dir).select(CONFIG, SPLIT, "doc_id"), ["doc_id"])
    return positions.assign_chunks(placed, 10)


def role_counts(spark, sf_dir):
    return projection.role_counts(documents(spark, sf_dir), COST_ROLES)


# Text functions


def text_lengths(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", fn.char_length("text").alias("n_chars"), fn.byte_length("text").alias("n_bytes"))


def token_counts(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id",
        fn.word_count("text").alias("n_words"),
        fn.words075("text").alias("words075"),
        fn.chars4("text").alias("chars4"),
    )


def conv_value_chars(spark, sf_dir):
    chars = fn.conversation_value_chars("conversations").alias("value_chars")
    return conversation_cells(spark, sf_dir).select("conv_id", chars)


def strip_text(spark, sf_dir):
    stripped = F.transform(fn.split_literal("text", "."), fn.strip_text)
    return _numbered_parts(documents(spark, sf_dir), stripped, "stripped")


def sentence_split(spark, sf_dir):
    return _numbered_parts(documents(spark, sf_dir), fn.sentences("text"), "sentence")


def _pieces(spark, sf_dir, policy):
    pieces = segments.explode_pieces(documents(spark, sf_dir), ["doc_id"], "text", policy)
    return pieces.withColumns({c: F.col(c).cast("bigint") for c in ("seg", "sub")})


def byte_segments(spark, sf_dir):
    return _pieces(spark, sf_dir, segments.bytes_policy())


def char_slices(spark, sf_dir):
    return _pieces(spark, sf_dir, segments.chars_policy()).select("doc_id", "seg", "piece")


def segment_rejoin(spark, sf_dir):
    policy = segments.bytes_policy()
    return segments.rejoin_pieces(_pieces(spark, sf_dir, policy), ["doc_id"], policy)


# Cost


def cost_chars(spark, sf_dir):
    counters = cost.cost_counters(documents(spark, sf_dir), COST_ROLES)
    return counters.select("total_chars", "conversation_chars", "other_chars")


def cost_system_unique(spark, sf_dir):
    return cost.unique_prompts(documents(spark, sf_dir), COST_ROLES)


def cost_conversation_chars(spark, sf_dir):
    counters = cost.cost_counters(conversation_cells(spark, sf_dir), ["conversations"])
    return counters.select("total_chars", "conversation_chars")


def conv_value_tokens(spark, sf_dir):
    return cost.value_tokens(conversation_cells(spark, sf_dir), ["conv_id"], "conversations")


def cost_tokens(spark, sf_dir):
    """Token counters with the text as plain text and as (unreadable) conversations."""
    docs = documents(spark, sf_dir)
    names = ("total_tokens", "regular_input_tokens", "cached_input_tokens", "output_tokens")
    by_role = [
        cost.cost_counters(docs, {**COST_ROLES, "text": role}).select(F.lit(role).alias("text_role"), *names)
        for role in (projection.TEXT, projection.CONVERSATION)
    ]
    return by_role[0].unionByName(by_role[1])


def _rounded(costs: DataFrame, *names: str) -> DataFrame:
    return costs.withColumns({n: F.round(n, 6) for n in names})


def cost_estimate(spark, sf_dir):
    return _rounded(cost.estimate_cost(documents(spark, sf_dir), COST_ROLES), "aws_cost", "openai_cost")


def cost_verdict(spark, sf_dir):
    costs = cost.verdict(cost.estimate_cost(documents(spark, sf_dir), COST_ROLES))
    names = ("aws_cost", "openai_cost", "cost_diff", "savings_pct")
    return _rounded(costs.select("cheaper", *names), *names)


def cost_by_split(spark, sf_dir):
    return cost.split_counters(documents(spark, sf_dir), COST_ROLES)


def cost_extrapolated(spark, sf_dir):
    docs = documents(spark, sf_dir)
    by_mode = [
        cost.extrapolate_cost(docs, SAMPLE_ROWS, COST_ROLES, order_by=["doc_id"], mode=mode).withColumn(
            "mode", F.lit(mode)
        )
        for mode in ("reference", "corrected")
    ]
    names = ("factor", "aws_cost", "openai_cost", "cost_diff", "savings_pct")
    return _rounded(by_mode[0].unionByName(by_mode[1]), *names)


def sample_first_n(spark, sf_dir):
    return sampling.first_rows(documents(spark, sf_dir), SAMPLE_ROWS, ["doc_id"]).select(CONFIG, SPLIT, "doc_id")


# Translation


def memo_join(spark, sf_dir):
    """Every piece of every source name and text with its reply; the few source names are hot."""
    settings = Settings(FunctionTranslator(_tag)).with_memo(spark)
    cells = projection.non_null_values(documents(spark, sf_dir), ["doc_id"], COST_ROLES)
    keys = ["doc_id", "col"]
    pieces = memo.with_digest(segments.explode_pieces(cells, keys, "value", settings.policy))
    index = materialize(pieces.drop("piece"))
    memo.fill_memo(pieces, settings.translator, settings.policy, settings.memo)
    replies = settings.memo.read(spark, memo.scope_of(settings.translator, settings.policy))
    hot = memo.hot_texts(index, share=0.01, min_rows=1)
    found = memo.look_up(index, replies, [*keys, "seg", "sub"], hot)
    numbers = {c: F.col(c).cast("bigint") for c in ("seg", "sub")}
    return found.withColumns(numbers).select(*keys, "seg", "sub", "translated", "status")


def translate_text_column(spark, sf_dir):
    docs = documents(spark, sf_dir).select(CONFIG, SPLIT, "doc_id", "text")
    return translate_columns(docs, ["doc_id"], Settings(FunctionTranslator(_tag)), ["text"], with_status=True)


def token_guard(spark, sf_dir):
    policy = segments.chars_policy(max_tokens=GUARD_TOKENS)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return translate_columns(docs, ["doc_id"], Settings(FunctionTranslator(_tag), policy), ["text"], with_status=True)


def translate_conversation(spark, sf_dir):
    cells = conversation_cells(spark, sf_dir)
    done = translate_columns(cells, ["conv_id"], Settings(FunctionTranslator(_tag)), ["conversations"])
    turns = done.select("conv_id", F.inline(fn.conversation_values("conversations")))
    return turns.withColumn("pos", F.col("pos").cast("bigint"))


def batch_groups(spark, sf_dir):
    grouped = batching.group_cells(_text_cells(turn_corpus(spark, sf_dir)))
    return batching.pack_groups(grouped).drop("col", "members")


def batch_roundtrip(spark, sf_dir):
    settings = Settings(FunctionTranslator(_tag_each), batching=batching.Batching())
    done = translate_packed(_text_cells(turn_corpus(spark, sf_dir)), settings)
    return done.select(CONFIG, SPLIT, ROW, "translated", "status")


def uniform_batches(spark, sf_dir):
    """Source names as system prompts, rows in order of source: long runs of one prompt."""
    docs = corpus.as_corpus(table(spark, sf_dir, "documents"), "lang").select(CONFIG, SPLIT, "source", "doc_id")
    placed = positions.position_by_key(docs, ["source", "doc_id"])
    return batching.uniform_batches(placed.withColumnRenamed("source", "text"), 20)


def _translation_run(spark, sf_dir, chunks_per_wave: int = CHUNKS_PER_WAVE) -> TranslationRun:
    placed, path = languages(spark, sf_dir), scratch_path(spark, "corpus")
    rows_per_file = CHUNK_ROWS * CHUNKS_PER_WAVE  # a range of waves is a range of files
    sinks.write_splits(placed, path, rows_per_file=rows_per_file)
    stored = StructType([*placed.schema.fields, StructField(RANGE, StringType())])
    rows = spark.read.schema(stored).parquet(path).select(*placed.columns, RANGE)
    return TranslationRun(
        rows,
        scratch_path(spark, "run"),
        Settings(FunctionTranslator(_tag)),
        ["text"],
        chunk_size=CHUNK_ROWS,
        chunks_per_wave=chunks_per_wave,
        rows_per_file=rows_per_file,
    )


def chunk_progress(spark, sf_dir):
    run = _translation_run(spark, sf_dir)
    run.translate()
    return run.progress.read(spark).drop("attempt", "fingerprint", "finished_at")


def pending_chunks(spark, sf_dir):
    """What a run that stopped after its first wave has left to do."""
    run = _translation_run(spark, sf_dir, chunks_per_wave=4)
    run.translate(max_waves=1)
    return progress.pending_chunks(run.chunks(), run.progress.read_run(spark, run.fingerprint))


def finalize_split(spark, sf_dir):
    return _translation_run(spark, sf_dir).run().select(CONFIG, SPLIT, ROW, "doc_id", "text")


def resume_to_end(spark, sf_dir):
    """A run that stopped after its first wave, finished in waves of another size."""
    first = _translation_run(spark, sf_dir, chunks_per_wave=4)
    first.translate(max_waves=1)
    return replace(first, chunks_per_wave=CHUNKS_PER_WAVE).run().select(CONFIG, SPLIT, ROW, "doc_id", "text")


def smoke_run(spark, sf_dir):
    """The smoke test of a run: ten rows of each split of the first config, in chunks of five."""
    settings = Settings(FunctionTranslator(_tag))
    run = TranslationRun.smoke(languages(spark, sf_dir), scratch_path(spark, "smoke"), settings, ["text"])
    return run.run().select(CONFIG, SPLIT, ROW, "doc_id", "text")


def _refusing() -> Settings:
    return Settings(FunctionTranslator(_refuse_sevens), replace(segments.bytes_policy(), backoff=0.0))


def failed_rows(spark, sf_dir):
    """The failures of a run whose service refuses some texts."""
    run = replace(_translation_run(spark, sf_dir), settings=_refusing())
    run.run()
    return run.failed()


def retry_attempts(spark, sf_dir):
    """How many distinct pieces took how many attempts, by outcome."""
    settings = _refusing().with_memo(spark)
    pieces = segments.explode_pieces(documents(spark, sf_dir), ["doc_id"], "text", settings.policy)
    memo.fill_memo(memo.with_digest(pieces), settings.translator, settings.policy, settings.memo)
    replies = settings.memo.read(spark, memo.scope_of(settings.translator, settings.policy))
    attempts = F.col("attempts").cast("bigint").alias("attempts")
    return replies.groupBy("status", attempts).agg(F.count(F.lit(1)).alias("n_pieces"))


def incremental_translate(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "stream")
    schema = table(spark, sf_dir, "documents").select("doc_id", "text").schema
    # A glob, as a plain path must be a folder: the table may be one file or a folder of many.
    stream = read_new_files(spark, f"{sf_dir}/documents.parque[t]", schema)
    settings = Settings(FunctionTranslator(_tag))
    translate_stream(stream, ["doc_id"], settings, out, checkpoint, ["text"]).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "text", "text_status")


# Cells that are missing or empty, files that are broken, keys that come twice: the same tables, made so


def with_gaps(spark, sf_dir) -> DataFrame:
    """Documents of which every seventh has no text, and the one after it an empty one; sources likewise by elevens."""
    by_seven, by_eleven = F.col("doc_id") % 7, F.col("doc_id") % 11

    def holed(column: str, rest: Column) -> Column:
        return F.when(rest == 0, None).when(rest == 1, "").otherwise(F.col(column))

    return documents(spark, sf_dir).withColumns({"text": holed("text", by_seven), "source": holed("source", by_eleven)})


def non_null_values_with_gaps(spark, sf_dir):
    return projection.non_null_values(with_gaps(spark, sf_dir), ["doc_id"], COST_ROLES)


def translatable_with_gaps(spark, sf_dir):
    docs = with_gaps(spark, sf_dir)
    return docs.where(projection.translatable("text")).select(CONFIG, SPLIT, "doc_id", "text")


def translate_with_gaps(spark, sf_dir):
    """Two columns, with nulls and empty strings in both."""
    docs = with_gaps(spark, sf_dir).select("doc_id", "source", "text")
    return translate_columns(docs, ["doc_id"], Settings(FunctionTranslator(_tag)), ["source", "text"], with_status=True)


def positions_in_files(spark, sf_dir):
    """Positions found again from the files of written splits alone."""
    path = scratch_path(spark, "data")
    sinks.write_splits(languages(spark, sf_dir), path, rows_per_file=64)
    return positions.position_in_files(corpus.read_corpus(spark, path).drop(ROW)).select(CONFIG, SPLIT, ROW, "doc_id")


def unreadable_files(spark, sf_dir):
    """What came of the files of a folder in which one is no Parquet file at all, and how many rows the others gave."""
    path = scratch_path(spark, "files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce("lang", F.lit("default")).alias("lang"))
    docs.write.partitionBy("lang").parquet(path)  # each task writes what it reads, whatever a language's share
    broken = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/lang=broken/part-0.parquet")
    file = broken.getFileSystem(spark._jsc.hadoopConfiguration()).create(broken, True)
    file.writeBytes("this is no Parquet file, whatever its name says")
    file.close()
    rows, outcomes = corpus.read_files(spark, [(None, None, path)])
    lang = F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang")
    judged = outcomes.groupBy(lang, "status").agg(F.sum("n_rows").alias("n_rows"))
    found = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("").alias("lang"), F.lit("rows").alias("status"), "n_rows")
    return judged.unionByName(found)


def bpe_tokens(spark, sf_dir):
    """Byte-pair tokens of every document, by a vocabulary file that goes to the executors with the job."""
    tokens = fn.bpe(fn.Vocabulary(VOCABULARY).ship(spark))
    return documents(spark, sf_dir).select("doc_id", tokens("text").alias("n_tokens"))


def cost_conversation_tokens(spark, sf_dir):
    """Token counters of whole conversations as Python literals."""
    counters = cost.cost_counters(conversation_cells(spark, sf_dir), ["conversations"])
    return counters.select("total_tokens", "regular_input_tokens", "cached_input_tokens", "output_tokens")


def preserved_separators(spark, sf_dir):
    """Documents cut small by a policy that keeps what stood between the pieces, and put together from untouched replies."""
    policy = segments.bytes_policy(limit=400, preserve_separators=True)
    pieces = segments.explode_pieces(documents(spark, sf_dir), ["doc_id"], "text", policy)
    parts = F.collect_list(F.struct(*segments.piece_fields(policy), "piece"))
    largest = F.max(F.octet_length("piece"))
    return pieces.groupBy("doc_id").agg(segments.joined_text(parts, policy).alias("text"), (largest <= policy.limit).alias("fits"))


def calls_without_memo(spark, sf_dir):
    """Calls made for the turns when equal texts share a reply, and when each is sent by itself."""
    turns = _text_cells(turn_corpus(spark, sf_dir)).where(projection.translatable("text"))
    keys = [CONFIG, SPLIT, ROW, "col"]
    out = []
    for shared in (True, False):
        settings = Settings(FunctionTranslator(_tag), share_replies=shared).with_memo(spark)
        places = () if shared else (*keys, "seg", "sub")
        pieces = memo.with_digest(segments.explode_pieces(turns, keys, "text", settings.policy), places)
        folders = memo.fill_memo(pieces, settings.translator, settings.policy, settings.memo)
        calls = memo.read_replies(spark, folders).agg(F.sum("attempts").alias("n_calls"))
        out.append(calls.select(F.lit(shared).alias("shared"), "n_calls"))
    return out[0].unionByName(out[1])


def memo_hits(spark, sf_dir):
    """Which texts a second wave finds in the memo that a first one, over the odd documents, has filled."""
    settings = Settings(FunctionTranslator(_tag)).with_memo(spark)
    policy = settings.policy
    pieces = memo.with_digest(segments.explode_pieces(documents(spark, sf_dir), ["doc_id"], "text", policy))
    pieces = materialize(pieces, "pieces")
    memo.fill_memo(pieces.where("doc_id % 2 = 1"), settings.translator, policy, settings.memo)
    later = pieces.where("doc_id % 2 = 0")
    folders = settings.memo.holding(later, settings.memo.commits(spark, memo.scope_of(settings.translator, policy)))
    known = memo.read_replies(spark, folders).select("text_hash", F.lit(True).alias("known"))
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("seg", "sub")]
    return later.join(known, "text_hash", "left").select("doc_id", *numbers, F.coalesce("known", F.lit(False)).alias("known"))


class _Gauge:
    """Replies with the number of calls going on in its process, and waits a little, so that others may begin."""

    going = 0

    def __call__(self, text: str) -> str:
        with _gauge_lock():
            _Gauge.going += 1
            now = _Gauge.going
        time.sleep(0.002)
        with _gauge_lock():
            _Gauge.going -= 1
        return str(now)


@lru_cache(maxsize=1)
def _gauge_lock() -> threading.Lock:
    return threading.Lock()


def calls_in_flight(spark, sf_dir):
    """The turns' texts called one at a time and up to ten at a time in a task: whether the bound holds, and is used."""
    turns = memo.with_digest(table(spark, sf_dir, "conversations").select(F.col("text").alias("piece")).where("text <> ''"))
    out = []
    for most in (1, 10):
        settings = Settings(FunctionTranslator(_Gauge())).with_memo(spark)
        folders = memo.fill_memo(turns, settings.translator, settings.policy, settings.memo, concurrency=4, in_flight=most)
        going = F.max(F.col("translated").cast("int"))
        seen = memo.read_replies(spark, folders).agg(
            F.count(F.lit(1)).alias("n_calls"), (going <= most).alias("within"), (going > 1).alias("overlapped"))
        out.append(seen.select(F.lit(most).cast("bigint").alias("in_flight"), "n_calls", "within", "overlapped"))
    return out[0].unionByName(out[1])


def finished_ranges(spark, sf_dir):
    """The union of two sets of finished chunks of other sizes, some of which overlap or touch."""
    placed = languages(spark, sf_dir)
    tens = positions.plan_chunks(placed, 10).where("chunk_id % 3 <> 2")
    fifteens = positions.plan_chunks(placed, 15).where("chunk_id % 4 = 1")
    return progress.finished_ranges(tens.unionByName(fifteens))


def published_snapshot(spark, sf_dir):
    """What readers see of a run whose second publication stopped half-way: the first, of the splits complete by then."""
    run = _translation_run(spark, sf_dir, chunks_per_wave=1)
    run.translate(max_waves=1)
    run.finalize()
    replace(run, chunks_per_wave=CHUNKS_PER_WAVE).translate()
    run._write_version()  # and stops before the version is marked as whole
    return run.output().select(CONFIG, SPLIT, ROW, "doc_id", "text")


def stream_once_per_key(spark, sf_dir):
    """Documents of which most arrive twice under the same keys: what a stream hands on."""
    source, out, checkpoint = (scratch_path(spark, name) for name in ("in", "out", "stream"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    for part in (docs.where("doc_id % 3 <> 0"), docs):
        part.write.mode("append").parquet(source)
        stream = once_per_key(read_new_files(spark, source, docs.schema), ["doc_id"], time_out="7 days")
        translate_stream(stream, ["doc_id"], Settings(FunctionTranslator(_tag)), out, checkpoint, ["text"]).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "text", "text_status")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        corpus_scan, config_select, split_list, column_list, split_counts, chunk_stage, manifest,
        column_select, non_null_values, translatable_rows, stringify_values, chunk_assign, role_counts,
        text_lengths, token_counts, conv_value_chars, strip_text, sentence_split, byte_segments, char_slices,
        segment_rejoin, cost_chars, cost_system_unique, cost_conversation_chars, conv_value_tokens, cost_tokens,
        cost_estimate, cost_verdict, cost_by_split, cost_extrapolated, sample_first_n, memo_join, translate_text_column,
        token_guard, translate_conversation, batch_groups, batch_roundtrip, uniform_batches, chunk_progress,
        pending_chunks, finalize_split, resume_to_end, smoke_run, failed_rows, retry_attempts, config_list,
        incremental_translate, non_null_values_with_gaps, translatable_with_gaps, translate_with_gaps, positions_in_files,
        unreadable_files, cost_conversation_tokens, preserved_separators, calls_without_memo, memo_hits, calls_in_flight,
        finished_ranges, published_snapshot, stream_once_per_key,
    )
}
# Queries that SQL cannot express; tests hold them against brute force.
UNORACLED: dict[str, Query] = {"bpe_tokens": bpe_tokens}
