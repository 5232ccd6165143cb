"""Translating new corpus files as they arrive, each row once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tonguemill.functions.text import text_digest
from tonguemill.operators.memo import Memo
from tonguemill.operators.projection import Roles
from tonguemill.operators.translate import Settings, translate_columns
from tonguemill.session import materialize, scratch_area


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType, name_filter: str | None = None, max_files: int | None = None
) -> DataFrame:
    """A stream over the Parquet files of a folder; each file is seen once. A glob may name folders and single files."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


# Column of a stream that `once_per_key` adds and takes away.
ARRIVED = "_arrived"


def once_per_key(stream: DataFrame, keys: Sequence[str], texts: Sequence[str] = (), time_out: str | None = None) -> DataFrame:
    """Rows whose key no earlier row of the stream had; later ones are skipped, also in later files and after a restart.

    With `texts`, a row is skipped only if those columns repeat as well; their digests, not the texts, are the state. The state is
    keyed and checkpointed by Spark, one entry a key. `time_out` (such as `7 days`) forgets a key so long after it was seen, which
    bounds the state by the rows of that time; a key that comes back later is then a new one. Null keys are keys like others.
    """
    digests = {f"_digest_{t}": text_digest(t) for t in texts}
    state = [*keys, *digests]
    keyed = stream.withColumns(digests) if digests else stream
    if time_out is None:
        return keyed.dropDuplicates(state).drop(*digests)
    arrived = keyed.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, time_out)
    return arrived.dropDuplicatesWithinWatermark(state).drop(ARRIVED, *digests)


def translate_stream(
    stream: DataFrame,
    keys: Sequence[str],
    settings: Settings,
    out: str,
    checkpoint: str,
    roles: Roles | Sequence[str] | None = None,
) -> StreamingQuery:
    """Translate all rows the stream has not delivered yet, then stop.

    Every micro-batch replaces its own folder `batch=<id>`, so a batch repeated after a failure
    leaves one copy of its rows; its finished calls are in the memo and are not made again. A batch is written
    before it is translated: its rows are used more than once, and the stream's state is read and kept once.
    """
    if settings.memo is None:
        settings = replace(settings, memo=Memo(f"{checkpoint}/memo"))

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_area(batch.sparkSession):
            rows = materialize(batch, "batch")
            translated = translate_columns(rows, keys, settings, roles, with_status=True)
            translated.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
