"""Corpora: rows under a config and a split, read from Parquet or taken from a table."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonguemill.session import materialize

CONFIG, SPLIT, ROW = "config", "split", "row_idx"
RANGE = "row_range"  # folders of a written split, by first position
# Names used where the corpus has none.
DEFAULT_CONFIG, DEFAULT_SPLIT = "default", "train"


def _named(name: str | Column | None, default: str) -> Column:
    if name is None:
        return F.lit(default)
    column = F.col(name) if isinstance(name, str) else name
    return F.coalesce(column.cast("string"), F.lit(default))


def as_corpus(df: DataFrame, config: str | Column | None = None, split: str | Column | None = None) -> DataFrame:
    """Give a table its config and split columns; missing ones get the default names."""
    if config is None and CONFIG in df.columns:
        config = CONFIG
    if split is None and SPLIT in df.columns:
        split = SPLIT
    return df.withColumns({CONFIG: _named(config, DEFAULT_CONFIG), SPLIT: _named(split, DEFAULT_SPLIT)})


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """Read `root/config=.../split=.../*.parquet`. Config and split filters prune folders.

    Folders of ranges within a split are no column of the corpus.
    """
    discovered = spark.read.parquet(root).schema
    # Partition values are names: keep '01' from becoming the number 1.
    fields = [
        T.StructField(f.name, T.StringType()) if f.name in (CONFIG, SPLIT) else f for f in discovered.fields if f.name != RANGE
    ]
    return as_corpus(spark.read.schema(T.StructType(fields)).parquet(root).drop(RANGE))


def read_entries(spark: SparkSession, entries: Iterable[tuple[str | None, str | None, str]]) -> DataFrame:
    """Union of (config, split, path) entries. An entry that cannot be opened is reported and skipped."""
    parts = []
    for config, split, path in entries:
        try:
            part = spark.read.parquet(path)
        except AnalysisException as error:
            warnings.warn(f"skipping config {config or DEFAULT_CONFIG!r}: {error.getCondition()} {path}", stacklevel=2)
            continue
        parts.append(
            part.withColumns({
                CONFIG: F.lit(config or DEFAULT_CONFIG),
                SPLIT: F.lit(split or DEFAULT_SPLIT),
            })
        )
    if not parts:
        raise ValueError("none of the entries could be read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


FILE_OUTCOMES = "config string, split string, path string, n_bytes bigint, n_rows bigint, status string, error string"
READABLE, UNREADABLE = "readable", "unreadable"


def read_files(
    spark: SparkSession, entries: Iterable[tuple[str | None, str | None, str]], schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, outcomes) of (config, split, path) entries: a file that cannot be read costs its own rows alone.

    Outcomes have one row per Parquet file, with its rows or with what is wrong with it. All pages are read once for
    that, so a file that breaks off half-way is unreadable as a whole. Files without a single byte are passed over, as in any
    scan. Without `schema` it is that of the readable files of an entry, taken together.
    """
    rows, outcomes = [], []
    for config, split, path in entries:
        names = {CONFIG: F.lit(config or DEFAULT_CONFIG), SPLIT: F.lit(split or DEFAULT_SPLIT)}
        part = _tolerant(spark, path, schema)
        judged = _file_outcomes(spark, path, part).withColumns(names)
        judged = materialize(judged.select(*[f.split()[0] for f in FILE_OUTCOMES.split(", ")]), "outcomes")
        outcomes.append(judged)
        if part is not None:
            bad = judged.where(F.col("status") == UNREADABLE).select(F.col("path").alias("_bad"))
            placed = part.select("*", _file().alias("_path"))
            rows.append(placed.join(bad, F.col("_path") == F.col("_bad"), "left_anti").drop("_path").withColumns(names))
    if not rows:
        raise ValueError("none of the files could be read")
    return (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows),
        reduce(lambda a, b: a.unionByName(b), outcomes),
    )


def _file() -> Column:
    return F.col("_metadata.file_path")


def _tolerant(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame | None:
    """Whatever can be read of the Parquet files below a path; None if nothing tells their columns."""
    reader = spark.read.options(ignoreCorruptFiles="true", recursiveFileLookup="true", pathGlobFilter="*.parquet")
    try:
        return (reader.schema(schema) if schema else reader.option("mergeSchema", "true")).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _file_outcomes(spark: SparkSession, path: str, part: DataFrame | None) -> DataFrame:
    """path, n_bytes, n_rows, status and error of each Parquet file below a path."""
    listing = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet")
    try:
        files = listing.load(path).select(_file().alias("path"), F.col("length").alias("n_bytes"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lost = [(path, None, 0, UNREADABLE, error.getCondition())]
        return spark.createDataFrame(lost, "path string, n_bytes bigint, n_rows bigint, status string, error string")
    if part is None:
        counted = files.withColumns({c: F.lit(None).cast("bigint") for c in ("promised", "delivered")})
    else:
        # Footers promise rows; whether the pages deliver them shows when all columns are read.
        promised = part.select(_file().alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("promised"))
        read = part.select(_file().alias("path"), F.xxhash64(F.to_json(F.struct(*part.columns))).alias("_read"))
        # The sum is kept, or no column would need to be read for the count.
        delivered = read.groupBy("path").agg(F.count(F.lit(1)).alias("delivered"), F.bit_xor("_read").alias("_sum"))
        counted = files.join(promised, "path", "left").join(delivered, "path", "left")
    counted = materialize(counted, "files")
    silent = [r.path for r in counted.where("promised IS NULL").select("path").collect()]  # names, as any scan lists them
    broken = _broken_footers(spark, silent)
    short = F.when(F.coalesce("delivered", F.lit(0)) < F.col("promised"), F.lit("the file breaks off after some rows"))
    error = F.coalesce("error", short)
    return counted.join(broken, "path", "left").select(
        "path", "n_bytes", F.when(error.isNull(), F.coalesce("promised", F.lit(0))).otherwise(0).alias("n_rows"),
        F.when(error.isNull(), READABLE).otherwise(UNREADABLE).alias("status"), error.alias("error"),
    )


def _broken_footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, error) of files whose footer cannot be read; a file without rows that is otherwise sound is none of them."""
    schema = "path string, error string"
    if not paths:
        return spark.createDataFrame([], schema)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    pq.read_metadata(pa.BufferReader(content.as_buffer()))
                except Exception as error:  # noqa: BLE001 - whatever is wrong with the file is the answer
                    found.append({"path": path, "error": str(error)})
            yield pa.RecordBatch.from_pylist(found, pa.schema([("path", pa.string()), ("error", pa.string())]))

    files = spark.read.format("binaryFile").load(list(paths)).select(_file().alias("path"), "content")
    return files.mapInArrow(look, schema)


def list_configs(df: DataFrame) -> DataFrame:
    return df.select(CONFIG).distinct()


def list_splits(df: DataFrame) -> DataFrame:
    return df.select(CONFIG, SPLIT).distinct()


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split. Partial counts leave each task, so one large split costs nothing extra."""
    return df.groupBy(CONFIG, SPLIT).agg(F.count(F.lit(1)).alias("n_rows"))


def name_list(text: str | None, trim: bool = True) -> list[str] | None:
    """A comma-separated option. Trimming also drops empty names; without it names are kept as typed."""
    if not text:
        return None
    names = text.split(",")
    return [n.strip() for n in names if n.strip()] if trim else names


def select_configs(df: DataFrame, configs: Sequence[str] | None) -> DataFrame:
    """Keep the named configs; all of them if none are named."""
    return df.where(F.col(CONFIG).isin(list(configs))) if configs else df


def configs_at(available: Sequence[str], choice: str) -> list[str]:
    """Names picked by ordinals ('0,2') or 'all'. Ordinals out of range are dropped."""
    if choice.strip().lower() == "all":
        return list(available)
    wanted = [int(part.strip()) for part in choice.split(",")]
    return [available[i] for i in wanted if 0 <= i < len(available)]


def data_columns(df: DataFrame) -> list[str]:
    """Columns a user may pick: from the schema alone, no row is read."""
    return [c for c in df.columns if c not in (CONFIG, SPLIT, ROW)]


def present_columns(df: DataFrame, wanted: Sequence[str] | None) -> list[str]:
    """The wanted columns the table has, in the wanted order; the others are skipped silently."""
    available = data_columns(df)
    return available if not wanted else [c for c in dict.fromkeys(wanted) if c in available]


def list_columns(df: DataFrame) -> DataFrame:
    """One row per split and column, with the number of values that are not null.

    After a union by name a split may lack a column, which shows here as zero values.
    """
    columns = data_columns(df)
    counts = df.groupBy(CONFIG, SPLIT).agg(*[F.count(F.col(c)).alias(c) for c in columns])
    entries = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("ordinal"), F.lit(c).alias("column"), F.col(c).alias("n_values"))
        for i, c in enumerate(columns)
    ])
    return counts.select(CONFIG, SPLIT, F.inline(entries))
