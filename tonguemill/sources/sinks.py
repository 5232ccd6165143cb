"""Writing chunks, final splits and the manifest."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tonguemill.session import folders_in, remove
from tonguemill.sources.corpus import CONFIG, RANGE, ROW, SPLIT
from tonguemill.sources.positions import assign_chunks

# Characters that Spark escapes in names of partition folders, the escape mark first.
ESCAPED = "%\"#'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))


@cache
def _folder_name(name: str) -> str:
    """A config's or split's name as it is written in a path, as SQL."""
    sql = name
    for mark in ESCAPED:
        sql = f"replace({sql}, char({ord(mark)}), '%{ord(mark):02X}')"
    return sql


def _partition(name: str) -> Column:
    return F.concat(F.lit(f"{name}="), F.expr(_folder_name(name)))


def _with_names(df: DataFrame) -> DataFrame:
    """Refuses empty names: as a folder they would be read back as no name at all."""

    def named(column: str) -> Column:
        nameless = F.raise_error(F.lit(f"a {column} without a name cannot be a folder")).cast("string")
        return F.when(F.col(column) != "", F.col(column)).otherwise(nameless)

    return df.withColumns({c: named(c) for c in (CONFIG, SPLIT)})


def stage_chunks(df: DataFrame, path: str, chunk_size: int, chunks_per_folder: int = 1) -> None:
    """Write rows under `path/config=/split=/chunk_group=`, replacing only the groups that `df` holds.

    A group is `chunks_per_folder` consecutive chunks. One chunk per folder is the unit that small
    corpora want; at scale a folder per hundred rows would drown the file system, so raise the number
    (or the chunk size) until a group fills a file or more. The group follows from `row_idx` and groups are dealt
    by a hash, so nothing is sampled, `df` is evaluated once, and a large split spreads over all tasks.
    """
    group = F.floor(F.col("chunk_id") / F.lit(chunks_per_folder)).cast("bigint")
    keys = (CONFIG, SPLIT, "chunk_group")
    (
        assign_chunks(_with_names(df), chunk_size)
        .withColumn("chunk_group", group)
        .repartition(*keys)
        .sortWithinPartitions(*keys, ROW)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


# Digits of a folder's first position, so that folders sort by name as by position.
RANGE_DIGITS = 12


def range_name(first: int) -> str:
    """Name of the folder of the rows from position `first` on."""
    return str(first).zfill(RANGE_DIGITS)


def _with_range(df: DataFrame, rows_per_file: int) -> DataFrame:
    first = F.floor(F.col(ROW) / F.lit(rows_per_file)).cast("bigint") * rows_per_file
    return _with_names(df).withColumn(RANGE, F.lpad(first.cast("string"), RANGE_DIGITS, "0"))


def write_splits(df: DataFrame, path: str, n_partitions: int | None = None, rows_per_file: int = 100_000) -> None:
    """Write `path/config=/split=/row_range=/` with rows in position order.

    A split becomes a folder of ranges of `rows_per_file` positions. Which range a row goes to follows from its
    `row_idx`, and ranges are dealt by a hash: nothing is sampled, `df` is evaluated once, no task holds a whole
    large split, and a later filter on `row_idx` skips files by their statistics. A split that was there before
    is replaced whole.
    """
    ranged = _with_range(df, rows_per_file)
    keys = (CONFIG, SPLIT, RANGE)
    dealt = ranged.repartition(n_partitions, *keys) if n_partitions else ranged.repartition(*keys)
    _write_ranges(dealt, path)


def publish_splits(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """As `write_splits`, for rows that stored files already hold in ranges of positions: no exchange.

    Each task writes what it reads, sorted by itself. Ranges that several files share get a file from each.
    """
    _write_ranges(_with_range(df, rows_per_file), path)


def _write_ranges(ranged: DataFrame, path: str) -> None:
    spark = ranged.sparkSession
    keys = (CONFIG, SPLIT, RANGE)
    seen = Observation("written ranges")
    folder = F.concat(_partition(CONFIG), F.lit("/"), _partition(SPLIT), F.lit(f"/{RANGE}="), F.col(RANGE))
    (
        ranged.observe(seen, F.array_join(F.collect_set(folder), "\n").alias("folders"))  # each is written, so each is known
        .sortWithinPartitions(*keys, ROW)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    written = {f for f in (seen.get["folders"] or "").split("\n") if f}
    for split in sorted({f.rsplit("/", 1)[0] for f in written}):
        for old in folders_in(spark, f"{path}/{split}"):
            if f"{split}/{old}" not in written:
                remove(spark, f"{path}/{split}/{old}")


def manifest(df: DataFrame, text_columns: list[str], root: str = "data") -> DataFrame:
    """Per split: relative path, rows and text bytes, sorted by config and split.

    Configs without rows do not appear.
    """
    sizes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text_columns]
    path = F.concat(F.lit(f"{root}/"), _partition(CONFIG), F.lit("/"), _partition(SPLIT))
    return (
        df.groupBy(CONFIG, SPLIT)
        .agg(F.count(F.lit(1)).alias("n_rows"), sum(sizes, F.lit(0)).cast("bigint").alias("n_bytes"))
        .withColumn("path", path)
        .orderBy(CONFIG, SPLIT)
    )


MANIFEST = "config_name string, data_files array<struct<split: string, path: string>>"


def write_manifest(entries: DataFrame, path: str) -> None:
    """Store as JSON lines: one config per line with its `data_files`, sorted by split."""
    files = F.transform(
        F.array_sort(F.collect_list(F.struct(SPLIT, "path"))),
        lambda e: F.struct(e[SPLIT].alias("split"), e["path"].alias("path")),
    )
    (
        entries.groupBy(F.col(CONFIG).alias("config_name"))
        .agg(files.alias("data_files"))
        .write.mode("overwrite")
        .json(path)
    )
