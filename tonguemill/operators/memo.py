"""Stored translations, and the join that brings them back to every place a text occurs."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonguemill.functions.text import text_digest
from tonguemill.operators.segments import Policy
from tonguemill.operators.translator import REPLY_SCHEMA, Translator, over_token_limit, translate_distinct
from tonguemill.session import commit_folder, committed_folders, folders_in, materialize, materialize_at, scratch_path, stored_bytes

# A text is hot when it takes more than this share of all lookups, so at most 1/share texts are.
HOT_SHARE = 0.001
# Folders of a commit; a lookup opens those that hold a digest it asks for.
BUCKETS = 32
# Stored texts that a translator task takes at most, where there are more tasks to be had.
TASK_BYTES = 32 << 20
# Stored texts whose digests one task takes.
DIGEST_TASK_BYTES = 1 << 30
# Stored texts in a file of a part, about.
PART_FILE_BYTES = 4 << 20
FILTER_SCHEMA = "fingerprint bigint, bucket int"


@dataclass(frozen=True)
class Memo:
    """Parquet replies found by digest, a folder per scope and append, for one writer at a time.

    A commit deals its replies by digest into `buckets` folders of sorted files, and keeps a filter beside
    them: 64 bits of every digest and the bucket it went to. A lookup reads the filters of earlier commits
    and opens only the buckets that hold what it asks for, so a wave reads no replies of buckets it shares
    no text with, however many waves there were before.

    Failed replies are kept like any other. Services share replies only under the same provider,
    languages, model and policy, so give each service its own provider name.
    """

    path: str
    buckets: int = BUCKETS

    @classmethod
    def temporary(cls, spark: SparkSession) -> Memo:
        return cls(scratch_path(spark, "memo"))

    def commits(self, spark: SparkSession, scope: str) -> list[str]:
        return committed_folders(spark, f"{self.path}/scope={scope}/commit=*")

    def read(self, spark: SparkSession, scope: str) -> DataFrame:
        """All replies committed so far."""
        return read_replies(spark, [f"{c}/replies" for c in self.commits(spark, scope)])

    def holding(self, digests: DataFrame, commits: Sequence[str]) -> list[str]:
        """The buckets of `commits` that hold any of the digests; at most `buckets` folders a commit.

        The filters are all that is read. Two digests with the same 64 bits may name a bucket too many.
        """
        if not commits:
            return []
        spark = digests.sparkSession
        filters = spark.read.schema(FILTER_SCHEMA).parquet(*[f"{c}/filter" for c in commits])
        commit = F.regexp_extract(F.col("_metadata.file_path"), r"/(commit=[0-9a-f]+)/filter/", 1)
        asked = digests.select(F.xxhash64("text_hash").alias("fingerprint")).distinct()
        found = filters.select("fingerprint", "bucket", commit.alias("commit")).join(asked, "fingerprint", "left_semi")
        folder = {c.rsplit("/", 1)[1]: c for c in commits}
        return sorted(f"{folder[r.commit]}/replies/bucket={r.bucket}" for r in found.select("commit", "bucket").distinct().collect())

    def append(self, replies: DataFrame, scope: str, digests: DataFrame | None = None) -> str:
        """Commit replies, and return the folder that holds them.

        The filter is made of the replies when they are written or, of stored `digests` that are known to be theirs, meanwhile.
        """
        folder = f"{self.path}/scope={scope}/commit={uuid.uuid4().hex}"
        spark = replies.sparkSession
        if digests is None:
            self._write_replies(replies, folder)
            # Digests alone are read.
            stored = spark.read.schema("text_hash binary").parquet(f"{folder}/replies")
            self._write_filter(stored.hint("rebalance"), folder)  # few files, by size
        else:
            with ThreadPoolExecutor(1) as beside:
                filtered = beside.submit(self._write_filter, digests, folder)
                self._write_replies(replies, folder)
                filtered.result()
        commit_folder(spark, folder)
        return folder

    def _write_replies(self, replies: DataFrame, folder: str) -> None:
        dealt = replies.withColumn("bucket", bucket_of("text_hash", self.buckets)).sortWithinPartitions("bucket", "text_hash")
        dealt.write.mode("error").partitionBy("bucket").parquet(f"{folder}/replies")

    def _write_filter(self, digests: DataFrame, folder: str) -> None:
        filters = digests.select(F.xxhash64("text_hash").alias("fingerprint"), bucket_of("text_hash", self.buckets).alias("bucket"))
        filters.write.mode("error").parquet(f"{folder}/filter")


def bucket_of(digest: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(buckets)).cast("int")


def read_replies(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """The replies in the named folders.

    Every append has a folder of its own, and the folders are named in the scan. Spark takes two
    scans of one root path for the same table, even when files were added between them, and would
    answer both from the older one if they meet in one query.
    """
    if not folders:
        return spark.createDataFrame([], REPLY_SCHEMA)
    return spark.read.schema(REPLY_SCHEMA).option("recursiveFileLookup", "true").parquet(*folders)  # buckets are no column


def scope_of(translator: Translator, policy: Policy) -> str:
    """Everything besides the text that decides a reply: service, languages, model, cutting policy."""
    service = (translator.provider, translator.source, translator.target, translator.model)
    digest = hashlib.sha256(repr((service, policy.fingerprint)).encode()).hexdigest()
    readable = re.sub(r"[^A-Za-z0-9]+", "_", "-".join(service[:3]))
    return f"{readable}-{digest[:16]}"


def with_digest(pieces: DataFrame, places: Sequence[str] = ()) -> DataFrame:
    """Adds the key under which a piece's reply is found: of its text, and of its place if replies are not shared."""
    if not places:
        return pieces.withColumn("text_hash", text_digest("piece"))
    return pieces.withColumn("text_hash", text_digest(F.to_json(F.struct(*places, "piece"))))


def _dealt(pending: DataFrame, n: int, buckets: int) -> DataFrame:
    """Rows dealt to about `n` tasks along the memo's buckets, so that a task writes few files.

    The number of tasks is explicit, because adaptive execution would merge small ones.
    """
    bucket = bucket_of("text_hash", buckets)
    if n <= buckets:
        return pending.repartitionById(n, F.floor(bucket * n / buckets).cast("int"))
    spread = n // buckets
    inside = F.pmod(F.hash("text_hash"), F.lit(spread))
    return pending.repartitionById(buckets * spread, (bucket * spread + inside).cast("int"))


@dataclass(frozen=True)
class Answers:
    """Where the replies to some pieces are: those to the `known` digests in buckets of earlier commits, the others in new ones."""

    earlier: list[str]
    known: DataFrame | None
    new: list[str]

    @property
    def folders(self) -> list[str]:
        return [*self.earlier, *self.new]

    def read(self, spark: SparkSession) -> DataFrame:
        """The replies to the pieces and, of the buckets that are opened, no others: their texts need not travel."""
        new = read_replies(spark, self.new)
        if not self.earlier:
            return new
        return read_replies(spark, self.earlier).join(self.known, "text_hash", "left_semi").unionByName(new)


def fill_memo(
    pieces: DataFrame,
    translator: Translator,
    policy: Policy,
    memo: Memo,
    concurrency: int | None = None,
    slices: int = 1,
    in_flight: int = 1,
) -> list[str]:
    """Translate every distinct piece the memo lacks, store the replies, and name the folders that answer all pieces."""
    return answer(pieces, translator, policy, memo, concurrency, slices, in_flight).folders


def answer(
    pieces: DataFrame,
    translator: Translator,
    policy: Policy,
    memo: Memo,
    concurrency: int | None = None,
    slices: int = 1,
    in_flight: int = 1,
    stored: str | None = None,
) -> Answers:
    """Translate every distinct piece the memo lacks and store the replies.

    `pieces` has (text_hash, piece). Copies of a text meet in each task first, so a text that fills a
    third of the corpus leaves every task once. The calls run in `concurrency` partitions with `in_flight`
    calls at a time in each, which bounds the request rate; without it there are as many tasks as the session runs at
    a time, or more if the texts are large. That is seen where they are stored, as `pieces` may be, in the folder `stored`. With `slices` > 1 the replies are
    committed in that many parts: a failure repeats one part only. The pending texts are then stored by part, so
    each part reads its own, and its filter is written while its calls are made. Of earlier commits only the buckets
    that hold some of the pieces are opened, and of those only the digests are read here, once.
    """
    spark = pieces.sparkSession
    scope = scope_of(translator, policy)
    earlier = memo.commits(spark, scope)
    pending = pieces.where(F.col("piece") != "").groupBy("text_hash").agg(F.first("piece").alias("piece"))
    asked = pieces.select("text_hash")
    if earlier and stored is None:  # written, or every use would read and gather all texts again
        stored = scratch_path(spark, "wanted")
        pending = materialize_at(pending, stored)
        asked = pending.select("text_hash")
    folders, known = memo.holding(asked, earlier), None
    if folders:
        held = read_replies(spark, folders).select("text_hash")
        known = materialize(held.join(asked, "text_hash", "left_semi"), "known")
        pending = pending.join(known, "text_hash", "left_anti")  # grouped before, so no copies travel
    if slices > 1:
        new = [
            memo.append(
                translate_distinct(_sent(_dealt_part(part, n, slices, memo.buckets), policy), translator, policy, in_flight),
                scope,
                digests,
            )
            for part, digests, n in _parts(pending, slices, memo.buckets, concurrency, stored)
        ]
    else:
        n = _n_tasks(spark, stored, concurrency)
        new = [memo.append(translate_distinct(_sent(_dealt(pending, n, memo.buckets), policy), translator, policy, in_flight), scope)]
    return Answers(folders, known, [f"{commit}/replies" for commit in new])


def _sent(texts: DataFrame, policy: Policy) -> DataFrame:
    return texts.withColumn("over_limit", over_token_limit("piece", policy))


def _n_tasks(spark: SparkSession, stored: str | None, concurrency: int | None) -> int:
    """Translator tasks for the texts in the folder `stored`. Small ones beyond those that run at a time would only cost their start."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if concurrency or stored is None:
        return concurrency or most
    return min(most, max(spark.sparkContext.defaultParallelism, -(-stored_bytes(spark, stored) // TASK_BYTES)))


def _place(slices: int, buckets: int) -> Column:
    """A digest's place in [0, slices) along the buckets: the whole part is its slice, so a slice has rows of few buckets."""
    inside = F.pmod(F.xxhash64("text_hash", F.lit("place")), F.lit(1 << 30)) / F.lit(1 << 30)
    return (bucket_of("text_hash", buckets) + inside) * F.lit(slices) / F.lit(buckets)


def _dealt_part(part: DataFrame, n: int, slices: int, buckets: int) -> DataFrame:
    """Rows of a part dealt to `n` tasks along the buckets."""
    place = _place(slices, buckets)
    return part.repartitionById(n, F.floor((place - F.floor(place)) * n).cast("int"))


def _parts(
    pending: DataFrame, slices: int, buckets: int, concurrency: int | None, stored: str | None
) -> list[tuple[DataFrame, DataFrame, int]]:
    """The rows in `slices` parts by digest, each stored in a folder of its own, with its digests and number of tasks.

    A part has rows of few buckets, so that a commit has few folders. Digests come in few tasks, as they are a small
    share of a part. Parts without rows are left out.
    """
    spark = pending.sparkSession
    path = scratch_path(spark, "parts")
    files = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // slices)
    if stored:
        files = max(1, min(files, stored_bytes(spark, stored) // (PART_FILE_BYTES * slices)))
    dealt = pending.withColumn("part", F.floor(_place(slices, buckets)).cast("int"))
    dealt = dealt.repartition("part", F.pmod(F.hash("text_hash"), F.lit(files)))
    dealt.write.mode("error").partitionBy("part").parquet(path)
    parts = []
    for name in sorted(folders_in(spark, path)):
        folder = f"{path}/{name}"
        part = spark.read.schema(pending.schema).parquet(folder)
        digests = part.select("text_hash").coalesce(1 + stored_bytes(spark, folder) // DIGEST_TASK_BYTES)
        parts.append((part, digests, _n_tasks(spark, folder, concurrency)))
    return parts


def hot_texts(index: DataFrame, share: float = HOT_SHARE, min_rows: int = 1) -> DataFrame | None:
    """(text_hash, n_salts) of texts with too many lookups for one task; None if there are none.

    A hot text takes more than `share` of all rows, so the result has fewer than 1/share rows whatever
    the data, and salting cuts each hot text into parts of at most `share` of all rows (`min_rows` at least).
    """
    limit = max(min_rows, int(index.count() * share))
    counts = index.groupBy("text_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    hot = materialize(counts.select("text_hash", F.ceil(F.col("n") / limit).cast("int").alias("n_salts")), "hot")
    return None if hot.isEmpty() else hot


def look_up(
    index: DataFrame, replies: DataFrame, spread_by: Sequence[str], hot: DataFrame | None = None
) -> DataFrame:
    """Left join of `index` with `replies` on text_hash, spreading hot texts over several tasks.

    `hot` comes from `hot_texts`, which bounds its size; rows of a hot text are
    salted by `spread_by` and its single reply is repeated once per salt.
    """
    if hot is None:
        return index.join(replies, "text_hash", "left")
    salts = hot  # written, so Spark knows its size
    salted = index.join(salts, "text_hash", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("n_salts")), F.lit(0)).cast("int")
    )
    repeated = replies.join(salts, "text_hash", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salts"), F.lit(1)) - 1))
    )
    joined = salted.drop("n_salts").join(repeated.drop("n_salts"), ["text_hash", "salt"], "left")
    return joined.drop("salt")
