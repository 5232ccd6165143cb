"""A resumable translation of a whole corpus: waves of chunks, recorded progress, final splits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonguemill.operators.batching import Batching
from tonguemill.operators.memo import Memo
from tonguemill.operators.progress import (
    ProgressTable,
    chunk_progress,
    finished_ranges,
    outside,
    run_fingerprint,
    split_progress,
)
from tonguemill.operators.projection import Roles, translation_roles
from tonguemill.operators.sampling import smoke_rows
from tonguemill.operators.segments import Policy
from tonguemill.operators.translate import Settings, translate_columns
from tonguemill.operators.translator import FAILED, Translator
from tonguemill.session import commit_folder, committed_folders, folders_in, materialize, remove, scratch_area
from tonguemill.sources.corpus import CONFIG, RANGE, ROW, SPLIT
from tonguemill.sources.positions import plan_chunks
from tonguemill.sources.sinks import MANIFEST, manifest, publish_splits, range_name, write_manifest, write_splits

ROW_KEY = (CONFIG, SPLIT, ROW)
# Fixed value: chunk size of a smoke test.
SMOKE_CHUNK = 5
# Most waves whose rows are put together and recorded at once.
PASS_WAVES = 64
RECORD = (
    "provider string, model string, source string, target string, roles string, policy string, "
    "batching string, null_conversation string, chunk_size bigint, fingerprint string"
)


@dataclass(frozen=True)
class TranslationRun:
    """Translate `corpus` (config, split, row_idx, ...) into `work_dir`.

    A wave is the same range of `chunks_per_wave` chunks in every split: a filter on `row_idx`, which
    the stored corpus answers from Parquet statistics. Waves bound what a failure can lose of paid calls: the
    replies are committed in as many parts as there are waves. Around the calls, waves go together in passes of
    1, 2, 4, ... up to `PASS_WAVES` waves, so a failure also loses what a pass cuts and joins, which is at most as
    much as was done before it, and no calls; small waves don't cost a round of small jobs each. Each pass
    writes its rows to a folder of its own and then records its chunks together with that folder, so
    rows of an interrupted attempt are never read. Rows in equal rows out: what fails keeps its text.

    A corpus read from `write_splits` may have the `row_range` of its folders, which is no column of the result: with
    the `rows_per_file` it was written with, a pass opens its own folders only.
    """

    corpus: DataFrame
    work_dir: str
    settings: Settings
    roles: Roles | Sequence[str] | None = None
    chunk_size: int = 100
    chunks_per_wave: int | None = None
    rows_per_file: int | None = None

    def __post_init__(self) -> None:
        """Packing restarts in every chunk of the run, so what is packed does not depend on waves or stops."""
        batching = self.settings.batching
        if batching and batching.chunk_size != self.chunk_size:
            tied = replace(self.settings, batching=replace(batching, chunk_size=self.chunk_size))
            object.__setattr__(self, "settings", tied)

    @classmethod
    def smoke(cls, corpus: DataFrame, work_dir: str, settings: Settings, roles=None) -> TranslationRun:
        """A run over at most ten rows of each split of the first config, in chunks of five."""
        return cls(smoke_rows(corpus), work_dir, settings, roles, SMOKE_CHUNK)

    @classmethod
    def resume(cls, corpus: DataFrame, work_dir: str, translator: Translator, **waves) -> TranslationRun:
        """Go on with the columns, policy, packing and chunk size the run in `work_dir` was started with."""
        record = cls.recorded(corpus.sparkSession, work_dir)
        service = (translator.provider, translator.model, translator.source, translator.target)
        if service != (record["provider"], record["model"], record["source"], record["target"]):
            raise ValueError("the run was started with another service, model or language")
        batching = json.loads(record["batching"])
        settings = Settings(
            translator,
            Policy(**json.loads(record["policy"])),
            batching=batching and Batching(**batching),
            null_conversation=record["null_conversation"],
        )
        return cls(corpus, work_dir, settings, json.loads(record["roles"]), record["chunk_size"], **waves)

    @staticmethod
    def recorded(spark: SparkSession, work_dir: str) -> dict:
        """What a run was started with."""
        return spark.read.schema(RECORD).json(f"{work_dir}/settings").first().asDict()

    def _record(self) -> None:
        settings, translator = self.settings, self.settings.translator
        batching = asdict(settings.batching) if settings.batching else None
        row = (
            translator.provider, translator.model, translator.source, translator.target, json.dumps(self.chosen),
            json.dumps(asdict(settings.policy)), json.dumps(batching), settings.null_conversation, self.chunk_size,
            self.fingerprint,
        )
        self.spark.createDataFrame([row], RECORD).write.mode("overwrite").json(f"{self.work_dir}/settings")

    @property
    def spark(self) -> SparkSession:
        return self.corpus.sparkSession

    @property
    def columns(self) -> list[str]:
        return [c for c in self.corpus.columns if c != RANGE]

    @property
    def chosen(self) -> dict[str, str]:
        return translation_roles(self.corpus, self.roles)

    @property
    def fingerprint(self) -> str:
        return run_fingerprint(self.settings, self.chosen, self.chunk_size)

    @property
    def progress(self) -> ProgressTable:
        return ProgressTable(f"{self.work_dir}/progress")

    def chunks(self) -> DataFrame:
        return plan_chunks(self.corpus, self.chunk_size)

    def waves(self) -> list[tuple[int, int]]:
        """Position ranges [start, end) of the waves. Only the longest split's length is fetched."""
        rows = self.corpus.agg(F.max(ROW)).first()[0]
        n_rows = 0 if rows is None else rows + 1
        step = self.chunk_size * self.chunks_per_wave if self.chunks_per_wave else max(n_rows, 1)
        return [(start, start + step) for start in range(0, n_rows, step)]

    def translate(self, max_waves: int | None = None) -> int:
        """Translate pending chunks, wave by wave; returns the number of waves that had work."""
        settings = self.settings
        if settings.memo is None:
            settings = replace(settings, memo=Memo(f"{self.work_dir}/memo"))
        if self.progress.ranges_of_run(self.spark, self.fingerprint).isEmpty():
            self._record()
        with scratch_area(self.spark):
            pending = self._pending_waves()[:max_waves]
        worked = 0
        while worked < len(pending):
            together = pending[worked : worked + min(worked + 1, PASS_WAVES)]
            with scratch_area(self.spark):
                rows = self._pending_rows(together[0][0], together[-1][1])
                self._translate_waves(rows, len(together), settings)
            worked += len(together)
        return worked

    def _pending_waves(self) -> list[tuple[int, int]]:
        """The waves that hold rows which no recorded range covers."""
        waves = self.waves()
        if not waves:
            return []
        step = waves[0][1] - waves[0][0]
        rows = self._outside_of_done(self.corpus.select(*ROW_KEY), self.progress.ranges(self.spark))
        found = rows.select(F.floor(F.col(ROW) / F.lit(step)).cast("bigint").alias("wave")).distinct().collect()
        return [waves[r.wave] for r in sorted(found)]

    def _pending_rows(self, start: int, end: int) -> DataFrame:
        """Rows at positions from `start` to `end` that no recorded range covers."""
        rows = self.corpus.where((F.col(ROW) >= start) & (F.col(ROW) < end))
        if self.rows_per_file:
            first = start - start % self.rows_per_file
            rows = rows.where(F.col(RANGE).between(range_name(first), range_name(end - 1)))
        done = self.progress.ranges(self.spark).where((F.col("row_start") < end) & (F.col("row_end") > start))
        return self._outside_of_done(rows, done).select(*self.columns)

    def _outside_of_done(self, rows: DataFrame, done: DataFrame) -> DataFrame:
        return rows if done.isEmpty() else outside(rows, materialize(finished_ranges(done), "finished"))

    def _translate_waves(self, rows: DataFrame, n_waves: int, settings: Settings) -> None:
        attempt = uuid.uuid4().hex
        by_wave = replace(settings, memo_slices=settings.memo_slices * n_waves)
        translated = translate_columns(rows, ROW_KEY, by_wave, self.chosen, with_status=True)
        # A folder per split and wave: the pass is the unit of writing, the chunk that of progress.
        in_files = {"rows_per_file": self.chunk_size * self.chunks_per_wave} if self.chunks_per_wave else {}
        write_splits(translated, self._staged(attempt), **in_files)
        staged = self._read_staged([attempt])
        finished = chunk_progress(staged, self.chunk_size, list(self.chosen))
        self.progress.append(finished, self.fingerprint, attempt, self.chunk_size)

    def finished_ranges(self) -> DataFrame:
        """Which positions of every split are done."""
        return finished_ranges(self.progress.ranges_of_run(self.spark, self.fingerprint))

    def _staged(self, attempt: str) -> str:
        return f"{self.work_dir}/staging/attempt={attempt}"

    def _read_staged(self, attempts: Sequence[str]) -> DataFrame:
        """Rows of committed attempts with the corpus's columns and the outcome of each translated one."""
        statuses = [f"{c}_status" for c in self.chosen]
        fields = [*self.columns, *statuses]
        types = {f.name: f.dataType for f in self.corpus.schema.fields}
        if not attempts:
            return self.corpus.limit(0).select(*self.columns, *[F.lit(None).cast("string").alias(s) for s in statuses])
        staged = self.spark.read.option("basePath", f"{self.work_dir}/staging").parquet(
            *[self._staged(a) for a in attempts]
        )
        return staged.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in fields])

    def split_progress(self) -> DataFrame:
        state = self.progress.read_run(self.spark, self.fingerprint)
        return split_progress(self.chunks(), state)

    def finalize(self) -> DataFrame:
        """Publish every complete split, the failures and the manifest as one version; returns the written rows.

        A version is a folder that readers see once it is marked as whole, which is the last thing written: all of
        it or, after a stop, the version before. The waves' files are read and written in place, without an exchange.
        While no split is complete, a version has no rows.
        """
        self._commit(self._write_version())
        return self.output()

    def _write_version(self) -> str:
        """The folder of a version that is written and not yet seen by readers."""
        splits = materialize(self.split_progress().select(CONFIG, SPLIT, "n_rows", "complete"), "splits")
        ready = splits.where("complete")
        state = self.progress.ranges(self.spark)
        attempts = [r.attempt for r in state.select("attempt").distinct().collect()]  # one per wave
        staged = self._read_staged(attempts)
        if not splits.where("NOT complete").isEmpty():
            staged = staged.join(ready, [CONFIG, SPLIT], "left_semi")
        self._refuse_other_counts(staged, ready)
        begun = folders_in(self.spark, f"{self.work_dir}/published")
        number = 1 + max((int(name.removeprefix("version=")) for name in begun), default=0)
        version = f"{self.work_dir}/published/version={number:08d}"
        publish_splits(staged.select(*self.columns), f"{version}/data")
        self._failures(staged).write.mode("error").parquet(f"{version}/failed")
        write_manifest(manifest(self._read_data(version), list(self.chosen)), f"{version}/manifest")
        return version

    def _commit(self, version: str) -> None:
        commit_folder(self.spark, version)

    def versions(self) -> list[str]:
        """Folders of the published versions, the newest last."""
        return committed_folders(self.spark, f"{self.work_dir}/published/version=*")

    def _published(self) -> str:
        versions = self.versions()
        if not versions:
            raise ValueError("nothing is published yet")
        return versions[-1]

    def _read_data(self, version: str) -> DataFrame:
        written = self.spark.read.schema(self.corpus.select(*self.columns).schema).parquet(f"{version}/data")
        return written.select(*self.columns)

    def retire_versions(self) -> None:
        """Delete all versions but the newest published one; call it when no reader uses them any more."""
        newest = self._published().rsplit("/", 1)[1]
        for name in folders_in(self.spark, f"{self.work_dir}/published"):
            if name < newest:
                remove(self.spark, f"{self.work_dir}/published/{name}")

    def _refuse_other_counts(self, staged: DataFrame, ready: DataFrame) -> None:
        """A split is written only with as many rows as were planned for it."""
        found = staged.groupBy(CONFIG, SPLIT).agg(F.count(F.lit(1)).alias("n_staged"))
        other = ready.join(found, [CONFIG, SPLIT], "left").where(F.coalesce("n_staged", F.lit(0)) != F.col("n_rows"))
        if not other.isEmpty():
            raise ValueError("a finished split has other rows staged than planned")

    def _failures(self, staged: DataFrame) -> DataFrame:
        outcome = [
            F.struct(F.lit(c).alias("column"), F.col(f"{c}_status").alias("status")) for c in self.chosen
        ]
        return staged.select(*ROW_KEY, F.inline(F.array(*outcome))).where(F.col("status") == FAILED)

    def output(self) -> DataFrame:
        return self._read_data(self._published())

    def manifest(self) -> DataFrame:
        """config_name and data_files of the newest version; paths are within its folder."""
        return self.spark.read.schema(MANIFEST).json(f"{self._published()}/manifest")

    def failed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self._published()}/failed")

    def run(self) -> DataFrame:
        self.translate()
        return self.finalize()

    def retire_staging(self) -> None:
        """Delete the staged chunks. Call it once `finalize` has written every split."""
        if not self.split_progress().where("NOT complete").isEmpty():
            raise ValueError("some splits are not complete; their chunks are still needed")
        remove(self.spark, f"{self.work_dir}/staging")
