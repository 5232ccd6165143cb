"""Runs at size: small waves cost little, and what a pass reads of earlier replies does not grow with the memo."""

import random
import re
from dataclasses import replace
from pathlib import Path

import pytest
from fakes import Fake, tag

from tonguemill import sources
from tonguemill.operators import memo as memos
from tonguemill.operators.memo import Memo
from tonguemill.operators.segments import bytes_policy
from tonguemill.operators.translate import Settings
from tonguemill.plans import TranslationRun


@pytest.fixture
def service(tmp_path):
    (tmp_path / "calls").mkdir()
    return Fake(str(tmp_path / "calls"))


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield 64
    spark.conf.set("spark.sql.shuffle.partitions", before)


def digested(spark, texts):
    return memos.with_digest(spark.createDataFrame([(t,) for t in texts], "piece string"))


def buckets_in(folder):
    return sorted(p.name for p in Path(folder).glob("bucket=*"))


def test_a_small_part_gets_no_more_tasks_than_run_at_a_time(spark, service, tmp_path, many_partitions):
    texts = [f"text {i}" for i in range(400)]
    folders = memos.fill_memo(digested(spark, texts), service, bytes_policy(), Memo(str(tmp_path / "memo"), buckets=8), slices=2)
    assert len(folders) == 2
    for folder in folders:  # a task writes a file in each bucket that it has rows of, and has them in their order
        assert len(list(Path(folder).glob("bucket=*/*.parquet"))) <= spark.sparkContext.defaultParallelism + 8 < many_partitions
    assert sorted(r.translated for r in memos.read_replies(spark, folders).collect()) == sorted(map(tag, texts))
    assert service.calls() == 400


@pytest.mark.parametrize("slices", [3, 8, 20])
def test_a_part_fills_few_buckets_and_all_parts_fill_them_alike(spark, service, tmp_path, slices):
    texts = [f"text {i}" for i in range(600)]
    memo = Memo(str(tmp_path / "memo"), buckets=8)
    pieces = digested(spark, texts)
    folders = memos.fill_memo(pieces, service, bytes_policy(), memo, slices=slices)
    assert len(folders) == slices
    assert all(len(buckets_in(f)) <= -(-8 // slices) + 1 for f in folders)
    assert {b for f in folders for b in buckets_in(f)} == {f"bucket={b}" for b in range(8)}
    sizes = [spark.read.parquet(f).count() for f in folders]
    assert sum(sizes) == 600 and max(sizes) < 2 * 600 / slices
    for f in folders:
        replies = spark.read.parquet(f)
        assert replies.where(memos.bucket_of("text_hash", 8) != replies.bucket).isEmpty()
        filtered = spark.read.parquet(f.removesuffix("/replies") + "/filter")  # the filter tells of each reply
        assert filtered.count() == filtered.join(replies.selectExpr("xxhash64(text_hash) AS fingerprint", "bucket"), ["fingerprint", "bucket"], "left_semi").count() == replies.count()


@pytest.mark.parametrize("slices", [1, 5])
def test_of_earlier_replies_only_those_asked_for_are_read(spark, service, tmp_path, slices):
    memo, rng = Memo(str(tmp_path / "memo"), buckets=4), random.Random(4)
    first, later = [f"one {i}" for i in range(300)], [f"two {i}" for i in range(100)]
    memos.fill_memo(digested(spark, first), service, bytes_policy(), memo, slices=slices)
    asked = rng.sample(first, 30) + later
    pieces = digested(spark, asked + asked[:9] + [""])
    found = memos.answer(pieces, service, bytes_policy(), memo, slices=slices)
    assert found.earlier and memos.read_replies(spark, found.folders).count() > 130
    assert sorted(r.translated for r in found.read(spark).collect()) == sorted(map(tag, asked))
    assert service.calls() == 400
    again = memos.answer(pieces, service, bytes_policy(), memo, slices=slices)  # all is known
    assert sorted(r.translated for r in again.read(spark).collect()) == sorted(map(tag, asked))
    assert service.calls() == 400


def test_a_part_that_fails_costs_its_own_calls_only(spark, service, tmp_path, monkeypatch):
    memo, texts, made = Memo(str(tmp_path / "memo")), [f"text {i}" for i in range(40)], []
    write = Memo._write_replies

    def fail_at_the_third(self, replies, folder):
        made.append(folder)
        if len(made) == 3:
            raise RuntimeError("lost")
        write(self, replies, folder)

    with monkeypatch.context() as patch:
        patch.setattr(Memo, "_write_replies", fail_at_the_third)
        with pytest.raises(RuntimeError, match="lost"):
            memos.fill_memo(digested(spark, texts), service, bytes_policy(), memo, slices=4)
    scope = memos.scope_of(service, bytes_policy())
    assert len(memo.commits(spark, scope)) == 2
    paid = service.calls()
    found = memos.answer(digested(spark, texts), service, bytes_policy(), memo, slices=4)
    assert 0 < paid < 40 == service.calls()
    assert sorted(r.translated for r in found.read(spark).collect()) == sorted(map(tag, texts))


@pytest.fixture
def ranged(spark, tmp_path):
    """A corpus as `write_splits` stores it, with the names of its folders."""
    rows = [("c", split, i, f"{split} {i}") for split, n in (("a", 47), ("b", 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "config string, split string, row_idx bigint, text string")
    sources.write_splits(df, str(tmp_path / "corpus"), rows_per_file=10)
    stored = spark.read.schema("config string, split string, row_idx bigint, text string, row_range string")
    return stored.parquet(str(tmp_path / "corpus")).select(*df.columns, "row_range")


def test_a_pass_opens_only_the_folders_of_its_ranges(ranged, service, tmp_path):
    run = TranslationRun(ranged, str(tmp_path / "run"), Settings(service), ["text"], 5, 3, rows_per_file=10)
    for start, end in ((0, 15), (15, 30), (30, 47), (0, 47)):
        rows = run._pending_rows(start, end)
        chosen = re.search(r"PartitionFilters: \[(.*?)\], ", rows._jdf.queryExecution().executedPlan().toString()).group(1)
        assert re.findall(r"row_range#\d+ (>=|<=) (\d+)", chosen) == [(">=", f"{start // 10 * 10:012d}"), ("<=", f"{end - 1:012d}")]
        want = [(s, i) for s, n in (("a", 47), ("b", 9)) for i in range(n) if start <= i < end]
        assert sorted((r.split, r.row_idx) for r in rows.collect()) == want
        assert rows.columns == ["config", "split", "row_idx", "text"]


def test_a_run_over_ranges_gives_whole_splits_in_waves_of_any_size(ranged, service, tmp_path):
    run = TranslationRun(ranged, str(tmp_path / "run"), Settings(service), ["text"], 5, 3, rows_per_file=10)
    assert run.translate(max_waves=1) == 1
    assert run.finalize().columns == ["config", "split", "row_idx", "text"]
    got = replace(run, chunks_per_wave=4).run()
    assert got.columns == ["config", "split", "row_idx", "text"]
    want = [(s, i, tag(f"{s} {i}")) for s, n in (("a", 47), ("b", 9)) for i in range(n)]
    assert sorted((r.split, r.row_idx, r.text) for r in got.collect()) == want
    assert service.calls() == len(want)
