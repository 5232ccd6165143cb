"""Waves that share replies, writes that read once, versions that are seen whole, progress as ranges."""

import random
from dataclasses import replace
from pathlib import Path

import pytest
from fakes import Fake, tag
from pyspark.sql import functions as F

from tonguemill import sources
from tonguemill.operators import memo as memos
from tonguemill.operators import progress
from tonguemill.operators.memo import Memo
from tonguemill.operators.segments import bytes_policy
from tonguemill.operators.translate import Settings, translate_columns
from tonguemill.operators.translator import call_with_retries
from tonguemill.plans import TranslationRun
from tonguemill.streaming import once_per_key, read_new_files, translate_stream

KEY = ["config", "split", "row_idx"]


def placed(spark, texts, split="a", first=0):
    rows = [("c", split, first + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "config string, split string, row_idx bigint, text string")


@pytest.fixture
def fake(tmp_path):
    made = []

    def make(**how):
        folder = tmp_path / f"calls{len(made)}"
        folder.mkdir()
        made.append(folder)
        return Fake(str(folder), **how)

    return make


def commit_of(path):
    return path.split("/commit=")[1].split("/")[0]


# Memo


def test_a_wave_opens_only_the_buckets_it_hits(spark, fake, tmp_path):
    service, policy, memo = fake(), bytes_policy(), Memo(str(tmp_path / "memo"), buckets=8)

    def fill(texts):
        pieces = memos.with_digest(placed(spark, texts).withColumnRenamed("text", "piece"))
        return pieces, memos.fill_memo(pieces, service, policy, memo)

    _, first = fill([f"one {i}" for i in range(60)])
    _, second = fill([f"two {i}" for i in range(60)])
    assert len(first) == 1 and len(second) == 1 and commit_of(first[0]) != commit_of(second[0])  # nothing shared, nothing opened
    pieces, third = fill(["one 7", "two 9", "two 9", *[f"three {i}" for i in range(20)]])
    earlier = [f for f in third if "/bucket=" in f]
    assert {commit_of(f) for f in earlier} == {commit_of(first[0]), commit_of(second[0])} and len(earlier) == 2
    bucket = {r.piece: r.b for r in pieces.select("piece", memos.bucket_of("text_hash", 8).alias("b")).collect()}
    assert {f.rsplit("=", 1)[1] for f in earlier} == {str(bucket["one 7"]), str(bucket["two 9"])}
    opened = memos.read_replies(spark, third)
    assert {commit_of(f) for f in opened.inputFiles()} == {commit_of(f) for f in third}
    assert len([f for f in opened.inputFiles() if commit_of(f) == commit_of(first[0])]) == 1
    found = pieces.select("text_hash", "piece").distinct().join(opened, "text_hash")
    assert sorted((r.piece, r.translated) for r in found.collect()) == sorted((t, tag(t)) for t in {"one 7", "two 9", *[f"three {i}" for i in range(20)]})
    assert service.calls() == 140


@pytest.mark.parametrize("concurrency", [1, 3, 8, 20])
def test_replies_are_dealt_along_the_buckets(spark, fake, tmp_path, concurrency):
    service, memo = fake(), Memo(str(tmp_path / "memo"), buckets=8)
    pieces = memos.with_digest(placed(spark, [f"t{i}" for i in range(200)]).withColumnRenamed("text", "piece"))
    folders = memos.fill_memo(pieces, service, bytes_policy(), memo, concurrency)
    replies = memos.read_replies(spark, folders)
    assert replies.count() == replies.select("text_hash").distinct().count() == 200
    assert len(list(Path(folders[0]).glob("bucket=*/*.parquet"))) <= max(8, 8 * (concurrency // 8))
    stored = spark.read.parquet(folders[0])
    assert stored.where(memos.bucket_of("text_hash", 8) != F.col("bucket")).isEmpty()


def test_texts_are_hot_by_their_share_at_every_size(spark):
    index = memos.with_digest(placed(spark, ["hot"] * 30 + [f"t{i}" for i in range(70)]).withColumnRenamed("text", "piece"))
    assert [r.n_salts for r in memos.hot_texts(index, 0.1).collect()] == [3]
    assert memos.hot_texts(index.limit(0)) is None


def test_replies_that_are_not_shared(spark, fake):
    service, texts = fake(), ["a", "b", "a", "", None, "a"]
    settings = Settings(service, share_replies=False)
    got = translate_columns(placed(spark, texts), KEY, settings, ["text"]).orderBy("row_idx").collect()
    assert [r.text for r in got] == [t and tag(t) for t in texts]
    assert service.calls() == 4


@pytest.mark.parametrize("in_flight", [1, 10])
def test_calls_in_flight_change_no_result(spark, fake, in_flight):
    texts = [f"text {i % 50}" for i in range(300)]
    service = fake(failures=1, bad="7")
    policy = replace(bytes_policy(), backoff=0.0)
    got = translate_columns(placed(spark, texts), KEY, Settings(service, policy, in_flight=in_flight), ["text"], with_status=True)
    want = [(t, "failed") if "7" in t else (tag(t), "translated") for t in texts]
    assert [(r.text, r.text_status) for r in got.orderBy("row_idx").collect()] == want
    assert service.calls() == sum(3 if "7" in t else 2 for t in set(texts))


def test_no_back_off_waits_not_at_all():
    waits = []

    def refuse(text):
        raise ValueError

    call_with_retries(refuse, "x", replace(bytes_policy(), backoff=0.0), sleep=waits.append)
    assert waits == []


# Writes


def counted(df, seen):
    def run(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(run, df.schema)


def test_writes_evaluate_their_input_once(spark, tmp_path):
    df = placed(spark, [f"t{i}" for i in range(300)]).repartition(6)
    for n, write in enumerate((sources.write_splits, sources.publish_splits, lambda d, p: sources.stage_chunks(d, p, 10))):
        seen = spark.sparkContext.accumulator(0)
        write(counted(df, seen), str(tmp_path / str(n)))
        assert seen.value == 300
        assert sources.read_corpus(spark, str(tmp_path / str(n))).count() == 300


def test_files_follow_from_positions_and_a_smaller_split_leaves_nothing_behind(spark, tmp_path):
    root = str(tmp_path / "data")
    both = placed(spark, [f"t{i}" for i in range(95)]).unionByName(placed(spark, ["x"] * 12, "b"))
    sources.write_splits(both, root, rows_per_file=10)
    assert sorted(p.name for p in Path(root, "config=c", "split=a").iterdir()) == [f"row_range={10 * i:012d}" for i in range(10)]
    sources.write_splits(placed(spark, [f"new {i}" for i in range(15)]), root, rows_per_file=10)
    back = sources.read_corpus(spark, root)
    assert back.columns == ["row_idx", "text", "config", "split"]
    assert {(r.split, r.n) for r in back.groupBy("split").agg(F.count("*").alias("n")).collect()} == {("a", 15), ("b", 12)}
    assert back.where("text like 'new%'").count() == 15


def test_publishing_moves_no_rows_between_tasks(spark, tmp_path):
    path = str(tmp_path / "staged")
    placed(spark, [f"t{i}" for i in range(50)]).write.parquet(path)
    plan = sources.sinks._with_range(spark.read.parquet(path), 10)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# Versions


@pytest.fixture
def corpus(spark):
    return placed(spark, [f"text {i}" for i in range(23)]).unionByName(placed(spark, ["b 0", "b 1", "b 2"], "b"))


def contents(df):
    return sorted((r.split, r.row_idx, r.text) for r in df.collect())


def test_readers_see_a_version_whole_or_not_at_all(spark, corpus, tmp_path, fake, monkeypatch):
    run = TranslationRun(corpus, str(tmp_path / "run"), Settings(fake()), ["text"], 5, 2)
    with pytest.raises(ValueError, match="nothing is published"):
        run.output()
    run.translate(max_waves=1)
    first = contents(run.finalize())
    assert [r[0] for r in first] == ["b"] * 3
    run.translate()

    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(TranslationRun, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            run.finalize()
    assert contents(run.output()) == first and len(run.versions()) == 1
    assert [r.config_name for r in run.manifest().collect()] == ["c"]
    assert [f.split for r in run.manifest().collect() for f in r.data_files] == ["b"]
    assert len(contents(run.finalize())) == 26 and len(run.versions()) == 2
    assert [f.path for r in run.manifest().collect() for f in r.data_files] == ["data/config=c/split=a", "data/config=c/split=b"]
    run.retire_versions()
    assert len(run.versions()) == 1 and len(contents(run.output())) == 26


def test_a_version_without_a_complete_split_has_no_rows(spark, corpus, tmp_path, fake):
    run = TranslationRun(corpus.where("split = 'a'"), str(tmp_path / "run"), Settings(fake()), ["text"], 5, 1)
    assert run.finalize().count() == 0 and len(run.versions()) == 1  # before any wave
    run.translate(max_waves=1)
    assert run.finalize().columns == corpus.columns and run.output().count() == 0
    assert run.failed().count() == run.manifest().count() == 0
    run.translate()
    run._write_version()  # not marked as whole, so not seen
    assert run.output().count() == 0
    assert len(contents(run.finalize())) == 23 and len(run.versions()) == 3


def test_a_run_over_no_rows_gives_none(spark, corpus, tmp_path, fake):
    run = TranslationRun(corpus.limit(0), str(tmp_path / "run"), Settings(fake()), ["text"], 5, 1)
    assert run.run().count() == 0 and run.failed().count() == 0


# Progress


def test_ranges_stand_for_chunks(spark, corpus, tmp_path, fake):
    run = TranslationRun(corpus, str(tmp_path / "run"), Settings(fake(bad="text 12"), replace(bytes_policy(), backoff=0.0)), ["text"], 5)
    run.translate()
    stored = run.progress.ranges(spark).orderBy("split", "row_start").collect()
    assert [(r.split, r.row_start, r.row_end, r.n_rows, r.n_failed) for r in stored] == [
        ("a", 0, 10, 10, 0), ("a", 10, 15, 5, 1), ("a", 15, 23, 8, 0), ("b", 0, 3, 3, 0)]
    chunks = run.progress.read(spark).orderBy("split", "chunk_id").collect()
    assert [(r.split, r.chunk_id, r.row_start, r.row_end, r.n_rows, r.status) for r in chunks] == [
        *[("a", k, 5 * k, min(23, 5 * k + 5), min(23, 5 * k + 5) - 5 * k, "done_with_failures" if k == 2 else "done") for k in range(5)],
        ("b", 0, 0, 3, 3, "done")]
    assert sorted((r.split, r.row_start, r.row_end) for r in run.finished_ranges().collect()) == [("a", 0, 23), ("b", 0, 3)]


def test_chunks_with_gaps_stay_by_themselves(spark):
    rows = [("c", "a", 0, 0, 5, 5, 0), ("c", "a", 1, 5, 10, 5, 0), ("c", "a", 2, 10, 15, 3, 0), ("c", "a", 4, 20, 25, 5, 0), ("c", "a", 5, 25, 27, 2, 0)]
    chunks = spark.createDataFrame(rows, "config string, split string, chunk_id bigint, row_start bigint, row_end bigint, n_rows bigint, n_failed bigint")
    ranges = progress.neighbours(chunks, 5)
    assert sorted((r.chunk_start, r.chunk_end, r.n_rows) for r in ranges.collect()) == [(0, 2, 10), (2, 3, 3), (4, 6, 7)]
    named = ranges.withColumns({"attempt": F.lit("x"), "fingerprint": F.lit("y"), "finished_at": F.current_timestamp()})
    back = progress.chunks_of(named).select(*chunks.columns)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_unions_of_random_ranges(spark):
    rng = random.Random(8)
    rows = [(c, s, a, a + rng.randint(1, 9)) for c, s in (("c", "a"), ("c", "b"), ("d", "a")) for a in (rng.randint(0, 120) for _ in range(25))]
    schema = "config string, split string, row_start bigint, row_end bigint"
    got = {(r.config, r.split, r.row_start, r.row_end, r.n_positions) for r in progress.finished_ranges(spark.createDataFrame(rows, schema)).collect()}
    want = set()
    for c, s in {(r[0], r[1]) for r in rows}:
        inside = sorted({x for r in rows if r[:2] == (c, s) for x in range(r[2], r[3])})
        starts = [x for x in inside if x - 1 not in inside]
        ends = [x + 1 for x in inside if x + 1 not in inside]
        want |= {(c, s, a, b, b - a) for a, b in zip(starts, ends)}
    assert got == want
    assert progress.finished_ranges(spark.createDataFrame([], schema)).count() == 0


# Streams


def test_a_key_that_comes_again_is_skipped(spark, tmp_path, fake):
    source, service = str(tmp_path / "in"), fake()

    def arrive(rows):
        spark.createDataFrame(rows, "id int, text string").write.mode("append").parquet(source)

    def deliver(name, **how):
        stream = once_per_key(read_new_files(spark, source, spark.read.parquet(source).schema), ["id"], **how)
        translate_stream(stream, ["id"], Settings(service), str(tmp_path / f"out{name}"), str(tmp_path / f"check{name}")).awaitTermination()
        return sorted((r.id, r.text) for r in spark.read.parquet(str(tmp_path / f"out{name}")).collect())

    arrive([(1, "a"), (2, "b"), (1, "a")])
    want = [(1, tag("a")), (2, tag("b"))]
    assert deliver("x") == deliver("y", time_out="7 days") == want
    arrive([(2, "b"), (3, "c"), (1, "a")])
    assert deliver("x") == deliver("y", time_out="7 days") == [*want, (3, tag("c"))]
    assert service.calls() == 6


def test_with_texts_only_repeated_texts_are_skipped(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(1, "a"), (1, "b"), (1, "a"), (2, "a"), (None, None), (None, None)]
    spark.createDataFrame(rows, "id int, text string").write.parquet(source)
    stream = once_per_key(read_new_files(spark, source, spark.read.parquet(source).schema), ["id"], ["text"])
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=repr) == sorted({*rows}, key=repr)
