from dataclasses import replace
from pathlib import Path

import pytest
from fakes import Fake, tag, tag_each

from tonguemill.operators.batching import Batching
from tonguemill.operators.segments import bytes_policy
from tonguemill.operators.translate import Settings
from tonguemill.plans import TranslationRun
from tonguemill.session import materialize, scratch_area, scratch_path
from tonguemill.streaming import read_new_files, translate_stream

TEXTS = [f"text {i}" for i in range(23)]


@pytest.fixture
def corpus(spark):
    rows = [("c", "a", i, t) for i, t in enumerate(TEXTS)] + [("c", "b", i, f"b {i}") for i in range(3)]
    return spark.createDataFrame(rows, "config string, split string, row_idx bigint, text string")


@pytest.fixture
def translator(tmp_path):
    (tmp_path / "calls").mkdir()
    return Fake(str(tmp_path / "calls"))


def start(corpus, tmp_path, translator, **changes):
    settings = {"chunk_size": 5, "chunks_per_wave": 2, "roles": ["text"], **changes}
    return TranslationRun(corpus, str(tmp_path / "run"), Settings(translator), **settings)


def contents(df):
    return sorted((r.split, r.row_idx, r.text) for r in df.collect())


WHOLE = sorted([("a", i, tag(t)) for i, t in enumerate(TEXTS)] + [("b", i, tag(f"b {i}")) for i in range(3)])


def test_a_stopped_run_goes_on_where_it_was(corpus, tmp_path, translator):
    first = start(corpus, tmp_path, translator)
    assert first.translate(max_waves=1) == 1
    assert translator.calls() == 13
    states = {r["split"]: (r.n_chunks, r.chunks_done, r.complete) for r in first.split_progress().collect()}
    assert states == {"a": (5, 2, False), "b": (1, 1, True)}
    assert contents(first.finalize()) == WHOLE[-3:]  # only the complete split

    again = start(corpus, tmp_path, translator, chunks_per_wave=5)  # other waves, half of it done
    assert again.translate() == 1
    assert again.translate() == 0
    assert translator.calls() == 26
    assert contents(again.finalize()) == WHOLE
    state = again.progress.read(corpus.sparkSession)
    assert sorted((r.split, r.chunk_id, r.row_start, r.row_end, r.status) for r in state.collect()) == [
        *[("a", k, 5 * k, min(5 * k + 5, 23), "done") for k in range(5)], ("b", 0, 0, 3, "done"),
    ]
    again.retire_staging()
    assert not (tmp_path / "run" / "staging").exists()
    assert contents(again.output()) == WHOLE


def test_rows_of_an_attempt_that_was_not_recorded_are_not_used(corpus, tmp_path, translator, monkeypatch):
    broken = start(corpus, tmp_path, translator)

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr("tonguemill.operators.progress.ProgressTable.append", die)
        with pytest.raises(KeyboardInterrupt):
            broken.translate()
    assert contents(start(corpus, tmp_path, translator).run()) == WHOLE
    assert translator.calls() == 26  # the lost attempt's replies were in the memo


def test_small_waves_go_together_in_passes(corpus, tmp_path, translator):
    run = start(corpus, tmp_path, translator, chunks_per_wave=1)
    assert run.translate() == 5
    state = run.progress.read(corpus.sparkSession).collect()
    passes = [{r.chunk_id for r in state if r.attempt == attempt} for attempt in {r.attempt for r in state}]
    assert sorted(passes, key=min) == [{0}, {1, 2}, {3, 4}]
    scopes = list((tmp_path / "run/memo").iterdir())
    assert len(scopes) == 1 and len(list(scopes[0].iterdir())) == 5  # replies are committed for each wave
    assert contents(run.finalize()) == WHOLE and translator.calls() == 26


def test_failures_are_reported_and_lose_no_rows(corpus, tmp_path, translator):
    failing = replace(translator, bad="text 7")
    run = start(corpus, tmp_path, failing)
    run = replace(run, settings=Settings(failing, replace(bytes_policy(), backoff=0.0)))
    got = contents(run.run())
    assert got == sorted(w if w[:2] != ("a", 7) else ("a", 7, "text 7") for w in WHOLE)
    assert [tuple(r) for r in run.failed().collect()] == [("c", "a", 7, "text", "failed")]
    state = run.progress.read(corpus.sparkSession).where("n_failed > 0").collect()
    assert [(r.chunk_id, r.n_failed, r.status) for r in state] == [(1, 1, "done_with_failures")]


def test_other_settings_are_refused(corpus, tmp_path, translator):
    start(corpus, tmp_path, translator).translate(max_waves=1)
    for changes in ({"chunk_size": 6}, {"translator": replace(translator, target="fr")}):
        changed = {"translator": translator, **changes}
        with pytest.raises(ValueError, match="other settings"):
            start(corpus, tmp_path, **changed).translate()


def test_resume_takes_the_recorded_settings(corpus, tmp_path, translator):
    start(corpus, tmp_path, translator, chunk_size=4).translate(max_waves=1)
    again = TranslationRun.resume(corpus, str(tmp_path / "run"), translator)
    assert (again.chunk_size, again.chosen, again.settings.policy) == (4, {"text": "text"}, bytes_policy())
    assert contents(again.run()) == WHOLE
    assert translator.calls() == 26
    with pytest.raises(ValueError, match="another service"):
        TranslationRun.resume(corpus, str(tmp_path / "run"), replace(translator, model="other"))


def test_packing_does_not_depend_on_waves(spark, tmp_path, translator):
    rows = [("c", "a", i, f" t{i} ") for i in range(12)]
    df = spark.createDataFrame(rows, "config string, split string, row_idx bigint, text string")
    settings = Settings(replace(translator, reply=tag_each), batching=Batching())
    runs = [TranslationRun(df, str(tmp_path / str(n)), settings, ["text"], 6, n) for n in (1, 2)]
    one, two = (contents(run.run()) for run in runs)
    assert one == two
    assert [t for _, i, t in one if i in (5, 11)] == [tag(" t5 "), tag(" t11 ")]  # alone in their groups


def test_scratch_tables_end_with_their_area(spark):
    with scratch_area(spark) as area:
        assert materialize(spark.range(3)).count() == 3
        assert Path(area).exists()
    assert not Path(area).exists()
    assert not scratch_path(spark, "t").startswith(area)


def test_smoke_run(corpus, tmp_path, translator):
    run = TranslationRun.smoke(corpus, str(tmp_path / "smoke"), Settings(translator), ["text"])
    assert contents(run.run()) == [w for w in WHOLE if w[1] < 10]
    assert run.progress.read(corpus.sparkSession).count() == 3


def test_new_files_are_translated_once(spark, tmp_path, translator):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))

    def arrive(ids):
        spark.createDataFrame([(i, f"t{i % 40}") for i in ids], "id int, text string").write.mode("append").parquet(source)

    def deliver():
        stream = read_new_files(spark, source, spark.read.parquet(source).schema)
        translate_stream(stream, ["id"], Settings(translator), out, checkpoint).awaitTermination()
        return sorted((r.id, r.text) for r in spark.read.parquet(out).collect())

    want = [(i, f"[es] t{i % 40}") for i in range(50)]
    arrive(range(30))
    assert deliver() == want[:30]
    arrive(range(30, 50))
    assert deliver() == want
    assert deliver() == want
    assert translator.calls() == 40
