"""Tables that are folders of many files: each is read, and no task gets more than its part."""

from pathlib import Path

import pytest
from fakes import tag

from tonguemill.operators.translate import Settings
from tonguemill.operators.translator import FunctionTranslator
from tonguemill.plans import catalog
from tonguemill.streaming import read_new_files, translate_stream

N_FILES = 4


@pytest.fixture
def folder(spark, sf_dir, tmp_path):
    """The documents as a folder of several files, as larger tables are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.repartition(N_FILES, "doc_id").write.parquet(str(tmp_path / "tables/documents.parquet"))
    return str(tmp_path / "tables")


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    """Where a query's own tables go, by name."""
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / "scratch" / name))
    return tmp_path / "scratch"


def test_a_stream_over_a_table_of_many_files(spark, folder, sf_dir):
    got = catalog.incremental_translate(spark, folder)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in docs.collect())
    assert {r.text_status for r in got.collect()} == {"translated"}


def test_a_language_is_written_by_every_task_that_reads_it(spark, folder, scratch):
    catalog.unreadable_files(spark, folder)
    assert len(list((scratch / "files/lang=en").glob("*.parquet"))) == N_FILES


def test_arrivals_are_written_by_every_task_that_reads_them(spark, folder, scratch):
    n_rows = catalog.stream_once_per_key(spark, folder).count()
    assert len(list((scratch / "in").glob("*.parquet"))) == 2 * N_FILES
    assert n_rows == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_a_batch_of_a_stream_is_evaluated_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(300).selectExpr("id", "concat('text ', id) AS text").write.parquet(source)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    stream = read_new_files(spark, source, spark.read.parquet(source).schema)
    counted = stream.mapInPandas(count, stream.schema)
    translate_stream(counted, ["id"], Settings(FunctionTranslator(tag)), out, str(tmp_path / "check"), ["text"]).awaitTermination()
    assert spark.read.parquet(out).count() == seen.value == 300
