import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tonguemill import sources
from tonguemill.operators import projection, sampling
from tonguemill.sources.corpus import as_corpus


def placed(spark, sizes):
    """Splits of the given sizes; ids grow in no order of the splits."""
    splits = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(n).alias("n")) for s, n in sizes.items()])
    rows = spark.range(1).select(F.inline(splits)).select(
        F.lit("c").alias("config"), "split", F.explode(F.sequence(F.lit(1), "n")).alias("i")
    )
    return rows.select("config", "split", (F.col("i") * 7).cast("bigint").alias("id"), F.col("i").cast("string").alias("text"))


def row_positions(df):
    return sorted((r.split, r.row_idx, r.id) for r in df.collect())


def test_positions_by_key_cover_uneven_splits(spark):
    df = placed(spark, {"big": 5_000, "small": 3, "one": 1}).repartition(5)
    want = [(s, i, (i + 1) * 7) for s, n in (("big", 5_000), ("one", 1), ("small", 3)) for i in range(n)]
    assert row_positions(sources.position_by_key(df, ["id"])) == want


def test_positions_need_a_key_and_accept_nulls_in_it(spark):
    df = spark.createDataFrame([("c", "s", None, 2), ("c", "s", 1, 2)], "config string, split string, a int, id int")
    assert row_positions(sources.position_by_key(df, ["a"])) == [("s", 0, 2), ("s", 1, 2)]
    with pytest.raises(ValueError, match="identify"):
        sources.position_by_key(df, ["id"])


def test_layout_round_trip_keeps_names_and_file_order(spark, tmp_path):
    df = sources.position_by_key(
        placed(spark, {"01": 40, "train": 7}).unionByName(placed(spark, {"x": 2}).withColumn("config", F.lit("1"))), ["id"]
    )
    root = str(tmp_path / "data")
    sources.write_splits(df, root, 4)
    back = sources.read_corpus(spark, root)
    assert sorted((r.config, r.split) for r in sources.list_splits(back).collect()) == [
        ("1", "x"), ("c", "01"), ("c", "train"),
    ]
    again = sources.position_in_files(back.drop("row_idx"))
    assert row_positions(again) == row_positions(df)
    plan = back.where("config = 'c' AND row_idx < 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(coalesce(config" in plan and "LessThan(row_idx,3)" in plan


def test_positions_in_files_shuffle_no_rows(spark, tmp_path):
    placed(spark, {"a": 50, "b": 5}).repartition(3).write.partitionBy("config", "split").parquet(str(tmp_path / "d"))
    df = sources.position_in_files(sources.read_corpus(spark, str(tmp_path / "d")))
    rows = row_positions(df)
    assert [r[1] for r in rows if r[0] == "a"] == list(range(50)) and len(rows) == 55
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_positions_in_files_have_no_gaps_where_rows_were_filtered(spark, tmp_path):
    placed(spark, {"a": 50, "b": 5}).repartition(3).write.partitionBy("config", "split").parquet(str(tmp_path / "d"))
    whole = sources.read_corpus(spark, str(tmp_path / "d"))
    order = {(r.split, r.id): r.row_idx for r in sources.position_in_files(whole).collect()}
    left = row_positions(sources.position_in_files(whole.where("id % 2 = 0")))
    assert [r[1] for r in left if r[0] == "a"] == list(range(25))
    places = [(s, order[s, i]) for s, _, i in left]
    assert places == sorted(places)


def test_names_in_paths_are_those_of_the_folders(spark, tmp_path):
    names = [("a/b", "x:y"), ("50%", "a=b"), ("ä b", "[^]")]
    df = spark.createDataFrame([(c, s, 0, "t") for c, s in names], "config string, split string, row_idx bigint, text string")
    sources.write_splits(df, str(tmp_path / "data"))
    listed = {r.path for r in sources.manifest(sources.read_corpus(spark, str(tmp_path / "data")), ["text"]).collect()}
    assert listed == {str(p.relative_to(tmp_path)) for p in Path(tmp_path, "data").glob("*/*") if p.is_dir()}
    with pytest.raises(Exception, match="without a name"):
        sources.write_splits(df.withColumn("split", F.lit("")), str(tmp_path / "other"))


def test_default_names(spark):
    row = as_corpus(spark.sql("SELECT 1 AS id")).first()
    assert (row.config, row.split) == ("default", "train")
    row = as_corpus(spark.sql("SELECT CAST(NULL AS string) AS split, 5 AS lang"), "lang").first()
    assert (row.config, row.split) == ("5", "train")


def test_entries_that_cannot_be_read_are_skipped(spark, tmp_path):
    good, other = str(tmp_path / "a"), str(tmp_path / "b")
    spark.sql("SELECT 'x' AS text").write.parquet(good)
    spark.sql("SELECT 'y' AS text, 's' AS system").write.parquet(other)
    with pytest.warns(UserWarning, match="PATH_NOT_FOUND"):
        df = sources.read_entries(spark, [(None, None, good), ("gone", "s", str(tmp_path / "no")), ("o", "test", other)])
    assert sorted(tuple(r) for r in df.select("config", "split", "text", "system").collect()) == [
        ("default", "train", "x", None), ("o", "test", "y", "s"),
    ]
    counts = {(r["split"], r["column"]): r["n_values"] for r in sources.list_columns(df).collect()}
    assert counts == {("train", "text"): 1, ("train", "system"): 0, ("test", "text"): 1, ("test", "system"): 1}
    with pytest.warns(UserWarning), pytest.raises(ValueError):
        sources.read_entries(spark, [("gone", "s", str(tmp_path / "no"))])


def test_selection_options():
    assert sources.name_list(" a, ,b ") == ["a", "b"]
    assert sources.name_list(" a,b", trim=False) == [" a", "b"]
    assert sources.name_list("") is None
    assert sources.configs_at(["a", "b", "c"], "2, 0,7") == ["c", "a"]
    assert sources.configs_at(["a", "b"], "ALL") == ["a", "b"]


def test_roles(spark):
    df = as_corpus(spark.sql("SELECT 's' AS system, 'c' AS conversation, 'd' AS conversations, 't' AS text, 1 AS n"))
    assert projection.cost_roles(df) == {
        "system": "system", "conversation": "text", "conversations": "conversation", "text": "text", "n": "text",
    }
    assert projection.translation_roles(df) == {
        "system": "system", "conversation": "conversation", "conversations": "conversation", "text": "text",
    }
    assert projection.translation_roles(df, ["text", "none"]) == {"text": "text"}


def test_nulls_are_not_values_and_empty_strings_are_not_translatable(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "id int, text string")
    values = projection.non_null_values(df, ["id"], {"text": "text"})
    assert sorted((r.id, r.value) for r in values.collect()) == [(2, ""), (3, "a")]
    row = projection.role_counts(df, {"text": "text"}).first()
    assert (row.n_values, row.n_translatable, row.n_chars) == (2, 1, 1)


@pytest.mark.parametrize("n", [1, 10, 4_000])
def test_first_rows_with_and_without_positions(spark, n):
    df = placed(spark, {"big": 5_000, "small": 3}).repartition(6)
    want = sorted([("big", (i + 1) * 7) for i in range(n)] + [("small", (i + 1) * 7) for i in range(min(n, 3))])
    assert sorted((r.split, r.id) for r in sampling.first_rows(df, n, ["id"]).collect()) == want
    stored = sources.position_by_key(df, ["id"])
    assert sorted((r.split, r.id) for r in sampling.first_rows(stored, n).collect()) == want


def test_smoke_rows_come_from_the_first_config(spark):
    df = placed(spark, {"a": 30, "b": 4}).unionByName(placed(spark, {"a": 5}).withColumn("config", F.lit("z")))
    got = sampling.smoke_rows(df, ["id"]).groupBy("config", "split").count().collect()
    assert sorted(map(tuple, got)) == [("c", "a", 10), ("c", "b", 4)]


def test_staging_replaces_only_its_own_chunks(spark, tmp_path):
    path = str(tmp_path / "staging")
    df = sources.position_by_key(placed(spark, {"a": 23}), ["id"])
    sources.stage_chunks(df, path, 5)
    sources.stage_chunks(df.where("row_idx BETWEEN 5 AND 9").withColumn("text", F.lit("new")), path, 5)
    back = sources.read_corpus(spark, path)
    assert back.count() == 23
    assert sorted(r.row_idx for r in back.where("text = 'new'").collect()) == [5, 6, 7, 8, 9]
    assert {p.name for p in Path(path, "config=c", "split=a").iterdir()} == {f"chunk_group={i}" for i in range(5)}


def test_manifest_lists_sorted_splits_of_each_config(spark, tmp_path):
    df = placed(spark, {"test": 2, "a": 3})
    entries = sources.manifest(df, ["text"])
    assert [tuple(r) for r in entries.collect()] == [
        ("c", "a", 3, 3, "data/config=c/split=a"), ("c", "test", 2, 2, "data/config=c/split=test"),
    ]
    sources.write_manifest(entries, str(tmp_path / "m"))
    lines = [line for p in Path(tmp_path, "m").glob("*.json") for line in p.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{
        "config_name": "c",
        "data_files": [{"split": "a", "path": "data/config=c/split=a"}, {"split": "test", "path": "data/config=c/split=test"}],
    }]
