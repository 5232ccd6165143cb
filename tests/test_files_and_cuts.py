"""Files that cannot be read, cuts that lose nothing, byte-pair counts by a vocabulary file."""

import base64
import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from fakes import tag
from pyspark.sql import functions as F

from tonguemill import functions as fn
from tonguemill import sources
from tonguemill.operators.segments import bytes_policy, chars_policy, explode_pieces, rejoin_pieces
from tonguemill.operators.translate import Settings, translate_columns
from tonguemill.operators.translator import FunctionTranslator
from tonguemill.plans import catalog


def write(path, ids, width=10):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    rows = pa.table({"id": pa.array(ids, pa.int64()), "text": pa.array([f"{i} " * width for i in ids], pa.string())})
    pq.write_table(rows, path, compression="none", use_dictionary=False, row_group_size=50)


def test_a_broken_file_costs_its_own_rows_alone(spark, tmp_path):
    good, other = tmp_path / "good", tmp_path / "other"
    write(good / "a.parquet", range(100))
    write(good / "b.parquet", range(100, 250))
    write(good / "empty.parquet", [])
    (good / "none.parquet").write_bytes(b"")  # no scan sees it
    (good / "text.parquet").write_text("this is no Parquet file, whatever its name says")
    whole = (good / "b.parquet").read_bytes()
    (good / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    write(good / "page.parquet", range(300, 500))
    damaged = bytearray((good / "page.parquet").read_bytes())
    place = pq.ParquetFile(good / "page.parquet").metadata.row_group(2).column(1).data_page_offset
    damaged[place : place + 60] = b"\xff" * 60
    (good / "page.parquet").write_bytes(bytes(damaged))
    write(other / "z.parquet", range(900, 903))
    entries = [("c", "a", str(good)), ("c", "b", str(other)), (None, None, str(tmp_path / "missing"))]
    rows, outcomes = sources.read_files(spark, entries)
    assert sorted(r.id for r in rows.collect()) == [*range(250), *range(900, 903)]
    assert {(r.config, r.split) for r in rows.select("config", "split").distinct().collect()} == {("c", "a"), ("c", "b")}
    judged = {Path(r.path).name: (r.status, r.n_rows, r.error is None) for r in outcomes.collect()}
    assert judged == {
        "a.parquet": ("readable", 100, True), "b.parquet": ("readable", 150, True), "empty.parquet": ("readable", 0, True),
        "z.parquet": ("readable", 3, True), "text.parquet": ("unreadable", 0, False),
        "cut.parquet": ("unreadable", 0, False), "page.parquet": ("unreadable", 0, False), "missing": ("unreadable", 0, False),
    }


def test_nothing_readable(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("nothing")
    with pytest.raises(ValueError, match="none of the files"):
        sources.read_files(spark, [(None, None, str(tmp_path))])
    schema = spark.createDataFrame([], "id bigint, text string").schema
    rows, outcomes = sources.read_files(spark, [(None, None, str(tmp_path))], schema)
    assert rows.count() == 0 and outcomes.first().status == "unreadable"


TEXTS = [
    "One. Two.\n\nThree.  Four. ", "\n\n\n", " " * 90, "x" * 130, "a. " * 60, ". . . .\n\n. ", "é. ñ\n\nü" * 20, "  lead and tail \n", "", None,
    "no end", "A sentence. Another one.\n\n\n\nA third,\twith blanks   inside. \n\n Last",
]


@pytest.mark.parametrize("policy", [
    bytes_policy(limit=40, preserve_separators=True), chars_policy(limit=12, preserve_separators=True), bytes_policy(limit=9_900, preserve_separators=True)])
def test_cuts_that_keep_separators_give_the_text_back(spark, policy):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(["a", "bc ", ". ", "\n\n", " ", "\t", "é", "😀", ".", "　"]) for _ in range(rng.randint(0, 120))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    some = df.where("text <> ''")
    pieces = explode_pieces(some, ["id"], "text", policy)
    joined = {r.id: r.text for r in rejoin_pieces(pieces, ["id"], policy).collect()}
    assert joined == {i: t for i, t in enumerate(texts) if t}
    size = F.octet_length("piece") if policy.kind == "bytes" else F.length("piece")
    assert pieces.where(size > policy.limit).isEmpty()
    assert pieces.where(fn.strip_text("piece") != F.col("piece")).isEmpty()
    same = translate_columns(df, ["id"], Settings(FunctionTranslator(str), policy), ["text"])
    assert [r.text for r in same.orderBy("id").collect()] == texts


def test_separators_stand_between_replies(spark):
    df = spark.createDataFrame([(0, "One. Two.\n\nThree. ")], "id int, text string")
    policy = bytes_policy(limit=6, preserve_separators=True)
    got = translate_columns(df, ["id"], Settings(FunctionTranslator(tag), policy), ["text"]).first().text
    assert got == "[es] One. [es] Two.\n\n[es] Three. "
    assert bytes_policy().fingerprint != policy.fingerprint and "preserve" not in bytes_policy().fingerprint


def test_byte_pairs_of_all_documents(spark, sf_dir):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(catalog.VOCABULARY, "rb"))}
    whole = tiktoken.Encoding("whole", pat_str=fn.Vocabulary("").pattern, mergeable_ranks=ranks, special_tokens={})
    docs = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    got = {r.doc_id: r.n_tokens for r in catalog.bpe_tokens(spark, sf_dir).collect()}
    assert got == {d["doc_id"]: len(whole.encode_ordinary(d["text"])) for d in docs}
    odd = spark.createDataFrame([(0, None), (1, ""), (2, "<|endoftext|> x")], "id int, text string")
    tokens = fn.bpe(fn.Vocabulary(catalog.VOCABULARY).ship(spark))
    found = [r.n for r in odd.select("id", tokens("text").alias("n")).orderBy("id").collect()]
    assert found == [None, 0, len(whole.encode_ordinary("<|endoftext|> x"))]
