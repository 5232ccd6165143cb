"""Every query of the package on whole tables against brute force, SQL, or what its contract promises."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
import brute
from tonguemill.llm import queries as Q
from tonguemill.llm.html_text import main_text

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{DIR}/documents.parquet").to_pylist()


def rows_of(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


def test_sources_are_mixed_to_their_targets(spark, docs):
    got = Q.op2_source_mix(spark, DIR).collect()
    sizes = {d["doc_id"]: len(brute.BLANK_WORDS.findall(d["text"])) for d in docs}
    source = {d["doc_id"]: d["source"] for d in docs}
    total, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r.size == sizes[r.doc_id] and 0 <= r.taken <= 3 * r["size"]
        total[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    names = sorted(total)
    assert len(got) == len(docs)
    assert [target[n] for n in names] == pytest.approx(brute.targets([total[n] for n in names]))
    assert all(r.source_size == total[source[r.doc_id]] for r in got)
    assert all(abs(taken[n] - target[n]) <= 0.01 * target[n] + 5 for n in names)
    assert sorted(got) == sorted(Q.op2_source_mix(spark, DIR).collect())


def test_token_lengths(spark, docs):
    import base64

    import tiktoken

    from tonguemill.llm import token_counts as T

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(T.VOCABULARY, "rb"))}
    whole = tiktoken.Encoding("whole", pat_str=T.BytePairs().pattern, mergeable_ranks=ranks, special_tokens={})
    lengths = [len(whole.encode_ordinary(d["text"])) for d in docs]
    sums = Q.op3_token_lengths(spark, DIR)
    for r in sums.collect():
        assert (r.docs, r.docs_at_least, r.tokens_at_least) == (
            lengths.count(r.n_tokens), sum(x >= r.n_tokens for x in lengths), sum(x for x in lengths if x >= r.n_tokens))
        assert r.truncated_total == sum(min(x, r.n_tokens) for x in lengths)
        assert r.quantile == pytest.approx(sum(x <= r.n_tokens for x in lengths) / len(lengths))
    limits = [0, 7, 512, 2048, max(lengths), max(lengths) + 9]
    for r in T.totals(sums, limits).collect():
        cut = sum(min(x, r.limit) for x in lengths)
        assert (r.docs_over, r.truncated_total, r.tokens_lost) == (sum(x > r.limit for x in lengths), cut, sum(lengths) - cut)


def test_secret_spans(spark, docs):
    got = rows_of(Q.op4_secret_spans(spark, DIR), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == {d["doc_id"]: brute.secrets(d["text"]) for d in docs}


def test_near_duplicates(spark, docs):
    got = rows_of(Q.op5_near_duplicates(spark, DIR), "doc_id", "n_shingles", "component_id")
    assert got == brute.near_duplicates([(d["doc_id"], d["text"]) for d in docs])


def test_top_k_matches_sql(spark):
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DIR}/embeddings.parquet'")
        want = c.sql("SELECT query_id, rank, vec_id, score FROM (" + Q.ORACLE["op6_exact_top_k"] + ")").fetchall()
    assert sorted(map(tuple, Q.op6_exact_top_k(spark, DIR).collect())) == sorted(want)


def test_long_repeats(spark, docs):
    got = rows_of(Q.op7_long_repeats(spark, DIR), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == dict(zip([d["doc_id"] for d in docs], brute.long_repeats([d["text"] for d in docs])))


def test_license_notices(spark, docs):
    got = rows_of(Q.op8_license_notices(spark, DIR), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {d["doc_id"]: brute.licenses(d["text"]) for d in docs}


def test_toxicity_on_held_out_labels(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{DIR}/labels.parquet").to_pylist()}
    got = Q.op9_toxicity(spark, DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in got)
    known = [r for r in got if r.held_out and r.doc_id in toxic]
    wrong = [r for r in known if r.predicted and not toxic[r.doc_id]]
    found = [r for r in known if r.predicted and toxic[r.doc_id]]
    assert len(wrong) <= 0.02 * len(known)
    assert len(found) >= 0.6 * sum(toxic[r.doc_id] for r in known)


def test_decontamination(spark, docs):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{DIR}/benchmark.parquet").to_pylist()]
    got = rows_of(Q.op10_decontamination(spark, DIR), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == dict(zip([d["doc_id"] for d in docs], brute.contamination([d["text"] for d in docs], items)))


def test_pages(spark):
    pages = pq.read_table(f"{DIR}/pages.parquet").to_pylist()
    got = {r.page_id: r for r in Q.op1_html_text(spark, DIR).collect()}
    assert len(got) == len(pages)
    for p in pages:
        text = got[p["page_id"]].text
        assert text == main_text(p["html"]) and got[p["page_id"]].n_chars == len(text)
        body = p["html"].split("<article>")[1].split("</article>")[0]
        assert "track(" not in text and "·" not in text and not any(line != line.strip() or "  " in line for line in text.split("\n"))
        assert len(text) >= 0.8 * len(body) - 200 - body.count("&") * 5 - 10 * body.count("<")


def test_pipeline(spark, docs):
    """Each stage against brute force on what it was given."""
    given = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = given.columns
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{DIR}/benchmark.parquet").to_pylist()]
    stages = dict(corpus_pipeline.STAGES)
    from tonguemill.session import materialize

    clean = materialize(stages["toxicity"](spark, given, DIR))
    kept = {r.doc_id for r in clean.collect()}
    gone = {r.doc_id for r in Q.op9_toxicity(spark, DIR).filter("predicted = 1").collect()}
    assert kept == {d["doc_id"] for d in docs} - gone
    one = materialize(stages["near_dedup"](spark, clean, DIR))
    groups = brute.near_duplicates([(d["doc_id"], d["text"]) for d in docs if d["doc_id"] in kept])
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, c in groups.values()})
    free = materialize(stages["decontamination"](spark, one, DIR))
    rows = one.collect()
    hits = brute.contamination([r.text for r in rows], items)
    assert sorted(r.doc_id for r in free.collect()) == sorted(r.doc_id for r, h in zip(rows, hits) if not h[4])
    masked = materialize(stages["secrets"](spark, free, DIR))
    before, after = {r.doc_id: r for r in free.collect()}, {r.doc_id: r for r in masked.collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        secret = sum(brute.secrets(before[i].text)[:3]) > 0
        assert not secret or ("[secret]" in r.text and r.n_chars == len(r.text))
        assert sum(brute.secrets(r.text)[:3]) == 0 or secret
    assert masked.columns == free.columns == one.columns == clean.columns == columns
    mixed = stages["mixing"](spark, masked, DIR)
    words = defaultdict(int)
    for r in mixed.collect():
        assert 0 < r.mix_words <= len(brute.BLANK_WORDS.findall(r.text)) and 0 <= r.mix_shard < 64
        words[r.doc_id] += r.mix_words
    assert all(words[i] <= 3 * len(brute.BLANK_WORDS.findall(r.text)) for i, r in after.items())
    whole = sum(len(brute.BLANK_WORDS.findall(r.text)) for r in after.values())
    assert abs(sum(words.values()) - whole) <= 0.01 * whole
    assert corpus_pipeline.run(spark, DIR).count() == mixed.count()
