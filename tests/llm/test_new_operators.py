"""Divergence of sources, ranked search and pieces: whole tables against SQL or the library, odd rows against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import floor, log

import brute
import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece

from tonguemill.llm import divergence, pieces, ranked
from tonguemill.llm import queries as Q

DIR = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, source string, term string, n long, ids array<int>, shard long, score double"


def make(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1, [1], 2, 0.5) for i, t, lang, s in rows], ODD)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice(["Alpha", "beta", "Ünï", "gamma9delta", "x", "éa", "the", "THE"]) for _ in range(n))
    rows = [(i, some(rng.randint(0, 40)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])) for i in range(120)]
    rows += [(7, some(30_000), "en", "a"), (8, None, "en", "d"), (None, None, None, None), (9, "", "xx", "p"), (9, "one two", "xx", "q"), (None, some(9), "en", "a")]
    return rows + rows[:9] + [(200 + i, "the same words again the", "en", "a") for i in range(80)]


def sql_rows(name):
    with duckdb.connect() as c:
        for t in ("documents", "benchmark"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        found = c.sql(Q.ORACLE[name])
        order = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
        return sorted(tuple(r[i] for i in order) for r in found.fetchall())


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_ranked_search"])
def test_whole_tables_match_sql(spark, name):
    got = Q.QUERIES[name](spark, DIR)
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect())) == sql_rows(name)


# --- divergence ----------------------------------------------------------------------------------------------------


def brute_divergence(rows):
    letters = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    n, docs, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = letters.findall((text or "").translate(brute.LOWER))
        n.update((lang, source, w) for w in words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        terms = sorted(w for (x, w), d in docs.items() if x == lang and d >= 3)
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(n[lang, s, w] for w in terms) for s in sources}
        p = {(s, w): 1 + 10**9 * (n[lang, s, w] + 1) // (total[s] + len(terms)) for s in sources for w in terms}
        q = {w: 1 + 10**9 * (sum(n[lang, s, w] for s in sources) + 1) // (sum(total.values()) + len(terms)) for w in terms}
        for s in sources:
            pairs = [(o, sum((p[s, w] - p[o, w]) ** 2 // p[o, w] for w in terms)) for o in sources if o != s]
            over = [(w, (p[s, w] - q[w]) ** 2 // q[w]) for w in terms if n[lang, s, w] and p[s, w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", over, 200)):
                ranked_ = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked_, 1)]
    return sorted(out)


@pytest.mark.parametrize("section", [3, 1 << 18])
def test_divergence_of_odd_rows(spark, odd_rows, section):
    got = divergence.audit(make(spark, odd_rows), section=section)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_divergence(odd_rows)
    assert divergence.audit(make(spark, [])).count() == 0


def test_run_columns_hold_the_counts():
    rng = random.Random(3)
    for _ in range(200):
        widths = [rng.randint(1, 4) for _ in range(rng.randint(1, 9))]
        ends = np.cumsum(widths)
        dense = [rng.choice([0, 0, 1, 2]) for _ in widths]
        held = [(int(e) - w, w, c) for e, w, c in zip(ends, widths, dense) if c]
        starts, counts = divergence.runs_of(*(list(x) for x in zip(*held)), int(ends[-1])) if held else ([0], [0])
        assert starts[0] == 0 and all(a != b for a, b in zip(counts, counts[1:]))
        spread = np.repeat(counts, np.diff([*starts, int(ends[-1])])).tolist()
        assert spread == np.repeat(dense, widths).tolist()


def test_shares_beyond_64_bits():
    counts = np.array([0, 5, 10**13], np.int64)
    assert divergence._shares(counts, 3 * 10**13, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (3 * 10**13 + 7) for c in counts]


# --- ranked search -------------------------------------------------------------------------------------------------


def brute_search(rows, items, top):
    docs = [(i, Counter(brute.WORDS.findall((t or "").translate(brute.LOWER)))) for i, t, *_ in rows]
    n_docs, n_words = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in set(items):
        terms = sorted(set(brute.WORDS.findall((text or "").translate(brute.LOWER))))
        scored = []
        for i, c in docs:
            m = 50 + (50 * c.total() * n_docs) // n_words if n_words else 50
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m)) for w in terms if c[w])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", [ranked.Search(), ranked.Search(top=7, shard_words=60, block_words=4, opened=2, table_bytes=1), ranked.Search(top=3, shard_docs=5)])
def test_search_of_odd_rows(spark, odd_rows, how):
    items = [("i1", "the Alpha words"), ("i2", "x x delta gamma9delta"), (None, "éa again"), ("i3", None), ("i4", ""), ("i5", "nowhere"), ("i1", "the Alpha words")]
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id string, text string, no long, w long")
    got = ranked.search(make(spark, odd_rows), bench, how)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(odd_rows, items, how.top)
    assert ranked.search(make(spark, []), bench, how).count() == ranked.search(make(spark, odd_rows), bench.limit(0), how).count() == 0


def test_range_maxima_and_best_first():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 200))
        dense = rng.integers(0, 6, (int(rng.integers(1, 5)), n)) * rng.integers(0, 2, n)
        lists = [ranked.RangeMaximum(np.flatnonzero(row), row[row > 0].astype(np.int64), n) for row in dense if row.any()]
        low = rng.integers(0, n, 50)
        high = np.array([rng.integers(a, n + 1) for a in low])
        kept = [row for row in dense if row.any()]
        for each, row in zip(lists, kept):
            impact, doc = each.largest(low, high)
            assert impact.tolist() == [int(row[a:b].max(initial=0)) for a, b in zip(low, high)]
            assert all(row[d] == i and row[a:d].max(initial=0) < i for a, d, i in zip(low, doc, impact) if i)
        how = ranked.Search(top=5, opened=int(rng.integers(1, 9)))
        total = sum(kept, np.zeros(n, np.int64))
        want = sorted((-int(s), d) for d, s in enumerate(total) if s)[:5]
        docs, scores = ranked.best_documents(lists, n, how)
        assert list(zip((-scores).tolist(), docs.tolist())) == want


# --- pieces --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def digests(library, text):
    ids = library.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def test_pieces_of_all_documents(spark, library):
    docs = pq.read_table(f"{DIR}/documents.parquet").to_pylist()
    got = {r.doc_id: tuple(r[1:]) for r in Q.op13_piece_tokens(spark, DIR).collect()}
    assert got == {d["doc_id"]: digests(library, d["text"]) for d in docs}


def test_pieces_of_odd_texts(library):
    rng = random.Random(2)
    table = pieces.Pieces(remembered=50, pairs=200).open()
    letters = ["▁", " ", "  ", "a", "e", "t", "the", "in", "\n", "\t", "é", "😀", "ﬁ", "x́", "\x00", "日本", "<0x0A>", "</s>", "aaaa", "....", "7", " " * 20, "က"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(list(table.ids)) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    texts += ["".join(rng.choice("abcdehe") for _ in range(100_000)), "word " * 100_000, "", " " * 5000]
    assert [t for t in texts if table.ids_of(t) != library.encode(t)] == []


def test_pieces_of_odd_rows(spark, odd_rows, library):
    got = pieces.encode(make(spark, odd_rows))
    want = sorted([(i, library.encode(t or "")) for i, t, *_ in odd_rows], key=repr)
    assert sorted([(r.doc_id, r.ids) for r in got.collect()], key=repr) == want
    back = pieces.decode(got)
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=repr) == sorted([(i, t or "") for i, t, *_ in odd_rows], key=repr)
    assert pieces.report(make(spark, [])).count() == 0
    assert pieces.decode(got.selectExpr("doc_id", "cast(null as array<int>) ids").limit(1)).first().text == ""
