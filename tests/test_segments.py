import random

import pytest
from pyspark.sql import functions as F

from tonguemill.operators.segments import bytes_policy, chars_policy, explode_pieces, rejoin_pieces

LIMIT = 200


def expected_bytes(text, limit):
    """Pieces by the stated rules: pack sentences while bytes + 1 for each fit, cut what still is too long."""
    if len(text.encode()) <= limit:
        return [(0, 0, text, "whole")]
    packs = []
    for s in (s.strip() + "." for p in text.split("\n\n") for s in p.split(". ") if s.strip()):
        need = len(s.encode()) + 1
        if packs and packs[-1][1] + need <= limit:
            packs[-1] = (packs[-1][0] + " " + s, packs[-1][1] + need)
        else:
            packs.append((s, need))
    out = [] if packs else [(0, 0, "", "segment")]
    for seg, (pack, _) in enumerate(packs):
        if len(pack.encode()) <= limit:
            out.append((seg, 0, pack, "segment"))
        else:
            width = limit // 4
            cuts = [pack[i : i + width] for i in range(0, len(pack), width)]
            out += [(seg, sub, cut, "hard_cut") for sub, cut in enumerate(cuts)]
    return out


def pieces(spark, texts, policy):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = explode_pieces(df, ["id"], "text", policy)
    by_id = {}
    for r in found.orderBy("id", "seg", "sub").collect():
        by_id.setdefault(r.id, []).append((r.seg, r.sub, r.piece, r.cut))
    joined = {r.id: r.text for r in rejoin_pieces(found, ["id"], policy).collect()}
    return [by_id[i] for i in range(len(texts))], [joined[i] for i in range(len(texts))]


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(3)
    parts = ["word ", "ñandú ", "😀", ". ", "end.", "\n\n", "　", "x" * 60, "\t", "y" * 240]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(300)]


def test_random_texts_in_bytes(spark, random_texts):
    texts = random_texts + [" " * 300, "\n\n" * 200, ". " * 150]
    got, joined = pieces(spark, texts, bytes_policy(LIMIT))
    assert got == [expected_bytes(t, LIMIT) for t in texts]
    assert all(len(p[2].encode()) <= LIMIT for t in got for p in t)
    for text, one, whole in zip(texts, got, joined):
        if one[0][3] == "whole":
            assert whole == text
        else:
            sentences = [s.strip() + "." for p in text.split("\n\n") for s in p.split(". ") if s.strip()]
            assert whole == " ".join(sentences).strip()


def test_random_texts_in_characters(spark, random_texts):
    got, joined = pieces(spark, random_texts, chars_policy(50))
    assert joined == random_texts
    assert all([p[2] for p in one] == [t[i : i + 50] for i in range(0, len(t), 50)] for t, one in zip(random_texts, got))


def test_borders_of_the_byte_limit(spark):
    fits = "a" * 9_899 + "."
    two = ("b" * 4_950 + ". ") * 2
    texts = [fits, fits + "!", two, "ñ" * 4_951, "x" * 12_000, " " * 9_901, "p" * 6_000 + "\n\n" + "q" * 6_000]
    got, joined = pieces(spark, texts, bytes_policy())
    assert [p[3] for p in got[0]] == ["whole"]
    assert [p[3] for p in got[1]] == ["hard_cut"] * 5  # 9,902 bytes with the added period
    assert [(len(p[2]), p[3]) for p in got[2]] == [(4_951, "segment"), (4_951, "segment")]
    assert [p[3] for p in got[3]] == ["hard_cut"] * 3
    assert [len(p[2]) for p in got[4]] == [2_475] * 4 + [2_101]
    assert got[5] == [(0, 0, "", "segment")] and joined[5] == ""
    assert [len(p[2]) for p in got[6]] == [6_001, 6_001]
    assert joined[6] == "p" * 6_000 + ". " + "q" * 6_000 + "."


def test_a_final_period_is_doubled_in_long_texts_only(spark):
    text = "One. Two."
    assert pieces(spark, [text], bytes_policy())[1] == [text]
    assert pieces(spark, [text], bytes_policy(6))[1] == ["One. Two.."]


def test_borders_of_the_character_limit(spark):
    got, _ = pieces(spark, ["é" * 8_000, "é" * 8_001, ""], chars_policy())
    assert [[len(p[2]) for p in one] for one in got] == [[8_000], [8_000, 1], [0]]


def test_a_long_text_is_cut_in_linear_work(spark):
    text = "Some sentence of a long book, with ñ. " * 100_000  # 3.9 MB
    df = spark.createDataFrame([(1,)], "id int").select("id", F.repeat(F.lit(text[:39_000]), 100).alias("text"))
    found = explode_pieces(df, ["id"], "text", bytes_policy())
    row = found.agg(F.count("*").alias("n"), F.max(F.octet_length("piece")).alias("most")).first()
    assert row.n > 390 and row.most <= 9_900
    assert explode_pieces(df, ["id"], "text", chars_policy()).count() == -(-3_900_000 // 8_000)
