import random
import sys

import pytest
from pyspark.sql import functions as F

from tonguemill import functions as fn
from tonguemill.functions.text import PY_WHITESPACE


def one(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def every_code_point():
    return [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]


def test_white_space_is_python_white_space():
    assert sorted(PY_WHITESPACE) == [c for c in every_code_point() if c.isspace()]


def test_words_and_strip_agree_with_python_for_every_code_point(spark):
    texts = [f"{c}a{c}b{c}" for c in every_code_point() if ord(c) < 0x3100 or ord(c) % 97 == 0]
    assert one(spark, texts, fn.words("t")) == [t.split() for t in texts]
    assert one(spark, texts, fn.word_count("t")) == [len(t.split()) for t in texts]
    assert one(spark, texts, fn.strip_text("t")) == [t.strip() for t in texts]


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(7)
    pieces = ["a", "ñ", "😀", ". ", ".", " ", "\n\n", "\n", " ", "word", "\x1f"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(80))) for _ in range(500)] + ["", " ", "\n\n"]


def test_lengths_and_tokens(spark, prose):
    assert one(spark, prose, fn.char_length("t")) == [len(t) for t in prose]
    assert one(spark, prose, fn.byte_length("t")) == [len(t.encode()) for t in prose]
    assert one(spark, prose, fn.words075("t")) == [int(len(t.split()) / 0.75) for t in prose]
    assert one(spark, prose, fn.chars4("t")) == [len(t) // 4 for t in prose]


def test_splits(spark, prose):
    assert one(spark, prose, fn.split_literal("t", ". ")) == [t.split(". ") for t in prose]
    sentences = [[s.strip() + "." for p in t.split("\n\n") for s in p.split(". ") if s.strip()] for t in prose]
    assert one(spark, prose, fn.sentences("t")) == sentences
    assert one(spark, prose, fn.fixed_slices("t", 7)) == [[t[i : i + 7] for i in range(0, len(t), 7)] for t in prose]


LITERALS = [
    ("[{'from': 'user', 'value': 'hi'}]", 2),
    ("[{'from': 'user', 'value': \"it's\"}]", 4),
    (r"[{'from': 'u', 'value': 'a\nb\xa0c'}]", 5),
    ("[{'from': 'u', 'value': None}]", 0),
    ("[{'from': 'u', 'value': 3}]", 1),
    ("[{'from': 'u', 'value': 'x', 'w': True}]", 1),
    ("[1, {'value':'z'}]", 1),
    ("[('a','b')]", 0),
    ("[]", 0),
    ("{'a':1}", 7),
    ('[{"from":"u","value":null}]', 27),
    ("not a list", 10),
    ("", 0),
    ("[" * 5000, 5000),
    (None, None),
]


def test_conversation_value_chars(spark):
    texts = [t for t, _ in LITERALS]
    assert one(spark, texts, fn.conversation_value_chars("t")) == [n for _, n in LITERALS]


def test_conversation_values_are_the_strings_that_can_be_sent(spark):
    texts = ["[{'value': 'a'}, {'value': 3}, 'x', {'value': ''}, {'value': '😀'}]", r"[{'value': '\ud800'}]", "no", None]
    got = one(spark, texts, fn.conversation_values("t"))
    assert [g and [tuple(x) for x in g] for g in got] == [[(0, "a"), (4, "😀")], [], None, None]


def test_rebuild_keeps_untouched_text_and_prints_changed_lists(spark):
    text = "[ {'value':'a', 'n': None},  {'value': \"b's\"} ]"
    df = spark.createDataFrame(
        [(0, text, [(0, "a")]), (1, text, [(1, "c'd\n")]), (2, text, []), (3, "x", [(0, "b")]), (4, text, None)],
        "i int, t string, r array<struct<pos:int,value:string>>",
    )
    got = [r[1] for r in df.select("i", fn.rebuild_conversation("t", "r")).orderBy("i").collect()]
    assert got == [text, str([{"value": "a", "n": None}, {"value": "c'd\n"}]), text, "x", text]


def test_python_str(spark):
    df = spark.sql(
        "SELECT 1 AS a, true AS b, 1e7D AS c, 1e-5D AS d, array(1, 2) AS e, named_struct('k', array('v')) AS f, "
        "CAST(NULL AS boolean) AS g"
    )
    row = df.select(*[fn.py_str(f.name, f.dataType).alias(f.name) for f in df.schema.fields]).first()
    assert tuple(row) == ("1", "True", "10000000.0", "1e-05", "[1, 2]", "{'k': ['v']}", None)


def test_bpe_needs_its_vocabulary(spark):
    try:
        import tiktoken

        tiktoken.get_encoding("cl100k_base")
    except Exception:
        pytest.skip("the byte-pair vocabulary is not on this machine")
    assert one(spark, ["hello world"], fn.bpe()(F.col("t"))) == [2]


def test_special_tokens_fall_back_for_that_text_alone():
    from tonguemill.functions.tokens import encoded_length

    class Encoder:
        def encode(self, text):
            if "<|end|>" in text:
                raise ValueError("special token")
            return list(text)

    assert [encoded_length(Encoder(), t) for t in ("abc", "one two <|end|>", "")] == [3, 4, 0]
