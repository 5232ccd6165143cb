import pytest
from fakes import Fake, tag, tag_each
from pyspark.sql import functions as F

from tonguemill.operators import memo as memos
from tonguemill.operators.batching import DELIMITER, Batching, group_cells, pack_groups
from tonguemill.operators.memo import Memo
from tonguemill.operators.segments import bytes_policy, chars_policy
from tonguemill.operators.translate import Settings, translate_columns
from tonguemill.operators.translator import FunctionTranslator, call_with_retries
from tonguemill.sources.corpus import as_corpus

ROW_KEY = ["config", "split", "row_idx"]


@pytest.fixture
def fake(tmp_path):
    def make(**settings):
        folder = tmp_path / f"calls{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        return Fake(str(folder), **settings)

    return make


def corpus(spark, texts, column="text", split="train"):
    rows = [("default", split, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"config string, split string, row_idx bigint, {column} string")


def run(df, settings, roles=None, column="text"):
    done = translate_columns(df, ROW_KEY, settings, roles, with_status=True)
    return [(r[column], r[f"{column}_status"]) for r in done.orderBy(*ROW_KEY).collect()]


def quick(**changes):
    return bytes_policy(**changes).__class__(**{**bytes_policy(**changes).__dict__, "backoff": 0.0})


# Retries


def failing(times):
    left = [times]

    def call(text):
        left[0] -= 1
        if left[0] >= 0:
            raise RuntimeError
        return tag(text)

    return call


@pytest.mark.parametrize(
    "failures, expected, waits",
    [(0, ("[es] a", "translated", 1), []), (2, ("[es] a", "translated", 3), [1.0, 1.5]), (3, ("a", "failed", 3), [1.0, 1.5])],
)
def test_retries_and_back_off(failures, expected, waits):
    slept = []
    assert call_with_retries(failing(failures), "a", bytes_policy(), slept.append) == expected
    assert slept == waits


def test_back_off_doubles_under_the_chat_policy():
    slept = []
    assert call_with_retries(failing(9), "a", chars_policy(max_retries=4), slept.append) == ("a", "failed", 4)
    assert slept == [1.0, 2.0, 4.0]


def test_no_attempts_keep_the_text():
    assert call_with_retries(tag, "a", bytes_policy(max_retries=0)) == ("a", "failed", 0)


def test_empty_and_blank_replies():
    no_wait = lambda seconds: None
    assert call_with_retries(lambda t: "", "a", bytes_policy()) == ("", "translated", 1)
    assert call_with_retries(lambda t: "", "a", chars_policy(), no_wait) == ("a", "failed", 3)
    assert call_with_retries(lambda t: "  ", "a", chars_policy()) == ("", "translated", 1)
    assert call_with_retries(lambda t: None, "a", bytes_policy(), no_wait) == ("a", "failed", 3)


# Columns


def test_values_that_are_not_sent_keep_their_place(spark, fake):
    translator = fake()
    df = corpus(spark, ["a", None, "", " ", "a"]).withColumn("n", F.col("row_idx") * 2)
    assert run(df, Settings(translator)) == [
        ("[es] a", "translated"), (None, "unchanged"), ("", "unchanged"), ("[es]  ", "translated"), ("[es] a", "translated"),
    ]
    assert translator.calls() == 2
    assert translate_columns(df, ROW_KEY, Settings(translator), ["n"]).collect() == df.collect()


def test_rows_of_failed_texts_stay(spark, fake):
    policy = quick(limit=20)
    texts = ["good text", "bad text", "first part. bad part of a text. third part"]
    got = run(corpus(spark, texts), Settings(fake(bad="bad"), policy))
    assert got == [
        ("[es] good text", "translated"),
        ("bad text", "failed"),
        ("[es] first part. bad part of a text. [es] third part.", "failed"),
    ]


def test_a_text_that_fails_twice_is_translated(spark, fake):
    translator = fake(failures=2)
    assert run(corpus(spark, ["a"]), Settings(translator, quick())) == [("[es] a", "translated")]
    assert translator.calls() == 3


def test_a_long_text_loses_outer_blanks_and_a_short_one_keeps_them(spark, fake):
    got = run(corpus(spark, [" ab. ", "  one two. three four "]), Settings(fake(reply=lambda t: t), bytes_policy(15)))
    assert [t for t, _ in got] == [" ab. ", "one two. three four."]


def test_chat_slices_are_stripped_one_by_one(spark, fake):
    settings = Settings(fake(reply=lambda t: t), chars_policy(4))
    assert run(corpus(spark, ["abc def", " a "]), settings) == [("abcdef", "translated"), ("a", "translated")]


def test_token_guard_skips_without_a_call(spark, fake):
    translator = fake()
    settings = Settings(translator, chars_policy(max_tokens=50, prompt_tokens=46))
    assert run(corpus(spark, ["x" * 19, "x" * 20]), settings) == [
        ("[es] " + "x" * 19, "translated"), ("x" * 20, "skipped_tokens"),
    ]
    assert translator.calls() == 1


# Memo


def test_the_memo_is_kept_between_runs_and_per_service(spark, fake, tmp_path):
    memo, first = Memo(str(tmp_path / "memo")), fake()
    df = corpus(spark, ["a", "b", "a"])
    run(df, Settings(first, memo=memo))
    assert first.calls() == 2
    assert run(corpus(spark, ["b", "c"]), Settings(first, memo=memo)) == [("[es] b", "translated"), ("[es] c", "translated")]
    assert first.calls() == 3
    other = fake(model="m2", reply=lambda t: "[m2] " + t)
    assert run(df, Settings(other, memo=memo))[0] == ("[m2] a", "translated")
    assert run(df, Settings(other, bytes_policy(5_000), memo=memo))[1] == ("[m2] b", "translated")
    assert other.calls() == 4


def test_two_results_that_share_a_memo_can_meet_in_one_query(spark, fake, tmp_path):
    settings = Settings(fake(), memo=Memo(str(tmp_path / "memo")))
    parts = [translate_columns(corpus(spark, [t], split=t), ROW_KEY, settings, ["text"]) for t in ("a", "b", "c")]
    together = parts[0].union(parts[1]).union(parts[2])
    assert sorted(r.text for r in together.collect()) == ["[es] a", "[es] b", "[es] c"]


def test_failed_replies_are_remembered(spark, fake, tmp_path):
    memo, translator = Memo(str(tmp_path / "memo")), fake(bad="a")
    for _ in range(2):
        assert run(corpus(spark, ["a"]), Settings(translator, quick(), memo=memo)) == [("a", "failed")]
    assert translator.calls() == 3


def test_memo_in_slices(spark, fake):
    translator = fake()
    texts = [f"text {i % 40}" for i in range(100)]
    got = run(corpus(spark, texts), Settings(translator, memo_slices=3, concurrency=2))
    assert got == [(tag(t), "translated") for t in texts]
    assert translator.calls() == 40


def test_hot_texts_are_spread_and_the_result_is_the_same(spark, fake):
    texts = ["hot" if i % 3 == 0 else f"text {i}" for i in range(600)] + ["warm"] * 50
    df = corpus(spark, texts)
    spread = Settings(fake(), hot_share=0.01, hot_min_rows=1)
    assert run(df, spread) == [(tag(t), "translated") for t in texts]
    index = memos.with_digest(df.withColumnRenamed("text", "piece"))
    hot = {r.n_salts for r in memos.hot_texts(index, 0.01, 1).collect()}
    assert hot == {34, 9}  # 200 and 50 lookups in parts of at most 6
    assert memos.hot_texts(index, 0.5, 1) is None
    replies = index.select("text_hash").distinct().withColumns({
        "translated": F.lit("x"), "status": F.lit("translated"),
    })
    joined = memos.look_up(index, replies, ROW_KEY, memos.hot_texts(index, 0.01, 1))
    assert joined.count() == 650 and joined.where("translated IS NULL").count() == 0


# Conversations


def conversations(spark, cells, column="conversations"):
    return corpus(spark, cells, column)


def test_only_values_of_conversations_are_translated(spark, fake):
    cells = [
        "[{'from': 'user', 'value': 'hi'}, {'from': 'gpt', 'value': \"it's\", 'n': None}]",
        "[{'value': 3}, 7, {'value': ''}, {'from': 'value'}]",
        "not a list",
        "{'value': 'a'}",
        None,
        "[{'value': 'hi'}]",
    ]
    translator = fake()
    got = [t for t, _ in run(conversations(spark, cells), Settings(translator), column="conversations")]
    assert got == [
        "[{'from': 'user', 'value': '[es] hi'}, {'from': 'gpt', 'value': \"[es] it's\", 'n': None}]",
        *cells[1:5],
        "[{'value': '[es] hi'}]",
    ]
    assert translator.calls() == 2


def test_an_unchanged_conversation_keeps_its_spelling(spark, fake):
    cell = '[  {"value":"a"} ]'
    assert run(conversations(spark, [cell], "conversation"), Settings(fake(reply=lambda t: t)), column="conversation") == [
        (cell, "translated")
    ]


def test_missing_conversations_may_become_empty(spark, fake):
    got = run(conversations(spark, [None]), Settings(fake(), null_conversation="empty"), column="conversations")
    assert got == [("", "unchanged")]


def test_long_values_of_a_conversation_are_cut_and_rejoined(spark, fake):
    cell = str([{"value": "first one. second one. third"}, {"value": "b"}])
    got = run(conversations(spark, [cell]), Settings(fake(), bytes_policy(15)), column="conversations")
    assert got[0][0] == str([{"value": "[es] first one. [es] second one. [es] third."}, {"value": "[es] b"}])


def test_several_columns_and_roles(spark, fake):
    df = corpus(spark, ["a", "b"]).withColumns({
        "system": F.lit("s"), "conversations": F.lit("[{'value': 'a'}]"), "other": F.lit("o"),
    })
    translator = fake()
    rows = translate_columns(df, ROW_KEY, Settings(translator), ["text", "system", "conversations", "missing"]).collect()
    assert {tuple(r)[3:] for r in rows} == {
        ("[es] a", "[es] s", "[{'value': '[es] a'}]", "o"), ("[es] b", "[es] s", "[{'value': '[es] a'}]", "o"),
    }
    assert translator.calls() == 3


# Packing


def groups(spark, texts, batching=Batching(), role="text"):
    cells = corpus(spark, texts).withColumns({"col": F.lit("c"), "role": F.lit(role)})
    packed = pack_groups(group_cells(cells, batching), batching).orderBy("chunk_id", "map_batch", "group_id")
    return [([m.row_idx for m in r.members], r.eligible) for r in packed.collect()]


def test_groups_skip_what_is_not_sent_and_restart_in_every_map_batch(spark):
    assert groups(spark, ["a", None, "b", "", "c", "d", "e", "f"]) == [([0, 2, 4, 5, 6], True), ([7], False)]
    assert [len(rows) for rows, _ in groups(spark, ["t"] * 70)] == [5] * 12 + [4, 5, 1]
    assert [len(rows) for rows, _ in groups(spark, ["t"] * 25, Batching(chunk_size=10, batch_size=4))] == [4, 4, 2] * 2 + [4, 1]


def test_a_single_text_in_a_map_batch_is_not_packed(spark):
    assert groups(spark, ["a", None, None]) == []
    assert groups(spark, ["a", ""]) == [([0], False)]


def test_limits_of_a_packed_request(spark):
    assert groups(spark, ["x" * 1_500, "b"]) == [([0, 1], True)]
    assert groups(spark, ["x" * 1_501, "b"]) == [([0, 1], False)]
    assert groups(spark, ["😀" * 1_230, "😀" * 1_235, "y" * 2], Batching()) == [([0, 1, 2], True)]  # 9,900 bytes
    assert groups(spark, ["😀" * 1_230, "😀" * 1_235, "y" * 3], Batching()) == [([0, 1, 2], False)]


def test_equal_system_prompts_are_not_packed(spark):
    assert groups(spark, ["s", "s"], role="system") == []
    assert groups(spark, ["s", None], role="system") == []
    assert groups(spark, ["s", "t"], role="system") == [([0, 1], True)]


def test_packed_requests_come_apart(spark, fake):
    texts = [" a", "b ", None, "c", "d", "e", "f", "", "g" * 1_600]
    translator = fake(reply=tag_each)
    got = run(corpus(spark, texts), Settings(translator, batching=Batching()))
    assert [t for t, _ in got] == [
        "[es]  a", "[es] b", None, "[es] c", "[es] d", "[es] e", "[es] f", "", "[es] " + "g" * 1_600,
    ]
    assert translator.calls() == 3  # five at once, two alone


@pytest.mark.parametrize(
    "reply", [lambda t: t.replace(DELIMITER, " "), lambda t: t + DELIMITER if DELIMITER in t else t]
)
def test_replies_that_lost_or_gained_a_mark_are_redone_one_by_one(spark, fake, reply):
    translator = fake(reply=reply)
    assert run(corpus(spark, [" a ", "b", "c"]), Settings(translator, batching=Batching())) == [
        (" a ", "translated"), ("b", "translated"), ("c", "translated"),
    ]
    assert translator.calls() == 4


def test_a_text_that_holds_the_mark_goes_alone(spark, fake):
    texts = ["a" + DELIMITER + "b", "c"]
    translator = fake()
    got = run(corpus(spark, texts), Settings(translator, batching=Batching()))
    assert [t for t, _ in got] == [tag(texts[0]), tag("c")]


def test_a_failed_packed_request_returns_its_stripped_texts(spark, fake):
    got = run(corpus(spark, [" a ", "b"]), Settings(fake(bad="a"), quick(), batching=Batching()))
    assert got == [("a", "failed"), ("b", "failed")]


def test_packing_leaves_conversations_alone(spark, fake):
    df = corpus(spark, ["a", "b", None]).withColumns({
        "conversations": F.lit("[{'value': 'c'}]"), "system": F.lit("s"),
    })
    translator = fake(reply=tag_each)
    rows = translate_columns(df, ROW_KEY, Settings(translator, batching=Batching())).orderBy("row_idx").collect()
    assert [tuple(r)[3:] for r in rows] == [
        (t, "[{'value': '[es] c'}]", "[es] s") for t in ("[es] a", "[es] b", None)
    ]
    assert translator.calls() == 3  # a and b at once, c, s


def test_packed_requests_stay_within_the_limit_of_the_policy(spark, fake):
    texts = ["word " * 12, "other " * 10]
    settings = Settings(fake(reply=tag_each), bytes_policy(limit=100), batching=Batching())
    assert [t for t, _ in run(corpus(spark, texts), settings)] == [tag(t) for t in texts]


def test_keys_are_checked_before_any_call_and_may_be_null(spark, fake):
    translator = fake()
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, text string")
    with pytest.raises(ValueError, match="identify"):
        translate_columns(twice, ["id"], Settings(translator), ["text"])
    assert translator.calls() == 0
    nulls = spark.createDataFrame([(None, "a"), (1, "b")], "id int, text string")
    rows = translate_columns(nulls, ["id"], Settings(translator), ["text"], with_status=True).collect()
    assert sorted((r.id or 0, r.text, r.text_status) for r in rows) == [(0, "[es] a", "translated"), (1, "[es] b", "translated")]


def test_replies_are_found_without_success_marks(spark, fake):
    marks = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark.conf.set(marks, "false")
    try:
        assert run(corpus(spark, ["a", "b"]), Settings(fake())) == [("[es] a", "translated"), ("[es] b", "translated")]
    finally:
        spark.conf.unset(marks)


def test_packing_needs_positions(spark, fake):
    df = as_corpus(spark.createDataFrame([(1, "a")], "id int, text string"))
    with pytest.raises(ValueError, match="row_idx"):
        translate_columns(df, ["id"], Settings(FunctionTranslator(tag), batching=Batching()), ["text"])
