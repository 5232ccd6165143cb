import random

import pytest
from pyspark.sql import functions as F

from tonguemill.operators import cost
from tonguemill.operators.projection import CONVERSATION, SYSTEM, TEXT
from tonguemill.sources.corpus import as_corpus

MIXED = [
    ("You are a helper.", "[{'from': 'user', 'value': 'Hi there'}, {'from': 'gpt', 'value': 'Hello'}]", "One two three"),
    ("You are a helper.", "not a list", None),
    ("Other", "[]", ""),
    ("You are a helper.", None, "ñandú 😀"),
]
MIXED_SCHEMA = "system string, conversations string, text string"


@pytest.fixture(scope="module")
def mixed(spark):
    return as_corpus(spark.createDataFrame(MIXED, MIXED_SCHEMA))


def test_mixed_roles(mixed):
    row = cost.estimate_cost(mixed).first()
    assert row.total_chars == 99
    assert (row.system_unique_chars, row.system_unique_prompts) == (22, 2)
    assert (row.conversation_chars, row.other_chars) == (23, 20)
    assert (row.total_tokens, row.regular_input_tokens) == (39, 16)
    assert (row.cached_input_tokens, row.output_tokens) == (10, 13)
    assert row.aws_cost == 0.0
    assert row.openai_cost == pytest.approx(1.095e-05, abs=1e-15)


def test_columns_a_table_lacks_are_skipped(mixed):
    row = cost.cost_counters(mixed, ["text", "no_such_column"]).first()
    assert (row.total_chars, row.system_unique_prompts) == (20, 0)


def test_a_singular_conversation_column_counts_as_text(mixed):
    renamed = mixed.withColumnRenamed("conversations", "conversation").select("config", "split", "conversation")
    row = cost.cost_counters(renamed).first()
    assert (row.conversation_chars, row.other_chars) == (0, sum(len(c) for _, c, _ in MIXED if c))


def test_values_of_any_type_are_measured_as_python_prints_them(spark):
    df = as_corpus(spark.sql("SELECT 12 AS a, true AS b, array('x', NULL) AS c, named_struct('k', 1.5D) AS d, 1e20D AS e"))
    printed = [str(v) for v in (12, True, ["x", None], {"k": 1.5}, 1e20)]
    assert cost.cost_counters(df).first().total_chars == sum(map(len, printed))


def test_empty_corpus(spark):
    row = cost.estimate_cost(as_corpus(spark.createDataFrame([], MIXED_SCHEMA))).first()
    assert set(row[c] for c in cost.COUNTERS) == {0}
    assert (row.aws_cost, row.openai_cost) == (0.0, 0.0)


def brute_force(rows):
    """The counters by one pass over rows of (config, split, system, conversations, text), in order."""
    seen, out = set(), dict.fromkeys(cost.COUNTERS, 0)
    for _, _, system, conversation, text in rows:
        tokens = lambda s: int(len(s.split()) / 0.75)
        if system is not None:
            out["total_chars"] += len(system)
            out["total_tokens"] += tokens(system)
            if system in seen:
                out["cached_input_tokens"] += tokens(system)
            else:
                seen.add(system)
                out["system_unique_prompts"] += 1
                out["system_unique_chars"] += len(system)
                out["regular_input_tokens"] += tokens(system)
        if conversation is not None:
            try:
                n = sum(len(str(e["value"])) for e in eval(conversation) if e.get("value"))
            except Exception:
                n = len(conversation)
            t = tokens(conversation)
            out["total_chars"] += n
            out["conversation_chars"] += n
            out["total_tokens"] += t
            out["regular_input_tokens"] += int(t * 0.33)
            out["output_tokens"] += t - int(t * 0.33)
        if text is not None:
            out["total_chars"] += len(text)
            out["other_chars"] += len(text)
            out["total_tokens"] += tokens(text)
            out["regular_input_tokens"] += tokens(text)
    return out


def random_rows(seed, n=400):
    rng = random.Random(seed)
    words = ["a", "bé", "　", "𝔘x", "\t", " ", "\n\n", "tail.", "\x1c", "ß"]

    def text():
        return None if rng.random() < 0.1 else "".join(rng.choice(words) for _ in range(rng.randrange(12)))

    def talk():
        if rng.random() < 0.2:
            return text()
        return str([{"from": "u", "value": text()} for _ in range(rng.randrange(4))])

    rows = []
    for _ in range(n):
        # One split and one prompt hold a third of all rows and more.
        split = "big" if rng.random() < 0.5 else rng.choice(["s1", "s2", "s3"])
        prompt = "hot prompt" if rng.random() < 0.4 else rng.choice(["p one", "p two", None, ""])
        rows.append(("c", split, prompt, talk(), text()))
    return rows


SCHEMA = "config string, split string, system string, conversations string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_counters_equal_one_pass_over_the_rows(spark, seed):
    rows = sorted(random_rows(seed), key=lambda r: r[:2])
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_force(rows)
    assert cost.cost_counters(df).first().asDict() == want
    shuffled = df.orderBy(F.rand(seed))
    assert cost.cost_counters(shuffled).first().asDict() == want
    per_split = cost.split_counters(shuffled).collect()
    assert {c: sum(r[c] for r in per_split) for c in cost.COUNTERS} == want
    # The prompt belongs to the first split in order, as in a pass over the splits in order.
    first = next(r for r in per_split if r.split == "big")
    assert first.asDict() | {"config": "c"} == {
        **brute_force([r for r in rows if r[1] == "big"]), "config": "c", "split": "big",
    }


def test_explicit_roles_override_names(mixed):
    roles = {"text": SYSTEM, "system": TEXT, "conversations": CONVERSATION}
    row = cost.cost_counters(mixed, roles).first()
    assert (row.system_unique_prompts, row.system_unique_chars) == (3, 20)


def one_row(spark, aws, openai):
    return cost.verdict(spark.createDataFrame([(aws, openai)], "aws_cost double, openai_cost double")).first()


def test_verdict(spark):
    assert one_row(spark, 2.0, 2.0).cheaper == "equal"
    assert one_row(spark, 0.0, 0.0)[2:] == ("equal", 0.0, 0.0)
    assert one_row(spark, 1.0, 4.0)[2:] == ("aws", 3.0, 75.0)
    assert one_row(spark, 5.0, 4.0)[2:] == ("openai", 1.0, 20.0)


def test_extrapolation(spark):
    rows = [("c", "a", i, "x" * 10) for i in range(20)] + [("c", "b", i, "y" * 30) for i in range(2)]
    df = spark.createDataFrame(rows, "config string, split string, row_idx bigint, text string")
    prices = cost.Prices(free_chars=100)
    reference = cost.extrapolate_cost(df, 5, ["text"], prices=prices, mode="reference").first()
    # 5 * 10 + 2 * 30 characters sampled, 10 over the free tier, times 22 / 5.
    assert reference.factor == 22 / 5
    assert reference.aws_cost == pytest.approx(10 / 1e6 * 15 * 22 / 5)
    corrected = cost.extrapolate_cost(df, 5, ["text"], prices=prices).first()
    assert corrected.aws_cost == pytest.approx((20 * 10 + 2 * 30 - 100) / 1e6 * 15)
    whole = cost.extrapolate_cost(df, 22, ["text"], prices=prices, mode="reference").first()
    assert whole.factor == 1.0
    with pytest.raises(ValueError):
        cost.extrapolate_cost(df, 0, ["text"])


def test_one_exchange_per_grouping_and_no_join(mixed):
    plan = mixed.sparkSession._jvm.PythonSQLUtils.explainString(
        cost.estimate_cost(mixed.drop("conversations"))._jdf.queryExecution(), "simple"
    )
    assert plan.count("Exchange") == 2 and "Join" not in plan
