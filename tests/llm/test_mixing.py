import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import tokens
from tessera.llm.mixing import mix, sainte_lague, shares


def one_by_one(weights, seats, caps):
    out = {k: 0 for k in weights}
    for _ in range(seats):
        open_ = [k for k in weights if weights[k] > 0 and out[k] < caps.get(k, 10**9)]
        if not open_:
            break
        k = max(sorted(open_, key=str), key=lambda k: weights[k] / (2 * out[k] + 1))
        out[k] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(0, 50)), st.integers(0, 200), st.dictionaries(st.sampled_from("abcdefg"), st.integers(0, 60)))
def test_apportionment_equals_dealing_seat_by_seat(weights, seats, caps):
    assert sainte_lague(weights, seats, caps) == one_by_one(weights, seats, caps)


def test_equal_quotients_go_to_the_smaller_key():
    weights = {"a": 2, "b": 4, "c": 30, "d": 38, "e": 42}
    assert sainte_lague(weights, 49) == one_by_one(weights, 49, {})


def test_many_seats_cost_nothing():
    got = sainte_lague({"a": 0.5, "b": 0.3, "c": 0.2}, 10**12)
    assert sum(got.values()) == 10**12 and abs(got["a"] - 5 * 10**11) <= 1


@pytest.fixture
def corpus(spark):
    rng = random.Random(7)
    rows, no = [], 0
    for source, n in (("big", 400), ("mid", 150), ("small", 40), ("untargeted", 30)):
        for _ in range(n):
            no += 1
            rows.append((no, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([20, 50, 400]))), source))
    rows += [(no + 1 + i, rows[0][1], "big") for i in range(50)]
    rows += [(9001, None, "mid"), (9002, "  ", "mid"), (9003, "text", None), (None, "text", "mid")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, source string, tokens string"), rows


def test_shares_caps_and_repeats(spark, corpus):
    df, rows = corpus
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4), ("none", 0.0, 3)], "source string, target_share double, max_repeats int")
    chosen = mix(df, targets, block_tokens=100).collect()
    cap = {"big": 1, "mid": 2, "small": 4}
    text = {r[0]: r[1] for r in rows}
    assert all(1 <= r["repeats"] <= cap[r["source"]] for r in chosen)
    assert len({text[r["doc_id"]] for r in chosen}) == len(chosen)
    assert all(r["tokens"] == tokens.count(text[r["doc_id"]]) for r in chosen)
    got = {r["source"]: r for r in shares(mix(df, targets, block_tokens=100), targets).collect()}
    assert got["none"]["actual_share"] == 0
    assert all(abs(got[s]["actual_share"] - w) < 0.01 for s, w in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))
    again = mix(df.repartition(7), targets, block_tokens=100).collect()
    assert sorted(map(str, again)) == sorted(map(str, chosen))
    assert sorted(map(str, mix(df, targets, block_tokens=100, seed=5).collect())) != sorted(map(str, chosen))


def test_shards_keep_the_quota(spark, corpus):
    df, _ = corpus
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3)], "source string, target_share double, max_repeats int")
    got = {r["source"]: r["actual_share"] for r in shares(mix(df, targets, block_tokens=100, shard_tokens=8000), targets).collect()}
    assert abs(got["big"] - 0.6) < 0.03


def test_empty_and_without_targets(spark, corpus):
    df, _ = corpus
    none = spark.createDataFrame([], "source string, target_share double, max_repeats int")
    assert mix(df, none).count() == 0
    targets = spark.createDataFrame([("big", 1.0, 1)], none.schema)
    assert mix(df.limit(0), targets).count() == 0
    assert shares(mix(df.limit(0), targets), targets).collect()[0]["actual_share"] == 0
