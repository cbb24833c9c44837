import random

from tessera.llm import leakage
from tessera.llm.leakage import clean_words, leaked, leaked_items


def brute(docs, items, window):
    out = set()
    for d, text in docs:
        s = " " + " ".join(clean_words(text)) + " "
        for i, item in items:
            w = clean_words(item)
            runs = [w[k : k + window] for k in range(max(1, len(w) - window + 1))] if w else []
            if any(f" {' '.join(r)} " in s for r in runs):
                out.add((d, i))
    return out


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id bigint, text string, item_id string")
    e = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, topic string")
    return d, e, leaked(d, e, **kw)


def test_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 8, 12, 30])))) for i in range(40)]
    docs = []
    for i in range(200):
        w = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 3 == 0:
            part = rng.choice(items)[1].split()
            k = rng.randrange(len(part))
            w[5:5] = part[k : k + rng.choice([5, 12, 20])]
        docs.append((i, ", ".join(w)))
    got = [tuple(r) for r in run(spark, docs, items)[2].collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items, 12)


def test_a_bit_set_that_is_too_small_costs_time_but_no_result(spark, monkeypatch):
    monkeypatch.setattr(leakage, "MOST_BITS", 1 << 10)
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=30) + items[i % 60][1].split()[3 : 3 + i % 20])) for i in range(60)]
    assert {tuple(r) for r in run(spark, docs, items)[2].collect()} == brute(docs, items, 12) != set()


def test_a_very_long_item(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(5000)}" for _ in range(30_000)]
    docs = [(1, " ".join(long[20_000:20_012])), (2, " ".join(long[20_000:20_011])), (3, " ".join(long))]
    assert sorted(map(tuple, run(spark, docs, [(1, " ".join(long))])[2].collect())) == [(1, 1), (3, 1)]


def test_layout_marks_vanish_and_documents_do_not_run_together(spark):
    twelve = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, twelve), (2, "alpha beta"), (3, None), (4, "..."), (5, twelve)]
    docs = [
        (1, "x One-two thr-\r\nee four fi\u00adve six se\u200bven eight nine ten ELEVEN-\n twelve y"),
        (2, "one two three four five six"), (3, "seven eight nine ten eleven twelve alpha"), (4, "beta"), (5, None), (6, ""),
        (7, "word " * 40_000 + twelve + " word" * 5), (7, twelve), (None, "alpha-beta"), (8, "alpha- beta"), (9, "alpha-\nbeta"),
    ]
    d, e, df = run(spark, docs, items)
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted([(1, 1), (1, 5), (7, 1), (7, 5), (8, 2), (None, 2)], key=str)
    assert {tuple(r) for r in leaked_items(df, e).collect()} == {(1, "x", 2), (2, "x", 2), (3, "x", 0), (4, "x", 0), (5, "x", 2)}


def test_empty(spark):
    assert run(spark, [], [(1, "a b")])[2].count() == 0
    assert run(spark, [(1, "a b")], [])[2].count() == 0
    assert run(spark, [(1, "a b")], [(1, None)])[2].count() == 0
