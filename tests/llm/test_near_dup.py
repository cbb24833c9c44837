import random
from collections import Counter

from tessera.llm.near_dup import NearDuplicates
from tessera.llm.wording import words


def brute(rows, threshold, least):
    bags = [(i, Counter(words(t))) for i, t in rows if len(words(t)) >= least]
    out = set()
    for n, (i, a) in enumerate(bags):
        for j, b in bags[n + 1 :]:
            shared, total = sum((a & b).values()), sum((a | b).values())
            if shared >= threshold * total - 1e-9:
                out.add((min(i, j), max(i, j)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], "id bigint, text string, v string")


def edited(rng, text):
    w = text.split()
    for _ in range(rng.randint(1, 3)):
        k = rng.randrange(len(w))
        rng.choice([lambda: w.pop(k), lambda: w.insert(k, f"new{rng.random()}"), lambda: w.append(w.pop(k))])()
    return " ".join(w)


def test_small_edits_are_found_and_only_those(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for k in range(60):
        base = " ".join(rng.choices(vocabulary, k=rng.randint(25, 60)))
        rows += [(10 * k, base), (10 * k + 1, edited(rng, base)), (10 * k + 2, base.upper() + "!")]
        if not k % 3:
            rows.append((10 * k + 3, " ".join(reversed(base.split(" ")))))
    rows += [(-1, None), (-2, ""), (-3, "too short"), (-4, "x " * 30_000)]
    rng.shuffle(rows)
    got = NearDuplicates(frame(spark, rows), threshold=0.7, min_words=20)
    want = brute(rows, 0.7, 20)
    pairs = [tuple(r) for r in got.pairs().collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    near = Counter(x for p in want for x in p)
    classes = got.classes().collect()
    assert {r["id"] for r in classes} == {i for i, t in rows if len(words(t)) >= 20}
    assert all(r["links"] + r["copies"] - 1 == near[r["id"]] for r in classes)


def test_lists_of_common_words_are_split_without_loss(spark):
    # every text is made of the same few common words, so no shingle has a rare one
    rng = random.Random(5)
    rows = []
    for k in range(40):
        base = [rng.choice("abcdefghij") for _ in range(40)]
        other = list(base)
        other[rng.randrange(40)] = rng.choice("abcdefghij")
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    got = NearDuplicates(frame(spark, rows), threshold=0.9, min_words=20, common_share=0.001, min_overlap=1)
    near = {(2 * k, 2 * k + 1) for k in range(40)}
    found = {tuple(r) for r in got.pairs().collect()}
    assert near & brute(rows, 0.9, 20) <= found <= brute(rows, 0.9, 20)


def test_copies_meet_once(spark):
    rows = [(i, "one two three four five six seven eight nine ten") for i in range(30)] + [(99, "nothing like the others at all in any of its words")]
    got = NearDuplicates(frame(spark, rows), threshold=0.8, min_words=5)
    assert got.links.count() == 0 and got.pairs().count() == 30 * 29 // 2
    assert {(r["class_id"], r["copies"], r["links"]) for r in got.classes().collect()} == {(0, 30, 0), (99, 1, 0)}


def test_empty(spark):
    got = NearDuplicates(frame(spark, []), threshold=0.8)
    assert got.pairs().count() == 0 and got.classes().count() == 0


def test_exact_mode_loses_nothing_even_where_no_shingle_is_shared(spark):
    # every third word of the copies is new, or the words are laid out in another order: no run of five is left
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(40):
        base = rng.choices(vocabulary, k=rng.randint(20, 80))
        spaced = [x for i, w in enumerate(base) for x in ([w, f"n{k}x{i}"] if not i % 3 else [w])]
        rows += [(3 * k, " ".join(base)), (3 * k + 1, " ".join(spaced)), (3 * k + 2, " ".join(rng.sample(base, len(base) - 1)))]
    long = [f"l{i}" for i in range(390)]
    rows += [(900, " ".join(long)), (901, " ".join([*long, *(f"m{i}" for i in range(60))])), (902, " ".join(long * 3)), (903, " ".join(long * 3 + ["z"] * 50)), (904, None), (905, "")]
    want = brute(rows, 0.7, 20)
    assert len(want) >= 80 and {tuple(r) for r in NearDuplicates(frame(spark, rows), threshold=0.7, min_words=20, exact=True).pairs().collect()} == want
    want = brute(rows, 0.5, 20)
    assert {tuple(r) for r in NearDuplicates(frame(spark, rows), threshold=0.5, min_words=20, exact=True).pairs().collect()} == want


def test_a_value_met_through_several_parts_of_its_list_counts_once(spark):
    # one shared run of five common words, hence one shared value, whatever the number of shared prefix elements
    rows = [(1, "a b c d e " + "f g h i j k l m n o " * 2), (2, "a b c d e " + "o m k i g f h j l n " * 2)]
    links = NearDuplicates(frame(spark, rows), threshold=0.9, min_words=5, common_share=0.001, min_overlap=2).links
    assert links.count() == 0


def test_texts_of_one_wording_seldom_meet(spark, monkeypatch):
    # sentences of a few forms with rare words in their slots: one of those in common, beside words of the form, is no reason to meet
    rng = random.Random(7)
    forms = [[f"{c}{i}" for i in range(12)] for c in "abcdefghij"]
    rows = []
    for k in range(2000):
        text = " ".join(" ".join([*f[:4], f"r{rng.randrange(2000)}", *f[4:8], f"r{rng.randrange(2000)}", *f[8:], f"r{rng.randrange(2000)}"]) for f in rng.sample(forms, 4))
        rows.append((2 * k, text))
        if not k % 50:
            rows.append((2 * k + 1, edited(rng, text)))
    met = []
    monkeypatch.setattr("tessera.llm.near_dup.discard", lambda df: met.append(df.count()))
    got = NearDuplicates(frame(spark, rows), threshold=0.7, min_words=20, common_share=1 / 500)
    pairs = {tuple(r) for r in got.pairs().collect()}
    assert {(100 * k, 100 * k + 1) for k in range(40)} <= pairs and met[0] < 500
