import random
import re
from difflib import SequenceMatcher

from tessera.operators.fuzzy import distinct_notes, first_similar, greedy_leaders, greedy_matching, greedy_text_matching, jaccard_pairs, name_score, names_match, set_match_share, similar_leaders, similar_pairs, text_similarity
from pyspark.sql import functions as F


def test_leaders_equal_the_sequential_rule(spark):
    rng = random.Random(1)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)}
    leader = {}
    for x in range(40):
        mine = [y for y in range(x) if leader.get(y) == y and (y, x) in pairs]
        leader[x] = min(mine) if mine else x
    nodes = spark.createDataFrame([(i,) for i in range(40)], "node bigint")
    got = greedy_leaders(nodes, spark.createDataFrame(sorted(pairs), "a bigint, b bigint")).collect()
    assert {r["node"]: r["leader"] for r in got} == leader
    assert greedy_leaders(nodes.limit(0), spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_matching_equals_the_sequential_rule(spark):
    rng = random.Random(2)
    rows = [(g, e, rng.choice([0.0, 0.5, 0.7, 0.8, 0.9])) for g in range(12) for e in range(10)]
    used, want = set(), set()
    for g in range(12):
        free = [(s, -e) for a, e, s in rows if a == g and e not in used and s >= 0.7]
        if free:
            s, e = max(free, default=(0.0, 0))
            used.add(-e)
            want.add((g, -e, s))
    df = spark.createDataFrame(rows, "g bigint, e bigint, score double")
    assert {tuple(r) for r in greedy_matching(df, 0.7).collect()} == want
    assert greedy_matching(df.limit(0)).count() == 0


def test_pairs_lose_none_above_the_threshold(spark):
    rng = random.Random(3)
    names = []
    for i in range(60):
        base = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(4, 40))).strip() or "x"
        names += [base, base[:-1] + "z", base.replace("a", "b", 1)]
    names += [None, "", "A*", "a"]
    rows = [(i, "t", n) for i, n in enumerate(names)]
    clean = [(i, " ".join((n or "").lower().replace("*", "").split())) for i, _, n in rows]
    want = {(i, j) for i, x in clean for j, y in clean if i < j and x and y and (x == y or max(SequenceMatcher(None, x, y).ratio(), 0) >= 0.85) and len(x) + len(y) >= 9}
    got = {(r["a"], r["b"]) for r in similar_pairs(spark.createDataFrame(rows, "o bigint, k string, name string"), ["k"], "o", "name").collect()}
    assert want <= got


def test_scores(spark):
    df = spark.createDataFrame([("Vital signs*", "vital signs"), ("Period 1", "Period 2"), (None, "x"), ("informed consent", "informed consent form"), ("tbd", "n/a")], "a string, b string")
    rows = df.select(name_score(F.col("a"), F.col("b")).alias("s"), names_match(F.col("a"), F.col("b")).alias("m"), text_similarity(F.col("a"), F.col("b")).alias("t")).collect()
    assert rows[0]["s"] == 1.0 and rows[1]["m"] is False and rows[2]["s"] == 0.0
    assert abs(rows[3]["s"] - 0.8648648) < 1e-6 and abs(rows[3]["t"] - 0.9) < 1e-9 and rows[4]["t"] == 1.0


def test_set_share(spark):
    e = spark.createDataFrame([("k", "alpha beta"), ("k", "gamma"), ("k", None)], "k string, text string")
    a = spark.createDataFrame([("k", "Alpha  beta")], "k string, text string")
    assert [tuple(r) for r in set_match_share(e, a, ["k"]).collect()] == [("k", 3, 1)]


def test_jaccard_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    sets = [(g, i, rng.sample("abcdefghij", rng.randint(0, 6))) for g in "xy" for i in range(40)]
    for t in (0.5, 0.8):
        want = {(g, i, j) for g, i, a in sets for h, j, b in sets if g == h and i < j and a and b and len(set(a) & set(b)) > t * len(set(a) | set(b))}
        df = spark.createDataFrame([*sets, ("x", 99, None)], "g string, n int, w array<string>")
        assert {tuple(r) for r in jaccard_pairs(df, ["g"], "n", "w", t).collect()} == want


def test_distinct_notes_equal_the_sequential_rule(spark):
    rng = random.Random(5)
    vocabulary = ["cycle", "day", "visit", "1", "15", "3d", "5", "the", "d", "follow-up", "v", "[a]", "unscheduled", "week", "twelve"]
    names = [("s1", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 7)))) for _ in range(120)]
    names += [("s2", x) for x in ["Cycle 5 Day 15 3d", "Cycle 5 Day 15", "cycle 5  day 15*", "V", "xv", "Day 1 *", "Day 10", "Day\u00a07\u1d43", "the", "a b c d e f g h i", "a b c d e f g h i j", "**", "!"]]
    names += [("s3", x) for x in ["Week 2", None, "Week 1", "-", "Week 1"]] + [("s4", x) for x in ["*", "Day 1"]]
    want, seen = {}, {}
    for i, (s, name) in enumerate(names):
        if name is None:
            continue
        x = re.sub(r"[^\w\s]", "", re.sub(r"\s+", " ", name.lower().strip()))
        w = set(x.split())
        alike = lambda y: x in y or y in x or (w and y.split() and len(w & set(y.split())) / len(w | set(y.split())) > 0.8)
        want[i] = next((j for j, y in seen.get(s, []) if alike(y)), i)
        if want[i] == i:
            seen.setdefault(s, []).append((i, x))
    df = spark.createDataFrame([(s, i, n) for i, (s, n) in enumerate(names)], "study_id string, entity_no bigint, name string")
    assert {r["node"]: r["leader"] for r in distinct_notes(df, ["study_id"], "entity_no", "name").collect()} == want


def test_first_similar_equals_the_sequential_rule(spark):
    rng = random.Random(6)
    names = ["Treatment 1", "Treatment 2", "Follow-up", "abcd", "xabcd", "Screening", "Screening visits", "*", "Lead-in", "ab", "abc", "Washout b"]
    names += ["".join(rng.choice("abc 12") for _ in range(rng.randint(3, 9))).strip() or "x" for _ in range(40)]
    visits, epochs = [(rng.choice("st"), i, rng.choice(names)) for i in range(80)], [(rng.choice("st"), i, -i, rng.choice(names)) for i in range(40)]
    form = lambda n: " ".join(re.sub(r"[^a-z0-9\s\-]", "", n.lower()).split())
    tail = lambda n: (re.findall(r"(\d+)\s*$", n) or [None])[0]

    def match(x, y):
        return x == y or (not (tail(x) and tail(y) and tail(x) != tail(y)) and SequenceMatcher(None, x, y).ratio() >= 0.8)

    want = {}
    for s, v, n in visits:
        hits = [(o, e) for t, e, o, m in epochs if s == t and match(form(n), form(m))]
        if hits:
            want[v] = min(hits)[1]
    left = spark.createDataFrame(visits, "study_id string, visit bigint, name string")
    right = spark.createDataFrame(epochs, "study_id string, epoch bigint, o bigint, name string")
    assert {r["visit"]: r["epoch"] for r in first_similar(left, right, ["study_id"], 0.8).collect()} == want


def test_short_names_meet_by_a_run(spark):
    df = spark.createDataFrame([(1, "t", "abcd"), (2, "t", "xabcd")], "o int, k string, name string")
    assert [(r["a"], r["b"]) for r in similar_pairs(df, ["k"], "o", "name").collect()] == [(1, 2)]


def test_text_matching_equals_the_sequential_rule(spark, monkeypatch):
    monkeypatch.setattr("tessera.operators.fuzzy.BLOCK", 7)
    rng = random.Random(7)
    base = ["Risk outline", "Consent steps", "Criteria for stable withdrawal", "Criteria for distal withdrawal", "Dose", "Dose rationale", "", "tbd", "abcdefghij", "abcdefgxyz", "abcdefgxyzw"]
    noisy = lambda: "".join(c for c in rng.choice(base) if rng.random() > 0.12)
    golden, found = [(k, i, noisy()) for i in range(40) for k in "pq"], [(k, i, noisy()) for i in range(36) for k in "pq"]
    pairs = spark.createDataFrame([(k, g, e, x, y) for k, g, x in golden for h, e, y in found if k == h], "k string, g int, e int, x string, y string")
    score = {(r["k"], r["g"], r["e"]): r["s"] for r in pairs.select("k", "g", "e", text_similarity(F.col("x"), F.col("y")).alias("s")).collect()}
    want, used = {}, set()
    for k, g, _ in golden:
        free = [(score[k, g, e], -e) for h, e, _ in found if h == k and (k, e) not in used and score[k, g, e] >= 0.7]
        if free:
            want[k, g] = (-max(free)[1], max(free)[0])
            used.add((k, -max(free)[1]))
    assert any(s < 0.85 for _, s in want.values())
    side = lambda rows, c: spark.createDataFrame(rows, "k string, i int, text string").select("k", F.struct("k", "i").alias(c), "text")
    got = greedy_text_matching(side(golden, "g"), side(found, "e"), ["k"], 0.7)
    assert {(r["g"]["k"], r["g"]["i"]): (r["e"]["i"], r["score"]) for r in got.collect()} == want


def test_short_names_meet_and_group_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "u", "v", "w", "abcd"), (2, "u", "v", "w", "xabcd"), (3, "u", "v", "w", "ab1cdef"), (4, "u", "v", "w", "abcd2ef")], "o bigint, g string, t string, x string, name string")
    got = {(r["a"], r["b"]) for r in similar_pairs(df, ["g", "t", "x"], "o", "name").collect()}
    assert got == {(1, 2), (3, 4)}


def test_texts_that_share_words_of_two_characters_only_are_alike(spark):
    e = spark.createDataFrame([("k", "ab cd"), ("k", "N/A"), ("k", None), ("k", "zz")], "k string, text string")
    a = spark.createDataFrame([("k", "cd ab"), ("k", "  "), ("j", "zz")], "k string, text string")
    assert [tuple(r) for r in set_match_share(e, a, ["k"]).collect()] == [("k", 4, 2)]


def test_leaders_of_a_long_chain_take_one_pass(spark, monkeypatch):
    tables = []
    monkeypatch.setattr("tessera.operators.fuzzy.materialize", lambda df, *a, **k: tables.append(1) or df.localCheckpoint())
    nodes = spark.createDataFrame([(i,) for i in range(30)], "node bigint")
    got = greedy_leaders(nodes, spark.createDataFrame([(i, i + 1) for i in range(29)], "a bigint, b bigint")).collect()
    assert {r["node"]: r["leader"] for r in got} == {i: i - i % 2 for i in range(30)} and len(tables) <= 2


def test_similar_leaders_equal_the_sequential_rule(spark):
    rng = random.Random(8)
    base = ["Imaging by grysk", "Imaging by gryst", "Imaging by drist", "Storage of plup", "Storage of plup*", "STORAGE OF PLUPR", "*", ""]
    rows = [(g, i, "".join(c for c in rng.choice(base) if rng.random() > 0.03)) for i in range(150) for g in (("x", "y")[i % 2],)] + [(None, 200 + i, "Storage of plup") for i in range(2)]
    want, taken = {}, {}
    for g, i, n in rows:
        t = re.sub(r"\*", "", n.lower()).strip()
        want[i] = next((j for j, u in taken.get(g, []) if g and t and SequenceMatcher(None, u, t).ratio() >= 0.85), i)
        if want[i] == i:
            taken.setdefault(g, []).append((i, t))
    df = spark.createDataFrame(rows, "k string, o bigint, name string")
    assert {r["node"]: r["leader"] for r in similar_leaders(df, ["k"], "o", "name").collect()} == want


def test_many_that_want_the_same_are_matched_in_one_pass(spark, monkeypatch):
    tables = []
    monkeypatch.setattr("tessera.operators.fuzzy.materialize", lambda df, *a, **k: tables.append(1) or df.localCheckpoint())
    scores = spark.createDataFrame([(g, e, 0.9 - e / 100) for g in range(12) for e in range(12)], "g int, e int, score double")
    assert {(r["g"], r["e"]) for r in greedy_matching(scores).collect()} == {(i, i) for i in range(12)} and len(tables) <= 2


def test_similar_leaders_of_many_names_take_one_pass(spark, monkeypatch):
    made = []
    monkeypatch.setattr("tessera.operators.fuzzy.materialize", lambda df, *a, **k: made.append(1) or df.localCheckpoint())
    monkeypatch.setattr("tessera.operators.fuzzy.similar_pairs", lambda *a, **k: made.append(1))
    rng = random.Random(9)
    words = ["".join(rng.choice("aeioubdg") for _ in range(6)) for _ in range(30)]
    names = [f"{rng.choice(['Storage of', 'Prior and other', 'Imaging by'])} {rng.choice(words)}{rng.choice(['', ' use', 's', '\u00e9', '\u0161'])}" for _ in range(600)] + ["a" * 300 + "b", "a" * 300, "\u4e00\u4e8c", "ab", "abc", "xabc"]
    want, leaders = {}, []
    for i, n in enumerate(x.lower() for x in names):
        want[i] = next((j for j, u in leaders if u == n or SequenceMatcher(None, u, n).ratio() >= 0.85), i)
        leaders += [(i, n)] * (want[i] == i)
    df = spark.createDataFrame([("k", i, n) for i, n in enumerate(names)], "k string, o bigint, name string")
    assert {r["node"]: r["leader"] for r in similar_leaders(df, ["k"], "o", "name").collect()} == want
    assert len(leaders) > 40 and not made


def test_text_matching_of_many_texts_takes_one_pass(spark, monkeypatch):
    made = []
    monkeypatch.setattr("tessera.operators.fuzzy.materialize", lambda df, *a, **k: made.append(1) or df.localCheckpoint())
    rng = random.Random(10)
    words = ["".join(rng.choice("aeioubdg") for _ in range(6)) for _ in range(25)]
    name = lambda: f"{rng.choice(['storage of', 'prior and other', 'imaging by', 'risk'])} {rng.choice(words)}{rng.choice(['', ' use', 's', chr(233), chr(353)])}"
    left, right = [(i, name()) for i in range(260)], [(i, name()) for i in range(240)]
    left += [(300, "\tConsent steps"), (301, "Consent steps"), (302, "tbd"), (303, "a" * 250 + "b"), (304, None)]
    right += [(300, "Consent steps"), (301, "Consent\n steps\n"), (302, "\tN/A"), (303, "a" * 250)]
    plain = lambda t: "" if " ".join((t or "").lower().split()) in ("tbd", "n/a") else " ".join((t or "").lower().split())

    def rate(x, y):
        if not x or not y or x == y:
            return float(x == y)
        wx, wy = set(x.split()), set(y.split())
        share = len(wx & wy) / min(len(wx), len(wy))
        inside = min(len(x), len(y)) >= 5 and (x in y or y in x)
        return max(SequenceMatcher(None, x, y).ratio(), 0.85 if inside else 0.0, 0.6 + share * 0.3 if share >= 0.5 else 0.0)

    want, used = {}, set()
    for g, x in left:
        free = [(rate(plain(x), plain(y)), -e) for e, y in right if e not in used]
        s, e = max(free, default=(0.0, 0))
        if s >= 0.7:
            want[g] = (-e, s)
            used.add(-e)
    side = lambda rows, c: spark.createDataFrame([("k", i, t) for i, t in rows] + [(None, 400, "Dose")], "k string, i int, text string").select("k", F.struct("k", "i").alias(c), "text")
    got = greedy_text_matching(side(left, "g"), side(right, "e"), ["k"], 0.7).collect()
    assert {r["g"]["i"]: (r["e"]["i"], r["score"]) for r in got} == want
    assert want[300] == (300, 1.0) and want[301] == (301, 1.0) and len({s for _, s in want.values()}) > 20 and not made
