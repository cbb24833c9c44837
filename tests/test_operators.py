"""Reference operators on small fixtures: nulls, blanks, ties, repeats, empty tables."""

from pyspark.sql import functions as F

from tessera.operators import extract as X
from tessera.operators import linking as K
from tessera.operators import metrics as M
from tessera.operators import provenance as P
from tessera.operators import resolve as R
from tessera.operators import sequence as W
from tessera.operators import store as S
from tessera.operators import validate as V


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_store(spark):
    df = spark.createDataFrame([("a", "t", None, 1), ("b", "t", "m", 2), ("c", None, "m", 1)], "id string, entity_type string, model string, version int")
    assert rows(S.query_entities(df, "t", model="m"), "id") == [("b",)] and rows(S.query_entities(df, model=None), "id") == []
    assert rows(S.by_types(df, ["t"], ["t"]), "id") == [] and len(rows(S.by_types(df), "id")) == 3
    edges = spark.createDataFrame([("a", "r", "b"), ("a", "r", "b"), ("a", "r", "zz"), ("zz", "r", "a")], "from_id string, rel_type string, to_id string")
    assert rows(S.valid_edges(edges, df)) == [("a", "r", "b")]
    nodes, left = S.delete_nodes(df, edges, df.where("id = 'b'"))
    assert rows(nodes, "id") == [("a",), ("c",)] and ("a", "r", "b") not in rows(left)
    assert rows(S.related(S.valid_edges(edges, df), df, "r"), "from_id", "id") == [("a", "b")]
    new = spark.createDataFrame([("a", "x"), ("d", None)], "id string, model string")
    up = S.upsert(df.select("id", "model", "version"), new, ["id"], ["model"])
    assert rows(up) == [("a", "x", 2), ("b", "m", 2), ("c", "m", 1), ("d", None, 1)]
    ok, no = S.insert_new(df, spark.createDataFrame([("d", 2), ("d", 1), ("a", 1)], "id string, o int"), ["id"], ["o"])
    assert rows(ok, "id", "o") == [("d", 1)] and rows(no, "id", "o") == [("a", 1), ("d", 2)]
    kept, gone = S.newest(df, 0, [F.desc("version")])
    assert rows(kept) == [] and len(rows(gone)) == 3


def test_provenance_and_metrics(spark):
    df = spark.createDataFrame([("soa_vision_agent", 0.9, [1, 1, 2]), ("text", None, None), ("enrich", 1.0, [])], "source_agent string, confidence double, source_pages array<int>").withColumn("entity_no", F.monotonically_increasing_id())
    got = rows(df.select(P.source_type("source_agent"), P.aggregate_confidence_bp(F.col("confidence"), P.source_type("source_agent"), F.lit(9))))
    assert got == [("derived", 8000), ("text", None), ("vision", 8650)]
    assert rows(P.summary(df, []), "entities", "with_confidence", "low", "min_bp", "max_bp") == [(3, 2, 0, 9000, 10000)]
    assert rows(P.confidence_bins(df, []), "bin", "n") == [(4, 2)] and rows(P.page_groups(df, []), "page", "entities") == [(1, 1), (2, 1)]
    t = spark.createDataFrame([("k", "a"), ("k", "a"), ("l", "a"), ("l", "b"), ("m", None)], "k string, source string")
    assert rows(P.tag_sources(t, ["k"])) == [("k", "a"), ("l", "both"), ("m", None)]
    m = spark.createDataFrame([("x", "g", "e"), ("x", "g2", None), ("y", None, "e"), ("z", "g", None)], "t string, golden_id string, extracted_id string")
    assert rows(M.precision_recall(m, ["t"]), "t", "precision_bp", "recall_bp", "f1_bp") == [("x", 10000, 5000, 6667), ("y", 0, 10000, 0), ("z", 0, 0, 0)]
    one = spark.createDataFrame([(1,)], "x int")
    none = F.lit(None).cast("array<string>")
    assert rows(one.select(M.overlap_score(none, none), M.count_score(F.lit(0), F.lit(0)), M.count_score(F.lit(2), F.lit(9)), M.percent_label(F.lit(1), F.lit(0)), M.percent(F.lit(1), F.lit(0)))) == [(10000, 10000, 0, "Extra", 0)]


def test_resolve(spark):
    c = spark.createDataFrame(
        [("k", "soa_text_agent", 1, "", "T", None, 9), ("k", "execution_agent", 2, " ", None, 5, None), ("k", "other", 3, "n", "O", 7, 8), ("k", "other", 4, "late", "P", 1, 2)],
        "key string, source string, pos int, name string, status string, lo int, hi int",
    ).withColumn("priority", R.source_priority("source"))
    got = R.merge_by_priority(c, ["key"], ["name", "status"], pairs={"w": ["lo", "hi"]})
    assert rows(got.select("key", "name", "status", "w.lo", "w.hi")) == [("k", "n", "T", 5, None)]
    n = spark.createDataFrame([("s", "a", 1), ("s", "a", 2), ("s", None, 3)], "s string, name string, pos int")
    assert rows(R.numbered_names(n, ["s"], "name", ["pos"]), "name") == [("a (2)",), ("a",), (None,)]
    cells = [("X", "✓", 9000, 9500), ("X", "-", None, None), ("", "yes", 1, 2), ("1", "2", 100, 200), ("abc", "d", 1000, 900), (None, "x", None, 1), (None, None, None, None), ("1", "1.0", 9900, 1)]
    got = R.reconcile_cells(spark.createDataFrame(cells, "vision_value string, text_value string, vision_bp int, text_bp int"))
    assert [tuple(r)[4:] for r in got.collect()] == [
        ("X", 10000, "agree"), ("X", 3500, "tick_present_over_absent"), ("yes", 0, "tick_present_over_absent"), ("2", 0, "numeric_higher_confidence"),
        ("abc", 0, "source_priority"), ("x", None, "single"), (None, None, "single"), ("1", 10000, "agree"),
    ]
    o = R.overlay(spark.createDataFrame([("a", 1, "x")], "k string, n int, t string"), spark.createDataFrame([("a", 0, ""), ("b", 2, None)], "k string, n int, t string"), ["k"], ["n", "t"])
    assert rows(o) == [("a", 1, "x"), ("b", 2, None)]
    assert rows(R.merge_by_priority(c.limit(0), ["key"], ["name"])) == []


def test_sequences(spark):
    p = spark.createDataFrame([("d", x) for x in (1, 2, 5, 9, 9)] + [("e", 0)], "doc string, page int")
    assert rows(W.islands(p, ["doc"], "page", 3)) == [("d", 1, 5, 3), ("d", 9, 9, 1), ("e", 0, 0, 1)]
    assert [r[1] for r in rows(W.expanded_pages(p, ["doc"], "page", F.lit(10))) if r[0] == "d"] == [0, 1, 2, 3, 4, 5, 6, 8, 9]
    n = spark.createDataFrame([(x,) for x in "abcdxy"], "node string")
    e = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("a", "unknown")], "node string, depends_on string")
    assert dict(rows(W.waves(n, e))) == {"a": 0, "b": 1, "c": 1, "d": 2, "x": 3, "y": 3}
    assert rows(W.waves(n.limit(0), e)) == []
    chain = spark.range(1, 20).selectExpr("id AS node", "id - 1 AS depends_on")
    assert dict(rows(W.waves(chain.select("node"), chain))) == {i: i - 1 for i in range(1, 20)}
    lines = W.lines_of(spark.createDataFrame([(1, "| a\n| b\n| c\n\n| d\n| e"), (2, None)], "id int, text string"), ["id"])
    assert rows(W.line_regions(lines, ["id"], F.col("line").startswith("|")), "id", "start", "end", "n") == [(1, 0, 2, 3)]


def test_linking(spark):
    left = spark.createDataFrame([("s", "e1", "Alpha"), ("s", None, "beta "), ("s", "zz", None), ("t", "e1", "alpha")], "s string, ref string, name string")
    right = spark.createDataFrame([("s", "e1", "x", 1), ("s", "e2", "alpha", 3), ("s", "e3", "BETA", 2), ("s", "e4", "beta", 9)], "s string, id string, label string, o int")
    got = K.tiered_match(left, right, ["s"], [(F.col("ref"), F.col("id")), (F.lower(F.trim("name")), F.lower("label"))], "o", "id")
    assert rows(got, "s", "name", "match_id", "tier") == [("s", "Alpha", "e1", 1), ("s", "beta ", "e3", 2), ("s", None, None, None), ("t", "alpha", None, None)]
    texts = spark.createDataFrame([("s", "a week of visits"), ("s", "xx"), ("s", None)], "s string, t string")
    keys = spark.createDataFrame([("s", "eek of"), ("s", "xx"), ("s", "visits!"), ("s", None)], "s string, k string")
    assert rows(K.containing(texts, keys, ["s"], "t", "k")) == [("s", "a week of visits", "eek of")]
    m = spark.createDataFrame([("s", "a", "A")], "s string, id string, new_id string")
    arr = spark.createDataFrame([("s", 1, ["b", "a", None]), ("s", 2, None)], "s string, n int, xs array<string>")
    assert rows(K.remap_array(arr, m, ["s"], ["n"], "xs")) == [(1, ["b", "A", None]), (2, [])]


def test_extraction_and_rules(spark):
    df = spark.createDataFrame([(1, "Every 4 hours and every 6 hours, from Day –3 to Day 2"), (2, None), (3, "")], "doc_id int, text string")
    got = X.matches(df, ["doc_id"], [(r"every\s+(\d+)\s*hours?", "H")], 1)
    assert rows(got, "doc_id", "match_no", "g1") == [(1, 0, "4"), (1, 1, "6")]
    assert rows(X.matches(df.limit(0), ["doc_id"], [("x", "k")])) == []
    notes = W.lines_of(spark.createDataFrame([(1, "a. first\nmore\n\nb) second\nAbbreviations: x\na. last")], "id int, text string"), ["id"])
    assert rows(X.footnote_blocks(notes, ["id"])) == [(1, "a", "last"), (1, "b", "second")]
    t = spark.createDataFrame([("30 minutes before dosing",), ("Only for women of childbearing potential",), ("2 hours after lunch",), ("12-hour fast",)], "t string")
    assert [r[0] for r in t.select(X.structured_condition("t", F.when(F.col("t").contains("fast"), "procedure_fasting").when(F.col("t").contains("women"), "eligibility_wocbp").otherwise("timing"))).collect()] == [
        "timing.before(dosing, PT30M)", "subject.sex == 'Female' AND subject.isOfChildbearingPotential == true", "timing.after(lunch, PT2H)", "subject.fastingHours >= 12",
    ]
    ents = spark.createDataFrame([("1", "o", " ", []), ("2", "o", "x", ["a", "b", "c"]), ("3", "q", None, None), ("4", None, None, None)], "id string, entity_type string, text string, refs array<string>")
    spec = [V.Field("o", "text", required=True, default="none"), V.Field("o", "refs", "list", required=True, most=2)]
    found = V.issues(ents, ["id"], spec, {"text": F.col("text"), "refs": F.col("refs")}, ["o", "p"])
    assert rows(found, "id", "field", "category") == [("1", "refs", "missing"), ("1", "text", "missing"), ("2", "refs", "cardinality"), ("3", "", "unknown_type"), ("4", "", "unknown_type")]
    fixed, n = V.fix_until_stable(ents.select("id", "entity_type", "text"), lambda d: V.fill_defaults(d, spec[:1]).drop("filled"), lambda d: d.where("entity_type = 'o' AND trim(text) = ''").count())
    assert n == 1 and rows(fixed.where("id = '1'"), "text") == [("none",)]
