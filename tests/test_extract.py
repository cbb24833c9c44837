"""Row generators on sentences whose rows are written down by hand."""

import re

import pytest

from tessera.functions import patterns as P
from tessera.operators import extract as X


@pytest.fixture
def docs(spark):
    return lambda *texts: spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, kind string")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_places_and_contexts(docs):
    text = "Cycle 1 Day 8, é then C2D15 until disease progression. " + "x" * 300 + " 21-day cycle"
    m = X.matches(docs(text, None, ""), ["doc_id"], [(p, "c") for p in P.CYCLES], 1, context=5)
    got = {(r["found"], r["start"], r["context"]) for r in m.collect()}
    want = {(x.group(), x.start(), text[max(0, x.start() - 5) : x.end() + 5]) for p in P.CYCLES for x in re.finditer(p, text, re.I)}
    assert got == want and len(want) == 4


def test_intervals(docs):
    m = X.matches(docs("every 15 minutes; q6h; at time 0, 5, 10 min; PK samples at: 0, 1.5, 3; BID; glucose every 2 hours"), ["doc_id"], [(p, X.interval_unit(p)) for p in P.INTERVALS], 1)
    iso, n = X.interval(m["g1"], m["kind"])
    got = {(r[0].strip(), r[1], r[2]) for r in m.select("found", iso, n).collect()}
    assert got >= {("every 15 minutes", "PT15M", None), ("q6h", "PT6H", None), ("at time 0, 5, 10 min", "PT5M", 3), ("BID", None, None), ("glucose every 2 hour", "PT2H", None)}
    assert ("every 2 hours", "PT2H", None) in got


def test_a_list_with_other_than_whole_numbers_says_nothing(docs):
    m = X.matches(docs("PK sampling at 0, 1.5, 3"), ["doc_id"], [(p, X.interval_unit(p)) for p in P.INTERVALS], 1)
    iso, n = X.interval(m["g1"], m["kind"])
    assert {tuple(r) for r in m.select(iso, n).collect()} == {(None, None)}


def test_daily_bindings(docs):
    df = docs("On Days -4 through -1 a 24-hour urine collection is made.", "daily weight " + "y" * 250 + " days 1 to 3", "daily diary, days 0-2 and day 5 to day 9")
    assert rows(X.daily_bindings(df, ["doc_id"]), "doc_id", "activity", "expected", "start_iso", "end_iso") == [
        (0, "urine_collection", 4, "-P4D", "-P1D"), (2, "daily_diary", 3, "P0D", "P2D"), (2, "daily_diary", 5, "P5D", "P9D"),
    ]


def test_samplings(docs):
    df = docs(
        "PK sampling at 0, 0.5, 1, 2 hours", "blood samples at 5, 10 min", "plasma glucose at 0, 5, 10 minutes", "minimum of 5 samples", "minimum of 1 sample", "intensive PK sampling, then sparse sampling design", "1" * 60
    )
    got = rows(X.samplings(df, ["doc_id"]), "doc_id", "kind", "samples", "unit")
    assert set(got) == {(0, "pk", 4, "hours"), (2, "glucose", 3, "minutes"), (3, "minimum", 5, None), (5, "dense", None, None), (5, "sparse", None, None)}


def test_footnote_layouts(docs):
    text = (
        "a. Collected before the first dose of drug\n   on site.\nb) Only for women of childbearing potential.\n\n"
        "[c] Fasting sample of ten hours or more.\n\n^d Vital signs after five minutes at rest.\n\n1. Repeat when clinically indicated by the lab.\n\n2. Table of nothing that counts here\n\n\n"
    )
    got = rows(X.footnote_layouts(docs(text, None, "short"), ["doc_id"]), "pos", "layout", "label", "footnote")
    by = {(x[1], x[2]): x[3] for x in got}
    assert by["letters", "a"] == "Collected before the first dose of drug on site."
    assert by["letters", "b"].startswith("Only for women of childbearing potential.")
    assert by["brackets", "[c]"] == "Fasting sample of ten hours or more."
    assert by["superscripts", "^d"] == "Vital signs after five minutes at rest."
    assert by["numbers", "1"] == "Repeat when clinically indicated by the lab." and ("numbers", "2") not in by
    assert by["section", "a"] == by["letters", "a"] and [x[0] for x in got] == sorted(x[0] for x in got)
    headed = "Notes to table:\nThe first part has no label at all.\na. The second part has one."
    assert rows(X.footnote_layouts(docs(headed), ["doc_id"]).where("layout = 'section'"), "pos", "label")[:2] == [(1, "fn_2"), (2, "a")]
