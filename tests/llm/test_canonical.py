import pytest

from tessera.llm.canonical import UNMATCHED, distance, map_results, map_values, tokenize

CONCEPTS = [
    ("Q12345", "Nimybroor Rating Questionnaire", ["Nimybroor Symptom Inventory", "NIMRQ6"]),
    ("Q12346", "Voliaryex Syndrome", None),
    ("Q12347", "Voliaryex Serum Assay", []),
    ("Q99999", None, None),
]


@pytest.fixture
def concepts(spark):
    return spark.createDataFrame(CONCEPTS, "code string, name string, synonyms array<string>")


def mapped(spark, concepts, values):
    df = spark.createDataFrame([(v, "clash") for v in values], "value string, code string")
    return {r["value"]: r["code"] for r in map_values(df, concepts).collect()}


def test_forms(spark, concepts):
    a, b, c = "Q12345", "Q12346", "Q12347"
    want = {
        "Nimybror Rating Questionaire": a, "Rating Questionnaire, Nimybroor": a, "NIMYBROOR  Rating Ques.": a, "NimybroorSymptom Inventory": a,
        "nimybroorratingquestionnaire": a, "Planned Nimybroor Rating Questionnaires (Week 4)": a, "nIMYBROOR rATING qUESTIONNAIREᵃ": a,
        "vo1iaryex syndr0me": b, "Voliaryex_Syndromeb)": b, "Serum Assay of the Voliaryex [1]": c, "Voliaryex Serm Asay": c,
        "vocab:Q12345": a, " q12345 ": a, "Q-12345.0": a, "Q12346.0": b, "nimrq6": a, "Q12348": UNMATCHED,
        "Voliaryex": UNMATCHED, "Syndrome": UNMATCHED, "Hiklaryon Syndrome": UNMATCHED, "Nimybroor Syndrome": UNMATCHED, "???": UNMATCHED, "n/a": UNMATCHED,
        "x" * 100_000: UNMATCHED, "Voliaryex Syndrome " + "noise " * 500: b,
    }
    assert mapped(spark, concepts, [*want, "Voliaryex Syndrome", "NIMRQ6", "Q12345", None, "", "  ", "???"]) == want


def test_no_bound_on_tokens_but_that_of_the_list(spark):
    long, six = "pneumono" * 9, "alpha beta gamma delta epsil zetaa"
    ref = spark.createDataFrame([("Q1", f"{long} study", None), ("Q2", six, [])], "code string, name string, synonyms array<string>")
    typed = {f"{long[:-1]}x study": "Q1", f"{long[:40]}{long[41:]}study": "Q1", six.replace(" ", ""): "Q2", six.replace(" ", "").replace("mm", "m"): "Q2", "q" * 200: UNMATCHED}
    assert mapped(spark, ref, typed) == typed


def test_results_take_the_first_term_that_is_not_blank(spark, concepts):
    rows = [
        (1, "Voliaryex Syndrom", "other", "Q1"), (1, "Voliaryex Syndrom", "other", "Q1"), (2, " ", "Voliaryex Serum Asay", "Q1"), (3, None, "", "q12345"),
        (4, None, None, None), (5, "Voliaryex Syndrome", "x", "y"), (None, "Voliaryex Syndrom", None, None),
    ]
    df = spark.createDataFrame(rows, "result_no bigint, entity_name string, display_name string, code string")
    got = sorted(((r["result_no"], r["code"]) for r in map_results(df, concepts).collect()), key=str)
    assert got == [(1, "Q12346"), (2, "Q12347"), (3, "Q12345"), (None, "Q12346")]
    assert map_results(df.limit(0), concepts).count() == 0
    assert {r["code"] for r in map_results(df, concepts.limit(0)).collect()} == {UNMATCHED}


def test_distance_and_tokens():
    assert distance("panel", "apnel", 2) == 1 and distance("abc", "xyz", 1) == 2 and distance("", "ab", 3) == 2
    assert tokenize("UrineAssay¹, Ques.") == ["urine", "assay", "ques."]
