import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions import repair as J
from tessera.functions import timing as T

values = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text('ab"\\,{}[]: ', max_size=4)), lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.text("ab", max_size=2), x, max_size=3)), max_leaves=10)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abc", max_size=2), values, max_size=4), st.integers(0, 60))
def test_cut_json_is_closed(doc, cut):
    text = json.dumps(doc)
    assert json.loads(J.closed(text)) == doc
    part = J.closed(text[: max(1, len(text) - cut)])
    assert part is None or isinstance(json.loads(part), dict)
    assert J.closed("no json") is None and J.closed(None) is None


def test_stitch_and_merge(spark):
    assert J.stitched('{"a": [1, 2, 3, 4', '```json\n[1, 2, 3, 4, 5]}```') == '{"a": [1, 2, 3, 4, 5]}'
    df = spark.createDataFrame([('{"a": {"b": 1, "c": [1]}}', '{"a": {"c": [2], "d": null}}'), (None, '{"x": 1}'), ("bad", None)], "p string, q string")
    rows = [r[0] for r in df.select(J.merge_json("p", "q")).collect()]
    assert json.loads(rows[0]) == {"a": {"b": 1, "c": [2], "d": None}} and rows[1] == '{"x": 1}' and rows[2] == "bad"
    assert [r[0] for r in df.select(J.close_json("p")).collect()][1:] == [None, None]


def test_names_and_times_of_odd_texts(spark):
    names = [None, "", "  ", "Vital Signs (Day 1)", "Screening a", "Exam (b)", "Epoch [2] *", "UNS¹ EOSᵃ†", "x" * 100_000]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    row = {r[0]: r for r in df.select("n", N.clean_name("n"), N.clean_name_letters("n"), F.array_join(N.footnote_letters("n"), ""), N.split_superscripts("n"), N.drop_timing("n"), T.timepoint("n")).collect()}
    assert row[None][1] is None and row[""][1] == "" and row["Epoch [2] *"][1] == "Epoch"
    assert row["Screening a"][2] == "Screening" and row["Exam (b)"][3] == "b"
    assert row["UNS¹ EOSᵃ†"][4]["clean"] == "UNS EOS" and row["UNS¹ EOSᵃ†"][4]["refs"] == ["1", "a", "dagger"]
    assert row["Vital Signs (Day 1)"][5] == "Vital Signs" and row["Vital Signs (Day 1)"][6] == "day_1"


def test_timepoints_and_windows(spark):
    cases = {"Day -42 to -9": "day_range_-42_to_-9", "Day _6 through _4": "day_range_-6_to_-4", "(-42 to -9)": "day_range_-42_to_-9", "(Day 2)": "day_2", "Day 7": "day_7", "Week 4": "week_4", "(-42)": "day_-42", "(±3D)": "rel_±3D", "none": None}
    df = spark.createDataFrame(list(cases.items()), "n string, want string")
    assert df.where(~T.timepoint("n").eqNullSafe(F.col("want"))).count() == 0
    w = spark.createDataFrame([("Day 1 (± 3 days)", 3, 3), ("-2 to +5 days", 2, 5), ("window of 7 days", 7, 7), ("none", 0, 0)], "t string, a int, b int")
    assert w.where((T.window_allowance("t")["before"] != F.col("a")) | (T.window_allowance("t")["after"] != F.col("b"))).count() == 0
    d = spark.createDataFrame([("15 Jan 2024", "2024-01-15"), ("January 5, 2024", "2024-01-05"), ("3/2/2024", "2024-02-03"), ("2024/02/03", "2024-02-03"), ("soon", "soon"), ("", None)], "t string, want string")
    assert d.where(~T.iso_date("t").eqNullSafe(F.col("want"))).count() == 0
