import json

import pytest

from tessera.operators import drift

SCHEMA = (
    "file_no bigint, file_name string, study_id string, agent_id string, file_ts timestamp_ntz, received_at timestamp_ntz, "
    "record_no int, entity_type string, record_id string, payload string, field string, tag int"
)


@pytest.fixture
def files(spark, at):
    def build(rows):
        out = []
        for no, day, rid, payload in rows:
            text = payload if isinstance(payload, (str, type(None))) else json.dumps(payload)
            out.append((no, f"f{no}", "s", "agent", None if day is None else at(day), at(0), 0, "objective", rid, text, "clash", 1))
        return spark.createDataFrame(out, SCHEMA)

    return build


def found(df):
    rows = drift.changes(df).select("file_no", "field", "change", "old_field").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_added_removed_and_type(files):
    df = files([
        (1, 1, "a", {"x": 1, "y": "t", "z": None}),
        (2, 2, "a", {"x": "1", "w": True}),
        (2, 2, "a", {"x": "1", "w": True}),
        (2, 2, "b", "{\"x\": [1], \"cut"),
    ])
    assert found(df) == [(2, "w", "added", None), (2, "x", "type", None), (2, "y", "removed", None)]


def test_renaming_needs_agreement_in_shared_records(files):
    df = files([
        (1, 1, "a", {"old": 1, "k": 1}), (1, 1, "b", {"old": None, "k": 1}), (1, 1, "gone", {"old": 5, "k": 1}),
        (2, 2, "a", {"New": 1.0, "k": 1}), (2, 2, "b", {"k": 1}), (2, 2, "c", {"New": 9, "k": 1}),
    ])
    assert found(df) == [(2, "New", "renamed", "old")]
    df = files([(1, 1, "a", {"old": 1, "k": 1}), (2, 2, "a", {"New": 2, "k": 1})])
    assert found(df) == [(2, "New", "added", None), (2, "old", "removed", None)]
    # no shared record has a value: two changes
    df = files([(1, 1, "a", {"old": 1}), (1, 1, "z", {"k": 1}), (2, 2, "b", {"New": 1}), (2, 2, "z", {"k": 1})])
    assert found(df) == [(2, "New", "added", None), (2, "old", "removed", None)]


def test_latest_earlier_file_with_readable_records(files):
    df = files([
        (3, 3, "a", {"x": 1, "y": 1}),
        (1, 1, "a", {"x": 1}),
        (2, 2, "a", "not json"),
        (4, None, "a", {"q": 1}),
        (5, 3, "a", {"x": 1}),
    ])
    assert found(df) == [(3, "y", "added", None)]


def test_odd_payloads(files):
    df = files([(1, 1, None, None), (1, 1, "a", "[1]"), (1, 1, "a", "NaN"), (1, 1, "b", ""), (2, 2, None, {"": "e", "A": {}, "a": []}), (2, 2, "b", "{}")])
    assert found(df) == [(2, "", "added", None), (2, "A", "added", None), (2, "a", "added", None)]
    assert found(files([])) == []


def test_schema_keeps_alternatives_and_table_splits_them(files):
    df = files([
        (1, 1, "a", {"v": 1, "only": "x", "File_No": "y"}),
        (2, 2, "a", {"v": "one", "only": "z", "V": True}),
        (3, 3, "a", {"v": [1, 2], "renamed": "z"}),
    ])
    fields = drift.file_fields(df)
    schema = drift.fused_schema(fields)
    assert {r["field"]: r["types"] for r in schema.collect()}["v"] == ["string", "number", "array"]
    out = drift.unified(df, schema, drift.changes(df, fields).where("change = 'renamed'"))
    rows = {r["file_no"]: r.asDict() for r in out.collect()}
    assert rows[1]["v__number"] == 1.0 and rows[2]["v__number"] is None
    assert rows[2]["v__string"] == "one" and rows[1]["v__string"] is None
    assert rows[3]["v__array"] == "[1,2]" and rows[3]["v_2"] == "[1,2]" and rows[1]["v_2"] == "1"
    assert rows[3]["only"] == "z"  # the renamed field goes on under the most used name
    assert rows[1]["File_No_2"] == "y" and rows[2]["V"] is True


def test_only_one_whole_json_value_is_readable(spark):
    texts = ['{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1}}', '{"a":1},{"b":2}', '{"a":1}],[{"b":2}', '{"a":1', "", None, "NaN", '{"a":NaN}', '{"a":1,"a":2}', "null", '"s"', "[1]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")
    got = {r["i"] for r in drift._records(df, "i").select("i").collect()}
    assert got == {0, 1, 11, 12, 13, 14}


def test_paths_at_any_depth_keep_their_alternatives(files):
    df = files([
        (1, 1, "a", {"p": {"q": [1, "x", {"r": None, "s": True}]}, "e": {}}),
        (2, 2, "a", {"p": "text", "e": [[2]]}),
        (2, 2, "a", "{\"cut"),
    ])
    got = {r["path"]: (r["types"], r["n_values"]) for r in drift.path_schema(df).collect()}
    assert got == {
        "": (["object"], 2), "p": (["string", "object"], 2), "p.q": (["array"], 1), "p.q[]": (["string", "number", "object"], 3), "p.q[].s": (["boolean"], 1),
        "e": (["object", "array"], 2), "e[]": (["array"], 1), "e[][]": (["number"], 1),
    }
    assert drift.path_schema(files([])).count() == 0
