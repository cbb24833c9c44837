import json

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import shredding as S
from tessera.operators import nested


def kids(record, key="g", **kw):
    return sorted(S.children(S.opened_all(record), key, **kw), key=str)


def test_positions_parents_and_single_objects():
    doc = {"id": "r", "g": {"id": "one"}, "d": [{"id": "x"}, {"id": None, "g": [None, {"id": "u"}, {}]}, {"id": "y", "g": "[{\"id\": \"s\"}]"}]}
    assert kids(doc) == sorted([("r", 0, "one"), ("r", 1, "u"), ("r", 2, None), ("y", 0, "s")], key=str)


def test_absent_empty_and_scalars():
    assert kids({"id": "r", "g": []}) == [] and kids({"g": None}) == [] and kids({"g": ["x", 3]}) == []
    assert kids([{"id": "a", "g": [{"id": "k"}]}, 5, None]) == [("a", 0, "k")]
    assert kids({"g": [{"id": "p", "g": [{"id": "c"}]}]}) == [("p", 0, "c"), (None, 0, "p")]


def test_a_list_beside_a_single_object():
    doc = {"x": [{"s": [{"a": 1}]}, {"s": {"g": [{"id": "k"}]}}, {"s": {"t": {"g": {"id": "l"}}}}]}
    assert kids(doc) == [(None, 0, "k"), (None, 0, "l")]
    assert {p for p in S.shred(doc) if p.endswith("a")} == {"x[].s[].a"}


def walk(value, key, parent, out):
    """Plain recursion, to compare the level columns with."""
    if isinstance(value, dict):
        me = value["id"] if value.get("id") is not None else parent
        for k, v in value.items():
            for i, m in enumerate(v if isinstance(v, list) else [v]):
                if k == key and isinstance(m, dict):
                    out.append((me, i, m.get("id")))
                walk(m, key, me, out)
    elif isinstance(value, list):
        for m in value:
            walk(m, key, parent, out)
    return out


leaf = st.one_of(st.none(), st.text("ab", max_size=2))
objects = st.recursive(
    st.fixed_dictionaries({}, optional={"id": leaf, "n": leaf}),
    lambda inner: st.fixed_dictionaries(
        {}, optional={"id": leaf, "g": st.one_of(inner, st.lists(st.one_of(st.none(), inner), max_size=3)), "d": st.one_of(inner, st.lists(inner, max_size=3)), "e": inner}
    ),
    max_leaves=12,
)


@settings(max_examples=300, deadline=None)
@given(objects)
def test_level_columns_rebuild_what_recursion_finds(doc):
    assert kids(doc) == sorted(walk(doc, "g", None, []), key=str)


def test_operators_on_rows(spark, at):
    head = "entity_no bigint, study_id string, id string, entity_type string, version int, is_deleted boolean"
    adv = spark.createDataFrame(
        [
            (1, "s", "a", "study_amendment", 1, False, json.dumps({"id": "a", "geographicScopes": {"id": "g"}})),
            (1, "s", "A", "study_amendment", 2, False, json.dumps({"id": "a", "geographicScopes": [{"id": 7}, {"id": None}]})),
            (2, "s", "b", "study_amendment", 1, True, json.dumps({"geographicScopes": [{"id": "x"}]})),
            (3, "s", "c", "country", 1, False, json.dumps({"geographicScopes": [{"id": "x"}]})),
            (4, "s", "d", "study_amendment", 1, False, "{\"geographicScopes\": [{"),
            (5, None, None, "study_amendment", None, None, None),
            (6, "s", "e", "study_amendment", 1, False, '{"id":"e","geographic\\u0053copes":[{"id":"esc"}]}'),
        ],
        head + ", data string",
    )
    assert sorted(map(tuple, nested.scope_children(adv).collect())) == [
        (1, "geographicScopes", "a", 0, "7"),
        (1, "geographicScopes", "a", 1, ""),
        (6, "geographicScopes", "e", 0, "esc"),
    ]
    data = "data struct<id string, level struct<id string, code string>, intercurrentEvents array<struct<id string, name string>>>"
    obj = spark.createDataFrame(
        [
            (1, "s", "a", "objective", 1, False, ("a", ("l", "C1"), [None, ("e", None), (None, None)])),
            (2, "s", "b", "objective", 1, False, ("b", ("l", None), [])),
            (3, "s", "c", "objective", 1, False, (None, (None, "C2"), None)),
            (4, "s", "d", "objective", 1, False, None),
        ],
        f"{head}, {data}",
    )
    assert sorted(map(tuple, nested.objective_children(obj).collect()), key=str) == sorted(
        [
            (1, "level", "a", 0, "C1"),
            (1, "intercurrentEvents", "a", 1, "e"),
            (1, "intercurrentEvents", "a", 2, ""),
            (3, "level", None, 0, "C2"),
        ],
        key=str,
    )
    assert nested.objective_children(obj.limit(0)).count() == 0


def test_levels(spark):
    df = spark.createDataFrame([(1, json.dumps({"a": [{"b": [1, 2]}, {}, {"b": [3]}]})), (2, "x"), (3, None)], "entity_no bigint, json string")
    rows = [tuple(r)[1:] for r in nested.level_columns(df).where("path = 'a[].b[]'").orderBy("entry").collect()]
    assert [(r[2], r[4]) for r in rows] == [(0, "1"), (2, "2"), (1, None), (1, "3")]
