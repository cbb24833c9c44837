from tessera.operators.orphans import Reference, find_orphans, orphan_report

HEAD = "entity_no bigint, study_id string, id string, entity_type string, version int, is_deleted boolean, created_at timestamp_ntz"
REFS = [
    Reference("a", "child", "parents", "a", "mid", many=True),
    Reference("a", "mid", "top", "b", "top"),
]


def tables(spark, at, a, b):
    data = "data struct<parents array<string>, top string, field string>"
    return {
        "a": spark.createDataFrame([(n, s, i, t, v, d, c if c is None else at(c), x) for n, s, i, t, v, d, c, x in a], f"{HEAD}, {data}"),
        "b": spark.createDataFrame([(n, s, i, t, v, d, c if c is None else at(c)) for n, s, i, t, v, d, c in b], HEAD),
    }


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_kinds(spark, at):
    t = tables(
        spark, at,
        [
            (1, "s", "m1", "mid", 1, False, 5, (None, "T-1 ", "x")),
            (2, "s", "m2", "mid", 1, False, 5, (None, "t2", None)),
            (3, "s", "m3", "mid", 1, False, 5, (None, "t3", None)),
            (4, "s", "m4", "mid", 1, False, 5, (None, "none", None)),
            (5, "s", "m5", "mid", 1, False, 5, (None, "  ", None)),
            (6, "s", "m6", "mid", 1, True, 5, (None, "none", None)),
            (7, "z", "m7", "mid", 1, False, 5, (None, "t1", None)),
            (8, "s", "m8", "mid", 1, False, None, None),
            (9, "s", "m9", "mid", 1, False, None, (None, "t3", None)),
        ],
        [
            (21, "s", "t_1", "top", 1, False, 1), (22, "s", "t2", "top", 1, False, 1), (22, "s", "t2", "top", 2, True, 1),
            (23, "s", "t3", "top", 1, False, 6), (23, "s", "T3", "top", 2, False, 7), (24, "s", "none", "other", 1, False, 1),
        ],
    )
    assert rows(find_orphans(t, REFS), "entity_no", "field", "ref_id", "kind") == [
        (2, "top", "t2", "deleted"), (3, "top", "t3", "late"), (4, "top", "none", "missing"), (7, "top", "t1", "missing"),
    ]


def test_cascade_reaches_children_of_orphans_and_ends_in_cycles(spark, at):
    a = [
        (1, "s", "m", "mid", 1, False, 5, (None, "gone", None)),
        (2, "s", "c", "child", 1, False, 5, (["M", "m ", None, ""], None, None)),
        (3, "s", "ok", "mid", 1, False, 5, (None, "t", None)),
        (4, "s", "d", "child", 1, False, 40, (["ok"], None, None)),
    ]
    t = tables(spark, at, a, [(9, "s", "t", "top", 1, False, 1)])
    found = find_orphans(t, REFS)
    assert rows(found, "sid", "kind", "round") == [("c", "inherited", 1), ("m", "missing", 0)]
    assert rows(orphan_report(found), "table_name", "month", "field", "kind", "n") == [
        ("a", "2025-01", "parents", "inherited", 1),
        ("a", "2025-01", "top", "missing", 1),
    ]
    loop = [Reference("a", "mid", "parents", "a", "mid", many=True), Reference("a", "mid", "top", "b", "top")]
    t = tables(spark, at, [(1, "s", "x", "mid", 1, False, 1, (["y"], "gone", None)), (2, "s", "y", "mid", 1, False, 1, (["x"], None, None))], [])
    assert rows(find_orphans(t, loop), "sid", "field", "kind", "round") == [("x", "parents", "inherited", 2), ("x", "top", "missing", 0), ("y", "parents", "inherited", 1)]


def test_a_chain_longer_than_a_batch_of_rounds_is_followed_to_its_end(spark, at):
    chain = [Reference("a", "mid", "top", "a", "mid")]
    t = tables(spark, at, [(i, "s", f"m{i}", "mid", 1, False, 1, (None, f"m{i - 1}", None)) for i in range(1, 13)], [])
    assert rows(find_orphans(t, chain), "entity_no", "round") == sorted(((i, i - 1) for i in range(1, 13)), key=str)


def test_empty(spark, at):
    t = tables(spark, at, [], [])
    assert find_orphans(t, REFS).count() == 0 and orphan_report(find_orphans(t, REFS)).count() == 0
