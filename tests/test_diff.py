from tessera.operators.diff import diff_entities, diff_summary

SCHEMA = "study_id string, id string, data struct<name string, text string>, version int, is_deleted boolean, diff string, sign int"


def table(spark, rows):
    return spark.createDataFrame([(s, i, d, v, x, "clash", 9) for s, i, d, v, x in rows], SCHEMA)


def found(spark, left, right):
    df = diff_entities(table(spark, left), table(spark, right), ["name", "text"], "narrative", "mirror")
    return sorted(map(tuple, df.collect()), key=str)


def test_fields_missing_rows_and_id_forms(spark):
    left = [
        ("s", "a_1", ("n", "t"), 1, False),
        ("s", "a_1", ("n", "t"), 1, False),
        ("s", "B-2", ("n", "t"), 2, False),
        ("s", "c", ("N", None), 1, False),
        ("s", "d", ("x", "y"), 1, False),
        ("s", "e", ("x", "y"), 1, True),
    ]
    right = [
        ("s", " A-1 ", ("n", "t"), 1, False),
        ("s", "b_2", ("n", "old"), 1, False),
        ("s", "b_2", ("n", " t\r\n "), 3, False),
        ("s", "c", ("n", ""), 1, False),
        ("s", "f", ("x", "y"), 1, False),
        ("s", "d", ("x", "y"), 1, False),
        ("s", "d", ("x", "y"), 2, True),
    ]
    assert found(spark, left, right) == [("s", "c", "name"), ("s", "d", "missing_in_mirror"), ("s", "f", "missing_in_narrative")]


def test_white_space_inside_and_both_fields(spark):
    assert found(spark, [("s", "a", ("a  b", "x y"), 1, False)], [("s", "a", ("a\tb", "xy"), 1, None)]) == [("s", "a", "text")]
    assert found(spark, [("s", "a", ("p", "x"), 1, False)], [("s", "a", ("q", "y"), 1, False)]) == [("s", "a", "name"), ("s", "a", "text")]


def test_nulls_are_keys_and_empty_sides(spark):
    row = (None, None, None, None, None)
    assert found(spark, [row], [row]) == []
    assert found(spark, [row], []) == [(None, None, "missing_in_mirror")]
    assert found(spark, [], [("s", "a", ("n", "t" * 200_000), 1, False)]) == [("s", "a", "missing_in_narrative")]
    assert found(spark, [], []) == []


def test_summary(spark):
    left = table(spark, [("s", str(i), ("n", "t"), 1, False) for i in range(5)])
    df = diff_summary(diff_entities(left, table(spark, []), ["name"], "l", "r"))
    assert [tuple(r) for r in df.collect()] == [("s", "missing_in_r", 5)]


def test_one_shuffle(spark):
    df = diff_entities(table(spark, []), table(spark, []), ["name", "text"], "l", "r")
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("Exchange hashpartitioning") == 1
