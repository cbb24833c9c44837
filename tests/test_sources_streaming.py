import datetime as dt
import json

from pyspark.sql import functions as F

from tessera.plans.registry import Registry
from tessera.sources import documents as D
from tessera.streaming import mailbox as B


def test_json_documents_and_outputs(spark, tmp_path):
    (tmp_path / "01_a.json").write_text(json.dumps({"agent_id": "x", "entities": [{"id": "1"}]}, indent=1))
    (tmp_path / "01_bad.json").write_text('{"agent_id": ')
    (tmp_path / "02_b.json").write_text(json.dumps({"agent_id": "y"}))
    df = D.read_json_documents(spark, str(tmp_path), "agent_id string, entities array<struct<id string>>", "01_*.json")
    rows = {r["file"].rsplit("/", 1)[1]: r for r in df.collect()}
    assert rows["01_a.json"]["entities"][0]["id"] == "1" and rows["01_bad.json"]["_corrupt_record"] and "02_b.json" not in rows
    D.write_json_by_agent(df.select("agent_id", F.lit("big").alias("raw_response"), F.lit(1).alias("n")), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).columns == ["n", "agent_id"]


def test_latest_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("P1_20250101_000000",), ("P1_20250301_000000",), ("P2_20240101_000000",)], "dir string")
    assert {r["dir"] for r in D.latest_per_prefix(df, "dir").collect()} == {"P1_20250301_000000", "P2_20240101_000000"}
    c = spark.createDataFrame([(1, ["a", None, "b"], "x" * 200, 'say "hi"')], "id int, xs array<string>, src string, q string")
    D.write_components({"rows": c}, str(tmp_path / "c"))
    got = D.read_csv(spark, str(tmp_path / "c" / "rows"), "id int, xs string, src string, q string").first()
    assert got["xs"] == "a; b" and len(got["src"]) == 100
    D.write_union_csv([c.select("id", "q"), c.select("id", "src")], str(tmp_path / "u"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "u")).collect()
    assert {r["q"] for r in back} == {'say "hi"', None}


def test_pages(spark):
    df = spark.createDataFrame([(1, "a\n\nb | c | d\ne | f | g\n\n" + "z" * 20), (2, None)], "doc_id bigint, text string")
    pages = D.pages_of(df, "doc_id")
    rows = {(r["doc_id"], r["page_no"]): r for r in pages.collect()}
    assert rows[(1, 1)]["has_tables"] and rows[(2, None)]["error"] == "no text" and rows[(1, 2)]["char_count"] == 20
    text = D.joined_pages(pages, "doc_id", [0, 2, 9], most=5).collect()
    assert [r["text"] for r in text] == ["--- Page 1 ---\na\n\n--- Page 3 ---\nzzzzz [cut]"]


def events(spark, path, rows):
    at = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(e, at + dt.timedelta(minutes=m), u, t, v, None) for e, m, u, t, v in rows], B.MESSAGE_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name).collect()


def test_windows_and_late_rows(spark, tmp_path):
    path = str(tmp_path / "m")
    events(spark, path, [(1, 0, 1, "a", 1.0), (2, 30, 1, "a", 2.0)])
    for i, m in enumerate((600, 660, 720)):
        events(spark, path, [(3 + i, m, 1, "a", 1.0)])
    events(spark, path, [(8, 5, 1, "a", 9.0), (9, 1200, 1, "a", 1.0)])
    events(spark, path, [(10, 1300, 1, "a", 1.0)])
    rows = drain(B.windowed_counts(B.message_stream(spark, path)), "w")
    assert {(r["n"], r["total"]) for r in rows} == {(2, 3.0), (1, 1.0)}  # the late ninth never counts


def test_retries_over_batches(spark, tmp_path):
    path = str(tmp_path / "r")
    events(spark, path, [(1, 0, 7, "fail", 0.0), (2, 1, 7, "fail", 0.0)])
    events(spark, path, [(1, 2, 7, "fail", 0.0)])
    events(spark, path, [(1, 3, 7, "fail", 0.0)])
    rows = {(r["event_id"], r["attempts"], r["fate"]) for r in drain(B.retries(B.message_stream(spark, path)), "r")}
    assert rows == {(1, 1, "retry"), (2, 1, "retry"), (1, 2, "retry"), (1, 3, "dead")}


def test_mailbox_order_and_repeats(spark, tmp_path):
    path = str(tmp_path / "p")
    events(spark, path, [(1, 5, 1, "low", 0.0), (2, 9, 1, "high", 0.0), (3, 1, 2, "low", 0.0), (2, 9, 1, "high", 0.0)])
    q = B.start_mailbox(B.first_deliveries(B.message_stream(spark, path)), str(tmp_path / "out"), str(tmp_path / "cp"), {"high": 1})
    q.processAllAvailable()
    q.stop()
    got = {(r["user_id"], r["place"], r["event_id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 1, 2), (1, 2, 1), (2, 1, 3)}


def test_registry(spark):
    r = Registry()
    r.register("a", ("src",))(lambda spark, src: src.where("x > 1"))
    r.register("b", ("a",), tags=("t",))(lambda spark, a: a.selectExpr("x + 1 AS x"))
    assert [[s.name for s in w] for w in r.waves()] == [["a"], ["b"]] and r.by_output("b")[0].tags == {"t"}
    out = r.run(spark, {"src": spark.createDataFrame([(1,), (2,)], "x int")}, keep=True)
    assert [tuple(x) for x in out["b"].collect()] == [(3,)]
