"""The registered queries for training text beside their oracles on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from compare import rows_of
from tessera.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_oracle(spark, con, name):
    df = Q.QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(Q.ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(columns, cur.fetchall()) == got


def test_every_case_of_the_canonical_list_gets_one_code(spark, con):
    got = {r["result_no"]: r["code"] for r in Q.p4_found(spark, SF).collect()}
    known = "SELECT name FROM concepts UNION SELECT unnest(synonyms) FROM concepts UNION SELECT code FROM concepts"
    term = "coalesce(CASE WHEN trim(entity_name) <> '' THEN entity_name END, CASE WHEN trim(display_name) <> '' THEN display_name END, CASE WHEN trim(code) <> '' THEN code END)"
    cases = {r[0] for r in con.execute(f"SELECT result_no FROM (SELECT result_no, {term} AS t FROM enrichment) WHERE t IS NOT NULL AND t NOT IN (SELECT * FROM ({known}) k(x) WHERE x IS NOT NULL)").fetchall()}
    codes = {r[0] for r in con.execute("SELECT code FROM concepts").fetchall()} | {"unmatched"}
    assert set(got) == cases and set(got.values()) <= codes


def test_a_mix_and_its_pieces_have_rows(spark):
    assert Q.p8_mix(spark, SF).count() > 0 and Q.p8_shares(spark, SF).count() == 9 and Q.p9_pieces(spark, SF).count() > 0
