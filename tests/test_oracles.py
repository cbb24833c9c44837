"""Every registered query beside its DuckDB oracle on the smallest tables.

Rows are compared as multisets, columns by name. Queries whose result is empty
at this size are compared like the others.
"""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from compare import rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


#: The subpackage for training text tests its own queries.
OWN = {n for m in entry.MODULES if not m.__name__.startswith("tessera.llm") for n in m.QUERIES}


@pytest.mark.parametrize("name", sorted(OWN & set(entry.oracle_sql())))
def test_query_equals_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(columns, cur.fetchall()) == got


@pytest.mark.parametrize("name", sorted(OWN - set(entry.oracle_sql())))
def test_query_has_rows(spark, name):
    """What the rows are is tested beside a sequential rule in the tests of the operators."""
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    # no epoch of the smallest tables has a name like that of a visit
    assert (rows or name == "c29_fuzzy_first_hit") and len(set(df.columns)) == len(df.columns) and all(any(v is not None for v in r) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).columns == ["study_id", "id", "diff"]
