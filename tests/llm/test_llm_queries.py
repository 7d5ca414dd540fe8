import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallystone.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = Q.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.execute("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({Q.SQL[name]})").fetchall()
    text = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert text(df.select(*cols).collect()) == text(want)


def test_registered(spark):
    assert set(Q.QUERIES) <= set(entry.queries()) and set(Q.SQL) <= set(entry.oracle_sql())
    for n, cols in {"p4_found": ["survivor_id", "field_name", "donor_id"], "p7_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "category"]}.items():
        assert Q.QUERIES[n](spark, DATA).columns == cols
