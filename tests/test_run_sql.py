"""Whole runs against their SQL, on documents with null, empty, short and long texts."""

import duckdb
import pytest

from foliomill.plans.oracle_split import SPLIT_SQL
from foliomill.plans.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("runs"))
    words = "the quick brown fox jumps over lazy dogs and keeps running through the long valley".split()
    text = lambda n, of: "\n".join(" ".join(words[(i + j) % len(words)] for j in range((i * 7 + n) % of)) for i in range(n))
    rows = [(0, None), (1, ""), (2, "one line"), (3, "ends in a break\n"), (4, text(40, 30))] + [(10 + n, text(n, 9 + n % 60)) for n in (3, 9, 19, 28, 60, 150)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(SPLIT_SQL))
def test_runs_equal_their_sql(spark, tables, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tables}/documents.parquet/*.parquet')")
    found = QUERIES[name](spark, tables)
    want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({SPLIT_SQL[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in found.collect()) and len(want) > 5
