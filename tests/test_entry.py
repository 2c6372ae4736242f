import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from folioforge import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    """Rows in an order of their own, numbers alike whatever their type."""
    value = lambda x: x if x is None or isinstance(x, str) else bool(x) if isinstance(x, bool) else round(float(x), 6) + 0.0
    return sorted((tuple(map(value, r)) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got_rows = [tuple(r) for r in got.select(*columns).collect()]
    want_rows = want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert plain(got_rows) == plain(want_rows)


@pytest.mark.parametrize("name", sorted(catalog.queries().keys() - catalog.oracle_sql().keys()))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_queries_without_the_training_data_package(tmp_path):
    """The rest imports and lists its queries where the package isn't there."""
    root = Path(__spark_entry__.__file__).parent
    for p in root.glob("*.py"):
        if p.name != "corpus_pipeline.py":
            (tmp_path / p.name).write_bytes(p.read_bytes())
    for p in (root / "folioforge").rglob("*.py"):
        to = tmp_path / p.relative_to(root)
        if "llm" not in to.parts:
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_bytes(p.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'search_hybrid' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
