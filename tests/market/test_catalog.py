"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tapeweave import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(row):
    out = []
    for v in row:
        if isinstance(v, float):
            assert math.isfinite(v)
            v = round(v, 5) + 0.0
        out.append(v)
    return repr(tuple(out))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(plain(r) for r in df.select(*columns).collect())
    if name in catalog.ORACLES:
        expected = db.execute(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]})").fetchall()
        assert rows == sorted(plain(r) for r in expected)


def test_entry_without_corpus(spark, tmp_path):
    """The entry module must work where the corpus subpackage is not there."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "tapeweave"), tmp_path / "tapeweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert not any(k.startswith('op') for k in e.queries()); assert 'pipeline' not in e.queries(); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
