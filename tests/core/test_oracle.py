"""Every registered query against its SQL, on the smallest tables the driver compares."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

from corvid import queries as own

QUERIES, ORACLES = own.queries(), own.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    if name not in ORACLES:
        assert df.columns
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    want = found.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows or not want
    assert bag(df.columns, rows) == bag(names, want)


def test_flagship(spark):
    assert own.flagship(spark, "/root/testdata/sf0.001").count() > 0


def test_entry_without_llm(tmp_path):
    """The entry works where the training-data subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "corvid", tmp_path / "corvid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(k.startswith('op1') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
