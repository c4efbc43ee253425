"""Each query against its SQL on the smallest tables, and the entry point with and without the corpus operators."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    if name in catalog.ORACLES:
        want = db.sql(catalog.ORACLES[name])
        order = sorted(df.columns)
        assert order == sorted(want.columns)
        pick = lambda cols: [list(cols).index(c) for c in order]
        own, other = pick(df.columns), pick(want.columns)
        norm = lambda x: float(x) if x.__class__.__name__ == "Decimal" else x
        assert sorted((tuple(norm(r[i]) for i in own) for r in rows), key=str) == sorted((tuple(norm(r[i]) for i in other) for r in want.fetchall()), key=str)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_without_the_corpus_operators(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    (tmp_path / "gridloom").mkdir()
    for name in os.listdir(f"{root}/gridloom"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{root}/gridloom/{name}", tmp_path / "gridloom" / name)
    with open(f"{root}/__spark_entry__.py") as f:
        (tmp_path / "__spark_entry__.py").write_text(f.read())
    # What is left of the folders, and a library that is missing elsewhere.
    (tmp_path / "gridloom/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, check=True)


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
