"""The registered queries against their SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from termloom.plans import queries

SF = "/root/testdata/sf0.001"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(str([norm(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, got.fetchall())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "final_score" in df.columns


def test_queries_without_the_training_data_folders(tmp_path):
    """The entry lists the engine's queries where the subpackage is gone, or left as an empty folder, and raises other faults."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/termloom", tmp_path / "termloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    count = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True)
    alone = count().stdout.split()
    assert int(alone[0]) == len(queries.QUERIES) and alone[0] == alone[1]
    (tmp_path / "termloom" / "llm").mkdir()
    assert count().stdout.split() == alone
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    (tmp_path / "termloom" / "llm" / "__init__.py").write_text("")
    assert "a_module_that_is_not_there" in count().stderr
