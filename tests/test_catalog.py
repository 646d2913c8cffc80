"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

from checks import compare
from __spark_entry__ import entry, oracle_sql, queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    database = duckdb.connect()
    for name in compare.TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return database


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    table = queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in table.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(table.columns)
    assert compare.sorted_rows(table.columns, rows) == compare.sorted_rows(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """From another folder the Python workers cannot import it; its functions travel with the plan."""
    script = tmp_path / "elsewhere.py"
    script.write_text(
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('checked', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "module = importlib.util.module_from_spec(spec)\n"
        "spec.loader.exec_module(module)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('rows', module.queries()['knn_join'](spark, {FOLDER!r}).count())\n"
    )
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "rows 5000" in done.stdout, done.stderr[-2000:]
