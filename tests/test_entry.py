"""Every registered query against its SQL on the smallest tables, and the driver contract."""

import os

import pytest

import __spark_entry__ as entry
from checks.run import TABLES, rows_of

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def connected(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def duck():
    return connected(SF)


@pytest.fixture(scope="module")
def larger():
    return connected(LARGER)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", [
    "judge_agreement", "detect_language", "cleaning_funnel", "select_stress_set", "triage_dead_letters", "score_profile",
    "triage_decisions", "stress_set_decisions"])
def test_query_equals_sql_on_the_driver_tables(spark, larger, name):
    """Queries whose numbers depend on size, on the tables that the driver compares."""
    df = entry.queries()[name](spark, LARGER)
    want = larger.sql(entry.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["agreement_lines", "judge_agreement"])
def test_query_equals_sql_at_any_number_of_threads(spark, name):
    """Sums of the engine's threads come in any order; what is printed must not depend on it."""
    df = entry.queries()[name](spark, LARGER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    for threads in (1, 2, 3, 4, 8):
        con = connected(LARGER)
        con.execute(f"SET threads = {threads}")
        want = con.sql(entry.oracle_sql()[name])
        assert rows_of(want.columns, want.fetchall()) == got


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_python_tasks_run_from_another_folder(tmp_path):
    """The tasks must not need the repository on the workers' import path."""
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"print('rows', e.queries()['max_similarity'](s, {SF!r}).count())\n"
    )
    root = os.path.dirname(os.path.abspath(entry.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 500" in out.stdout, out.stderr[-2000:]
