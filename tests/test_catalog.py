import pytest

import __spark_entry__ as entry
from tests.oracle import connection, spark_rows, sql_rows
from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert spark_rows(catalog.queries()[name](spark, SF)) == sql_rows(con, catalog.oracle_sql()[name])


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"lifecycle_cluster"}


def test_registry_needs_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True, timeout=120)
