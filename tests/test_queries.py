"""Every query of the engine against its SQL, over whole tables."""

import subprocess
import sys
from pathlib import Path

import pytest

from lintel import catalog
from tests.compare import duck, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, con, name):
    got = catalog.queries()[name](spark, SF)
    assert spark_rows(got) == sql_rows(con, catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_names_without_session():
    """The names are known before a session exists."""
    code = "import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
