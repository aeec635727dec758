import os

import pytest

from talkmill.plans import registry
from tests import oracle

QUERIES, SQL = registry.queries(), registry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    oracle.same(spark, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, f"{oracle.DATA}/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_does_not_import_llm():
    import subprocess
    import sys

    code = "import sys, talkmill.plans.registry, talkmill.control.cli, talkmill.streaming.continuous; sys.exit(any(m.startswith('talkmill.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(__file__))).returncode == 0
