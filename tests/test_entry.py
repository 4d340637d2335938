"""The driver's contract: the flagship query, and every core query runs whole with its columns."""

import os

import pytest

import __spark_entry__
from sheafline.plans import core

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["year", "papers", "items", "figs", "placeholders", "student", "done", "open"] and df.count() > 1


def test_sql_only_for_known_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_queries_without_sql_run(spark, name):
    df = core.QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()
