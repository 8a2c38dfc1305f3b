"""Every registered query against its check SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from workload.check import differences


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    sql = entry.oracle_sql()
    assert differences(df, sql[name], SF_SMALL) == [] if name in sql else df.collect()


def test_entry(spark):
    assert len(entry.entry(spark).collect()) == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
