"""Every query of the reference's operators against its SQL."""

import pytest

from lakespan.plans.registry import ORACLE_SQL, QUERIES
from tests.oracle import rows_in_sql, rows_of

#: A query whose result is empty by intent, and three that have rows on larger tables only.
EMPTY = {"scan_empty", "filter_date", "join_range", "join_theta"}
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name not in ORACLE_SQL:
        assert df.count() > 0
        return
    got, want = rows_of(df), rows_in_sql(ORACLE_SQL[name], SF)
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1] or name in EMPTY


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
