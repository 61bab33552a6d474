import pytest

from sluicegate.queries import ORACLES, QUERIES
from tests.compare import SMALL, assert_same


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        assert_same(spark, QUERIES[name], ORACLES[name])
    else:
        assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
