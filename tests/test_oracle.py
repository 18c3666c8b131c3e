"""Every registered query against its SQL on an independent engine (sf0.001)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
QS, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    from chanpulse.plans.catalog import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(SQL) <= set(QS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF, QS[name], SQL[name])
    assert ok, msg


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["publish_day", "publish_day_of_week", "video_count", "avg_views",
                          "avg_engagement_rate", "total_views"]
    assert df.count() == 7
