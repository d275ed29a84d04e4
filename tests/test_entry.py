"""The driver contract: entry(), queries() and oracle_sql()."""

import __spark_entry__ as E
from meterline.plans.oracle import ORACLE
from meterline.plans.registry import QUERIES
from tests.conftest import SF, assert_same


def test_entry_runs_with_stable_schema(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0
    assert "session_id" in a.columns


def test_every_oracle_key_is_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(o) == {"file_inventory"}
    assert set(ORACLE) == set(o) & set(QUERIES)


def test_flagship_against_oracle(spark, duck):
    assert_same(E.queries()["sessionized"](spark, SF), duck(), E.oracle_sql()["sessionized"])
