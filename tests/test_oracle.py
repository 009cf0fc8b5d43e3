"""Every registered query against its DuckDB oracle (the driver's correctness gate, run here at sf0.001)."""

import pytest

from rollwise.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

registry.load_all()
WITH_SQL = sorted(n for n in registry.QUERIES if n in registry.ORACLE_SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, registry.QUERIES[name], registry.ORACLE_SQL[name], SF_SMALL)
    assert "error" not in r, r["error"]


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert df.columns == ["prompt_key", "batch_step", "batch_block", "is_online", "batch_slot", "rollout_id", "reward", "advantage"]
