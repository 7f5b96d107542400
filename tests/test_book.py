"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference

from conftest import SMALL
from querybook import BOOK


@pytest.mark.parametrize("name", sorted(BOOK))
def test_query_matches_sql(spark, duck_small, name):
    entry = BOOK[name]
    assert entry.sql is not None
    assert difference(spark, entry.run, entry.sql, duck_small, SMALL) is None


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
