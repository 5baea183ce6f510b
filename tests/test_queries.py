"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from compare import assert_same

from tallymark.plans.oracles import ORACLES


def test_every_query_has_sql():
    assert set(contract.queries()) - set(contract.TEXT_QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert_same(contract.queries()[name](spark, sf_dir), duck, contract.oracle_sql()[name])


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert "status" in result.columns
