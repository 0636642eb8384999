"""Every registered query beside its check SQL, on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from staylake.plans.oracles import ORACLES
from staylake.plans.registry import QUERIES
from tests.check import differences, duck



@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    """Fitted values have none: those queries return what SQL can state, tests/test_models.py checks the rest."""
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, sf, con, name):
    got = QUERIES[name](spark, sf).toArrow()
    assert differences(got, con.sql(ORACLES[name]).to_arrow_table()) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
