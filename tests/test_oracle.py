import pytest
from compare import differences, duck
from conftest import SMALL

import __spark_entry__ as entry
from cashtide.plans.oracle import ORACLE
from cashtide.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(con, QUERIES[name](spark, SMALL), ORACLE[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 7
