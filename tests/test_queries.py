"""Each query of the catalogue against its SQL; those without SQL must run."""

import pytest

from gridclim.plans import catalog
from tests.compare import same_rows

SF = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    same_rows(spark, catalog.queries()[name], SQL[name], SF)


def test_every_query_has_sql():
    assert catalog.queries().keys() == SQL.keys()
