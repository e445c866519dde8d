"""Every registered query against its SQL in another engine."""

import pytest

from checks import catalogue
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_agrees_with_sql(spark, data, duck, name):
    found = catalogue.QUERIES[name](spark, data).toPandas()
    if name in catalogue.SQL:
        assert difference(found, duck.execute(catalogue.SQL[name]).df()) is None
    else:
        assert len(found) > 0
