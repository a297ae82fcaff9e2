import pytest

from millrace.plans import queries
from tests import oracle


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert name in queries.ORACLES
    assert oracle.differs(queries.QUERIES[name](spark, oracle.SF), queries.ORACLES[name], con) == ""
