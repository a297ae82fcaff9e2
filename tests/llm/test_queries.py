import pytest

from millrace.llm import queries
from tests import oracle


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(set(queries.ORACLES) - {"op11_license_scan", "op12_vector_codes", "op13_spelling_variants"}))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    """The other three are compared beside their own tests."""
    assert oracle.differs(queries.QUERIES[name](spark, oracle.SF), queries.ORACLES[name], con) == ""
