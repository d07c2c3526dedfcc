import pytest
from oracle import compare, database

from gristmill.queries import ALL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, base, name):
    function, sql = ALL[name]
    assert compare(spark, base, name, function, sql, FOLDER).startswith("ok")
