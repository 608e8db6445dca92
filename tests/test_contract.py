import pytest

import __spark_entry__ as contract
from tidemill.queries import QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    frame = contract.queries()[name](spark, sf_dir)
    rows, difference = compare(frame, con, contract.oracle_sql()[name])
    assert difference is None
    assert rows > 0 or name == "whitelisted_posts"


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0
    assert frame.columns[-3:] == ["sub_industry_id", "parent_id", "enrich_status"]
