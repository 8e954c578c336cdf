import compare
import pytest
from common import SF
from quotelake.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    found = registry.queries()[name](spark, SF)
    assert compare.differences(found, compare.connect(SF), registry.oracle_sql()[name]) == []
