import pytest
from oracle import connect, differences

from twinledger.llm import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_and_sql_agree(spark, middle, name):
    assert differences(QUERIES[name](spark, middle), connect(middle), ORACLE[name]) == []


def test_one_query_an_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
