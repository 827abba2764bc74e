"""The dealt queries that SQL can express, over the whole given tables, against their SQL."""

import pytest
from compare import check, connect

from spanbill.llm.oracle import ORACLE
from spanbill.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_with_sql(spark, sf_dir, name):
    assert check(spark, connect(sf_dir), sf_dir, name, QUERIES[name], ORACLE[name]) is None
