import pytest
from oracle import DATA, same

from loomline.plans import delivery_queries, queries

ALL = {**queries.QUERIES, **delivery_queries.QUERIES}
SQL = {**queries.SQL, **delivery_queries.SQL}


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_its_sql(spark, name):
    if name in SQL:
        same(spark, name, ALL[name], SQL[name])
    else:
        assert ALL[name](spark, DATA).count() > 0
