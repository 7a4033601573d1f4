import pytest
from oracle import DATA, same

from loomline.llm.queries import QUERIES, SQL

COLUMNS = {
    "p1_found": [("first_ord", "bigint"), ("ord", "bigint")],
    "p2_found": [("seq", "bigint"), ("defect", "string")],
    "p6_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p8_found": [("doc_id", "bigint"), ("subject", "string")],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in SQL:
        same(spark, name, QUERIES[name], SQL[name])
    df = QUERIES[name](spark, DATA)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    if name not in SQL:
        df.collect()
