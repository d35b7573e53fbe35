"""Every query of the subpackage runs over small tables with the columns that are asked for."""

import pytest

from loomcast.llm import queries

COLUMNS = {
    "p2_found": {"plan_id": "bigint", "target_id": "bigint"},
    "p3_found": {"id": "bigint", "field_name": "string"},
    "p4_found": {"track_id": "string", "first_pos": "bigint", "last_pos": "bigint"},
    "p5_found": {"id_a": "bigint", "id_b": "bigint"},
    "p6_found": {"record_table": "string", "record_key": "string", "lang_code": "string"},
    "p8_ids": {"doc_id": "bigint", "ids": "array<int>"},
    "p9_found": {"doc_id": "bigint", "item_id": "bigint"},
    "p10_found": {"doc_id": "bigint", "text_kind": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert dict(df.dtypes) == COLUMNS[name]
    n = df.count()
    assert n > 0 and df.distinct().count() == n
