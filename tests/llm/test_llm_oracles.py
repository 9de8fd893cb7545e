"""Every query of the subpackage with an oracle equals its SQL over the whole smallest tables; the others run."""

import pytest

import compare
from pixloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, con, name):
    got = compare.canonical(queries.QUERIES[name](spark, SF).toPandas())
    want = compare.canonical(con.execute(queries.ORACLES[name]).df())
    assert got == want


@pytest.mark.parametrize("name, columns", [("p3_found", {"pred_id"}), ("p4_found", {"field", "row_id", "defect"}), ("p5_found", {"dialogue_id", "item_index"}), ("p9_found", {"doc_id", "subject"})])
def test_columns_and_distinct_rows(spark, name, columns):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert set(got.columns) == columns and len(got) and not got.duplicated().any()
