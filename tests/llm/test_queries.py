from pathlib import Path

import pytest

from admitta import llm
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_rows(spark, name):
    assert compare(llm.queries()[name](spark, FOLDER), connect(FOLDER), llm.oracle_sql()[name]) == []


@pytest.mark.parametrize(("name", "columns"), [("p1_found", ["uid", "pdf_url", "row_idx"]), ("p2_found", ["uid", "field_name"]), ("p3_found", ["origin", "record_key", "catalog_id"]), ("p4_found", ["program_id", "field_name", "uid"]), ("p8_found", ["doc_id"])])
def test_columns(spark, name, columns):
    assert llm.queries()[name](spark, FOLDER).columns == columns
