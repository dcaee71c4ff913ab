"""Validation queries against their SQL where some documents have no letter or no text: the conversion quarantines them."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_queries import SF, ordered

NAMES = (
    "validate_table",
    "stored_checks",
    "validate_1000_wide",
    "validate_sidecar_fault",
    "validate_target_fault",
    "validate_width_fault",
    "validate_zero_fault",
    "validate_declared_fault",
    "validate_key_fault",
    "validate_label_fault",
)


@pytest.fixture(scope="module")
def documents(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    text = "case when doc_id % 41 = 0 then '12 34' when doc_id % 50 = 7 then '' when doc_id % 50 = 9 then null else text end"
    duckdb.sql(
        f"copy (select * replace ({text} as text) from '{SF}/documents.parquet' where doc_id % 4 < 2) to '{folder}/documents.parquet' (format parquet)"
    )
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_documents_without_letters(spark, documents, name):
    df = entry.queries()[name](spark, documents)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{documents}/documents.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert ordered(tuple(r[n] for n in names) for r in df.collect()) == ordered(cursor.fetchall())
