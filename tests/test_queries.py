import pytest
from oracle import compare

from rosterlink.queries import all_queries

QUERIES, ORACLE = all_queries()
SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    compare(spark, SF, QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", ["person_refs", "link_assertions", "evidence_row_snippets"])
def test_query_matches_sql_on_more_rows(spark, name):
    compare(spark, LARGER, QUERIES[name], ORACLE[name])


def test_entry_imports_and_registers():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())
