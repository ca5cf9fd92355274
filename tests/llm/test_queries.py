"""Queries against their SQL, and the folder rules of the pipeline."""

import pytest

from brooklet.llm.catalog import ORACLES, QUERIES
from tests.test_catalog import plain


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf, database, name):
    df = QUERIES[name](spark, sf)
    cursor = database.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(cursor.fetchall(), columns)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
