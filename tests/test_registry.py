"""Every registered query against its SQL at the smallest scale."""

from pathlib import Path

import pytest
from compare import compare, connect

from sparkkit.oracle import ORACLE
from sparkkit.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLE:
        assert compare(df, ORACLE[name], connection).startswith("same (")
    else:
        assert df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(ORACLE)) == ["cluster_categories", "cluster_words", "mixture_clusters"]
