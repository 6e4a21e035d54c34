"""Every query against its SQL; the rest at least gives rows."""

import pytest

from check import compare, connect
from mandiscope.catalog import QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, folder, duck, name):
    got = QUERIES[name].run(spark, folder).toPandas()
    assert compare(got, duck.execute(QUERIES[name].sql).df()) == ""


def test_names_and_sources_are_plain():
    assert not [n for n in QUERIES if "pipeline" in n or n.startswith("op")]
    for q in QUERIES.values():
        assert q.sql is None or q.sql.strip().upper().startswith(("SELECT", "WITH"))
