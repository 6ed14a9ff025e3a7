"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry
from tests.oracle import compare, connect
from tillhouse.registry import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES = {name: q.run for name, q in REGISTRY.items()}
CHECKS = {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    run = QUERIES[name]
    if name in CHECKS:
        assert compare(spark, db, SF, run, CHECKS[name]) is None
    else:
        assert run(spark, SF).count() > 0


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["category_code", "category_name", "net_units", "net_sales"]
    assert result.count() == 10


def test_rows_only_queries_are_few():
    assert set(QUERIES) - set(CHECKS) == {
        "gbt_predictions",
    }
