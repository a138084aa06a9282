"""Every registered query of the core against its SQL, or run to its end where SQL has none, on the smallest tables."""

import pytest
from oracle import connect, differences

from statuteloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, name):
    if name in catalogue.ORACLES:
        same, more, less = differences(spark, connect(sf_dir), catalogue.QUERIES[name], catalogue.ORACLES[name], sf_dir)
        assert same and not more and not less, (list(more)[:3], list(less)[:3])
    else:
        assert catalogue.QUERIES[name](spark, sf_dir).count() >= 0
    spark.catalog.clearCache()


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.entry(spark).count() > 0
