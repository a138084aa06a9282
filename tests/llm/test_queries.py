import pytest
from oracle import connect, differences

from statuteloom.llm import queries as q


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query(spark, sf_dir, name):
    sql = q.oracle_sql().get(name)
    if sql:
        same, more, less = differences(spark, connect(sf_dir), q.queries()[name], sql, sf_dir)
        assert same and not more and not less
    else:
        df = q.queries()[name](spark, sf_dir)
        assert df.count() > 0
        if name.endswith(("_found", "_ids")):
            assert df.count() == df.distinct().count()
    spark.catalog.clearCache()
