"""Every query with SQL gives DuckDB's rows; the others run."""

import pytest
from compare import duck, plain
from eventloom.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, name):
    found = registry.QUERIES[name](spark, sf).toPandas()
    if name in registry.ORACLE_SQL:
        wanted = duck(sf).execute(registry.ORACLE_SQL[name]).df()
        assert sorted(found.columns) == sorted(wanted.columns)
        assert plain(found) == plain(wanted)
    else:
        assert len(found) > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
