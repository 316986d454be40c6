"""Every registered query against DuckDB on the same tables; rows only where SQL has no equal."""

import pytest
from compare import same

from auditloom.plans import catalog


#: Tested against a plain version where its operator is.
APART = {"purchase_communities"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - APART))
def test_query(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    if name in catalog.ORACLES:
        assert same(df, duck.sql(catalog.ORACLES[name]))
    assert df.limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["lang", "green", "yellow", "red"]
    rows = out.collect()
    assert sum(r.red for r in rows) > 0 and sum(r.yellow for r in rows) > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
