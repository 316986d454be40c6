"""Rules over declared rows, each case once, against the same rule in SQL; no registered query, as they read no table."""

import gate_cases  # noqa: F401
import pytest
import study_cases  # noqa: F401
from cases import CASES, SQL
from compare import same


@pytest.mark.parametrize("name", sorted(CASES))
def test_case(spark, sf, duck, name):
    df = CASES[name](spark, sf)
    if name in SQL:
        assert same(df, duck.sql(SQL[name]))
    assert df.limit(1).count() == 1
