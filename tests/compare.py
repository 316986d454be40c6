"""Order-blind comparison of a Spark result and a DuckDB result."""

import math
from decimal import Decimal


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 9)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def same(df, relation):
    assert sorted(df.columns) == sorted(relation.columns)
    return rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(relation.columns, relation.fetchall())
