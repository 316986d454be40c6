"""Where queries and their oracle SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with its oracle where SQL has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_TYPES = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]", "timestamp": "TIMESTAMP"}


@dataclass(frozen=True)
class Given:
    """A short table of declared rows, for Spark as a frame and for DuckDB as values."""

    schema: str
    rows: list[tuple]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.schema)

    @property
    def sql(self) -> str:
        columns = [c.split(" ", 1) for c in self.schema.split(", ")]
        body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in self.rows)
        names = ", ".join(n for n, _ in columns)
        return "(SELECT " + ", ".join(f"CAST({n} AS {_TYPES[t]}) AS {n}" for n, t in columns) + f" FROM (VALUES {body}) v({names}))"


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(_literal, value)) + "]::VARCHAR[]"
    return quoted(str(value))
