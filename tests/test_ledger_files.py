"""The ledger source: appends are whole, repeated attempts leave nothing, ranges know their line numbers."""

import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from auditloom.sources import ledger_files
from auditloom.sources.tables import parse_ndjson, table

FIELDS = "event_id long, user_id long, event_type string, value double, props string"


@pytest.fixture
def ledger(spark, tmp_path):
    ledger_files.register(spark)
    return str(tmp_path / "ledger")


def read(spark, path):
    return spark.read.format(ledger_files.NAME).load(path)


def append(df, path, **options):
    df.write.format(ledger_files.NAME).options(**options).mode("append").save(path)


def test_round_trip_in_two_appends(spark, sf, ledger):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    append(events.where("event_id % 2 = 0").repartition(3), ledger, step="3000")
    append(events.where("event_id % 2 = 1").repartition(2), ledger, step="3000")
    back = read(spark, ledger)
    fields = back.select("append", F.from_json("value", FIELDS).alias("r")).select("append", "r.*")
    assert sorted(map(tuple, fields.drop("append").collect())) == sorted(map(tuple, events.collect()))
    assert {(r.append, r.odd) for r in fields.select("append", (F.col("event_id") % 2).alias("odd")).distinct().collect()} == {(0, 0), (1, 1)}
    # Many ranges, and every file's lines are numbered through.
    assert back.rdd.getNumPartitions() > 20
    for r in back.groupBy("file").agg(F.min("line_no").alias("a"), F.max("line_no").alias("b"), F.count_distinct("line_no").alias("n"), F.count("*").alias("m")).collect():
        assert r.a == 0 and r.b + 1 == r.n == r.m
    lines = {}
    for name in os.listdir(f"{ledger}/lines"):
        with open(f"{ledger}/lines/{name}", encoding="utf-8") as f:
            lines |= {(name, i): x.rstrip("\n") for i, x in enumerate(f)}
    assert {(r.file, r.line_no): r.value for r in back.collect()} == lines


def test_attempts_that_fail_or_repeat_are_not_seen(spark, ledger):
    writer = ledger_files.LedgerWriter(ledger, 10)
    rows = [Row(a=i, b=f"é{i}") for i in range(5)]

    def failing():
        yield from rows[:3]
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(failing())
    first, again = writer.write(iter(rows)), writer.write(iter(rows))  # a speculative attempt of the same task
    assert read(spark, ledger).count() == 0
    writer.commit([again, None])
    assert len(os.listdir(f"{ledger}/lines")) == 3
    assert [(r.line_no, r.value) for r in read(spark, ledger).orderBy("line_no").collect()] == [(i, f'{{"a": {i}, "b": "é{i}"}}') for i in range(5)]
    # An append that is given up leaves no file of its own and changes nothing.
    writer.abort([first])
    assert len(os.listdir(f"{ledger}/lines")) == 2 and read(spark, ledger).count() == 5


def test_a_failed_job_leaves_the_ledger_as_it_was(spark, ledger):
    append(spark.range(3), ledger)
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        append(bad, ledger)
    assert read(spark, ledger).count() == 3


def test_odd_values(spark, ledger):
    assert read(spark, ledger).count() == 0
    append(spark.range(0), ledger)
    assert read(spark, ledger).count() == 0
    append(spark.sql("SELECT 'a\nb' AS t, DATE'2024-01-02' AS d, TIMESTAMP'2024-01-02 03:04:05' AS s, 1.50BD AS m, X'00ff' AS x, array(1, NULL) AS l, NULL AS n"), ledger)
    assert read(spark, ledger).first().value == '{"t": "a\\nb", "d": "2024-01-02", "s": "2024-01-02T03:04:05", "m": "1.50", "x": "00ff", "l": [1, null], "n": null}'
    with pytest.raises(Exception, match="only appended"):
        spark.range(1).write.format(ledger_files.NAME).mode("overwrite").save(ledger)


def test_its_lines_parse_as_records(spark, ledger):
    append(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long"), ledger)
    rows = parse_ndjson(read(spark, ledger).select("file", "line_no", "value"), spark.createDataFrame([], "k string, n long").schema)
    assert {(r.k, r.n) for r in rows.collect()} == {("a", 1), ("b", 2)}
