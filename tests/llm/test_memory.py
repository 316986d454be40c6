"""What the driver keeps after training."""

import numpy as np

from auditloom.llm import common


def made():
    return {"a": np.ones(3)}


def test_training_gives_its_memory_back(spark, tmp_path, monkeypatch):
    given = []
    monkeypatch.setattr(common, "scratch_root", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(common, "release", lambda: given.append(1), raising=False)
    first = common.saved_arrays(spark, "memory", ["x"], made)
    assert len(given) == 1
    common._models.clear()
    again = common.saved_arrays(spark, "memory", ["x"], made)
    assert len(given) == 1 and (again["a"] == first["a"]).all()


def test_toxicity_is_not_trained_in_the_driver(spark, sf, tmp_path, monkeypatch):
    from auditloom.llm import toxicity

    monkeypatch.setattr(common, "scratch_root", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(common, "_models", {})
    ran, train = [], toxicity.train

    def noted(*args, **named):
        ran.append(1)  # a task has a copy of the list
        return train(*args, **named)

    monkeypatch.setattr(toxicity, "train", noted)
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    assert toxicity.fit(docs, labels).trained and not ran


def test_a_scope_has_the_driver_collect(spark, monkeypatch):
    collected = []
    monkeypatch.setattr(common, "settle", collected.append, raising=False)
    with common.tidy():
        common.cut(spark.range(3))
    assert collected == [spark]


def test_few_tables_are_written_without_a_collection(spark, sf, monkeypatch):
    from auditloom.llm import mixing

    seen, written = [], common.written
    monkeypatch.setattr(common, "settle", lambda spark: seen.append("c"))
    monkeypatch.setattr(common, "written", lambda *args: seen.append("t") or written(*args))
    mixing.mixed_documents(spark.read.parquet(f"{sf}/documents.parquet"))
    assert seen.count("t") > 4
    assert max(map(len, "".join(seen).split("c"))) <= 4
