"""Licence findings against a plain search, expressions against a recursive reader."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from auditloom.llm import licenses
from auditloom.llm.catalog import QUERIES

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_query(spark, sf):
    rows = {r.doc_id: r for r in QUERIES["op12_licenses"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert tuple(r[1:6]) == plain_base(d.text)
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
    assert any(r.base_labels for r in rows.values()) and any(not r.labels for r in rows.values())


words = st.sampled_from(["mit", "MIT", "license", "License", "apache", "general", "public", "é", "x1", "licensé", "version", "2", "0"])
gaps = st.sampled_from([" ", "-", "\n* ", "\u00a0", "\u0130", ". ", "_"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, gaps), max_size=25))
def test_base_places(parts):
    text = "".join(w + g for w, g in parts)
    found = licenses.Scanner()(text)
    assert (found["n_words"], found["n_base"], found["first_word"], found["last_word"], ",".join(found["base_labels"])) == plain_base(text)


def recursive(tokens):
    """Level and licences of the whole of ``tokens``, or None where they're no expression."""
    at = 0

    def look():
        return tokens[at] if at < len(tokens) else None

    def operand():
        nonlocal at
        t = look()
        if t == "(":
            at += 1
            inner = either()
            if look() != ")":
                raise ValueError
            at += 1
            return inner
        if t is None or t in (")", "or", "and", "with"):
            raise ValueError
        at += 1
        if look() != "with":
            return licenses._LEVEL.get(t, 4), {t}
        at += 1
        e = look()
        if e is None or e in ("(", ")", "or", "and", "with"):
            raise ValueError
        at += 1
        level = licenses._LEVEL.get(t, 4)
        return (1 if level == 2 else level) if e in licenses.EXCEPTIONS else 4, {f"{t} with {e}"}

    def every():
        nonlocal at
        out = operand()
        while look() == "and":
            at += 1
            b = operand()
            out = max(out[0], b[0]), out[1] | b[1]
        return out

    def either():
        nonlocal at
        out = every()
        while look() == "or":
            at += 1
            b = every()
            out = min(out[0], b[0]), out[1] | b[1]
        return out

    try:
        out = either()
    except ValueError:
        return None
    return out if at == len(tokens) else None


token = st.sampled_from(["mit", "gpl-3.0-only", "mpl-2.0", "foo", "llvm-exception", "(", ")", "and", "or", "with"])


@settings(max_examples=600, deadline=None)
@given(st.lists(token, max_size=14))
def test_expressions(tokens):
    longest = next((r for k in range(len(tokens), 0, -1) if (r := recursive(tokens[:k]))), None)
    _, postfix = licenses.read_expression(" ".join(tokens))
    if longest is None:
        assert postfix is None
    else:
        level, names = licenses.evaluate(postfix)
        assert (level, set(names)) == longest


@pytest.mark.parametrize(("text", "labels", "restriction"), [
    ("// SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Foo-1.0 */", ["foo-1.0", "gpl-3.0-only", "mit"], "unknown"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2.0-only with classpath-exception-2.0"], "weak"),
    ('"license": "Apache-2.0 OR MIT",', ["apache-2.0", "mit"], "permissive"),
    ("License: all of it", [], None),
    ("his license is old", [], None),
    ("GNU Lesser General Public License", ["gpl", "lgpl"], "strong"),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"], "restricted"),
    ("Permission is hereby\n * granted, free of charge, to any person obtaining a copy", ["mit"], "permissive"),
])
def test_labels(text, labels, restriction):
    found = licenses.Scanner()(text)
    assert found["labels"] == labels and found["restriction"] == restriction


def test_odd_tables(spark):
    docs = spark.createDataFrame([("a", None, 1), (None, "", 2), ("a", "MIT License " * 30_000, 3), ("a", "MIT License " * 30_000, 3)], "doc_id string, text string, labels int")
    rows = licenses.scan_licenses(docs).collect()
    assert sorted((r.doc_id or "", r.n_words, r.n_base, r.first_word, r.last_word) for r in rows if not r.n_words) == [("", 0, 0, None, None), ("a", 0, 0, None, None)]
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, len(r.findings)) for r in rows if r.n_words] == [(60_000, 30_000, 0, 59_998, 30_000)] * 2
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
