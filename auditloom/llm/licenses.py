"""Licence findings: an Aho-Corasick automaton over notices and tags, expressions by a shunting yard.

A text's ASCII letters are lower-cased; its words are runs of ASCII letters, digits and
characters beyond ASCII. One automaton runs over the words, joined by single blanks, and
finds every notice phrase in one pass, whatever stands between its words. Where a text holds
"licen", a second one runs over the lower-cased text and finds identifier tags, whose
and/or/with expression is read by a shunting yard: ``with`` binds closest, then ``and``,
then ``or``. The longest valid beginning counts. Evaluated, an expression gives how far its
licences restrict use: ``or`` leaves the choice of the milder side, ``and`` binds to the
stricter one, a known exception turns strong copyleft into weak.

Defined results: a null text is empty; a text without words has no findings and score 0;
very long texts are searched whole, in time that grows with their length; overlapping places
of one phrase all count; a phrase inside a longer one of the method's own gives no own label,
base labels always stay; a tag inside another tag's expression is no tag of its own; repeated
rows repeat their result; ids are passed through, null ones and strings too; columns beyond
the two are left out, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from auditloom.llm.common import kept_by_worker, small_batches

# The phrases that every scan looks for, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Phrases of notices, in words, and the method's labels for them.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license version 2 0": "apache-2.0",
    "apache 2 0 license": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "bsd license": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "isc license": "isc",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "general public license v2": "gpl-2.0",
    "general public license v3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "boost software license": "bsl-1.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons zero": "cc0-1.0",
    "cc0 1 0": "cc0-1.0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
for _terms in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
    _name = "cc-" + _terms.replace(" ", "-")
    NOTICES[f"cc {_terms}"] = _name
    NOTICES |= {f"cc {_terms} {v.replace('.', ' ')}": f"{_name}-{v}" for v in ("1.0", "2.0", "2.5", "3.0", "4.0")}

TAGS = ("spdx-license-identifier", "license-expression", "license", "licence")

# Licence identifiers by how far they restrict use.
LEVELS = ("permissive", "weak", "strong", "restricted", "unknown")
IDENTIFIERS = {
    "permissive": "mit mit-0 apache-1.1 apache-2.0 bsd-2-clause bsd-3-clause bsd-4-clause 0bsd isc zlib bsl-1.0 unlicense wtfpl cc0-1.0 cc-by-3.0 cc-by-4.0 python-2.0 psf-2.0 postgresql ncsa x11 artistic-2.0 afl-3.0 libpng ofl-1.1",
    "weak": "lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1+ lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0+ lgpl-3.0-only lgpl-3.0-or-later mpl-1.1 mpl-2.0 epl-1.0 epl-2.0 cddl-1.0 cddl-1.1 eupl-1.1 eupl-1.2 ms-pl ms-rl",
    "strong": "gpl-2.0 gpl-2.0+ gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0+ gpl-3.0-only gpl-3.0-or-later agpl-3.0 agpl-3.0+ agpl-3.0-only agpl-3.0-or-later osl-3.0 cc-by-sa-3.0 cc-by-sa-4.0 odbl-1.0",
    "restricted": "cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 busl-1.1 sspl-1.0 elastic-2.0 proprietary all-rights-reserved",
}
_LEVEL = {name: LEVELS.index(level) for level, names in IDENTIFIERS.items() for name in names.split()}
# Labels of notices that name a family.
_LEVEL |= {"apache": 0, "bsd": 0, "public-domain": 0, "cc-by": 0, "lgpl": 1, "mpl": 1, "epl": 1, "eupl": 1, "gpl": 2, "agpl": 2, "cc-by-sa": 2}
UNKNOWN = LEVELS.index("unknown")
EXCEPTIONS = frozenset("classpath-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 llvm-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 font-exception-2.0 linux-syscall-note openjdk-assembly-exception-1.0 gpl-cc-1.0".split())

#: How sure a kind of finding makes a licence; the score is the chance that one of the distinct findings holds.
WEIGHTS = {"base": 0.5, "notice": 0.6, "tag": 0.9}

_RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9]+(?:[.:+-]+[a-z0-9]+)*\+?)")
_ASSIGNED = re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?")
#: Bytes of words stand for themselves, capitals for their small letters, all others for a blank.
_SHOWN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def read_expression(text: str, at: int = 0) -> tuple[int, list[str] | None]:
    """Where reading ended, and the longest valid expression that begins at ``at``, in postfix order, if any."""
    out, waiting, best = [], [], None
    open_, operand, alone, excepted = 0, False, False, False  # ``operand``: one has just been read, ``alone``: it's a bare identifier
    while True:
        token = _TOKEN.match(text, at)
        if not token:
            break
        word = token[1]
        if word == "(":
            if operand or (waiting and waiting[-1] == "with"):
                break
            waiting.append(word)
            open_ += 1
        elif word == ")":
            if not operand or not open_:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            open_, alone = open_ - 1, False
        elif word in _RANK:
            if not operand or (word == "with" and (not alone or excepted)):
                break
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand, excepted = False, word == "with"
        else:
            if operand:
                break
            out.append(word)
            operand = alone = True
        at = token.end()
        if operand and not open_:
            best = len(out), waiting[::-1]
    return at, best and out[: best[0]] + best[1]


def evaluate(postfix: list[str]) -> tuple[int, list[str]]:
    """How far an expression restricts use, as a place in ``LEVELS``, and its licences, with their exceptions."""
    stack: list[tuple[int, str | None]] = []
    names = []
    for word in postfix:
        if word not in _RANK:
            stack.append((_LEVEL.get(word, UNKNOWN), word))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if word == "with":
            names.append(f"{left} with {right}")
            stack.append((1 if right in EXCEPTIONS and a == 2 else a if right in EXCEPTIONS else UNKNOWN, None))
        else:
            names += [x for x in (left, right) if x]
            stack.append((min(a, b) if word == "or" else max(a, b), None))
    level, last = stack.pop()
    return level, names + [last] if last else names


class Scanner:
    """The two automata, built once a worker."""

    def __init__(self) -> None:
        import ahocorasick

        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase in sorted({*BASE, *NOTICES}):
            # A phrase's words, and what it adds: the base label, the method's own.
            self.phrases.add_word(f" {phrase} ", (phrase.count(" ") + 1, BASE.get(phrase), NOTICES.get(phrase)))
        for tag in TAGS:
            self.tags.add_word(tag, len(tag))
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def _phrases(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str]]]:
        """Base places ``(start, label)`` and the method's own ``(start, end, label)``, in words, the longest of nested ones."""
        text = (b" " + b" ".join(words) + b" ").decode("latin-1")
        base, own, before, at = [], [], 0, 0
        for last, (n, label, mine) in self.phrases.iter(text):
            before, at = before + text.count(" ", at, last), last  # blanks before the phrase's last one: words up to its end
            start = before - n
            if label:
                base.append((start, label))
            if mine:
                # Ends come in order, so what began later than this one and ended no later lies inside.
                while own and own[-1][0] >= start:
                    own.pop()
                own.append((start, before, mine))
        return base, own

    def _tags(self, text: str) -> list[tuple[int, list[str], int]]:
        """``(offset, licences, level)`` of tags with a valid expression; a bare one must name known licences."""
        found, done = [], 0
        for last, n in self.tags.iter(text):
            start = last - n + 1
            if start < done or (start and (text[start - 1].isalnum() or text[start - 1] in "-_")):
                continue
            assigned = _ASSIGNED.match(text, last + 1)
            if not assigned:
                continue
            done, postfix = read_expression(text, assigned.end())
            if postfix:
                level, names = evaluate(postfix)
                if text.startswith("spdx", start) or all(x in _LEVEL or x in EXCEPTIONS or x in _RANK for x in postfix):
                    found.append((start, names, level))
        return found

    def __call__(self, text: str) -> dict:
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.translate(_SHOWN).split()
        base, own = self._phrases(words) if len(words) > 1 else ([], [])
        findings = [("base", label, start) for start, label in base] + [("notice", label, start) for start, _, label in own]
        levels = [_LEVEL.get(label, UNKNOWN) for _, label, _ in findings]
        lowered = raw.lower()
        if b"licen" in lowered:
            # Latin-1 gives every byte one character: offsets are the text's own in UTF-8.
            shown, at, before = lowered.decode("latin-1"), 0, 0
            for start, names, level in self._tags(shown):
                before, at = before + len(raw[at:start].translate(_SHOWN).split()), start
                findings += [("tag", name, before) for name in names]
                levels.append(level)
        starts = [start for start, _ in base]
        doubt = 1.0
        for kind, _ in {(kind, label) for kind, label, _ in findings}:
            doubt *= 1 - WEIGHTS[kind]
        return {
            "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": sorted({label for _, label in base}), "labels": sorted({label for _, label, _ in findings}), "score": 1 - doubt,
            "restriction": LEVELS[max(levels)] if levels else None,
            "findings": [{"kind": kind, "label": label, "word": start} for kind, label, start in sorted(findings, key=lambda f: (f[2], f))],
        }


_FOUND = pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64())])
_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())),
    ("score", pa.float64()), ("restriction", pa.string()), ("findings", pa.list_(_FOUND)),
]
_DDL = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, restriction string, findings array<struct<kind: string, label: string, word: long>>"


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and a document's licence findings, labels and score; no row is moved.

    ``findings`` are ``(kind, label, word)``: a base phrase, a notice of the method's own or a
    tag, and the words before it. ``restriction`` is the strictest of what was found.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    types = [t for _, t in _FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = kept_by_worker(("licenses",), Scanner)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [scan(x) for x in batch.column(1).to_pylist()]
                columns = [pa.array([f[name] for f in found], t) for (name, _), t in zip(_FIELDS, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *(name for name, _ in _FIELDS)])

    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *StructType.fromDDL(_DDL).fields])
    return rows.mapInArrow(run, schema)
