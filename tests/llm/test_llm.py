"""Each training-data operator against brute force, and its edge cases."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from auditloom.llm import bpe, chunks, covertree, lines, mixing, pii, simhash, tokens, toxicity, warc
from auditloom.llm.common import components, cut, running_total

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOC)


EDGE = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, None, None), (3, "", "x"), (None, "g h", "y"), (4, "w " * 30_000, "y"), (5, "x" * 40_000, None), (4, "other text", "x")]


@pytest.fixture(scope="module")
def edge(spark):
    odd = docs_of(spark, EDGE)
    # Columns that clash with internal and result names are no concern of the operators.
    return odd.withColumns({k: F.lit("z") for k in ("size", "taken", "fp", "block", "role", "ids", "key", "rank", "w", "score", "n_deleted", "sha")})


@pytest.fixture(scope="module")
def none(edge):
    return edge.limit(0)


# ---- shared pieces ----


def test_running_total(spark):
    rows = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "k int, v int")
    got = {r.k: r.before for r in running_total(rows, [F.col("k")], F.col("v"), "before").collect()}
    at, total = {}, 0
    for k, v in sorted((i * 7 % 101, i) for i in range(101)):
        at[k], total = total, total + v
    assert got == at
    assert running_total(rows.limit(0), [F.col("k")], F.col("v"), "before").count() == 0


def test_components(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + random.randrange(1, 40)) for _ in range(50)] + [(5, 5)]
    edges += [(b, a) for a, b in edges[::3]]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[b] for a, b in edges if a == 200} == {200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_scratch_goes_when_spent(spark):
    import os

    from auditloom.llm.common import forget, tidy

    there = lambda t: os.path.isdir(t._al_scratch.removeprefix("file://"))
    with tidy() as keep:
        with tidy() as inner:
            a, b = cut(spark.range(3)), inner(cut(spark.range(4)))
        assert not there(a) and there(b)
        c = keep(cut(spark.range(5)))
    assert not there(b) and there(c) and c.count() == 5
    forget(c)
    assert not there(c)


def test_stores_by_their_own_names(monkeypatch):
    from auditloom.llm import store

    monkeypatch.setattr(store, "_file_system", lambda prefix: prefix)
    assert [store.locate(u) for u in ("s3a://b/x/y", "s3://b/x", "gs://b/x", "hdfs://host:9000/x/y", "file:///x", "/x")] == [
        ("s3://b", "b/x/y"), ("s3://b", "b/x"), ("gs://b", "b/x"), ("hdfs://host:9000", "/x/y"), ("file://", "/x"), ("file://", "/x"),
    ]


def test_models_are_kept_by_sample(spark, monkeypatch):
    from auditloom.llm import common

    made, own = [], str(random.SystemRandom().random())  # earlier runs may have left theirs

    def make():
        made.append(1)
        return {"x": np.arange(3)}

    for sample in ([own, "a"], [own, "a"], [own, "b"], [own, "a"]):
        monkeypatch.setattr(common, "_models", {})
        assert common.saved_arrays(spark, "test", sample, make)["x"].tolist() == [0, 1, 2]
    assert len(made) == 2


# ---- 1 archives ----


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nX: y", None), (4, "u", ""), (5, "u", "only"), (5, "u", "only"), (None, "u", "only"), (6, "u", "only"), (7, "u", "z" * 300_000)]
    index = warc.write_archives(pages_of(spark, rows).withColumn("sha", F.lit(1)), path=f"file://{tmp_path}")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in warc.read_records(index).collect()), key=repr)
    want, first = [], {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in rows:
        raw = (h or "").encode()
        refers = first[h or ""] if i is not None and i > first[h or ""] else None
        want.append((i, "revisit" if refers else "response", refers, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), None if refers else raw))
    assert got == sorted(want, key=repr)
    # A selection of the index reads those records and no others; no gap, one read each.
    some = warc.read_records(index.where("page_id IN (5, 7)"), gap=0, span=1)
    assert sorted(r.page_id for r in some.collect()) == [5, 5, 7]
    assert warc.read_records(warc.write_archives(pages_of(spark, []))).count() == 0
    small = warc.write_archives(pages_of(spark, rows), dedup_min_bytes=6)
    assert {r.page_id for r in small.where("record_type = 'revisit'").collect()} == {2}


# ---- 2 fingerprints ----


def plain_fingerprint(text, n):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a B", "a b c", "É É\x0bx y\x85z A b", "a b c d e"])
def test_fingerprint(text):
    for n in (3, 5):
        assert simhash.fingerprint(text, n) == plain_fingerprint(text, n)


def test_long_fingerprint(monkeypatch):
    random.seed(2)
    text = " ".join(random.choice("abcdefgh") * random.randint(1, 4) for _ in range(1000))
    want = plain_fingerprint(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text, 3) == want


def test_cover_misses_nothing():
    rng = np.random.default_rng(3)
    masks = simhash.cover(3, 7)
    assert len(masks) == 15
    for _ in range(2000):
        flips = np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
        assert ((flips & masks) == 0).any()


@pytest.mark.parametrize("limit", [512, 2])
def test_near_duplicates(spark, limit):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 12, dtype=np.int64).astype(np.uint64)
    prints = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(12)] + [int(base[0])] * 5
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    near = simhash.links(df.select("fp").distinct(), key_limit=limit)
    roots = {r.node: r.root for r in components(near).collect()}
    label = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if bin(a ^ b).count("1") <= 3:
                    label[i] = label[j] = min(label[i], label[j])
    groups = {}
    for i, f in enumerate(signed):
        groups.setdefault(label[i], set()).add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(cut(df)).collect()}
    assert [got[i] for i in range(len(prints))] == label


def test_one_of_each(spark, edge, none):
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id, (r.text or "")[:5]) for r in kept.where("doc_id is not null").collect()) == [(1, "a b c"), (2, ""), (4, "other"), (4, "w w w"), (5, "xxxxx")]
    assert simhash.one_of_each(none).count() == 0
    assert simhash.near_duplicates(cut(simhash.fingerprints(none))).count() == 0


@pytest.mark.parametrize("crowd", [4096, 3])
def test_similar_sets(spark, crowd, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    random.seed(12)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(8):
        base = [word() for _ in range(random.choice([60, 120, 700]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(random.randint(0, 4) * max(1, len(base) // 120)):
                copy[random.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    got = {r.doc_id for r in simhash.one_of_each(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if len(a & b) >= 0.8 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    assert got == set(group)


def jaccard(a, b):
    a, b = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(a & b) / len(a | b)


def test_long_texts_are_settled_exactly(spark):
    rng, texts = np.random.default_rng(14), []
    for k in range(24):
        base = [f"w{x}" for x in rng.integers(0, 10**9, 1200)]
        # The copy's end differs: by a little less or a little more than a similarity of 0.8 allows.
        cut_at = 1200 - (131, 135)[k % 2]
        texts += [" ".join(base), " ".join(base[:cut_at] + [f"v{x}" for x in rng.integers(0, 10**9, 1200 - cut_at)])]
    likeness = [jaccard(*texts[i : i + 2]) for i in range(0, 48, 2)]
    assert all(0.79 < x < 0.81 for x in likeness) and 0 < sum(x >= 0.8 for x in likeness) < 24
    got = {r.doc_id for r in simhash.one_of_each(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got == set(range(0, 48, 2)) | {2 * k + 1 for k, x in enumerate(likeness) if x < 0.8}


def test_large_meetings_miss_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 20)
    # Sets in order of identity: each is like the ones next to it only, and all share one hash.
    rng = np.random.default_rng(15)
    pool = np.unique(rng.integers(2**20, 2**32, 1000, dtype=np.uint64)).astype("<u4")
    pool = pool[rng.permutation(len(pool))]
    rows = []
    for k in range(150):
        # Sliding windows, dealt over the ids so that like sets lie far apart.
        one = np.unique(np.concatenate([pool[k * 5 : k * 5 + 99], np.array([7], dtype="<u4")]))
        rows.append((k * 67 % 150, 0, len(one), [7], bytearray(one.tobytes())))
    sets = spark.createDataFrame(rows, "sid long, fp long, n long, least array<long>, kept binary")
    links = simhash.similar_links(cut(sets), lambda sids: sids.select("sid", F.lit(b"").alias("whole")))
    assert components(cut(links)).where("root = 0").count() == 150


def test_crowds_need_no_second_hash(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 4)
    rng = np.random.default_rng(16)
    rows = []
    for k in range(12):
        base = np.unique(rng.integers(2**20, 2**32, 60, dtype=np.uint64)).astype("<u4")
        # All twenty-four sets share hash 7; a set and its copy share no other of the five least.
        rows += [(2 * k + j, 0, len(base), [7, *rng.integers(100, 10**9, 4).tolist()], bytearray(base.tobytes())) for j in (0, 1)]
    sets = spark.createDataFrame(rows, "sid long, fp long, n long, least array<long>, kept binary")
    links = simhash.similar_links(cut(sets), lambda sids: sids.select("sid", F.lit(b"").alias("whole")))
    assert {tuple(sorted(r)) for r in links.collect()} == {(2 * k, 2 * k + 1) for k in range(12)}


def test_repeats_inside_a_line(spark):
    rng = np.random.default_rng(17)
    rows = []
    for k in range(6):
        base = " ".join(f"w{x}" for x in rng.integers(0, 10**9, 304))
        phrase = " ".join(f"p{x}" for x in rng.integers(0, 10**9, 5))
        rows += [(2 * k, base, "s"), (2 * k + 1, base + (" " + phrase) * 60, "s")]
        assert jaccard(rows[-1][1], base) > 0.9
    assert max((simhash.fingerprint(a, 5) ^ simhash.fingerprint(b, 5)).bit_count() for (_, a, _), (_, b, _) in zip(rows[::2], rows[1::2], strict=True)) > 22
    assert {r.doc_id for r in simhash.one_of_each(docs_of(spark, rows)).collect()} == set(range(0, 12, 2))


def test_shared_counts():
    rng = np.random.default_rng(18)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 150), dtype=np.uint64)).astype("<u4") for _ in range(30)]
    shared = simhash._shared(sets)
    for i in range(30):
        assert shared(i).tolist() == [len(set(sets[i].tolist()) & set(sets[j].tolist())) for j in range(i)]


def test_held_groups(monkeypatch):
    rng = np.random.default_rng(13)
    base = np.unique(rng.integers(0, 2**32, 200, dtype=np.uint64).astype("<u4"))
    kept = [np.unique(np.concatenate([base[: 200 - k % 5], rng.integers(0, 2**32, k % 5, dtype=np.uint64).astype("<u4")])).tobytes() for k in range(40)]
    u, v, root = simhash._similar_forest(np.zeros(40, dtype=np.uint64), np.full(40, 200), kept, 0.8)
    assert set(root.tolist()) == {0} and len(u) == 39


# ---- 3 mixing ----


def test_mixing_edges(spark, edge, none):
    sized = edge.drop("size").withColumn("size", mixing.n_words(F.col("text"))).select("doc_id", "text", "source", "size")
    rows = mixing.mix_sources(sized).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.taken <= 2 * r.size for r in rows)
    taken, target = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(taken[s] == int(target[s]) for s in taken)
    assert mixing.mix_sources(sized.limit(0)).count() == 0
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns
    words = {s: n for s, n in mixed.groupBy("source").agg(F.sum(mixing.n_words(F.col("text")))).collect()}
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mixed_documents(none).count() == 0


def test_mixing_clashing_columns_and_hot_ids(spark, monkeypatch):
    names = ["source_size", "target", "repeats", "extra", "taken"]
    rows = [(None if i % 3 else i, f"t{i} " * (1 + i % 5), "ab"[i % 2]) for i in range(120)]
    docs = docs_of(spark, rows).withColumns({k: F.lit("z") for k in names})
    sized = docs.withColumn("size", mixing.n_words(F.col("text")))
    got = mixing.mix_sources(sized).collect()
    taken, target = {}, {}
    for r in got:
        taken[r.source], target[r.source] = taken.get(r.source, 0) + r.taken, int(r.target)
        assert r.extra <= r.size and r.taken <= 2 * r.size
    assert taken == target and len(got) == 120
    again = mixing.mix_sources(sized.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and set(mixed.select("target").distinct().collect()) == {("z",)}
    with pytest.raises(ValueError):
        mixing.mix_sources(sized.withColumnRenamed("size", "extra_"), size="extra")


def test_mixing_targets(spark):
    rows = [(i, s, n) for i, (s, n) in enumerate([("a", 10), ("a", 30), ("b", 500), ("c", 100), (None, 60), ("d", 0)])]
    got = {r.source: r.target for r in mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    want, sizes, weights = {}, {"a": 40, "b": 500, "c": 100, "d": 0, None: 60}, {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    left, open_ = 1.5 * 700, set(sizes)
    while True:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level > 2 * sizes[s]}
        if not full:
            break
        for s in full:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        open_ -= full
    want |= {s: weights[s] * level for s in open_}
    assert got == pytest.approx(want)


# ---- 4 personal data ----


def test_base_spans():
    kinds = {
        "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
    }

    def plain(t):
        out = []
        for k, r in kinds.items():
            for m in r.finditer(t):
                d = re.sub("[^0-9]", "", m[0])
                ok = {"email": True, "ip": k != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[k]
                if ok:
                    out.append((k, *m.span()))
        return out

    random.seed(5)
    for _ in range(20_000):
        t = "".join(random.choice("0123456789012345.. -@+()ab%_\n") for _ in range(random.randint(0, 60)))
        assert pii.base_spans(t) == plain(t)
    assert pii.base_spans("a" * 200_000 + "1" * 200_000 + "@") == []


def test_added_spans(tagger):
    texts = ["write to jane.doe [at] example [dot] com now please and thank you for all", "call me at 555-123-4567 tomorrow morning or in the evening if you can", "nothing here at all. dot the i", ""]
    bases = [pii.base_spans(t) for t in texts]
    found = pii.added_spans(texts, bases, tagger)
    assert [{k for k, _, _ in f} for f in found[2:]] == [set(), set()]
    assert [{k for k, _, _ in f} for f in found[:2]] == [{"email"}, {"phone"}]
    held, tags = pii.training_windows(["some other words that stand between the finds of it " * 5], 300, seed=9)
    want = [set(pii._spans(t)) for t in tags]
    got = [set(pii._spans(t)) for t in tagger.decode(held)]
    hit = sum(len(a & b) for a, b in zip(want, got, strict=True))
    assert hit / sum(map(len, want)) > 0.8 and hit / max(1, sum(map(len, got))) > 0.8


class Marks:
    """Tags what lies between { and } as a span of a kind, as far as a window shows it."""

    def __init__(self, kind):
        self.kind = pii.KINDS.index(kind)

    def decode(self, ids):
        tags = np.zeros(ids.shape, np.int64)
        for row, out in zip(ids, tags, strict=True):
            text = "".join(chr(x + 31) if 0 < x < 96 else " " for x in row)
            for m in re.finditer(r"\{[^{}]*\}?|^[^{}]*\}", text):
                out[m.start() : m.end()] = 2 + 2 * self.kind
                out[m.start()] -= 1
        return tags


@pytest.mark.parametrize(("kind", "value"), [("email", "{john at example.com}"), ("ip", "{10[.]0[.]0[.]1}"), ("email", "{" + "j" * 60 + " at " + "e" * 30 + ".com}")])
def test_added_spans_are_whole(kind, value):
    for at in range(0, 140):
        text = "x " * 70 + "y" * at + value + " z" * 70
        assert pii.added_spans([text], [[]], Marks(kind)) == [[(kind, 140 + at, 140 + at + len(value))]]


def test_pii_frame(spark, edge, none, tagger):
    rows = docs_of(spark, [(1, "mail a@b.co and +1 (132) 555-1352", "s"), (2, None, "s"), (2, None, "s")])
    got = pii.find_personal_data(rows.withColumn("spans", F.lit(0)), tagger).orderBy("doc_id").collect()
    assert (got[0].n_email, got[0].n_phone, got[0].spans) == (1, 1, "email:5:11,phone:16:33")
    assert got[1] == got[2] and got[1].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_personal_data(edge, tagger).count() == len(EDGE) and pii.find_personal_data(none, tagger).count() == 0


# ---- 5 lines ----


def plain_lines(rows, least, longest=10**9):
    """Texts without repeated runs; runs of more than ``longest`` lines are unions of shorter ones."""
    strip = lambda x: x.strip(lines.BLANKS)
    seqs = {i: [strip(x) for x in t.split("\n") if strip(x)] for i, t in rows if t is not None}
    seen, gone = {}, {i: set() for i in seqs}
    for i in sorted(seqs):
        s = seqs[i]
        for a in range(len(s)):
            words = 0
            for b in range(a, min(len(s), a + longest)):
                words += len(s[b].split())
                if words >= least:
                    first = seen.setdefault(tuple(s[a : b + 1]), (i, a))
                    if first != (i, a):
                        gone[i].update(range(max(a, first[1] + b + 1 - a) if first[0] == i else a, b + 1))
    out = {}
    for i, t in rows:
        n, keep = 0, []
        for x in (t or "").split("\n"):
            if strip(x):
                n += 1
                if n - 1 in gone[i]:
                    continue
            keep.append(x)
        out[i] = (t if t is None else "\n".join(keep), len(gone.get(i, ())))
    return out


def test_line_dedup(spark):
    random.seed(6)
    rows = [(i, "\n".join(random.choice(["a", "b", "c d e", " f g\r", "h", ""]) for _ in range(random.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a\n" * 70), (103, rows[5][1]), (104, "one two three four five six\nz")]
    got = lines.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=6).collect()
    assert {r.doc_id: (r.text, r.n_deleted) for r in got} == plain_lines(rows, 6)


def test_line_copies_without_ids(spark):
    body = "one two three four\nfive six seven"
    rows = [(None, "head\n" + body), (9, body), (None, body + "\ntail"), (0, "zero\n" + body), (None, "x\n\n" + body + "\n" + body)]
    got = {r.text: r.n_deleted for r in lines.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=6).collect()}
    assert got == {"zero\n" + body: 0, "": 2, "head": 2, "tail": 2, "x\n": 4}


def test_line_edges(edge, none):
    out = lines.deduplicate_lines(edge)
    assert out.count() == len(EDGE) and set(out.columns) == set(edge.columns)
    again = lines.deduplicate_lines(out.drop("n_deleted"))
    assert again.agg(F.sum("n_deleted")).first()[0] == 0
    assert lines.deduplicate_lines(none).count() == 0


# ---- 6 toxicity ----


def test_toxicity(spark, edge, none):
    random.seed(7)
    word = lambda: "".join(random.choice("aeioubdfgt") for _ in range(random.randint(2, 7)))
    rows = []
    for i in range(500):
        ws = [word() for _ in range(random.randint(0, 120))]
        y = i % 3 == 0
        if y:
            for _ in range(random.randint(1, 3)):
                ws.insert(random.randint(0, len(ws)), random.choice(["vileword", "zorg" + word()]))
        rows.append((i, " ".join(ws), int(y)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(9999, None), (None, 1)], "doc_id long, toxic int")
    texts, ys = toxicity.training_sample(docs, labels)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not set(texts) & {t for i, t, _ in rows if i in held and t}
    model = toxicity.train(texts, ys)
    scored = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    assert np.mean([(scored[i] >= 0.5) == bool(y) for i, _, y in rows if i in held]) > 0.9
    out = toxicity.score_documents(edge, model)
    assert sorted(out.columns) == sorted(edge.columns) and out.count() == len(EDGE)
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score_documents(none, model).count() == 0
    plain = toxicity.train(["a"], [1])
    assert toxicity.Scorer(plain)(["a", None]).tolist() == [0.0, 0.0]


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 57, 200])
def test_windows_cover(n):
    seen = {i for s in toxicity.windows_of(n) for i in range(s, min(n, s + toxicity.WINDOW))}
    assert seen == set(range(n))


def test_gradients(monkeypatch):
    for module, shape in ((toxicity, None), (pii, None)):
        monkeypatch.setattr(module, "F4", np.float64)
        model = module.Model(1)
        model.p = {k: v.astype(float) for k, v in model.p.items()}
        rng = np.random.default_rng(0)
        if module is toxicity:
            gates, mask, d = rng.standard_normal((4, 6, 2, 24)), np.ones((4, 6), bool), rng.random(4)
            mask[1, 3:] = False
            loss = lambda: float((model.forward(gates, mask)[0] * d).sum())
            grads = model.backward(gates, model.forward(gates, mask, keep=True)[1], d)[0]
        else:
            ids, tags = rng.integers(1, 99, (3, 9)), np.array([[0, 1, 2, 2, 0, 3, 4, 0, 0]] * 3)
            loss = lambda: model.crf_loss(model.forward(ids)[0], tags)[0]
            scores, cache = model.forward(ids, keep=True)
            _, ds, dt = model.crf_loss(scores, tags)
            grads = model.backward(cache, ds) | {"T": dt}
        for k, g in grads.items():
            at = tuple(np.argwhere(np.abs(g) > 1e-5)[0])
            old = model.p[k][at]
            model.p[k][at] = old + 1e-4
            up = loss()
            model.p[k][at] = old - 1e-4
            down = loss()
            model.p[k][at] = old
            assert (up - down) / 2e-4 == pytest.approx(float(g[at]), rel=0.02, abs=1e-5)


# ---- 7 and 10 tokens ----


def odd_texts(n):
    random.seed(8)
    alphabet = [chr(i) for i in range(1, 0x250)] + list("́̈ΣσШ中\U0001f600 \u0085 Ⅰ²​﻿٣\U0001d400") + [" "] * 60 + ["'s", "<|endoftext|>", "<|startoftext|>", "the"] * 5
    return ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(n)]


def test_encoders_match_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), tokens.ByteLevelEncoder(path)
    for t in [*odd_texts(800), "a" * 5000, " " * 300]:
        assert list(memoryview(own(t)).cast("I")) == library.encode(t, add_special_tokens=False).ids
    path = public_tokenizers.path("word_bpe_49k.json")
    library, words = Tokenizer.from_file(path), bpe.WordVocabulary(path)
    lexicon = bpe.compile_lexicon({w.encode(): words.merge(w.encode()) for w in ("the", "then", "thin", "s", "é", "running", "singing")})
    for encoder in (bpe.Encoder(words), bpe.Encoder(words, bpe.Lexicon(lexicon))):
        for t in [*odd_texts(800), "a" * 5000, "the then singing thing"]:
            ids = library.encode(t, add_special_tokens=False).ids
            got = np.frombuffer(encoder.encode(t), dtype="<i4")
            assert got.tolist() == ids and words.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact():
    random.seed(9)
    words = {"".join(random.choice("abc") for _ in range(random.randint(1, 7))).encode() for _ in range(400)}
    table = {w: bytes([len(w), 0, 0, 0]) * (1 + w[0] % 3) for w in words}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(table))
    for k in range(4000):
        w = "".join(random.choice("abcd") for _ in range(random.randint(1, 8))).encode()
        assert lexicon.get(w) == table.get(w)
    assert all(lexicon.get(w) == v for w, v in table.items())
    shared = bpe.Lexicon(bpe.compile_lexicon({b"walking": b"\1\0\0\0", b"talking": b"\2\0\0\0"}))
    assert len(shared.final) == len(b"walking") + 1  # one chain of states: the suffix is shared
    assert bpe.Lexicon(bpe.compile_lexicon({})).get(b"x") is None


def test_token_files(spark, edge, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    manifest = tokens.write_tokens(edge, path, group_tokens=50)
    got = tokens.token_checks(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in EDGE), key=lambda i: (i is not None, i))
    known = {(i, tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, _ in EDGE}
    start = 0
    for r, full in zip(got, tokens.read_tokens(manifest).orderBy("start").collect(), strict=True):
        assert (r.doc_id, tuple(full.ids)) in known and r.start == full.start == start and r.n_tokens == len(full.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(full.ids, dtype="<u4").tobytes())
        start += r.n_tokens
    assert tokens.token_index(manifest).orderBy("start").collect() == [(r.doc_id, r.start, r.n_tokens) for r in got]
    import pyarrow.parquet as pq

    one = pq.ParquetFile(manifest.first().file.removeprefix("file://")).metadata.row_group(0)
    assert one.column(2).has_dictionary_page and "DELTA_BINARY_PACKED" in one.column(0).encodings and one.column(0).has_offset_index
    assert tokens.token_checks(tokens.write_tokens(none, path)).count() == 0


def test_selected_documents_by_page(spark, none, tmp_path):
    rng = np.random.default_rng(19)
    rows = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 10**6, 200)), "s") for i in range(3000)] + [(None, "n", "s"), (7, "again", "s")]
    manifest = tokens.write_tokens(docs_of(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), path=f"file://{tmp_path}/t")
    all_ids = tokens.read_tokens(manifest)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem

    def read_by(job):
        before = sum(x.getBytesRead() for x in files.getAllStatistics())
        got = sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in job.collect())
        return got, sum(x.getBytesRead() for x in files.getAllStatistics()) - before

    wanted = [7, 1500, 1501, 999_999, -4]
    whole = sum(p.stat().st_size for p in (tmp_path / "t").iterdir())
    got, spent = read_by(tokens.read_documents(manifest, wanted))
    assert got == sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in all_ids.where(F.col("doc_id").isin(wanted)).collect()) and len(got) == 4
    assert spent < whole / 5
    many, _ = read_by(tokens.read_documents(manifest, range(0, 3000, 10)))
    assert [i for i, _, _ in many] == list(range(0, 3000, 10))
    assert tokens.read_documents(manifest, []).count() == 0 and tokens.read_documents(tokens.write_tokens(none, public_tokenizers.path("byte_bpe_50k.json")), [1]).count() == 0


def test_repeated_ids_are_ordered_by_text(spark):
    rows = [(1, f"text {k}", "s") for k in range(40)] + [(None, f"none {k}", "s") for k in range(40)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    one, two = (sorted(map(tuple, tokens.token_checks(tokens.write_tokens(docs_of(spark, rows).repartition(n), path)).collect()), key=lambda r: r[1]) for n in (1, 5))
    assert one == two


def test_bpe_frame(spark, edge, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = bpe.digest_documents(edge, path).collect()
    assert len(got) == len(EDGE)
    empty = next(r for r in got if r.doc_id == 3)
    assert (empty.n_tokens, empty.ids_sha256, empty.decoded_sha256) == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    assert next(r for r in bpe.encode_documents(edge, path).collect() if r.doc_id is None).decoded == "g</w> h</w>"
    assert bpe.digest_documents(none, path).count() == 0
    counts = {r.word: r.n for r in bpe.count_words(edge, path).collect()}
    assert counts["w"] == 30_000 and counts["a"] == 2


# ---- 8 chunks ----


def test_chunks_resist_shifts():
    random.seed(10)
    text = " ".join("".join(random.choice("abcdefghij") for _ in range(random.randint(2, 9))) for _ in range(3000))
    data = text.encode()
    ends = chunks.chunk_lengths(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= chunks.MOST and sizes[:-1].min() >= chunks.LEAST
    moved = chunks.chunk_set(text[:500] + "inserted words" + text[500:])
    assert chunks.likeness(chunks.chunk_set(text), moved) > 0.95
    assert chunks.chunk_lengths(b"") == [] and chunks.likeness({}, {}) == 1.0 and chunks.likeness({}, {1: 2}) == 0.0
    flat = np.frombuffer(data, dtype=np.uint8)
    state, hashes = 0, []
    for b in flat[:400]:
        state = ((state << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        hashes.append(state)
    at, hard = chunks._ends(data[:400])
    loose = [i + 1 for i, h in enumerate(hashes) if h >> (32 - chunks.LOOSE_BITS) == 0]
    assert at.tolist() == loose


def test_chunk_frame(spark, none):
    texts = ["first text of some length " * 9, "", None, "zweiter Text äöü " * 30, "x", "x"]
    rows = [(i * 3, t, "s") for i, t in enumerate(texts)]
    got = chunks.fingerprint_documents(docs_of(spark, rows[::-1]).repartition(3)).orderBy("doc_id").collect()
    for k, r in enumerate(got):
        a, b = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        assert r.n_chars == len(a) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == chunks.written(chunks.chunk_set(a)) and r.edited_fingerprint == chunks.written(chunks.chunk_set(edited))
        assert r.near_next == chunks.likeness(chunks.chunk_set(a), chunks.chunk_set(b)) and 0 <= r.near_edited <= 1
    assert chunks.fingerprint_documents(none).count() == 0
    one = chunks.fingerprint_documents(docs_of(spark, [(None, "alone", "s")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_chunk_edges(edge):
    assert chunks.fingerprint_documents(edge).count() == len(EDGE)


# ---- 9 vectors ----


@pytest.mark.parametrize("block", [4096, 40])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((12, 16))
    x = np.concatenate([centres[i % 12] + rng.standard_normal((1, 16)) * rng.choice([0.02, 0.1, 0.2, 1.0]) for i in range(300)])
    x = np.concatenate([x, x[:5], x[:3] * 7]).astype(np.float32)
    label = [i % 2 for i in range(len(x))]
    rows = [(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, label, strict=True))]
    extra = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [None] * 16, 0), (904, x[0].tolist(), None), (905, [1.0], 0), (906, [2.0], 0), (907, [], 1), (908, [float("inf")] + [1.0] * 15, 0)]
    df = spark.createDataFrame(rows + extra, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in covertree.near_vectors(df.withColumn("key", F.lit(1)), block=block).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    comp = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([comp[near[i]].min() for i in range(len(x))])
        if (new == comp).all():
            break
        comp = new
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum() - 1, comp[i], comp[i] == i)
    for i in (900, 901, 902, 903, 904, 907, 908):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[906].component_id == 905
    assert covertree.near_vectors(df.limit(0)).count() == 0


def test_vectors_that_share_an_id(spark):
    rows = [(5, [1.0, 0.0], 0), (5, [0.0, 1.0], 0), (6, [1.0, 0.001], 0), (7, [0.001, 1.0], 0), (5, [1.0, 0.0], 1), (6, [1.0, 0.0], 1), (6, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = covertree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(((r.vec_id or -1), r.n_links, r.component_id or -1) for r in got) == [(-1, 0, -1), (5, 1, 5), (5, 1, 5), (5, 2, 5), (6, 1, 5), (6, 2, 5), (6, 2, 5), (7, 1, 5)]


def test_pairs_at_the_threshold():
    rng = np.random.default_rng(20)
    a = rng.standard_normal((200, 8))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((200, 8))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    # Each at a cosine within some 1e-12 of one threshold that is close to 1, where roots lose most.
    t = 1.0 - 1e-9
    b = t * a + np.sqrt(1 - t * t) * side
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    counts, _, _ = covertree.dual_links(a, b, np.ones(200, dtype=np.int64), t)
    assert counts.tolist() == (a @ b.T >= t).sum(axis=1).tolist()


def test_stages_on_edges(spark, edge, none, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 0), (4, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs, n in ((edge, len(EDGE)), (none, 0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert out.count() <= 3 * n
            if k < 4:
                assert out.columns == docs.columns
