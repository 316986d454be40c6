"""The registered queries of the training-data operators against plain versions of them."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import same
from pyspark.sql import functions as F
from test_llm import plain_fingerprint, plain_lines

from auditloom.llm import chunks, pii, toxicity
from auditloom.llm.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, duck, name):
    assert same(QUERIES[name](spark, sf), duck.sql(ORACLES[name]))


# ---- 2 and the near-duplicate stage ----


def groups_of(nodes, linked):
    """The smallest node that links reach, for every node."""
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {n: root(n) for n in nodes}


def test_simhash_query(spark, sf, documents):
    prints = {i: plain_fingerprint(r.text, 3) for i, r in documents.items()}
    group = groups_of(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash"](spark, sf).collect()}
    assert got == {i: (f"{prints[i]:016x}", group[i]) for i in documents}


# ---- 4 ----

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(digits[::-1])]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": 8 <= len(digits) <= 15}
            if ok[kind]:
                out.append((kind, *m.span()))
    return out


def read_spans(text):
    return [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in text.split(",") if x)]


def test_personal_data_query(spark, sf, documents):
    got = {r.doc_id: r for r in QUERIES["op4_personal_data"](spark, sf).collect()}
    assert set(got) == set(documents) and sum(r.spans != "" for r in got.values()) > 0
    for i, r in got.items():
        base = plain_base(documents[i].text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        spans = read_spans(r.spans)
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (list(PATTERNS).index(s[0]), s[1]))
        added = [s for s in spans if s not in base]
        assert all(pii.plausible(k, documents[i].text[a:b]) for k, a, b in added)
        for k, (_, a, b) in enumerate(added):
            assert all(b <= c or d <= a for j, (_, c, d) in enumerate([*added, *base]) if j != k)


def planted(documents, n, make, seed):
    """Texts with one invented value each, and where it stands."""
    rng = np.random.default_rng(seed)
    plain = [r.text for r in documents.values() if r.text and len(r.text) > 400]
    out = []
    while len(out) < n:
        kind, value = make(rng)
        text = plain[rng.integers(len(plain))]
        at = int(rng.choice([m.start() for m in re.finditer(" ", text)]))
        if kind and not plain_base(f" {value} "):
            out.append((text[:at] + f" {value} " + text[at + 1 :], kind, at + 1, at + 1 + len(value)))
    return out


def plain_decoding(text, model):
    """Every window decoded, one at a time; whole finds joined, the longest first."""
    starts = range(0, max(1, len(text) - pii.WINDOW + pii.STRIDE), pii.STRIDE)
    found, torn = set(), []

    def read(s):
        part = text[s : s + pii.WINDOW]
        ids = np.zeros((1, pii.WINDOW), np.int64)
        ids[0, : len(part)] = pii.char_ids(part)
        tags, a = [*model.decode(ids)[0][: len(part)].tolist(), 0], None
        for i, tag in enumerate(tags):
            if a is not None and (tag == 0 or tag % 2 or i == len(part)):
                yield pii.KINDS[(tags[a] - 1) // 2], a, i, len(part)
                a = None
            if tag % 2:
                a = i

    def take(s):
        for kind, a, b, n in read(s):
            if (s > 0 and a < pii.EDGE) or (s + n < len(text) and b > n - pii.EDGE):
                torn.append((kind, s + a, s + b))
                continue
            value = text[s + a : s + b]
            low, high = s + a + len(value) - len(value.lstrip()), s + a + len(value.rstrip().rstrip(",;:").rstrip(" \t\n,;:"))
            if low < high and pii.plausible(kind, text[low:high]):
                found.add((kind, low, high))

    for s in starts:
        take(s)
    merged = []
    for kind, a, b in sorted(torn, key=lambda x: (pii.KINDS.index(x[0]), x[1], x[2])):
        if merged and merged[-1][0] == kind and a <= merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        if b - a <= pii.LONGEST and not any(k == kind and c < b and a < d for k, c, d in found):
            take(max(0, min(len(text) - pii.WINDOW, (a + b - pii.WINDOW) // 2)))
    kept = []
    for kind, a, b in sorted(found, key=lambda x: (x[1] - x[2], x[1], pii.KINDS.index(x[0]))):
        if all(b <= c or d <= a for _, c, d in [*plain_base(text), *kept]):
            kept.append((kind, a, b))
    return sorted(kept)


def test_no_window_that_matters_is_skipped(documents, tagger):
    cases = planted(documents, 60, pii._invent, 21)
    texts = [t for t, *_ in cases] + [r.text for r in documents.values() if r.text][:40]
    got = pii.added_spans(texts, [pii.base_spans(t) for t in texts], tagger)
    assert [sorted(x) for x in got] == [plain_decoding(t, tagger) for t in texts]


def test_planted_values_are_found(documents, tagger):
    cases = planted(documents, 300, pii._invent, 22)
    texts = [t for t, *_ in cases]
    got = pii.added_spans(texts, [pii.base_spans(t) for t in texts], tagger)
    hit = sum((k, a, b) in found for found, (_, k, a, b) in zip(got, cases, strict=True))
    extra = sum(len([s for s in found if not (s[1] < b and a < s[2])]) for found, (_, _, a, b) in zip(got, cases, strict=True))
    assert hit >= 0.8 * len(cases) and extra <= 0.02 * len(cases)


# ---- 6 ----


def plain_score(model, text, seen):
    """The score of a text, word by word and window by window in double precision."""
    p, h = {k: v.astype(float) for k, v in model.p.items() if v.ndim < 2 or k not in ("own", "chars")}, toxicity.HIDDEN
    sig = lambda x: 1 / (1 + np.exp(-x))
    mask = (1 << 64) - 1

    def gates(word):
        data = b"<" + (word.encode() or b".") + b">"
        whole = 0
        for b in data:
            whole = (whole * 0x100000001B3 + b + 1) & mask
        own = (whole * 0x9E3779B97F4A7C15 & mask) >> (64 - toxicity.WORD_BITS)
        grams = []
        for n in range(3, 8):
            for at in range(len(data) - n + 1):
                run = 0
                for b in data[at : at + n]:
                    run = (run * 0x9E3779B1 + b) & mask
                grams.append(((run ^ n) * 0x9E3779B97F4A7C15 & mask) >> (64 - toxicity.GRAM_BITS))
        x = np.concatenate([model.p["own"][own], model.p["chars"][grams].astype(float).mean(axis=0), [1.0]])
        return [x @ p["W"][d] + p["b"][d, 0] for d in (0, 1)]

    words = re.findall(r"\w{1,32}", (text or "").lower()) or [""]
    for w in words:
        if w not in seen:
            seen[w] = gates(w)
    best = -np.inf
    starts = [0] if len(words) <= 32 else [*range(0, len(words) - 32, 24), len(words) - 32]
    for s in starts:
        part, sides = words[s : s + 32], []
        for d in (0, 1):
            state, states = np.zeros(h), []
            for w in part if d == 0 else part[::-1]:
                x, u = seen[w][d], state @ p["U"][d]
                z, r = sig(x[:h] + u[:h]), sig(x[h : 2 * h] + u[h : 2 * h])
                state = (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :]) + z * state
                states.append(state)
            sides.append(states if d == 0 else states[::-1])
        both = np.array([np.concatenate(x) for x in zip(*sides, strict=True)])
        e = np.tanh(both @ p["A"]) @ p["v"]
        a = np.exp(e - e.max())
        best = max(best, float((a / a.sum()) @ both @ p["w"] + p["c"][0]))
    return 1 / (1 + np.exp(-best))


@pytest.fixture(scope="module")
def judge(spark, sf):
    return toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet"))


@pytest.fixture(scope="module")
def scores(documents, judge):
    seen = {}
    return {i: plain_score(judge, r.text, seen) for i, r in documents.items()}


def test_toxicity_query(spark, sf, documents, scores):
    got = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    assert set(got) == set(documents)
    for i, r in got.items():
        assert r.score == pytest.approx(scores[i], abs=1e-3)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)


def average_precision(scores, marks):
    """Mean precision at the places of the marked, from the highest score down."""
    order = np.argsort(-np.array(scores), kind="stable")
    y = np.array(marks)[order]
    return float((np.cumsum(y) / np.arange(1, len(y) + 1))[y == 1].mean())


def test_held_out_accuracy(spark):
    """On a larger table, documents that training never saw: better than word statistics alone, far from a constant answer."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = [r for r in QUERIES["op6_toxicity"](spark, folder).where("held_out").collect() if labels.get(r.doc_id) is not None]
    y = [labels[r.doc_id] for r in rows]
    found = sum(r.predicted and labels[r.doc_id] for r in rows)
    assert len(rows) > 800 and sum(y) > 90
    assert found >= 0.75 * sum(y) and found >= 0.85 * sum(r.predicted for r in rows)
    # The highest smoothed log-odds of a word of the text, from the same sample.
    texts, ys = toxicity.training_sample(docs, marks)
    n, seen = [ys.count(0), ys.count(1)], {}
    for text, k in zip(texts, ys, strict=True):
        for w in set(toxicity.words_of(text)):
            seen.setdefault(w, [0, 0])[k] += 1
    odds = {w: np.log((c[1] * (n[0] / n[1]) ** 0.5 + 4) / (c[0] * (n[1] / n[0]) ** 0.5 + 4)) for w, c in seen.items()}
    held = {r.doc_id: r.text for r in docs.where(F.col("doc_id").isin([r.doc_id for r in rows])).collect()}
    words = [max((odds.get(w, 0.0) for w in toxicity.words_of(held[r.doc_id])), default=0.0) for r in rows]
    assert average_precision([r.score for r in rows], y) > max(0.88, average_precision(words, y))


# ---- 7 and 10 ----


def as_bytes(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_token_query(spark, sf, documents):
    from tokenizers import Tokenizer

    library, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i in sorted(documents):
        ids = library.encode(documents[i].text or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(as_bytes(ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op7_token_files"](spark, sf).collect()) == want


def word_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    return library


def plain_digest(library, i, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return i, len(ids), hashlib.sha256(as_bytes(ids)).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_query(spark, sf, documents):
    library = word_library()
    assert sorted(tuple(r) for r in QUERIES["op10_bpe"](spark, sf).collect()) == sorted(plain_digest(library, i, r.text) for i, r in documents.items())


# ---- 8 ----


def plain_chunks(text):
    """Digest to length of the chunks of a text, byte by byte."""
    data, out, start, state = text.encode(), {}, 0, 0
    for at, b in enumerate(data, 1):
        state = ((state << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        size = at - start
        # Zero bits are asked for at the top: seven before the usual size, five after it.
        if size == 512 or (size >= 64 and state >> 27 == 0) or (size >= 16 and state >> 25 == 0) or at == len(data):
            out[xxhash.xxh64_intdigest(data[start:at]) >> 16] = size
            start = at
    return out


def shared(a, b):
    if not a or not b:
        return float(not a and not b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def test_fingerprint_query(spark, sf, documents):
    order = sorted(documents)
    got = {r.doc_id: r for r in QUERIES["op8_chunk_fingerprints"](spark, sf).collect()}
    shown = lambda c: ",".join(f"{d:012x}:{c[d]}" for d in sorted(c))
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        a, b = documents[i].text or "", documents[j].text or ""
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        own, changed, after = plain_chunks(a), plain_chunks(edited), plain_chunks(b)
        want = (i, len(a), hashlib.sha256(edited.encode()).hexdigest(), shown(own), shown(changed), shared(own, changed), shared(own, after))
        assert tuple(got[i])[:5] == want[:5]
        assert tuple(got[i])[5:] == pytest.approx(want[5:])


# ---- the pipeline ----


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target | {s: weight[s] * level for s in open_}


def plain_mix(rows):
    """(id, text) of the mix; rows are (id, text, source)."""
    blank = r"[\x20\x09-\x0D]"
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + count(t)
    out = []
    for s, target in plain_targets(sizes).items():
        mine = sorted((r for r in rows if r[2] == s), key=lambda r: (hashlib.md5(f"42:{r[0]}".encode()).hexdigest(), r[0]))
        whole = int(target // sizes[s]) if sizes[s] else 0
        left = int(target) - whole * sizes[s]
        for i, t, _ in mine:
            out += [(i, t)] * whole
            extra = max(0, min(count(t), left))
            left -= extra
            if extra:
                words = re.findall(rf"[^\x20\x09-\x0D]+{blank}*", t)
                out.append((i, t if extra == count(t) else re.match(f"{blank}*", t)[0] + "".join(words[:extra])))
    return out


def test_pipeline_query(spark, sf, documents, scores):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]
    # Scores in single precision, held against the plain ones above, decide where those lie within a rounding of one half.
    single = {r.doc_id: r.score for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    kept = [(i, documents[i].text) for i in sorted(documents) if (single[i] if abs(scores[i] - 0.5) < 1e-3 else scores[i]) < 0.5]
    assert len(documents) / 3 < len(kept) <= len(documents)
    bare = {i: t for i, (t, _) in plain_lines(kept, 50, 50).items()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in bare.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    prints = {i: plain_fingerprint(t, 5) for i, t in bare.items()}
    near = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3 or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    group = groups_of(sorted(bare), near)
    mixed = plain_mix([(i, bare[i], documents[i].source) for i in sorted(set(group.values()))])
    library = word_library()
    want = sorted(plain_digest(library, i, t) for i, t in mixed)
    got = sorted(tuple(r) for r in QUERIES["pipeline"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == want and corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_the_columns(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert out.where(F.col("n_chars") != F.length("text")).count() == docs.where(F.col("n_chars") != F.length("text")).count()
