"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters as a learned vector of its own and the mean of its character n-grams' learned
vectors, and nothing else. Texts are cut into overlapping windows of ``WINDOW`` words that
cover them whole; forward and backward gated units read each window, attention pools their
states, and a document's score is that of its highest window. Training, in numpy, goes by
documents: the window that the network scores highest, a hard example where the label is 0,
is the one that learns. In the first epoch, when the network knows nothing, the window with
the most telling words is taken, by their log-odds in the sample's other folds; they are no
input and no part of the model. Own vectors are left out at random, so that n-grams learn
what they can for words that training hasn't seen.

The sample is bounded: at most ``SAMPLE`` labelled documents of each class, in seeded
order, of at most ``SAMPLE_CHARS`` characters. Scoring reads every text whole.

Defined results: a null text is empty; a text without words has the score of an empty
window; without labelled rows of both classes every score is 0; a null label or id is no
example; rows are scored one by one, so repeated rows repeat their score; an empty table
gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from auditloom.llm.common import kept_by_worker, saved_arrays, small_batches

SAMPLE, SAMPLE_CHARS = 2500, 12_000
WINDOW, STRIDE = 32, 24
HIDDEN, OWN, CHARS = 8, 4, 16
#: How often training leaves a word's own vector out, and the rate at which vectors learn.
LEFT_OUT, VECTOR_RATE = 0.5, 0.8
WORD_BITS, GRAM_BITS = 17, 18
FOLDS = 4
GRAMS = range(3, 8)
LONGEST = 32
#: Words a worker remembers before it starts anew; this bounds memory alone.
REMEMBERED = 120_000
WORD = re.compile(r"\w{1,%d}" % LONGEST)
F4 = np.float32


def words_of(text: str | None) -> list[str]:
    """Lower-case words; longer runs of word characters count as several."""
    return WORD.findall((text or "").lower())


class Grams:
    """Buckets of words and of their n-grams, these one after another: word i's stand from ``first[i]``."""

    def __init__(self, own: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        self.own, self.flat, self.size = own, flat, size
        self.first = np.cumsum(size) - size

    def take(self, which: np.ndarray) -> Grams:
        size = self.size[which]
        shift = np.repeat(self.first[which] - (np.cumsum(size) - size), size)
        return Grams(self.own[which], self.flat[shift + np.arange(len(shift))], size)


def gram_ids(words: list[str]) -> Grams:
    """The buckets of words, which should be of about one length; the empty word stands for padding."""
    data = [b"<" + (w.encode("utf-8") or b".") + b">" for w in words]
    size = np.array([len(x) for x in data])
    wide = int(size.max()) + max(GRAMS)
    flat = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in data), dtype=np.uint8).reshape(len(data), wide).astype(np.uint64)
    cells, inside, run = [], [], np.zeros_like(flat)
    whole = np.zeros(len(data), dtype=np.uint64)
    for k in range(int(size.max())):
        whole = np.where(size > k, whole * np.uint64(0x100000001B3) + flat[:, k] + np.uint64(1), whole)
    for k in range(max(GRAMS)):
        run[:, : wide - k] = run[:, : wide - k] * np.uint64(0x9E3779B1) + flat[:, k:]
        n = k + 1
        if n in GRAMS:
            cells.append(((run ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - GRAM_BITS))
            inside.append(np.arange(wide)[None, :] + n <= size[:, None])
    own = ((whole * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    there = np.concatenate(inside, axis=1)
    return Grams(own, np.concatenate(cells, axis=1)[there].astype(np.int32), there.sum(axis=1))


def all_grams(words: list[str]) -> Grams:
    """``gram_ids`` of words sorted by length, some at a time."""
    parts = [gram_ids(words[at : at + 1024]) for at in range(0, len(words), 1024)]
    return Grams(*(np.concatenate([getattr(g, k) for g in parts]) for k in ("own", "flat", "size")))


def _odds(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Log-odds of class 1 among documents with a feature, drawn towards 0 where they are few."""
    return np.log((positive + 4.0) / (negative + 4.0)).astype(F4)


def windows_of(n: int) -> list[int]:
    """Where the windows of a text of n words start; together they cover it."""
    if n <= WINDOW:
        return [0]
    at = list(range(0, n - WINDOW, STRIDE))
    return [*at, n - WINDOW]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F4(0.5) * (np.tanh(F4(0.5) * x) + F4(1))


class Model:
    """Parameters and the passes over them; both directions are computed side by side."""

    def __init__(self, seed: int = 42) -> None:
        rng = np.random.default_rng(seed)
        d, h = OWN + CHARS + 1, HIDDEN
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(F4)
        self.p = {
            "own": draw(1 << WORD_BITS, OWN, scale=0.1),
            "chars": draw(1 << GRAM_BITS, CHARS, scale=0.1),
            "W": draw(2, d, 3 * h, scale=d**-0.5),
            "b": np.zeros((2, 1, 3 * h), F4),
            "U": draw(2, h, 3 * h, scale=h**-0.5),
            "A": draw(2 * h, h, scale=0.3),
            "v": draw(h, scale=0.3),
            "w": draw(2 * h, scale=0.3),
            "c": np.zeros(1, F4),
        }
        self.trained = False

    def inputs(self, grams: Grams) -> np.ndarray:
        """The input vectors of words."""
        mean = np.add.reduceat(self.p["chars"][grams.flat], grams.first, axis=0) / grams.size[:, None]
        return np.concatenate([self.p["own"][grams.own], mean, np.ones((len(mean), 1), F4)], axis=1).astype(F4)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Inputs to the gates of both directions: (words, 2, 3 HIDDEN)."""
        return (np.matmul(x[None], self.p["W"]) + self.p["b"]).transpose(1, 0, 2)

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple:
        """Logits of windows from their words' gates (B, T, 2, 3H) and mask (B, T)."""
        B, T, h = gates.shape[0], gates.shape[1], HIDDEN
        U = self.p["U"]
        state, states, kept = np.zeros((2, B, h), F4), np.zeros((2, T, B, h), F4), []
        steps = np.stack([gates[:, :, 0].transpose(1, 0, 2), gates[::1, ::-1, 1].transpose(1, 0, 2)])  # (2, T, B, 3H)
        on = np.stack([mask.T, mask[:, ::-1].T])[..., None].astype(F4)
        full = bool(mask.all())
        for t in range(T):
            x, u = steps[:, t], np.matmul(state, U)
            zr = _sigmoid(x[..., : 2 * h] + u[..., : 2 * h])
            z, r = zr[..., :h], zr[..., h:]
            n = np.tanh(x[..., 2 * h :] + r * u[..., 2 * h :])
            new = n + z * (state - n)
            if not full:
                new = state + on[:, t] * (new - state)
            if keep:
                kept.append((state, z, r, n, u[..., 2 * h :]))
            state = new
            states[:, t] = state
        both = np.concatenate([states[0], states[1, ::-1]], axis=2)  # (T, B, 2H)
        look = np.tanh(both @ self.p["A"])
        e = look @ self.p["v"] + np.where(mask.T, F4(0), F4(-1e9))
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[..., None] * both).sum(axis=0)
        logits = pooled @ self.p["w"] + self.p["c"]
        return logits, (kept, on, both, look, a, pooled)

    def backward(self, gates: np.ndarray, cache: tuple, d: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters beyond the gates, and of the gates, from that of the logits."""
        kept, on, both, look, a, pooled = cache
        h, U, g = HIDDEN, self.p["U"], {}
        g["w"], g["c"] = pooled.T @ d, np.array([d.sum()], F4)
        dp = d[:, None] * self.p["w"]
        da = (both * dp).sum(axis=2)
        dboth = a[..., None] * dp
        de = a * (da - (a * da).sum(axis=0))
        dlook = de[..., None] * self.p["v"] * (1 - look**2)
        g["v"] = (look * de[..., None]).sum(axis=(0, 1))
        g["A"] = np.tensordot(both, dlook, axes=([0, 1], [0, 1]))
        dboth = dboth + dlook @ self.p["A"].T
        dstates = np.stack([dboth[..., :h], dboth[::-1, :, h:]])
        T, B = dstates.shape[1], dstates.shape[2]
        dx, dU, carry = np.zeros((2, T, B, 3 * h), F4), np.zeros_like(U), np.zeros((2, B, h), F4)
        for t in range(T - 1, -1, -1):
            state, z, r, n, un = kept[t]
            total = dstates[:, t] + carry
            dnew = total * on[:, t]
            dz = dnew * (state - n) * z * (1 - z)
            dn = dnew * (1 - z) * (1 - n**2)
            dr = dn * un * r * (1 - r)
            dx[:, t] = np.concatenate([dz, dr, dn], axis=2)
            du = np.concatenate([dz, dr, dn * r], axis=2)
            dU += np.matmul(state.transpose(0, 2, 1), du)
            carry = total * (1 - on[:, t]) + dnew * z + np.matmul(du, U.transpose(0, 2, 1))
        g["U"] = dU
        dgates = np.stack([dx[0].transpose(1, 0, 2), dx[1, ::-1].transpose(1, 0, 2)], axis=2)
        return g, dgates


class _Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.m, self.v, self.t = rate, {}, {}, 0

    def step(self, p: dict, g: dict) -> None:
        self.t += 1
        for k, d in g.items():
            m, v = self.m.get(k, 0.0), self.v.get(k, 0.0)
            self.m[k], self.v[k] = m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
            p[k] -= (self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)).astype(F4)


def _first_lead(grams: Grams, rows: list[np.ndarray], y: np.ndarray, fold: np.ndarray, ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How telling windows are before anything is learned: the highest log-odds of a word and its n-grams in other folds' documents."""
    words, parts = np.zeros((FOLDS, 2, 1 << WORD_BITS), F4), np.zeros((FOLDS, 2, 1 << GRAM_BITS), F4)
    for i, r in enumerate(rows):
        mine = grams.take(np.unique(r)) if len(r) else grams.take(np.zeros(1, dtype=np.int32))
        words[fold[i], int(y[i]), np.unique(mine.own)] += 1
        parts[fold[i], int(y[i]), np.unique(mine.flat)] += 1
    lead = np.zeros(len(ids), F4)
    for f in range(FOLDS):
        others = fold != f
        ratio = (max(1.0, (1 - y[others]).sum()) / max(1.0, y[others].sum())) ** 0.5
        word_odds, part_odds = (_odds((x.sum(axis=0) - x[f])[1] * ratio, (x.sum(axis=0) - x[f])[0] / ratio) for x in (words, parts))
        by_word = np.zeros(grams.own.size, F4)
        for k in range(0, len(by_word), 4096):
            some = grams.take(np.arange(k, min(k + 4096, len(by_word))))
            by_word[k : k + 4096] = word_odds[some.own] + np.maximum.reduceat(part_odds[some.flat], some.first)
        mine = np.nonzero(fold[doc] == f)[0]
        lead[mine] = by_word[ids[mine]].max(axis=1)
    return lead


def train(texts: list[str], labels: list[int], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 42) -> Model:
    """Fit a model to labelled texts."""
    model, rng = Model(seed), np.random.default_rng(seed)
    y = np.array(labels, dtype=F4)
    if not 0 < y.sum() < len(y):
        return model
    # Words become numbers as they come; then numbers follow length, as tables of n-grams want.
    names: dict[str, int] = {"": 0}
    plain = [np.array([names.setdefault(w, len(names)) for w in words_of(t)], dtype=np.int32) for t in texts]
    listed = sorted(names, key=lambda w: (len(w), w))
    place = np.zeros(len(names), dtype=np.int32)
    place[[names[w] for w in listed]] = np.arange(len(names))
    plain = [place[r] for r in plain]
    grams = all_grams(listed)
    del names, listed
    rows = plain
    starts = [windows_of(len(r)) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(s) for s in starts])
    ids = np.zeros((len(doc), WINDOW), dtype=np.int32)  # the empty word pads
    for k, (i, s) in enumerate(zip(doc, (s for one in starts for s in one), strict=True)):
        part = rows[i][s : s + WINDOW]
        ids[k, : len(part)] = part
    first = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1])
    mask = ids > 0
    mask[:, 0] = True
    fold = rng.permutation(len(y)) % FOLDS
    lead = _first_lead(grams, rows, y, fold, ids, doc)
    adam, squares = _Adam(rate), {k: np.zeros(len(model.p[k]), F4) for k in ("own", "chars")}

    def learn(name: str, at: np.ndarray, d: np.ndarray) -> None:
        """A step of vectors by what they have moved before; rows of ``at`` add up."""
        which, back = np.unique(at, return_inverse=True)
        total = np.zeros((len(which), d.shape[1]), F4)
        np.add.at(total, back, d)
        squares[name][which] += (total**2).mean(axis=1)
        model.p[name][which] -= VECTOR_RATE * total / (np.sqrt(squares[name][which])[:, None] + F4(1e-6))

    mean: dict[str, np.ndarray] = {}
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))).astype(F4)
    for epoch in range(epochs):
        best = np.array([a + int(np.argmax(lead[a:b])) for a, b in zip(first, [*first[1:], len(doc)], strict=True)])
        for at in range(0, len(best), batch):
            if at == 0:
                order = rng.permutation(len(best))
            some = order[at : at + batch]
            w = best[some]
            used, back = np.unique(ids[w], return_inverse=True)
            mine = grams.take(used)
            x, out = model.inputs(mine), rng.random(len(used)) < LEFT_OUT
            x[out, :OWN] = 0
            gates = model.project(x)[back.reshape(w.shape[0], WINDOW)]
            logits, cache = model.forward(gates, mask[w], keep=True)
            d = ((_sigmoid(logits) - y[some]) * weight[some] / len(some)).astype(F4)
            g, dgates = model.backward(gates, cache, d)
            by_word = np.zeros((len(used), 2, 3 * HIDDEN), F4)
            np.add.at(by_word, back.reshape(-1), dgates.reshape(-1, 2, 3 * HIDDEN))
            by_word = by_word.transpose(1, 0, 2)
            g["W"], g["b"] = np.matmul(x.T[None], by_word), by_word.sum(axis=1, keepdims=True)
            dx = np.matmul(by_word, model.p["W"].transpose(0, 2, 1)).sum(axis=0)
            adam.step(model.p, g)
            dx[out, :OWN] = 0
            learn("own", mine.own, dx[:, :OWN])
            learn("chars", mine.flat, np.repeat(dx[:, OWN : OWN + CHARS] / mine.size[:, None], mine.size, axis=0))
        if epoch >= epochs // 2:
            # What is kept is the mean of the later epochs' parameters, which sways less than the last.
            for k, v in model.p.items():
                mean[k] = mean.get(k, 0) + v / F4(epochs - epochs // 2)
        if epoch < epochs - 1:
            table = np.zeros((grams.own.size, 2, 3 * HIDDEN), F4)
            for k in range(0, len(table), 4096):
                table[k : k + 4096] = model.project(model.inputs(grams.take(np.arange(k, min(k + 4096, len(table))))))
            lead = np.zeros(len(ids), F4)
            for k in range(0, len(ids), 512):
                lead[k : k + 512] = model.forward(table[ids[k : k + 512]], mask[k : k + 512])[0]
            del table
    model.p, model.trained = mean, True
    return model


class Scorer:
    """Scores texts; remembers the gates of the words met so far."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.gates = np.zeros((1024, 2, 3 * HIDDEN), F4)
        self._learn([""])

    def _learn(self, new: list[str]) -> None:
        new.sort(key=len)  # words of about one length meet, which keeps the tables narrow
        for at in range(0, len(new), 1024):
            some = new[at : at + 1024]
            upto = len(self.place) + len(some)
            if upto > len(self.gates):
                more = max(upto - len(self.gates), min(len(self.gates), 1 << 14))
                self.gates = np.concatenate([self.gates, np.zeros((more, 2, 3 * HIDDEN), F4)])
            self.gates[len(self.place) : upto] = self.model.project(self.model.inputs(gram_ids(some)))
            for w in some:
                self.place[w] = len(self.place)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Scores of texts, a few windows at a time."""
        if not self.model.trained:
            return np.zeros(len(texts))
        out, held, owner, count = np.full(len(texts), -np.inf), [], [], 0

        def flush() -> None:
            nonlocal count
            if held:
                ids = np.concatenate(held)
                mask = ids > 0
                mask[:, 0] = True
                logits = self.model.forward(self.gates[ids], mask)[0]
                np.maximum.at(out, np.concatenate(owner), logits)
                held.clear()
                owner.clear()
                count = 0

        def hold(i: int, words: list[str]) -> None:
            nonlocal count
            ids = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
            starts = np.array(windows_of(len(words)))
            for at in range(0, len(starts), 256):
                some = starts[at : at + 256]
                if len(words) < WINDOW:
                    part = np.zeros((1, WINDOW), dtype=np.int64)
                    part[0, : len(words)] = ids
                else:
                    part = ids[some[:, None] + np.arange(WINDOW)[None, :]]
                held.append(part)
                owner.append(np.full(len(part), i))
                count += len(part)
                if count >= 256:
                    flush()

        split = [words_of(text) for text in texts]
        for at in range(0, len(split), 64):
            new = set().union(*split[at : at + 64]).difference(self.place)
            if len(self.place) + len(new) > REMEMBERED:
                flush()
                self._forget()
                new = set().union(*split[at : at + 64]).difference(self.place)
            self._learn(list(new))
            for i in range(at, min(at + 64, len(split))):
                hold(i, split[i])
        flush()
        return 1.0 / (1.0 + np.exp(-np.clip(out, -60, 60)))


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5) -> tuple[list[str], list[int]]:
    """Texts and labels of the bounded sample; documents of fold 0 never enter it."""
    usable = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != 0))
    order = F.xxhash64(F.lit(42), "doc_id")
    # Bounded by the sample's size: twice it per class, as long texts drop out.
    asked = [usable.where(F.col("y") == k).orderBy(order, "doc_id").limit(2 * SAMPLE) for k in (0, 1)]
    both = F.broadcast(asked[0].union(asked[1]))
    some = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.length("text") <= SAMPLE_CHARS).join(both, "doc_id")
    rows = []
    for k in (0, 1):
        rows += some.where(F.col("y") == k).orderBy(order, "doc_id", "text").limit(SAMPLE).collect()
    return [r["text"] for r in rows], [r["y"] for r in rows]


def fit(docs: DataFrame, labels: DataFrame, seed: int = 42, **columns) -> Model:
    """The model trained on the bounded sample, or the one kept for that sample."""
    texts, marks = training_sample(docs, labels, **columns)

    def made() -> dict[str, np.ndarray]:
        model = train(texts, marks, seed=seed)
        return {**model.p, "trained": np.array(model.trained)}

    found = saved_arrays(docs.sparkSession, "toxicity", [seed, *marks, *texts], made, apart=True)
    model = Model(seed)
    model.p = {k: found[k] for k in model.p}
    model.trained = bool(found["trained"])
    return model


def score_documents(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each row's whole text; it replaces a column of its name."""
    small_batches(docs.sparkSession)
    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def run(key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_by_worker(("toxicity", key), lambda: Scorer(sent.value))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                scores = scorer(batch.column(columns.index(text)).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], schema=whole.schema.append(pa.field(out, pa.float64())))

    schema = StructType([*docs.schema.fields]).add(out, DoubleType())
    return docs.mapInArrow(partial(run, uuid.uuid4().hex), schema)
