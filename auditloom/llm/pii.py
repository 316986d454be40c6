"""Personal data: base patterns, and a character-level bidirectional LSTM with a CRF.

Base spans follow the fixed patterns and checks and always stay. The network adds spans of
the same kinds in forms that the patterns miss (spelled-out marks, other separators, no
plus sign). It is trained in numpy on labelled spans: seeded invented values set into
passages of a bounded sample of the corpus, beside numbers and marks that are no personal
data. A text is read in overlapping windows at fixed places; each is decoded by itself, and
spans are reconciled over the whole text: a span at the edge of a window yields to the
window that sees it whole (where none at the fixed places does, one is decoded round it),
equal and overlapping finds become one, base spans win.

An added span must hold what its kind can't lack: an at-mark and after it a dot-mark, or
four digits (and the kind's own check). Windows that touch no such marks or digits within
LONGEST characters can't yield a span of that length, so they aren't decoded; longer spans
aren't looked for.

Defined results: a null text is empty; an empty text has no spans; a text of any length is
read whole; rows are independent, so repeated rows repeat their result; of added spans that
overlap the longest stays, then the first, then that of the kind listed first; offsets are
code points, ends exclusive; columns beyond the two are left out, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import saved_arrays, small_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS = 300, 4000
WINDOW, STRIDE, EDGE = 128, 64, 4
#: Spans up to this length lie whole within a window, edges apart.
LONGEST = WINDOW - 2 * EDGE
F4 = np.float32

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only, which finds the same matches in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans, by kind, then start."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        # The leftmost match at this mark starts where its run of local characters does.
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            end = found.end()
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p) <= 255 if len(p) < 9 else int(p.lstrip("0")[:4] or 0) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _only_digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_only_digits(m[0])) <= 15]
    return out


#: At-marks and dot-marks as written or spelled out.
_AT = re.compile(r"@|[\[({<]\s*at\s*[\])}>]|\sat\s|_at_", re.I)
_DOT = re.compile(r"\.|[\[({<]\s*dot\s*[\])}>]|\sdot\s|_dot_", re.I)
# The same marks at every place, also where they overlap.
_ANY_AT, _ANY_DOT = (re.compile(f"(?=({x.pattern}))", re.I) for x in (_AT, _DOT))


def plausible(kind: str, value: str) -> bool:
    """What an added span of a kind can't lack."""
    digits = _only_digits(value)
    if kind == "email":
        at = _AT.search(value)
        return bool(at and at.start() > 0 and (dot := _DOT.search(value, at.end())) and at.end() < dot.start() and dot.end() < len(value) and "\n" not in value)
    if kind == "ip":
        parts = re.findall("[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1
    return 7 <= len(digits) <= 15 and "\n" not in value


# ---- the network ----------------------------------------------------------------------

N_TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
EMBED, HIDDEN = 12, 16
N_CHARS = 100


def char_ids(text: str) -> np.ndarray:
    """Printable ASCII by itself; other letters, blanks and signs by class; 0 pads."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    out = np.where((code >= 32) & (code < 127), code - 31, 97)
    out[(code < 32) | (code == 0x85) | (code == 0xA0)] = 96
    return np.where((code >= 0xC0) & (code < 0x250), 98, out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F4(0.5) * (np.tanh(F4(0.5) * x) + F4(1))


class Model:
    def __init__(self, seed: int = 42) -> None:
        rng, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(F4)
        bias = np.zeros((2, 1, 4 * h), F4)
        bias[..., h : 2 * h] = 1.0  # remember at first
        self.p = {"E": draw(N_CHARS, EMBED, scale=0.3), "W": draw(2, EMBED, 4 * h, scale=EMBED**-0.5), "b": bias, "U": draw(2, h, 4 * h, scale=h**-0.5), "O": draw(2 * h, N_TAGS, scale=0.2), "o": np.zeros(N_TAGS, F4), "T": np.zeros((N_TAGS, N_TAGS), F4)}
        # An inside tag follows its own kind only; the rest of the transitions is learned.
        self.ban = np.zeros((N_TAGS, N_TAGS), F4)
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            self.ban[:, inside] = -1e4
            self.ban[[inside - 1, inside], inside] = 0.0

    def forward(self, ids: np.ndarray, keep: bool = False) -> tuple:
        """Tag scores (T, B, tags) of windows (B, T)."""
        B, T, h = len(ids), ids.shape[1], HIDDEN
        both = np.stack([ids.T, ids[:, ::-1].T])
        x = self.p["E"][both]
        gates = np.matmul(x.reshape(2, T * B, EMBED), self.p["W"]) + self.p["b"]
        gates = gates.reshape(2, T, B, 4 * h)
        state, cell, states, kept = np.zeros((2, B, h), F4), np.zeros((2, B, h), F4), np.zeros((2, T, B, h), F4), []
        for t in range(T):
            a = gates[:, t] + np.matmul(state, self.p["U"])
            ifo, g = _sigmoid(a[..., : 3 * h]), np.tanh(a[..., 3 * h :])
            i, f, o = ifo[..., :h], ifo[..., h : 2 * h], ifo[..., 2 * h :]
            new = f * cell + i * g
            squashed = np.tanh(new)
            if keep:
                kept.append((state, cell, i, f, o, g, squashed))
            state, cell = o * squashed, new
            states[:, t] = state
        out = np.concatenate([states[0], states[1, ::-1]], axis=2)
        return out @ self.p["O"] + self.p["o"], (both, x, kept, out)

    def backward(self, cache: tuple, d: np.ndarray) -> dict:
        both, x, kept, out = cache
        h, g = HIDDEN, {}
        T, B = d.shape[:2]
        g["O"], g["o"] = np.tensordot(out, d, axes=([0, 1], [0, 1])), d.sum(axis=(0, 1))
        dout = d @ self.p["O"].T
        dstates = np.stack([dout[..., :h], dout[::-1, :, h:]])
        dgates, dU = np.zeros((2, T, B, 4 * h), F4), np.zeros_like(self.p["U"])
        carry, dcell = np.zeros((2, B, h), F4), np.zeros((2, B, h), F4)
        for t in range(T - 1, -1, -1):
            state, cell, i, f, o, gg, squashed = kept[t]
            total = dstates[:, t] + carry
            dcell = dcell + total * o * (1 - squashed**2)
            da = np.concatenate([dcell * gg * i * (1 - i), dcell * cell * f * (1 - f), total * squashed * o * (1 - o), dcell * i * (1 - gg**2)], axis=2)
            dgates[:, t] = da
            dU += np.matmul(state.transpose(0, 2, 1), da)
            carry, dcell = np.matmul(da, self.p["U"].transpose(0, 2, 1)), dcell * f
        flat = dgates.reshape(2, T * B, 4 * h)
        g["U"], g["W"], g["b"] = dU, np.matmul(x.reshape(2, T * B, EMBED).transpose(0, 2, 1), flat), flat.sum(axis=1, keepdims=True)
        g["E"] = np.zeros_like(self.p["E"])
        np.add.at(g["E"], both.reshape(-1), np.matmul(flat, self.p["W"].transpose(0, 2, 1)).reshape(-1, EMBED))
        return g

    def crf_loss(self, scores: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Negative log-likelihood of tags (B, T) and its gradients by scores and transitions."""
        T, B, n = scores.shape
        move = (self.p["T"] + self.ban).astype(np.float64)
        s = scores.astype(np.float64)
        fwd, bwd = np.zeros((T, B, n)), np.zeros((T, B, n))
        fwd[0] = s[0]
        lse = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
        for t in range(1, T):
            fwd[t] = lse(fwd[t - 1][:, :, None] + move[None], 1) + s[t]
        for t in range(T - 2, -1, -1):
            bwd[t] = lse(move[None] + (s[t + 1] + bwd[t + 1])[:, None, :], 2)
        z = lse(fwd[-1], 1)
        p = np.exp(fwd + bwd - z[None, :, None])
        pair = np.exp(fwd[:-1, :, :, None] + move + (s[1:] + bwd[1:])[:, :, None, :] - z[None, :, None, None]).sum(axis=(0, 1))
        y = tags.T
        gold = np.take_along_axis(s, y[..., None], 2).sum() + move[y[:-1], y[1:]].sum()
        one = np.zeros_like(p)
        np.put_along_axis(one, y[..., None], 1.0, 2)
        np.subtract.at(pair, (y[:-1].reshape(-1), y[1:].reshape(-1)), 1.0)
        return float((z.sum() - gold) / B), ((p - one) / B).astype(F4), (pair / B).astype(F4)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tags (B, T) of windows by Viterbi."""
        scores, _ = self.forward(ids)
        T, B, n = scores.shape
        move, best, back = self.p["T"] + self.ban, scores[0], np.zeros((T, B, n), np.int8)
        for t in range(1, T):
            through = best[:, :, None] + move[None]
            back[t] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[t]
        tags = np.zeros((B, T), np.int64)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(T - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(B), tags[:, t]]
        return tags


# ---- training -------------------------------------------------------------------------


def _invent(rng: np.random.Generator) -> tuple[str | None, str]:
    """A kind and a value of it; or no kind and what only looks like one."""
    pick = lambda *xs: xs[rng.integers(len(xs))]
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda a=2, b=8: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(a, b + 1)))
    kind = pick("email", "ip", "card", "phone", "phone", "none", "none")
    if kind == "email":
        name = word() + pick("", ".", "_", "-") + pick("", word(), number(2))
        at, dot = pick(("@", "."), ("@", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "."), (" at ", " dot "), (" AT ", " DOT "), ("[at]", "."), (" @ ", " . "), ("_at_", "_dot_"), ("{at}", "{dot}"))
        return kind, name.strip("._-") + at + dot.join([word(3), *([word(3)] if rng.random() < 0.3 else []), pick("com", "org", "net", "edu", "de", "fr", "es", "io")])
    if kind == "ip":
        sep = pick(".", ".", " . ", "[.]", "(.)", ",", "-", " dot ")
        # Short numbers between commas or dashes are more often something else.
        return kind, sep.join(str(int(x)) for x in rng.integers(10 if sep in ",-" else 0, 256, 4))
    if kind == "card":
        digits = number(pick(15, 15, 15, 14, 18))
        digits = next(digits + str(k) for k in range(10) if luhn(digits + str(k)))
        sep = pick("", " ", "-", ".", "_", "/", "  ", " - ")
        return kind, sep.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    if kind == "phone":
        a, b, c = number(3), number(3), number(4)
        return kind, pick(f"+{number(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"00{number(2)} {a} {number(3)} {number(4)}", f"+{number(2)}-{a}-{b}{c}", f"1-{a}-{b}-{c}", f"({a}){b}-{c}", f"{a}/{b}-{c}", f"+{number(2)} {number(3)} {number(2)} {number(2)} {number(2)}")
    year = str(rng.integers(1900, 2030))
    return None, pick(year, f"{year}-{number(2)}-{number(2)}", number(16), number(8), number(5), f"v{number(1)}.{number(1)}.{number(2)}", "".join(pick(*"0123456789abcdef") for _ in range(pick(8, 32, 40))), f"${number(3)}.{number(2)}", f"{number(1)},{number(3)}", f"{number(2)}:{number(2)}:{number(2)}", f"ISBN {number(3)}-{number(1)}-{number(4)}-{number(4)}-{number(1)}", f"@{word()}", f"{word()} at {word()}. {word()}", f"dot {word()}", f"id={number(9)}", f"{number(12)}", f"{year} {year} {year}")


def training_windows(texts: list[str], n: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Windows of text with labelled spans: ids and tags."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if t] or ["the quick brown fox jumps over the lazy dog. "]
    ids, tags = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for k in range(n):
        whole = texts[rng.integers(len(texts))]
        while len(whole) < WINDOW:
            whole += " " + whole
        start = int(rng.integers(0, len(whole) - WINDOW + 1))
        text, mark = whole[start : start + WINDOW], [0] * WINDOW
        # What the passage itself holds is labelled by the base patterns.
        for kind, a, b in base_spans(text):
            mark[a:b] = [1 + 2 * KINDS.index(kind)] + [2 + 2 * KINDS.index(kind)] * (b - a - 1)
        for _ in range(int(rng.integers(1, 3))):
            kind, value = _invent(rng)
            blanks = [i for i, c in enumerate(text) if c in " \n" and not mark[i]]
            at = blanks[rng.integers(len(blanks))] if blanks else 0
            tag = [0] * len(value) if kind is None else [1 + 2 * KINDS.index(kind)] + [2 + 2 * KINDS.index(kind)] * (len(value) - 1)
            left, right = (" ", " ") if rng.random() < 0.8 else ((("(", ")"), (": ", "."), ("\n", "\n"), (" ", ", "))[rng.integers(4)])
            text = text[:at] + left + value + right + text[at:]
            mark = mark[:at] + [0] * len(left) + tag + [0] * len(right) + mark[at:]
        shift = int(rng.integers(0, len(text) - WINDOW + 1))
        text, mark = text[shift : shift + WINDOW], mark[shift : shift + WINDOW]
        if mark[0] and mark[0] % 2 == 0:  # a span that began before the window
            mark[0] -= 1
        ids[k], tags[k] = char_ids(text), mark
    return ids, tags


def train(texts: list[str], windows: int = 5000, epochs: int = 10, batch: int = 48, rate: float = 0.01, seed: int = 42) -> Model:
    model, rng = Model(seed), np.random.default_rng(seed)
    ids, tags = training_windows(texts, windows, seed)
    m, v, step = {k: 0.0 for k in model.p}, {k: 0.0 for k in model.p}, 0
    for epoch in range(epochs):
        order = rng.permutation(windows)
        pace = rate * (1 - epoch / epochs) + 0.001
        for at in range(0, windows, batch):
            some, step = order[at : at + batch], step + 1
            scores, cache = model.forward(ids[some], keep=True)
            _, d, dT = model.crf_loss(scores, tags[some])
            g = model.backward(cache, d)
            g["T"] = dT
            size = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
            for k, x in g.items():
                x = x * min(1.0, 5.0 / (size + 1e-9))
                m[k], v[k] = 0.9 * m[k] + 0.1 * x, 0.999 * v[k] + 0.001 * x * x
                model.p[k] -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(F4)
    return model


def fit(docs: DataFrame, windows: int = 5000, epochs: int = 10, seed: int = 42, **columns) -> Model:
    """The model trained on a bounded sample of ``docs``, or the one kept for that sample."""
    texts, model = sample_texts(docs, **columns), Model(seed)
    key = [windows, epochs, seed, *texts]
    model.p = saved_arrays(docs.sparkSession, "personal-data", key, lambda: train(texts, windows, epochs, seed=seed).p)
    return model


# ---- finding --------------------------------------------------------------------------


def _starts(text: str) -> list[int]:
    """Starts of the windows that touch what a plausible span of up to LONGEST characters holds; they lie at multiples of STRIDE."""
    n, wanted = len(text), set()
    last = max(0, -(-(n - WINDOW) // STRIDE))
    around = lambda i, j: range(max(0, -(-(i - WINDOW + 1) // STRIDE)), min(last, j // STRIDE) + 1)
    marks = [m.span(1) for m in _ANY_AT.finditer(text)]
    if marks:
        dots = [m.span(1) for m in _ANY_DOT.finditer(text)]
        starts, ends = [x for x, _ in dots], [x for _, x in dots]
        for k in range(len(ends) - 2, -1, -1):
            ends[k] = min(ends[k], ends[k + 1])
        for i, j in marks:
            k = bisect_right(starts, j)
            # An address has more on both sides.
            if i > 0 and k < len(ends) and ends[k] < n and ends[k] + 1 - (i - 1) <= LONGEST:
                wanted.update(around(i - 1, ends[k]))
    places = [m.start() for m in _DIGIT.finditer(text)]
    for i, j in zip(places, places[3:], strict=False):
        if j - i < LONGEST:
            wanted.update(around(i, j))
    return [k * STRIDE for k in sorted(wanted)]


def _spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    out, begin = [], -1
    for i, t in enumerate([*tags.tolist(), 0]):
        if begin >= 0 and (t == 0 or t % 2 or i == len(tags)):
            out.append(((int(tags[begin]) - 1) // 2, begin, i))
            begin = -1
        if t % 2:
            begin = i
    return out


def _decoded(texts: list[str], where: list[tuple[int, int]], model: Model, found: list[list[tuple[str, int, int]]]) -> list[tuple[int, int, int, int]]:
    """Adds the plausible spans of windows (text, start) to ``found``; gives those near an inner edge: text, kind, start, end."""
    torn = []
    for at in range(0, len(where), 256):
        some = where[at : at + 256]
        ids = np.zeros((len(some), WINDOW), np.int64)
        for k, (i, s) in enumerate(some):
            part = char_ids(texts[i][s : s + WINDOW])
            ids[k, : len(part)] = part
        for (i, s), tags in zip(some, model.decode(ids), strict=True):
            n = min(WINDOW, len(texts[i]) - s)
            for kind, a, b in _spans(tags[:n]):
                # Near an inner edge another window sees more of the span.
                if (a < EDGE and s > 0) or (b > n - EDGE and s + n < len(texts[i])):
                    torn.append((i, kind, s + a, s + b))
                    continue
                while a < b and texts[i][s + a].isspace():
                    a += 1
                while b > a and (texts[i][s + b - 1].isspace() or texts[i][s + b - 1] in ",;:"):
                    b -= 1
                if plausible(KINDS[kind], texts[i][s + a : s + b]):
                    found[i].append((KINDS[kind], s + a, s + b))
    return torn


def added_spans(texts: list[str], bases: list[list[tuple[str, int, int]]], model: Model) -> list[list[tuple[str, int, int]]]:
    """The network's spans of texts, reconciled over each whole text."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    torn = _decoded(texts, [(i, s) for i, t in enumerate(texts) for s in _starts(t)], model, found)
    # Spans cut at an edge, joined over the windows, that no window saw whole: a window round each.
    again: set[tuple[int, int]] = set()
    joined: list[list] = []
    for i, kind, a, b in sorted(torn):
        if joined and joined[-1][:2] == [i, kind] and a <= joined[-1][3]:
            joined[-1][3] = max(b, joined[-1][3])
        else:
            joined.append([i, kind, a, b])
    for i, kind, a, b in joined:
        if b - a <= LONGEST and not any(k == KINDS[kind] and c < b and a < d for k, c, d in found[i]):
            again.add((i, max(0, min(len(texts[i]) - WINDOW, (a + b - WINDOW) // 2))))
    _decoded(texts, sorted(again), model, found)
    out = []
    for spans, base in zip(found, bases, strict=True):
        kept: list[tuple[str, int, int]] = []
        for kind, a, b in sorted(set(spans), key=lambda x: (x[1] - x[2], x[1], KINDS.index(x[0]))):
            if all(b <= c or d <= a for _, c, d in [*base, *kept]):
                kept.append((kind, a, b))
        out.append(kept)
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def sample_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """At most SAMPLE passages of SAMPLE_CHARS characters, in seeded order, to train on."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("i"), F.xxhash64(F.lit(42), doc_id).alias("h"), F.substring(text, 1, SAMPLE_CHARS).alias("t"))
    # Ids are chosen first, so tasks send the driver no texts but the chosen ones.
    chosen = F.broadcast(rows.select("i", "h").orderBy("h", "i").limit(SAMPLE).select("i").distinct())
    return [r["t"] for r in rows.join(chosen, "i").orderBy("h", "t").limit(SAMPLE).collect()]


OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
_OUT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def find_personal_data(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the counts and digest of its base spans, and all its spans."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = batch.column(1).to_pylist()
                bases = [base_spans(t) for t in texts]
                rows = []
                for base, more in zip(bases, added_spans(texts, bases, sent.value), strict=True):
                    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                    rows.append([*counts, hashlib.sha256(written(base).encode()).hexdigest(), written([*base, *more])])
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(_OUT)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=_OUT)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, OUT)
