"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of the XXH64 values of its word shingles. To
find all pairs of fingerprints within ``radius`` bits, each bit position is given a
nonzero vector of ``radius + 1`` bits; for every nonzero vector v, table v keeps the
positions whose vector has an odd product with v. Any ``radius`` differing positions have
vectors that leave at least one v orthogonal to all of them, so the pair agrees on
everything that table v keeps: no pair within the radius is missed.

Fingerprints that share a key of one table are compared where they meet. Keys that more
than ``KEY_LIMIT`` fingerprints share are not compared as they are: their members are keyed
again under a second, independent cover, which misses no pair either; two keys leave about
a quarter of the bits open, which bounds how many distinct fingerprints can meet.

Equal texts meet as one fingerprint, and what leaves a key is a forest of links, not all
pairs, so groups of copies cost no more than their number.

Defined results: a null or blank text has fingerprint zero and is linked like any other;
fewer words than a shingle form one shingle; a text of any length is hashed whole, some
shingles at a time; rows of one id are rows of their own; null ids take part, but a
component's id is the smallest id that is not null; ``fingerprints`` leaves further columns
out and ``one_of_each`` carries them along, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import components, cut, small_batches, tidy

KEY_LIMIT = 512
#: Shingles hashed at once; bounds memory for very long texts.
BLOCK = 1 << 16


def shingle_digests(text: str | None, shingle: int, seed: int = 42) -> Iterator[bytes]:
    """The big-endian XXH64 digests of a text's word shingles, some at a time."""
    from xxhash import xxh64_digest

    # bytes.lower() and bytes.split() know A-Z and the six ASCII blanks alone.
    words = (text or "").encode("utf-8").lower().split()
    if len(words) <= shingle:
        if words:
            yield xxh64_digest(b" ".join(words), seed)
        return
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    for at in range(0, n, BLOCK):
        upto = min(n, at + BLOCK)
        a, b = starts[at:upto].tolist(), ends[at + shingle - 1 : upto + shingle - 1].tolist()
        yield b"".join([xxh64_digest(line[i:j], seed) for i, j in zip(a, b, strict=True)])


def majority(digests: Iterable[bytes]) -> int:
    """A bit is set where it is in over half the digests."""
    count, n = np.zeros(64, dtype=np.int64), 0
    for raw in digests:
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
        n += len(bits)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """The SimHash of a text as an unsigned 64-bit number."""
    return majority(shingle_digests(text, shingle, seed))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, carry: str | None = None) -> DataFrame:
    """``doc_id, fp`` (and ``carry``); fp is the fingerprint's 64 bits as a signed long."""
    small_batches(docs.sparkSession)
    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *([F.col(carry)] if carry else [])]
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), *([(carry, pa.string())] if carry else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), *batch.columns[2:]], schema=schema)

    return docs.select(*columns).mapInArrow(run, "doc_id long, fp long" + (f", {carry} string" if carry else ""))


def cover(radius: int, seed: int) -> np.ndarray:
    """The masks of a covering family over 64 bits: 2^(radius+1) - 1 unsigned numbers."""
    top = 1 << (radius + 1)
    vectors = np.resize(np.arange(1, top), 64)
    np.random.default_rng(seed).shuffle(vectors)
    masks = []
    for v in range(1, top):
        kept = [i for i in range(64) if bin(int(vectors[i]) & v).count("1") % 2]
        masks.append(sum(1 << i for i in kept))
    return np.array(masks, dtype=np.uint64)


def _signed(masks: np.ndarray) -> list[int]:
    return [int(x) for x in masks.view(np.int64)]


def _forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of ``values`` which paths of pairs within the radius join."""
    n = len(values)
    root = np.arange(n)
    a, b = [], []
    for at in range(0, n, 256):
        near = np.bitwise_count(values[at : at + 256, None] ^ values[None, :]) <= radius
        for i in range(at, min(n, at + 256)):
            mates = np.nonzero(near[i - at, :i])[0]
            for other in np.unique(root[mates]):
                if other != root[i]:
                    a.append(i)
                    b.append(int(mates[root[mates] == other][0]))
                    low, high = sorted((int(other), int(root[i])))
                    root[root == high] = low
    return values[a], values[b]


def _linked(keyed: DataFrame, radius: int) -> DataFrame:
    """Links among the fingerprints of each key; ``keyed`` has ``t, key, fp``, sorted runs of which meet in one task."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, dtype=np.int64)] * 3
        for batch in batches:
            t, key, fp = (np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, batch.columns, strict=True))
            new = np.nonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1]))[0] + 1
            if len(new):
                yield from links(fp, np.concatenate([[0], new]))
                rest = [x[new[-1] :] for x in (t, key, fp)]
            else:
                rest = [t, key, fp]
        if len(rest[0]):
            yield from links(rest[2], np.array([0, len(rest[2])]))

    def links(fp: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        u, v = [], []
        for at, upto in zip(bounds[:-1], bounds[1:], strict=True):
            if upto - at > 1:
                a, b = _forest(fp[at:upto].view(np.uint64), radius)
                u.append(a.view(np.int64))
                v.append(b.view(np.int64))
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], schema=schema)

    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.select("t", "key", "fp").repartition(parts, "t", "key").sortWithinPartitions("t", "key", "fp").mapInArrow(run, "u long, v long")


def links(distinct: DataFrame, radius: int = 3, seed: int = 7, key_limit: int = KEY_LIMIT) -> DataFrame:
    """Links ``u, v`` that connect whatever pairs of ``distinct`` fingerprints (fp) within the radius connect."""
    first, second = _signed(cover(radius, seed)), _signed(cover(radius, seed + 1))
    masks = F.array(*[F.lit(m) for m in first])
    keyed = distinct.select("fp", F.posexplode(masks).alias("t", "m")).select(F.col("t").cast("long").alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp")
    counts = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Most keys have one fingerprint and end here; both sides are written, so hot keys can be split.
    shared = cut(cut(keyed, "keyed").join(cut(counts, "counts"), ["t", "key"]), "shared")
    cold = _linked(shared.where(F.col("n") <= key_limit), radius)
    again = F.array(*[F.lit(m) for m in second])
    hot = shared.where(F.col("n") > key_limit).select("t", "key", "fp", F.posexplode(again).alias("t2", "m2"))
    hot = hot.select((F.col("t") * 100 + F.col("t2")).alias("t"), F.xxhash64("key", F.col("fp").bitwiseAND(F.col("m2"))).alias("key"), "fp")
    return cold.union(_linked(hot, radius))


def near_duplicates(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``prints`` (doc_id, fp, ...) with ``component_id``, the smallest id that links reach."""
    with tidy() as keep:
        distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("_al_low")), "distinct")
        roots = components(links(distinct.select("fp"), radius))
        rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        rooted = cut(rooted, "rooted")
        lowest = rooted.groupBy("root").agg(F.min("_al_low").alias("component_id"))
        named = keep(cut(rooted.join(cut(lowest, "lowest"), "root").select("fp", "root", "component_id"), "named"))
    return prints.join(named, "fp")


# ---- near copies beyond the radius ------------------------------------------------------
#
# Texts whose shingle sets have a Jaccard similarity of 0.8 differ in about 10 of 64 bits
# (5 to 14 as measured); a cover of that radius has tens of thousands of tables. So sets
# that share one of their least shingle hashes are compared as well, whatever their
# fingerprints, which count repeated shingles; these only tell what to try first.

#: Least hashes by which sets meet: a pair of similarity 0.8 misses all with probability 0.2^5.
MEET = 5
#: Elements of a set that are kept for a first comparison; larger sets are settled by all of theirs.
KEPT = 512
#: By the kept elements alone, larger sets may be alike down to this much below the similarity: over five standard errors.
MARGIN = 0.1
#: So many sets are tried one by one, the nearest fingerprints first; the rest by counts of shared hashes.
NEAR = 8
#: Sets that share a hash with more others than this are dealt into blocks of about so many, and every block meets every other.
CROWD = 512


def _shingle_set(digests: list[bytes]) -> tuple[np.ndarray, int]:
    """A text's distinct shingle hashes in order, and the set's identity."""
    one = np.unique(np.frombuffer(b"".join(digests), dtype=">u8").astype(np.uint64))
    # Equal sets have equal sums of mixed hashes and equal sizes.
    mixed = (one ^ (one >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return one, int((mixed.sum(dtype=np.uint64) ^ np.uint64(len(one))).view(np.int64))


def sketches(docs: DataFrame, doc_id: str, text: str, key: str, shingle: int) -> DataFrame:
    """``doc_id, key, fp, sid, n, least, kept``: fingerprint, identity, size and hashes of shingle sets."""
    schema = pa.schema([("doc_id", pa.int64()), (key, pa.int64()), ("fp", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("least", pa.list_(pa.int64())), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch, rows = whole.slice(at, 1024), []
                for t in batch.column(2).to_pylist():
                    digests = list(shingle_digests(t, shingle))
                    one, sid = _shingle_set(digests)
                    small = np.unique((one >> np.uint64(32)).astype("<u4"))[:KEPT]
                    fp = int(np.uint64(majority(digests)).view(np.int64))
                    rows.append((fp, sid, len(one), one[:MEET].view(np.int64), small.tobytes()))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {key} long, fp long, sid long, n long, least array<long>, kept binary")


def whole_sets(docs: DataFrame, wanted: DataFrame, text: str, key: str, shingle: int) -> DataFrame:
    """``sid, whole``: all shingle hashes of the ``wanted`` (key, sid) sets, made anew from their texts."""
    # Few sets are sent to where the texts are; many are dealt out with them.
    few = wanted.count() <= 500_000
    rows = docs.select(F.col(key), F.col(text).alias("text")).join(wanted.hint("broadcast" if few else "merge"), key).select("sid", "text")
    schema = pa.schema([("sid", pa.int64()), ("whole", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, own = _shingle_set(list(shingle_digests(t, shingle)))
                if own == sid:
                    yield pa.RecordBatch.from_arrays([pa.array([sid]), pa.array([one.tobytes()], pa.binary())], schema=schema)

    return rows.mapInArrow(run, "sid long, whole binary").dropDuplicates(["sid"])


def _estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sets by the least KEPT elements of each."""
    union = np.union1d(a, b)[:KEPT]
    shared = np.intersect1d(a, b, assume_unique=True)
    return int((shared <= union[-1]).sum()) / len(union) if len(shared) else 0.0


def _similar(a: np.ndarray, na: int, b: np.ndarray, nb: int, least: float) -> bool:
    """Whether two sets have at least the similarity; for sets not kept whole, whether they may have."""
    if na <= KEPT and nb <= KEPT:
        return _alike(a, b, least)
    return _estimate(a, b) >= least - MARGIN


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def _settled(n: np.ndarray, take: Callable[[int], np.ndarray], least: float) -> tuple[list[int], list[int]]:
    """Links that join what pairs of similar sets join, by all elements that ``take`` gives."""
    root, u, v = np.arange(len(n)), [], []
    heads = [take(i)[:KEPT].copy() for i in range(len(n))]
    for i in range(1, len(n)):
        mates = np.nonzero(np.minimum(n[:i], n[i]) >= least * np.maximum(n[:i], n[i]))[0]
        own = take(i)
        for j in mates[np.argsort(np.abs(n[mates] - n[i]), kind="stable")].tolist():
            if root[j] != root[i] and (n[i] <= KEPT or _estimate(heads[i], heads[j]) >= least - MARGIN) and _alike(own, take(j), least):
                u.append(i)
                v.append(j)
                low, high = sorted((int(root[i]), int(root[j])))
                root[root == high] = low
    return u, v


def _similar_forest(fp: np.ndarray, n: np.ndarray, kept: list[bytes], least: float, block: np.ndarray | None = None) -> tuple[list[int], list[int], np.ndarray]:
    """Links that join what pairs of (perhaps) similar sets join, and each set's group; joined sets aren't compared again.

    Where two blocks meet, sets of one block aren't compared: they meet by themselves.
    """
    root, u, v = np.arange(len(fp)), [], []
    sets = [np.frombuffer(k, dtype="<u4") for k in kept]
    sizes, shared = np.array([len(x) for x in sets]), None
    for i in range(1, len(fp)):
        mates = np.nonzero(np.minimum(n[:i], n[i]) >= least * np.maximum(n[:i], n[i]))[0]
        if block is not None and block[0] != block[-1]:
            mates = mates[block[mates] != block[i]]
        mates = mates[np.argsort(np.bitwise_count(fp[mates] ^ fp[i]), kind="stable")]
        for some in (slice(NEAR), slice(NEAR, None)):
            trial = mates[some]
            trial = trial[root[trial] != root[i]]
            if len(trial) > NEAR:
                shared = shared or _shared(sets)
                # A pair that shares less of the larger set can't pass.
                trial = trial[shared(i)[trial] >= (least - MARGIN) * np.maximum(sizes[trial], sizes[i])]
            for j in trial.tolist():
                if root[j] != root[i] and _similar(sets[i], n[i], sets[j], n[j], least):
                    u.append(i)
                    v.append(j)
                    low, high = sorted((int(root[i]), int(root[j])))
                    root[root == high] = low
    return u, v, root


def _shared(sets: list[np.ndarray]) -> Callable[[int], np.ndarray]:
    """A function of i: how many elements set i shares with each set before it."""
    lengths = np.array([len(x) for x in sets])
    of = np.repeat(np.arange(len(sets)), lengths)
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = count[which] > 1
    of, which = of[many].astype(np.int32), which[many].astype(np.int32)
    order = np.argsort(which, kind="stable")
    owners, sorted_ = of[order], which[order]
    start = np.concatenate([[0], np.nonzero(np.diff(sorted_))[0] + 1]) if len(sorted_) else np.zeros(0, dtype=np.int64)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    first = start[np.searchsorted(start, place, side="right") - 1]
    bounds = np.searchsorted(of, np.arange(len(sets) + 1))

    def counts(i: int) -> np.ndarray:
        out = np.zeros(i, dtype=np.int64)
        for at in range(bounds[i], bounds[i + 1], 64):
            a, b = first[at : min(at + 64, bounds[i + 1])], place[at : min(at + 64, bounds[i + 1])]
            runs = b - a
            places = np.repeat(a - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
            out += np.bincount(owners[places], minlength=i)
        return out

    return counts


def similar_links(sets: DataFrame, whole: Callable[[DataFrame], DataFrame], least: float = 0.8) -> DataFrame:
    """Links ``u, v`` between distinct shingle sets (sid, fp, n, least, kept) of at least the similarity.

    Groups that hold sets beyond KEPT are only supposed at first, then settled by the
    elements that ``whole`` gives for a table of ``sid``.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = cut(sets.select("sid", "least", F.explode("least").alias("h")), "met")
    counts = cut(met.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "met-counts")
    shared = cut(met.join(counts, "h"), "met-shared")
    own = shared.select("h", "sid", F.ceil(F.col("m") / CROWD).cast("int").alias("blocks"))
    own = own.withColumn("block", F.pmod(F.xxhash64("sid", "h"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("h", "sid", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    rows = cut(own, "blocks").join(sets.select("sid", "fp", "n", "kept"), "sid")
    schema = pa.schema([("g", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def links() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                _, _, _, block, sid, fp, n, kept = zip(*held, strict=True)
                u, v, root = _similar_forest(np.array(fp, dtype=np.int64).view(np.uint64), np.array(n), list(kept), least, np.array(block))
                if u:
                    yield found(np.array(sid, dtype=np.int64), np.array(n), np.array(u), np.array(v), root)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield from links()
                    held.clear()
                held.append(row)
        yield from links()

    def found(sid: np.ndarray, n: np.ndarray, u: np.ndarray, v: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
        """Links of the groups of small sets; of others the members, under one number wherever the same ones meet."""
        from xxhash import xxh64_intdigest

        unsure = np.zeros(len(sid), dtype=bool)
        unsure[root[n > KEPT]] = True
        sure = ~unsure[root[u]]
        g, a, b = [None] * int(sure.sum()), sid[u[sure]].tolist(), sid[v[sure]].tolist()
        order = np.argsort(root, kind="stable")
        for some in np.split(order, np.nonzero(np.diff(root[order]))[0] + 1):
            if len(some) > 1 and unsure[root[some[0]]]:
                members = np.sort(sid[some])
                g += [xxh64_intdigest(members.tobytes()) - (1 << 63)] * len(members)
                a += members.tolist()
                b += members.tolist()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (g, a, b)], schema=schema)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, sids, places, file = None, [], [0], tempfile.SpooledTemporaryFile(64 << 20)

        def take(i: int) -> np.ndarray:
            file.seek(places[i])
            return np.frombuffer(file.read(places[i + 1] - places[i]), dtype=np.uint64)

        def links() -> Iterator[pa.RecordBatch]:
            u, v = _settled(np.diff(places) // 8, take, least)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array([sids[i] for i in u]), pa.array([sids[i] for i in v])], schema=pa.schema(list(schema)[1:]))

        for batch in batches:
            for group, sid, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != g:
                    yield from links()
                    file.close()
                    g, sids, places, file = group, [], [0], tempfile.SpooledTemporaryFile(64 << 20)
                sids.append(sid)
                file.seek(places[-1])
                file.write(raw)
                places.append(places[-1] + len(raw))
        yield from links()
        file.close()

    dealt = rows.select("h", "a", "b", "block", "sid", "fp", "n", "kept").repartition(parts, "h", "a", "b").sortWithinPartitions("h", "a", "b", "block", "sid")
    first = cut(dealt.mapInArrow(run, "g long, u long, v long"), "supposed")
    unsure = cut(first.where("g IS NOT NULL").select("g", F.col("u").alias("sid")).distinct(), "unsure")
    full = cut(whole(unsure.select("sid").distinct()), "whole")
    second = unsure.join(full, "sid").select("g", "sid", "whole").repartition(parts, "g").sortWithinPartitions("g", "sid")
    return first.where("g IS NULL").select("u", "v").union(second.mapInArrow(settle, "u long, v long"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, radius: int = 3, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of every group: that of the smallest id, then of the least text hash.

    Groups join fingerprints within the radius, and shingle sets of at least the similarity.
    Rows that agree in id and text are one document.
    """
    i = F.col(doc_id).cast("long")
    keyed = docs.withColumns({"_al_i": i, "_al_k": F.xxhash64(i, F.col(text))})
    with tidy() as keep:
        rows = cut(sketches(keyed, doc_id, text, "_al_k", shingle), "sketches")
        sets = cut(rows.groupBy("sid").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("least").alias("least"), F.first("kept").alias("kept"), F.min("_al_k").alias("_al_k")), "sets")
        # Fingerprints within the radius join the sets that have them.
        near = cut(near_duplicates(rows.select("doc_id", "fp", "sid"), radius).select("sid", "root").distinct(), "near")
        low = near.groupBy("root").agg(F.min("sid").alias("low"), F.count("*").alias("m")).where("m > 1")
        by_print = near.join(cut(low, "low"), "root").where("sid <> low").select(F.col("sid").alias("u"), F.col("low").alias("v"))
        whole = lambda sids: whole_sets(keyed, cut(sets.select("_al_k", "sid").join(sids, "sid"), "wanted").select("_al_k", "sid"), text, "_al_k", shingle)
        roots = components(by_print.union(similar_links(sets, whole, similarity))).withColumnRenamed("node", "sid").withColumnRenamed("root", "grp")
        order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", F.col("_al_k").alias("k"))
        first = cut(rows.groupBy("sid").agg(F.min(order).alias("o")), "first")
        grouped = first.join(roots, "sid", "left").groupBy(F.coalesce("grp", "sid").alias("grp")).agg(F.min("o").alias("o"))
        # One plan at every size, as in the line stage.
        kept = keep(cut(grouped.select(F.col("o.doc_id").alias("_al_d"), F.col("o.k").alias("_al_h")).distinct(), "kept"))
    out = keyed.join(kept.hint("merge"), (F.col("_al_k") == F.col("_al_h")) & F.col("_al_i").eqNullSafe(F.col("_al_d")), "left_semi")
    return out.dropDuplicates(["_al_k", "_al_i"]).drop("_al_i", "_al_k")


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
