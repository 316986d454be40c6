"""The registered opN_ queries and the pipeline, with oracle SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.llm import align, bpe, chunks, covertree, licenses, lines, mixing, pii, simhash, tokens, toxicity, variants, warc
from auditloom.llm.common import cut

QUERIES: dict = {}
ORACLES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    return mixing.mix_sources(cut(docs, "sized")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op3_mix_sources"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w, source_size * 2.0::DOUBLE AS cap FROM s),
level(n, lvl) AS (
  SELECT 0, (SELECT sum(source_size) * 1.5::DOUBLE / sum(w) FROM r)
  UNION ALL
  SELECT n + 1, greatest(lvl, ((SELECT sum(source_size) * 1.5::DOUBLE FROM r) - (SELECT coalesce(sum(cap), 0) FROM r WHERE cap < w * lvl))
    / (SELECT sum(w) FROM r WHERE NOT cap < w * lvl)) FROM level WHERE n < 40),
t AS (SELECT source, source_size, least(cap, w * (SELECT max(lvl) FROM level)) AS target FROM r),
u AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS reps FROM t),
o AS (SELECT d.doc_id, d.size, u.source_size, u.target, u.reps, floor(u.target)::BIGINT - u.reps * u.source_size AS rest,
  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('42:' || d.doc_id::VARCHAR), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target, (reps * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM o
"""


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_records(index, with_payload=False).drop("payload")


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_checks(tokens.write_tokens(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = cut(simhash.fingerprints(_table(spark, sf_dir, "documents"), shingle=3), "prints")
    return simhash.near_duplicates(prints, radius=3).select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


@query
def op8_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.fingerprint_documents(_table(spark, sf_dir, "documents"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(_table(spark, sf_dir, "embeddings"))


ORACLES["op9_near_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS size FROM v WHERE list_dot_product(e, e) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return toxicity.score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicate_lines(docs).select("doc_id", "n_deleted", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, pii.fit(docs))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *[F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")], "score", "restriction")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants_of_texts(_table(spark, sf_dir, "documents"))


ORACLES["op1_warc"] = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, strlen(h) AS n, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, url, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - (i % 4) * 5)) & 31))::INT, 1)), '') AS payload_digest
FROM d
"""

ORACLES["op5_line_dedup"] = r"""
WITH t AS (SELECT doc_id, line, ln, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS ln FROM documents)),
l AS (SELECT doc_id, ln, s, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS i, greatest(1, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+'))) AS w FROM t WHERE s <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS cum FROM l),
f AS (SELECT a.doc_id, a.i AS a, b.i AS b FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.cum - a.cum + a.w >= 50),
r AS (SELECT doc_id, a, min(b) AS b FROM f GROUP BY doc_id, a UNION SELECT doc_id, max(a), b FROM f GROUP BY doc_id, b),
x AS (SELECT r.doc_id, r.a, r.b, string_agg(c.s, chr(10) ORDER BY c.i) AS body FROM r JOIN c ON c.doc_id = r.doc_id AND c.i BETWEEN r.a AND r.b GROUP BY ALL),
y AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(a) OVER o AS fa FROM x WINDOW o AS (PARTITION BY body ORDER BY doc_id, a)),
z AS (SELECT doc_id, CASE WHEN doc_id = fd THEN greatest(a, fa + b - a + 1) ELSE a END AS a, b FROM y WHERE doc_id > fd OR a > fa),
g AS (SELECT DISTINCT c.doc_id, c.ln FROM z JOIN c ON c.doc_id = z.doc_id AND c.i BETWEEN z.a AND z.b),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY ln) AS text FROM t ANTI JOIN g USING (doc_id, ln) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_deleted, length(coalesce(k.text, ''))::BIGINT AS n_chars, sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
"""

ORACLES["op13_spelling_variants"] = r"""
WITH RECURSIVE g(i, c, k) AS (SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM g WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM g WHERE k = 8),
r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents)),
d AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + unicode(x) // 64)::BIGINT, (128 + unicode(x) % 64)::BIGINT] END))),
  lambda a, x: xor(t[((xor(a, x) & 255) + 1)::INT], a >> 8))) AS h FROM d, tab),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
l AS (SELECT word, n, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM p),
e AS (SELECT a.word, b.word AS near, b.n FROM l a JOIN l b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, v.word, v.n FROM l JOIN v ON v.word = l.rest UNION SELECT v.word, l.word, l.n FROM l JOIN v ON v.word = l.rest),
b AS (SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near FROM e QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(near)) = 1),
f AS (SELECT v.word, v.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.n >= 10 * v.n THEN b.near END AS form, CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n FROM v LEFT JOIN b USING (word)),
c(word, stop, k) AS (SELECT word, word, 0 FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM c JOIN f ON f.word = c.stop WHERE f.form IS NOT NULL),
z AS (SELECT word, max_by(stop, k) AS root FROM c GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN z USING (word)
"""
