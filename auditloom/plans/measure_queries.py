"""Queries of prose checks, agreement, fidelity, retrieval and streaming twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.operators import measure, prose, retrieve
from auditloom.plans.registry import query, quoted
from auditloom.sources.tables import spread, table
from auditloom.streaming import twins

# Documents hold few citations of their own, so a seeded share of them gets some.
_CITED_TEXT = "text || CASE doc_id % 5 WHEN 0 THEN ' (Smith 2019) causes (Lee and Wong 2035)' WHEN 1 THEN chr(10) || 'This proves it (Autor et al. 2013).' || chr(10) || '[CLAIM-REVERSED: x]' WHEN 2 THEN chr(10) || '# References' || chr(10) || 'Smith 2019' || chr(10) || 'Smith 2019' || chr(10) || '[CLAIM-IMPRECISE]' ELSE '' END"
_CITED = f"d AS (SELECT doc_id, {_CITED_TEXT} AS text FROM documents)"


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    more = (
        F.when(k == 0, " (Smith 2019) causes (Lee and Wong 2035)")
        .when(k == 1, "\nThis proves it (Autor et al. 2013).\n[CLAIM-REVERSED: x]")
        .when(k == 2, "\n# References\nSmith 2019\nSmith 2019\n[CLAIM-IMPRECISE]")
        .otherwise("")
    )
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.concat("text", more).alias("text"))


_SQL_CITATION = r"\([A-Z][a-z]+(?: (?:and|&) [A-Z][a-z]+| et al\.?)? [12]\d{3}[a-z]?\)"
_CITATIONS = f"{_CITED}, c AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, {quoted(_SQL_CITATION)})) AS citation FROM d)"


@query(f"WITH {_CITATIONS} SELECT * FROM c")
def citation_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prose.citations(_cited(spark, sf_dir), ["doc_id"])


@query(f"WITH {_CITATIONS} SELECT doc_id, citation, regexp_extract(citation, '([12][0-9]{{3}})[a-z]?\\)$', 1)::INT AS year FROM c WHERE year > 2030")
def future_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prose.future(prose.citations(_cited(spark, sf_dir), ["doc_id"]))


def _count_sql(pattern: str) -> str:
    return f"len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {quoted(pattern)})))::BIGINT"


@query(f"WITH {_CITED} SELECT doc_id, regexp_matches(text, {quoted(_SQL_CITATION)}) AND {_count_sql('^(?:##? References|## Bibliography|## Works Cited)')} = 0 AS unreferenced FROM d")
def citations_unreferenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cited(spark, sf_dir).select("doc_id", prose.unreferenced("text").alias("unreferenced"))


_CITED_LINES = f"{_CITED}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no FROM d)"


@query(f"WITH {_CITED_LINES}, h AS (SELECT doc_id, min(line_no) AS head FROM l WHERE regexp_matches(line, '^#.*(?:[Rr]eferences|[Bb]ibliography)') GROUP BY doc_id) SELECT l.doc_id, line, count(*) AS n FROM l JOIN h ON h.doc_id = l.doc_id AND line_no > head WHERE line <> '' AND NOT starts_with(line, '#') GROUP BY ALL HAVING count(*) > 1")
def duplicate_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prose.duplicate_lines(_cited(spark, sf_dir), "doc_id")


@query("SELECT doc_id, sha256(line) AS line_sha256, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> '' AND NOT starts_with(line, '#') GROUP BY doc_id, line HAVING count(*) > 1")
def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prose.duplicate_lines(table(spark, sf_dir, "documents"), "doc_id", after_header=False)
    return found.select("doc_id", F.sha2("line", 256).alias("line_sha256"), "n")


_MARKS = {k: rf"\[CLAIM-{k.upper().replace('_', '-')}(?:\]|:)" for k in "reversed mischaracterized overcausal wrong_population unsupported imprecise not_checkable".split()}


@query(f"WITH {_CITED} SELECT doc_id, " + ", ".join(f"{_count_sql(p)} AS {k}" for k, p in _MARKS.items()) + ", CASE WHEN reversed + mischaracterized + overcausal + unsupported > 0 THEN 'FAIL' WHEN wrong_population + imprecise > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS verdict FROM d")
def marker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prose.marker_counts("text")
    named = _cited(spark, sf_dir).select("doc_id", *[c.alias(k) for k, c in counts.items()])
    return named.withColumn("verdict", prose.marker_verdict({k: F.col(k) for k in counts}))


_SQL_CITED = r"(?:\([A-Za-z][A-Za-z '&.,-]+ [12]\d{3}[a-z]?\)|[A-Z][A-Za-z'-]+(?: (?:and|&) [A-Z][A-Za-z'-]+)?(?: et al\.?)? \([12]\d{3}[a-z]?\))"
_SQL_CAUSAL = "(?:proves|causes|leads to|produces|results in|demonstrates conclusively|establishes that|confirms that)"


@query(f"WITH {_CITED} SELECT doc_id, {_count_sql(_SQL_CAUSAL + '.{0,80}' + _SQL_CITED + '|' + _SQL_CITED + '.{0,80}' + _SQL_CAUSAL)} AS n_lines FROM d")
def causal_near_citation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cited(spark, sf_dir).select("doc_id", prose.causal_lines("text").alias("n_lines"))


_WORDS = r"len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\x0b]+'), lambda x: x <> ''))::BIGINT"


@query(f"SELECT doc_id, {_WORDS} AS n_words, {_WORDS} >= 2000 AS review_ok, {_WORDS} >= 5000 AS draft_ok FROM documents")
def word_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = prose.word_count("text")
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n_words"), (n >= 2000).alias("review_ok"), (n >= 5000).alias("draft_ok"))


@query(f"SELECT source, sum({_WORDS})::BIGINT AS n_words, CASE WHEN sum({_WORDS}) < 3000 THEN 'FAIL' WHEN sum({_WORDS}) < 6000 THEN 'WARN' ELSE 'PASS' END AS tier FROM documents GROUP BY source")
def word_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(prose.word_count("text")).alias("n_words"))
    return sums.withColumn("tier", prose.length_tier(F.col("n_words")))


@query("""WITH d AS (SELECT doc_id, replace(text, ', ', ' — ') AS text FROM documents), n AS (SELECT doc_id, (length(text) - length(replace(text, '—', '')))::BIGINT AS dashes, ((length(text) - length(replace(text, chr(10), '')) + 49) // 50)::BIGINT AS pages FROM d)
SELECT doc_id, dashes, pages, CASE WHEN pages > 0 THEN dashes // pages ELSE 0 END AS per_page FROM n""")
def em_dash_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    dashed = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit(", "), F.lit(" — ")).alias("text"))
    dashes, pages, each = prose.dash_density("text")
    return dashed.select("doc_id", dashes.alias("dashes"), pages.alias("pages"), F.coalesce(each, F.lit(0)).cast("long").alias("per_page"))


_EMBEDS = "p AS (SELECT page_id, html || CASE page_id % 4 WHEN 0 THEN chr(10) || '## Table 1' || chr(10) || '|a|b|' || chr(10) || '![f](f.png)' WHEN 1 THEN chr(10) || '<img src=x>' ELSE '' END AS text FROM pages)"


@query(f"WITH {_EMBEDS} SELECT page_id, {_count_sql('^## Table|^[|].*[|].*[|]')} AS tables, len(list_filter(string_split(text, chr(10)), lambda x: contains(x, '![')))::BIGINT AS figures FROM p")
def embedded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    more = F.when(k == 0, "\n## Table 1\n|a|b|\n![f](f.png)").when(k == 1, "\n<img src=x>").otherwise("")
    tables, figures = prose.embedded("text")
    return table(spark, sf_dir, "pages").select("page_id", F.concat("html", more).alias("text")).select("page_id", tables.alias("tables"), figures.alias("figures"))


@query("""WITH r(phase, pattern, least, severity) AS (VALUES ('ingest', 'src[0-4]$', 100, 'FAIL'), ('draft', 'src1[0-9]$', 1000, 'WARN'), ('final', 'final', 1, 'FAIL')), f AS (SELECT phase, pattern, count(source) AS files, any_value(least) AS least, any_value(severity) AS severity FROM r LEFT JOIN documents ON regexp_matches('/drafts/' || source, pattern) GROUP BY phase, pattern)
SELECT phase, files, CASE WHEN files >= least THEN 'PASS' ELSE severity END AS state FROM f""")
def phase_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("ingest", "src[0-4]$", 100, "FAIL"), ("draft", "src1[0-9]$", 1000, "WARN"), ("final", "final", 1, "FAIL")], "phase string, pattern string, least int, severity string")
    inventory = table(spark, sf_dir, "documents").select(F.concat(F.lit("/drafts/"), "source").alias("path"))
    return prose.phase_rules(rules, inventory).select("phase", "files", "state")


# ---- agreement and fidelity ----

_SCORED = """s AS (SELECT l.doc_id, quality AS gold, CASE WHEN d.doc_id % 13 = 0 THEN NULL WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS pred,
  CASE WHEN quality IS NULL THEN 'gold_empty' WHEN d.doc_id IS NULL OR l.doc_id % 17 = 0 THEN 'annotator_absent' WHEN d.doc_id % 13 = 0 THEN 'annotator_blank' END AS why FROM labels l LEFT JOIN documents d USING (doc_id))"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("gold"))
    pred = F.when(F.col("doc_id") % 13 != 0, F.when(F.col("n_chars") >= 1000, 1).otherwise(0))
    predictions = table(spark, sf_dir, "documents").where("doc_id % 17 <> 0").select("doc_id", pred.alias("pred"))
    return measure.scored(gold, predictions, "doc_id")


@query(f"WITH {_SCORED} SELECT coalesce(why, 'scored') AS why, count(*) AS n FROM s GROUP BY 1")
def kappa_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).groupBy(F.coalesce("why", F.lit("scored")).alias("why")).agg(F.count("*").alias("n"))


@query(f"""WITH {_SCORED}, o AS (SELECT gold, pred FROM s WHERE why IS NULL), n AS (SELECT count(*) FILTER (why IS DISTINCT FROM 'gold_empty') AS n_gold, count(*) FILTER (why IS NULL) AS n_scored FROM s),
e AS (SELECT sum(a.c * coalesce(b.c, 0)) AS pe FROM (SELECT gold AS v, count(*) AS c FROM o GROUP BY gold) a LEFT JOIN (SELECT pred AS v, count(*) AS c FROM o GROUP BY pred) b USING (v)),
k AS (SELECT n_gold, n_scored, n_scored / n_gold AS coverage, (SELECT count(*) FROM o WHERE gold = pred) / n_scored AS po, pe / (n_scored * n_scored) AS pe FROM n, e)
SELECT n_gold, n_scored, round(coverage, 6) AS coverage, round((po - pe) / (1 - pe), 6) AS kappa, CASE WHEN coverage < 0.95 THEN 'coverage' WHEN (po - pe) / (1 - pe) < 0.7 THEN 'kappa' END AS reason, CASE WHEN coverage >= 0.95 AND (po - pe) / (1 - pe) >= 0.7 THEN 'GREEN' ELSE 'RED' END AS verdict FROM k""")
def kappa_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = measure.kappa_gate(measure.kappa(_scored(spark, sf_dir)))
    return result.select("n_gold", "n_scored", F.round("coverage", 6).alias("coverage"), F.round("kappa", 6).alias("kappa"), "reason", "verdict")


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (quality = toxic) AS agree FROM labels), v AS (SELECT v, count(*) AS c FROM (SELECT quality AS v FROM labels UNION ALL SELECT toxic FROM labels) GROUP BY v),
t AS (SELECT n, agree / n AS po, (SELECT sum(c * (c - 1)) FROM v) AS cc, (SELECT sum(c * c) FROM v) AS c2, (SELECT count(*) FROM v) AS q FROM c)
SELECT n, round(po, 6) AS po, round(1 - (1 - po) / (1 - cc / (2 * n * (2 * n - 1))), 6) AS alpha, round((po - c2 / (4 * n * n)) / (1 - c2 / (4 * n * n)), 6) AS fleiss, round((po - (1 - c2 / (4 * n * n)) / (q - 1)) / (1 - (1 - c2 / (4 * n * n)) / (q - 1)), 6) AS ac1 FROM t""")
def rater_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure.rater_suite(table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("po", "alpha", "fleiss", "ac1")])


@query("SELECT doc_id FROM documents ORDER BY sha256(doc_id::VARCHAR || ':7'), doc_id LIMIT 50")
def reproducible_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.hash_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50, 7)


@query("SELECT r_name, count(*) AS n_requests, round(count(*) * 0.002, 6) AS cost FROM region JOIN nation ON n_regionkey = r_regionkey CROSS JOIN part GROUP BY r_name")
def fanout_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Conditions, personas and items are small declared lists; their product is the request list.
    personas = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("personas"))
    items = table(spark, sf_dir, "part").agg(F.count("*").alias("items"))
    n = F.col("personas") * F.col("items")
    return personas.crossJoin(F.broadcast(items)).select("r_name", n.alias("n_requests"), F.round(n * 0.002, 6).alias("cost"))


@query("""WITH v AS (SELECT d.lang AS item, quality AS l, n_chars::DOUBLE AS x FROM labels JOIN documents d USING (doc_id)), m AS (SELECT item, avg(x) FILTER (l = 1) AS ml, avg(x) FILTER (l = 0) AS mr, count(*) FILTER (l = 1) AS nl, count(*) FILTER (l = 0) AS nr FROM v GROUP BY item),
s AS (SELECT item, x, count(*) FILTER (l = 1) AS a, count(*) FILTER (l = 0) AS b FROM v GROUP BY item, x), c AS (SELECT item, sum(a) OVER w AS ca, sum(b) OVER w AS cb FROM s WINDOW w AS (PARTITION BY item ORDER BY x)),
k AS (SELECT item, max(abs(ca / nl - cb / nr)) AS ks FROM c JOIN m USING (item) GROUP BY item), h AS (SELECT item, floor(x / 500) AS bin, count(*) FILTER (l = 1) AS a, count(*) FILTER (l = 0) AS b FROM v GROUP BY item, floor(x / 500)),
p AS (SELECT item, a / nl AS p, b / nr AS q FROM h JOIN m USING (item)), j AS (SELECT item, sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2) AS jsd FROM p GROUP BY item)
SELECT item, round(ml - mr, 4) AS mean_diff, round(ks, 6) AS ks, round(jsd, 6) AS jsd, nl AS n_left, nr AS n_right FROM m JOIN k USING (item) JOIN j USING (item)""")
def fidelity_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    out = measure.fidelity(values, "lang", "quality", "n_chars", 1, 0, width=500)
    return out.select("item", F.round("mean_diff", 4).alias("mean_diff"), F.round("ks", 6).alias("ks"), F.round("jsd", 6).alias("jsd"), "n_left", "n_right")


@query("SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd, min(l_extendedprice) AS low, max(l_extendedprice) AS high, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY l_returnflag")
def descriptive_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, q = "l_extendedprice", "l_quantity"
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.avg(p), 4).alias("mean"), F.round(F.stddev_samp(p), 4).alias("sd"), F.min(p).alias("low"), F.max(p).alias("high"),
        F.round(F.regr_slope(p, q), 4).alias("slope"), F.round(F.regr_r2(p, q), 6).alias("r2"),
    )


# ---- monitoring and retrieval ----


@query("""WITH s AS (SELECT event_type, item FROM (SELECT event_type, event_id % 701 AS item, max(ts) AS t FROM events WHERE event_id % 2 = 0 GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY t DESC, item) <= 200)
SELECT event_id FROM events e WHERE event_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM s WHERE s.event_type = e.event_type AND s.item = e.event_id % 701)""")
def seen_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % 701).alias("item"), "ts")
    seen = events.where("event_id % 2 = 0").groupBy("event_type", "item").agg(F.max("ts").alias("t"))
    return retrieve.unseen(events.where("event_id % 2 = 1"), seen, "event_type", "item", [F.desc("t"), "item"]).select("event_id")


@query("SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY event_type")
def digest_last7(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "value", "ts")
    last = events.agg(F.max("ts").alias("last"))
    recent = events.crossJoin(F.broadcast(last)).where(F.col("ts") >= F.col("last") - F.expr("INTERVAL 7 DAYS"))
    return recent.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("SELECT doc_id, i::BIGINT AS chunk, length(substr(text, (i * 1000 + 1)::INT, 1000))::BIGINT AS n_chars FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) + 999) // 1000 - 1)) AS i FROM documents WHERE length(text) > 0)")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.chunks(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "chunk", F.length("body").cast("long").alias("n_chars"))


_BM25 = """t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM documents), f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL), l AS (SELECT doc_id, sum(tf) AS dl FROM f GROUP BY doc_id), n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM l),
q AS (SELECT * FROM f WHERE term IN ('the', 'license', 'retion')), df AS (SELECT term, count(*) AS df FROM q GROUP BY term),
s AS (SELECT doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN df USING (term) JOIN l USING (doc_id), n GROUP BY doc_id)"""


@query(f"WITH {_BM25} SELECT doc_id, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS rank FROM s ORDER BY rank LIMIT 10")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = retrieve.bm25(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), ["the", "license", "retion"], "doc_id")
    return retrieve.top_k(scores.withColumn("score", F.round("score", 6)), 10, [F.desc("score"), F.col("doc_id")])


_COS = """c AS (SELECT v.vec_id, list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))) AS score FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) v, (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0) q WHERE v.vec_id <> 0)"""


def _cosines(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = F.broadcast(vectors.where("vec_id = 0").select(F.col("embedding").alias("q")))  # one row
    return vectors.where("vec_id <> 0").crossJoin(asked).select("vec_id", F.round(retrieve.cosine(F.col("q"), F.col("embedding")), 6).alias("score"))


@query(f"WITH {_COS} SELECT vec_id, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 6) DESC, vec_id) AS rank FROM c ORDER BY rank LIMIT 10")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.top_k(_cosines(spark, sf_dir), 10, [F.desc("score"), F.col("vec_id")])


@query(f"""WITH {_BM25}, {_COS}, a AS (SELECT doc_id AS id, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS rank FROM s ORDER BY rank LIMIT 50), b AS (SELECT vec_id AS id, row_number() OVER (ORDER BY round(score, 6) DESC, vec_id) AS rank FROM c ORDER BY rank LIMIT 50)
SELECT id, round(coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0), 8) AS score FROM a FULL JOIN b USING (id)""")
def rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = retrieve.bm25(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), ["the", "license", "retion"], "doc_id").withColumn("score", F.round("score", 6))
    text = retrieve.top_k(scores, 50, [F.desc("score"), F.col("doc_id")]).withColumnRenamed("doc_id", "id")
    near = retrieve.top_k(_cosines(spark, sf_dir), 50, [F.desc("score"), F.col("vec_id")]).withColumnRenamed("vec_id", "id")
    return retrieve.fuse(text, near, "id").select("id", F.round("score", 8).alias("score"))


@query("SELECT user_id, max(CASE WHEN event_type = 'click' THEN props END) AS click, max(CASE WHEN event_type = 'view' THEN props END) AS view, max(CASE WHEN event_type = 'purchase' THEN props END) AS purchase FROM events GROUP BY user_id")
def eav_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.eav_pivot(table(spark, sf_dir, "events"), "user_id", "event_type", "props", ["click", "view", "purchase"])


@query("""SELECT p.n_name AS title, count(DISTINCT s.s_suppkey) AS creators FROM nation p JOIN region r ON r.r_regionkey = p.n_regionkey LEFT JOIN supplier s ON s.s_nationkey = p.n_nationkey
WHERE r.r_name LIKE '%A%' OR p.n_name LIKE '%E%' GROUP BY p.n_name ORDER BY creators DESC, title LIMIT 20""")
def eav_bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("nation", "region", "supplier"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"bib_{name}")
    return spark.sql("""SELECT p.n_name AS title, count(DISTINCT s.s_suppkey) AS creators FROM bib_nation p JOIN bib_region r ON r.r_regionkey = p.n_regionkey LEFT JOIN bib_supplier s ON s.s_nationkey = p.n_nationkey
      WHERE r.r_name LIKE '%A%' OR p.n_name LIKE '%E%' GROUP BY p.n_name ORDER BY creators DESC, title LIMIT 20""")


# ---- streaming twins ----


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.daily_counts(spark, sf_dir)


@query("SELECT event_id, event_type FROM events")
def stream_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.captured(spark, sf_dir)


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.last_wins(spark, sf_dir)
