"""Queries over a project's files: every document is a file, its path made of its source, its id and, by id, a folder and a kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.operators import ledger, scan, status
from auditloom.plans.gate_oracle import AUDIT_OK, EXT, IS_DATA, MEDIA, OPAQUE, QUAL_SQL, RAW_SQL, SYSTEM, TAIL, VALID, WRITING, failed
from auditloom.plans.registry import query, quoted
from auditloom.plans.scan_oracle import DOC_VERDICT, RED, YELLOW, flags
from auditloom.sources.tables import spread, table

FOLDERS = ["p/data/raw", "p/data", "p/transcripts", "p/notes", "p/src", "p/media", "p/materials/consent", "p/corpus", "p/fig", "p/Interviews", "etc", "p/data/raw/waves", "var/log"]
KINDS = ["csv", "txt", "md", "py", "WAV", "docx", "json", "png", "rtf", "xyz", "parquet"]
STATUSES = ["CLEARED", "ANONYMIZED", "OVERRIDE", "LOCAL_MODE", "HALTED", "NEEDS_REVIEW", "NEEDS_REVIEW:RED", "NEEDS_REVIEW:", "cleared", "", None, None, None, None]
LEVELS = ["strict", None, "odd", "lockdown", "standard", "Strict", None]


def _pick(values: list, k: str) -> Column:
    """One of ``values`` by a whole number."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.expr(k) % len(values) + 1).cast("int"))


def _sql_pick(values: list, k: str) -> str:
    return f"[{', '.join('NULL' if v is None else quoted(v) for v in values)}][(({k}) % {len(values)} + 1)::INT]"


_PATH = f"'/' || {_sql_pick(FOLDERS, 'doc_id')} || '/' || source || doc_id || '.' || {_sql_pick(KINDS, 'doc_id')}"
_STATUS = _sql_pick(STATUSES, "doc_id // 3")
_P = f"f AS (SELECT doc_id, {_PATH} AS path, {_STATUS} AS status, text FROM documents)"


def _files(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", *more)
    path = F.concat(F.lit("/"), _pick(FOLDERS, "doc_id"), F.lit("/"), "source", "doc_id", F.lit("."), _pick(KINDS, "doc_id"))
    return docs.select("doc_id", path.alias("path"), _pick(STATUSES, "doc_id div 3").alias("status"), *more)


@query(f"WITH {_P} SELECT doc_id, {VALID} AS valid FROM f")
def file_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files(spark, sf_dir).select("doc_id", status.valid_status(F.col("status")).alias("valid"))


@query(f"SELECT doc_id, CASE WHEN a IN ('standard', 'strict', 'lockdown') THEN a WHEN b IN ('standard', 'strict', 'lockdown') THEN b ELSE 'standard' END AS level FROM (SELECT doc_id, {_sql_pick(LEVELS, 'doc_id')} AS a, {_sql_pick(LEVELS, 'doc_id // 7')} AS b FROM documents)")
def file_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", status.safety_level(_pick(LEVELS, "doc_id"), _pick(LEVELS, "doc_id div 7")).alias("level"))


@query(f"WITH {_P}, g AS (SELECT doc_id, path, lower(path) AS p, lower(path) AS l FROM f), e AS (SELECT *, {TAIL} AS ext FROM g) SELECT doc_id, {IS_DATA} AS data, {RAW_SQL('p')} AS raw, {QUAL_SQL('p')} AS qualitative FROM e")
def file_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("path")
    return _files(spark, sf_dir).select("doc_id", status.is_data(p, p).alias("data"), status.is_raw(p, p).alias("raw"), status.is_qualitative(p, p).alias("qualitative"))


@query(f"""WITH {DOC_VERDICT}, d AS (SELECT doc_id, {_PATH} AS path, {_STATUS} AS status FROM documents), g AS (SELECT d.*, v.verdict, lower(path) AS p, lower(path) AS l FROM d JOIN v USING (doc_id)), e AS (SELECT *, {TAIL} AS ext FROM g),
r AS (SELECT doc_id, CASE WHEN {SYSTEM} THEN 'system path' WHEN NOT {IS_DATA} THEN 'not data' WHEN status IS NOT NULL AND NOT {VALID} THEN 'invalid status'
  WHEN status = 'OVERRIDE' AND (ext IN ({MEDIA}) OR (ext IN ({WRITING}) AND {QUAL_SQL('p')})) THEN 'override refused' WHEN status IN ('CLEARED', 'ANONYMIZED', 'OVERRIDE') THEN 'status allows' WHEN status IS NOT NULL THEN 'status blocks'
  WHEN ext IN ('jpg', 'jpeg', 'png', 'tiff', 'tif', 'heic', 'heif', 'bmp', 'webp', 'gif') THEN CASE WHEN {RAW_SQL('p')} THEN 'raw image' ELSE 'image' END WHEN verdict = 'GREEN' THEN 'scan is green' ELSE 'scan blocks' END AS reason FROM e)
SELECT doc_id, reason, CASE WHEN reason IN ('not data', 'status allows', 'image', 'scan is green') THEN 'ALLOW' ELSE 'BLOCK' END AS decision FROM r""")
def file_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each file may be read: by its path, its status, and the scan of its text where neither decides."""
    scanned = scan.scan(spread(_files(spark, sf_dir, "text")), "text")
    decision, reason = status.decide(F.col("path"), F.col("status"), F.col("verdict"), F.col("path"))
    return scanned.select("doc_id", reason.alias("reason"), decision.alias("decision"))


@query(f"WITH {_P}, s AS (SELECT doc_id, path, text, {flags('text')} FROM f) SELECT doc_id, CASE WHEN {RED} > 0 THEN 'RED' WHEN {YELLOW} > 0 OR {EXT} IN ({OPAQUE}) THEN 'YELLOW' ELSE 'GREEN' END AS verdict FROM s")
def file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts graded as files: what can't be read as text is never GREEN."""
    return scan.scan(spread(_files(spark, sf_dir, "text")), "text", "path").select("doc_id", "verdict")


@query(f"WITH {_P} SELECT doc_id, 'BINARY_FORMAT' AS entity, 1.0::DOUBLE AS score, '.' || {EXT} AS value FROM f WHERE {EXT} IN ({OPAQUE})")
def file_opaque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.opaque_findings(_files(spark, sf_dir), ["doc_id"], "path")



@query(f"""WITH {_P}, r AS (SELECT DISTINCT '/' || string_split(path, '/')[2] || CASE WHEN doc_id % 2 = 0 AND len(string_split(path, '/')) > 3 THEN '/' || string_split(path, '/')[3] ELSE '' END AS dir FROM f WHERE status = 'CLEARED')
SELECT path, (SELECT max(dir) FROM r WHERE starts_with(f.path, r.dir || '/') AND length(dir) = (SELECT max(length(dir)) FROM r WHERE starts_with(f.path, r.dir || '/'))) AS root FROM f""")
def file_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of the folders that hold a cleared file, above each file."""
    files = _files(spark, sf_dir)
    parts = F.split("path", "/")
    deep = (F.col("doc_id") % 2 == 0) & (F.size(parts) > 3)
    roots = files.where("status = 'CLEARED'").select(F.concat(F.lit("/"), F.get(parts, F.lit(1)), F.when(deep, F.concat(F.lit("/"), F.get(parts, F.lit(2)))).otherwise("")).alias("dir")).distinct()
    return status.nearest_root(files.select("path"), roots)


@query(f"""WITH {_P}, a AS (SELECT doc_id, path AS canonical, '/l' || path AS lexical, parse_filename(path) AS raw, status FROM f),
s AS (SELECT canonical AS path, status FROM a WHERE status <> '' AND doc_id % 2 = 0 UNION ALL SELECT lexical, status FROM a WHERE status <> '' AND doc_id % 3 = 0 UNION ALL SELECT raw, 'HALTED' FROM a WHERE doc_id % 5 = 0)
SELECT canonical, coalesce(x.status, y.status, z.status) AS status FROM a LEFT JOIN s x ON x.path = a.canonical LEFT JOIN s y ON y.path = a.lexical LEFT JOIN s z ON z.path = a.raw""")
def file_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file's status by its canonical path, then as it was written, then by its bare name."""
    files = _files(spark, sf_dir).select("doc_id", F.col("path").alias("canonical"), F.concat(F.lit("/l"), "path").alias("lexical"), F.element_at(F.split("path", "/"), -1).alias("raw"), "status")
    some = files.where("status <> ''")
    said = some.where("doc_id % 2 = 0").select(F.col("canonical").alias("path"), "status").union(some.where("doc_id % 3 = 0").select("lexical", "status")).union(files.where("doc_id % 5 = 0").select("raw", F.lit("HALTED")))
    return status.lookup_status(files.select("canonical", "lexical", "raw"), said).select("canonical", "status")


# ---- audit records: every line of an order is a claim that was audited ----

VERDICTS = ["CLAIM-VERIFIED", "CLAIM-REVERSED", "CLAIM-UNSUPPORTED", "CLAIM-IMPRECISE", "CLAIM-OVERCAUSAL", "CLAIM-NOT-CHECKABLE", "VERIFIED", "CLAIM-NOT-A-CLAIM"]
SEVERITIES = ["OK", "HIGH", "HIGH", "MED", "MED", "UNVERIFIABLE", "OK", "OK", None]
TIERS = ["T0_kg_fulltext", "T1_fulltext", "T2_oa_fulltext", "T3_abstract", "T4_none"]
SUBS = ["SUPPORTED|because", "SUPPORTED|", "CONTRADICTED|no", "NOT_FOUND|", None]
ANCHORS = ["autor2013-3f9a1c2e", "lee-and_wong-00000000", "BAD", None]

_CLAIMS = f"""a AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_orderkey % 23 = 0 THEN 'x' ELSE 'claim-audit-record/v1' END AS schema, 'c' || l_orderkey || '-' || l_linenumber AS claim_id, 's' || l_suppkey AS cite_key,
  CASE WHEN l_partkey % 31 = 0 THEN '' ELSE 'p. ' || l_linenumber END AS manuscript_loc, 'q' || l_partkey AS manuscript_quote, CASE WHEN l_returnflag = 'R' AND l_partkey % 11 = 0 THEN NULL ELSE 'support' END AS citation_function,
  {_sql_pick(VERDICTS, 'l_partkey')} AS sentence_verdict, {_sql_pick(SEVERITIES, 'l_partkey + l_suppkey // 40')} AS severity, {_sql_pick(TIERS, 'l_orderkey')} AS access_tier_max, CASE WHEN l_linestatus = 'O' THEN true WHEN l_suppkey % 3 = 0 THEN false WHEN l_suppkey % 3 = 1 THEN true END AS evidence_retrieved,
  list_filter([{_sql_pick(SUBS, 'l_orderkey // 2')}], lambda x: x IS NOT NULL) AS subs, list_filter([{_sql_pick(ANCHORS, 'l_suppkey')}], lambda x: x IS NOT NULL) AS anchor_refs, CASE WHEN l_orderkey % 997 = 1 THEN '{{' END AS _corrupt FROM lineitem)"""
_PROBLEMS = f"{_CLAIMS}, c AS (SELECT id, severity, CASE WHEN _corrupt IS NOT NULL THEN 'unparseable' ELSE {failed(AUDIT_OK)} END AS problems FROM a)"


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, c = table(spark, sf_dir, "lineitem"), F.col
    sub = F.split(_pick(SUBS, "l_orderkey div 2"), r"\|")
    found = F.struct(F.lit("finding").alias("kind"), F.get(sub, F.lit(0)).alias("verdict"), F.get(sub, F.lit(1)).alias("evidence_quote"))
    return lines.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("id"), F.when(c("l_orderkey") % 23 == 0, "x").otherwise(ledger.AUDIT_SCHEMA).alias("schema"), F.concat(F.lit("c"), "l_orderkey", F.lit("-"), "l_linenumber").alias("claim_id"),
        F.concat(F.lit("s"), "l_suppkey").alias("cite_key"), F.when(c("l_partkey") % 31 == 0, "").otherwise(F.concat(F.lit("p. "), "l_linenumber")).alias("manuscript_loc"), F.concat(F.lit("q"), "l_partkey").alias("manuscript_quote"),
        F.when((c("l_returnflag") == "R") & (c("l_partkey") % 11 == 0), None).otherwise("support").alias("citation_function"), _pick(VERDICTS, "l_partkey").alias("sentence_verdict"),
        _pick(SEVERITIES, "l_partkey + l_suppkey div 40").alias("severity"), _pick(TIERS, "l_orderkey").alias("access_tier_max"),
        F.when(c("l_linestatus") == "O", True).when(c("l_suppkey") % 3 == 0, False).when(c("l_suppkey") % 3 == 1, True).alias("evidence_retrieved"),
        F.when(sub.isNull(), F.array().cast("array<struct<kind: string, verdict: string, evidence_quote: string>>")).otherwise(F.array(found)).alias("sub_claims"),
        F.array_compact(F.array(_pick(ANCHORS, "l_suppkey"))).alias("anchor_refs"), F.when(c("l_orderkey") % 997 == 1, "{").alias("_corrupt"),
    )


@query(f"WITH {_PROBLEMS} SELECT id, problems, count(*) AS n FROM c GROUP BY id, problems")
def claim_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistency rules that each audit record breaks; a line that an order has twice is two records."""
    checked = ledger.audit_problems(_claims(spark, sf_dir)).select("id", F.array_join("problems", ",").alias("problems"))
    return checked.groupBy("id", "problems").agg(F.count("*").alias("n"))


@query(f"WITH {_PROBLEMS} SELECT count(*) AS records, count(*) FILTER (problems <> '') AS failed, CASE WHEN count(*) FILTER (problems <> '') > 0 THEN 'RED' ELSE 'GREEN' END AS verdict FROM c")
def claim_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.audit_verdict(ledger.audit_problems(_claims(spark, sf_dir)))


@query(f"WITH {_PROBLEMS} SELECT count(*) FILTER (severity = 'HIGH') AS n_high FROM c")
def claim_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.high_count(_claims(spark, sf_dir))


# ---- evidence tags: every document's first words are a line that may cite and may be tagged ----

MARKS = ["Work falls (Autor 2013). <!--ev: autor2013-3f9a1c2e, ghost9999-deadbeef -->", "No author here <!--ev: autor2013-3f9a1c2e-->", "As (Autor and Dorn 2013a) say", "See [@autor2013] <!-- ev: lee2001-0a0b0c0d -->", "", "(Lee 2001) <!--note-->", "(Lee 2001) <!--ev: lee2001-0a0b0c0d-->"]
_LINES = f"l AS (SELECT doc_id AS n, replace(left(text, 60), chr(10), ' ') || ' ' || {_sql_pick(MARKS, 'doc_id')} AS line FROM documents)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("n"), F.concat(F.replace(F.substring("text", 1, 60), F.lit("\n"), F.lit(" ")), F.lit(" "), _pick(MARKS, "doc_id")).alias("line"))


@query(f"""WITH {_LINES}, c AS (SELECT count(*) FILTER (c) AS citing, count(*) FILTER (c AND t) AS tagged FROM (SELECT regexp_matches(line, '\\(([A-Z][A-Za-z-]+[^)]*[12][0-9]{{3}}[a-z]?)\\)|\\[@[a-zA-Z]') AS c, regexp_matches(line, '<!--[ \t]*ev:[ \t]*[a-z0-9_, \t-]*-->') AS t FROM l))
SELECT citing, tagged, (tagged * 100 // citing)::BIGINT AS pct, CASE WHEN tagged * 100 // citing < 60 THEN 'YELLOW' ELSE 'GREEN' END AS verdict FROM c""")
def line_tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.tag_coverage(_lines(spark, sf_dir))


_KEYS = "k AS (SELECT DISTINCT 'autor2013-3f9a1c2e' AS anchor_id, 'Autor2013' AS cite_key FROM documents UNION SELECT DISTINCT 'lee2001-0a0b0c0d', 'Lee2001' FROM documents)"


@query(f"""WITH {_LINES}, {_KEYS}, t AS (SELECT n, line, trim(unnest(regexp_extract_all(regexp_extract(line, '<!--[ ]*ev:([^>]*)-->', 1), '[a-z0-9_-]+-[0-9a-f]{{8}}'))) AS anchor_id FROM l),
j AS (SELECT t.*, lower(cite_key) AS k, lower(regexp_replace(line, '<!--[^>]*-->', '', 'g')) AS bare FROM t LEFT JOIN k USING (anchor_id))
SELECT n, anchor_id, coalesce(contains(bare, regexp_replace(k, '[0-9].*$', '')) AND contains(bare, regexp_extract(k, '[12][0-9]{{3}}')), false) AS adjacent FROM j""")
def line_tag_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keys = docs.select(F.explode(F.array(F.struct(F.lit("autor2013-3f9a1c2e").alias("anchor_id"), F.lit("Autor2013").alias("cite_key")), F.struct(F.lit("lee2001-0a0b0c0d").alias("anchor_id"), F.lit("Lee2001").alias("cite_key")))).alias("k")).select("k.*").distinct()
    return ledger.adjacent(ledger.tags(_lines(spark, sf_dir)), keys).select("n", "anchor_id", "adjacent")
