"""Queries of evidence ledgers, traces and review provenance.

The star-schema tables stand in for ledgers: events for append-only records, lineitem and
orders for inventories and their anchors, part and supplier for known ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.operators import ledger, prose, review, trace
from auditloom.plans.registry import query
from auditloom.sources.tables import table


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def ledger_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def capture_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.first_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id - 3 FROM events WHERE event_type = 'error')")
def superseded_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", F.col("event_id") - 3).alias("supersedes"))
    return ledger.without_superseded(events, "event_id").select("event_id")


@query("SELECT item_id, lower('Key' || item_id) || '-' || left(sha1('Key' || item_id || '|' || sha256(text) || '|p.1'), 8) AS anchor_id FROM benchmark")
def anchor_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("Key"), F.col("item_id").cast("string"))
    return table(spark, sf_dir, "benchmark").select("item_id", ledger.anchor_id(key, F.sha2("text", 256), F.lit("p.1")).alias("anchor_id"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\x0b]+'), lambda x: x <> '')) > 60 AS over_cap FROM documents")
def quote_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", ledger.over_quote_cap(F.col("text")).alias("over_cap"))


@query(r"SELECT item_id, array_to_string(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\x0b]+'), lambda x: x <> '')[1:60], ' ') AS shown FROM benchmark")
def quote_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", r"[ \t\n\r\f\x0b]+"), lambda x: x != "")
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.slice(words, 1, 60), " ").alias("shown"))


_KNOWN = "k AS (SELECT p_partkey FROM part WHERE p_size > 10)"
_COVERED = f"{_KNOWN}, c AS (SELECT o_orderkey, bool_or(l_partkey IS NOT NULL AND l_partkey IN (SELECT p_partkey FROM k)) AS covered FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)"


@query(f"WITH {_COVERED} SELECT count(*) AS total, count(*) FILTER (covered) AS covered, (count(*) FILTER (covered) * 100 // count(*))::BIGINT AS pct, CASE WHEN count(*) = 0 THEN 'INERT' WHEN count(*) FILTER (covered) * 100 // count(*) >= 70 THEN 'GREEN' ELSE 'RED' END AS verdict FROM c")
def inventory_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey"), "o_orderkey", "left")
    known = table(spark, sf_dir, "part").where("p_size > 10").select("p_partkey")
    return ledger.coverage_gate(ledger.coverage(rows, "o_orderkey", "l_partkey", known))


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)")
def unresolved_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "part").where("p_size <= 45").select("p_partkey")
    mentions = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey")
    return ledger.unresolved(mentions, "l_partkey", known).select("l_orderkey", "l_linenumber", "l_partkey")


_TAGGED = "d AS (SELECT item_id, text || ' <!--ev: k' || item_id || '-a, k' || (item_id + 1) || '-b -->' AS line FROM benchmark), t AS (SELECT item_id, line, trim(unnest(string_split(regexp_extract(line, '<!--[ ]*ev:[ ]*([^>]*?)[ ]*-->', 1), ','))) AS anchor_id FROM d)"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_id")
    line = F.concat("text", F.lit(" <!--ev: k"), i.cast("string"), F.lit("-a, k"), (i + 1).cast("string"), F.lit("-b -->"))
    return ledger.tags(table(spark, sf_dir, "benchmark").select("item_id", line.alias("line")))


@query(f"WITH {_TAGGED} SELECT item_id, anchor_id FROM t")
def evidence_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("item_id", "anchor_id")


@query(f"WITH {_TAGGED} SELECT count(*) AS dangling FROM t WHERE anchor_id NOT IN (SELECT 'k' || item_id || '-a' FROM benchmark)")
def dangling_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("k"), F.col("item_id").cast("string"), F.lit("-a")))
    return ledger.unresolved(_tagged(spark, sf_dir), "anchor_id", known).agg(F.count("*").alias("dangling"))


@query("""WITH t AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R'), a AS (SELECT DISTINCT p_partkey AS id FROM part WHERE p_size < 25)
SELECT tagged, audited, (audited * 100 // tagged)::BIGINT AS pct, CASE WHEN audited * 100 // tagged < 70 THEN 'YELLOW' ELSE 'GREEN' END AS verdict FROM (SELECT (SELECT count(*) FROM t) AS tagged, (SELECT count(*) FROM (SELECT id FROM t INTERSECT SELECT id FROM a)) AS audited)""")
def audit_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("anchor_id"))
    return ledger.audit_coverage(tagged, table(spark, sf_dir, "part").where("p_size < 25").select(F.col("p_partkey").alias("anchor_id")))


@query("SELECT p_partkey AS anchor_id FROM part EXCEPT (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1992-06-01' UNION SELECT l_suppkey FROM lineitem)")
def unused_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    early = items.where(F.col("l_shipdate") < F.lit("1992-06-01").cast("timestamp")).select("l_partkey")
    return ledger.unused(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("anchor_id")), early, items.select("l_suppkey"))


@query("SELECT count(*) AS n, CASE WHEN count(*) > 0 THEN (count(*) FILTER (o_orderpriority LIKE '5%' OR o_custkey % 4 = 1) * 100 // count(*))::BIGINT END AS pct, coalesce(count(*) FILTER (o_orderpriority LIKE '5%' OR o_custkey % 4 = 1) * 100 // count(*) > 40, false) AS warns FROM orders WHERE o_orderstatus = 'F'")
def metadata_only_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.when(F.col("o_orderpriority").startswith("5"), "metadata_only").otherwise("source_verbatim")
    tier = F.when(F.col("o_custkey") % 4 == 1, "T4_none").otherwise("T1_fulltext")
    anchors = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("produced_by"), form.alias("evidence_form"), tier.alias("access_tier"))
    return ledger.metadata_rate(anchors, "F")


_F = r"sha256(trim(regexp_replace(lower({}), '[ \t\n\r\f\x0b]+', ' ', 'g')))"


@query(f"""WITH d AS (SELECT DISTINCT {_F.format('line')} AS f FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)), a AS (SELECT DISTINCT {_F.format('text')} AS f FROM benchmark)
SELECT 'stale' AS side, count(*) AS n FROM (SELECT f FROM a EXCEPT SELECT f FROM d) UNION ALL SELECT 'unaudited', count(*) FROM (SELECT f FROM d EXCEPT SELECT f FROM a)""")
def reconcile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    draft = prose.line_table(table(spark, sf_dir, "documents"), ["doc_id"]).select(F.col("line").alias("sentence"))
    return ledger.reconcile(draft, table(spark, sf_dir, "benchmark").select(F.col("text").alias("sentence")))


_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no FROM documents)"


@query(rf"""WITH {_LINES}, h AS (SELECT doc_id, line_no, CASE WHEN line_no % 7 = 0 THEN '# ' || left(line, 12) ELSE line END AS line FROM l)
SELECT doc_id, line_no::BIGINT AS line_no, last_value(CASE WHEN regexp_matches(line, '^#{{1,3}} ') THEN regexp_replace(line, '^#{{1,3}} +', '') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM h""")
def section_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = prose.line_table(table(spark, sf_dir, "documents"), ["doc_id"])
    marked = lines.withColumn("line", F.when(F.col("line_no") % 7 == 0, F.concat(F.lit("# "), F.substring("line", 1, 12))).otherwise(F.col("line")))
    return ledger.running_heading(marked, "doc_id").select("doc_id", F.col("line_no").cast("long").alias("line_no"), "section")


@query("""WITH e AS (SELECT CASE WHEN event_id % 9 <> 0 THEN event_type END AS event_type, strftime(ts, '%Y-%m-%d') AS day FROM events)
SELECT CASE WHEN grouping(event_type) = 1 THEN '(all)' ELSE coalesce(event_type, '?') END AS event_type, CASE WHEN grouping(day) = 1 THEN '(all)' ELSE coalesce(day, '?') END AS day, grouping(event_type, day)::BIGINT AS level, count(*) AS n FROM e GROUP BY GROUPING SETS ((event_type), (day), (event_type, day), ())""")
def ledger_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 9 != 0, F.col("event_type"))
    return ledger.dashboard(table(spark, sf_dir, "events").select(kind.alias("event_type"), F.date_format("ts", "yyyy-MM-dd").alias("day")), ["event_type", "day"])


@query("SELECT n_name, array_to_string(list_sort(list(s_suppkey)), ',') AS suppliers FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def source_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    index = ledger.source_index(joined.select(F.col("n_name").alias("cite_key"), F.col("s_suppkey").alias("anchor_id")), per_row=1 << 20)
    ids = F.transform("anchor_ids", lambda x: x.cast("string"))
    return index.select(F.col("cite_key").alias("n_name"), F.array_join(ids, ",").alias("suppliers"))


@query("SELECT p_partkey AS anchor_id, row_number() OVER (ORDER BY CASE WHEN p_size > 25 THEN 0 ELSE 1 END, CASE p_partkey % 5 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 0 THEN 2 WHEN 3 THEN 3 ELSE 4 END, p_partkey) AS rank FROM part")
def brief_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    tier = F.get(F.array(*[F.lit(t) for t in ledger.ACCESS_TIERS]), (F.col("p_partkey") % 5).cast("int"))
    anchors = parts.select(F.col("p_partkey").alias("anchor_id"), (F.col("p_size") > 25).alias("verified"), tier.alias("access_tier"))
    return ledger.brief(anchors).select("anchor_id", F.col("rank").cast("long").alias("rank"))


@query("SELECT o_orderstatus, CASE WHEN count(*) = 0 THEN 'INERT' WHEN count(*) FILTER (o_totalprice > 490000) > 0 THEN 'RED' WHEN count(*) FILTER (o_totalprice > 400000) > 0 THEN 'YELLOW' ELSE 'GREEN' END AS verdict FROM orders GROUP BY o_orderstatus")
def phase_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(ledger.phase_verdict(F.count_if(p > 490000), F.count_if(p > 400000), F.count("*")).alias("verdict"))


@query(r"SELECT page_id, length(regexp_replace(html, '<!--[^>]*-->', '', 'g'))::BIGINT AS n_bare FROM pages")
def html_comment_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.length(F.regexp_replace("html", r"<!--[^>]*-->", "")).cast("long").alias("n_bare"))


# ---- traces ----


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events")
def trace_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.numbered(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"]).select("event_id", "user_id", "seq")


@query(r"SELECT conv_id, turn, sha256(regexp_replace(regexp_replace(text, '[\n\r\t]', ' ', 'g'), '[\x00-\x1F\x7F]', '', 'g')) AS normalised_sha256 FROM conversations")
def trace_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(trace.normalised(F.col("text")), 256).alias("normalised_sha256"))


@query(r"SELECT event_id, array_to_string(list_filter(regexp_split_to_array(event_type || ', ' || user_id || '  x', '[, \t\n\r]+'), lambda x: x <> ''), '|') AS refs FROM events")
def refs_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat("event_type", F.lit(", "), F.col("user_id").cast("string"), F.lit("  x"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(trace.refs(raw), "|").alias("refs"))


@query("SELECT event_id, coalesce(event_type <> '' AND event_type IN ('click', 'view', 'error') AND (value > 50 OR user_id % 2 = 0), false) AS valid FROM events")
def trace_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type").isin("click", "view"), "ok").when(F.col("event_type") == "error", "fail").otherwise("odd")
    some = lambda c, x: F.when(c, F.lit(x)).otherwise("")
    ok = trace.valid_record(F.col("event_type"), status, some(F.col("value") > 50, "reasoned"), some(F.col("user_id") % 2 == 0, "acted"))
    return table(spark, sf_dir, "events").select("event_id", ok.alias("valid"))


@query(f"SELECT conv_id, turn, coalesce(regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}|\\d{{3}}-\\d{{2}}-\\d{{4}}'), false) AS warns FROM conversations")
def trace_pii_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", trace.warns(F.col("text")).alias("warns"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def dispatch_missing_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    traces = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"))
    return trace.missing_traces(table(spark, sf_dir, "customer"), traces, "c_custkey")


@query("SELECT event_id, user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS bound FROM events")
def manifest_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return trace.bound(table(spark, sf_dir, "events").select("event_id", "user_id"), manifest, "user_id").select("event_id", "bound")


@query(r"SELECT conv_id, turn, CASE role WHEN 'user' THEN '✓' WHEN 'system' THEN '✗' ELSE 'SKIPPED' END AS symbol, sha256(CASE WHEN trim(replace(text, chr(10), ' ')) = '' THEN '—' ELSE replace(trim(replace(text, chr(10), ' ')), '|', '\|') END) AS cell_sha256, CASE WHEN turn % 3 = 0 THEN '—' ELSE '03:04:0' || (turn % 10) END AS clock FROM conversations")
def trace_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("role") == "user", "ok").when(F.col("role") == "system", "fail").otherwise("skipped")
    stamp = F.when(F.col("turn") % 3 != 0, F.concat(F.lit("2024-01-02T03:04:0"), (F.col("turn") % 10).cast("string"), F.lit("Z")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", trace.rendered(state).alias("symbol"), F.sha2(trace.cell(F.col("text")), 256).alias("cell_sha256"), trace.clock(stamp).alias("clock"))


@query("SELECT user_id, arg_min(event_type, (ts, event_id)) AS purpose, count(DISTINCT event_type) > 1 AS conflict FROM events GROUP BY user_id")
def purpose_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.purposes(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"])


@query("SELECT c_custkey, regexp_matches(lower(replace(c_name, '#', '_')), '^[a-z][a-z0-9_-]{12,}$') AS valid FROM customer")
def dispatch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", trace.dispatch_valid(F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))).alias("valid"))


# ---- review provenance ----


@query("""WITH r AS (SELECT DISTINCT event_type FROM events), d AS (SELECT DISTINCT event_type FROM events WHERE user_id % 50 = 7 AND value > 60), x AS (SELECT DISTINCT event_type FROM events WHERE event_type LIKE 'e%')
SELECT event_type, CASE WHEN event_type IN (SELECT event_type FROM d) THEN 'dispatched' WHEN event_type IN (SELECT event_type FROM x) THEN 'excused' ELSE 'missing' END AS state FROM r""")
def required_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id", "value")
    return review.required_coverage(events.select("event_type").distinct(), events.where("user_id % 50 = 7 AND value > 60"), events.where("event_type LIKE 'e%'"), "event_type")


@query("SELECT user_id, count(*) AS n_rows, count(DISTINCT event_type) AS n_ids, count(*) > count(DISTINCT event_type) AND count(DISTINCT event_type) >= 1 AS consolidated FROM events GROUP BY user_id")
def consolidated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.consolidated(table(spark, sf_dir, "events"), "user_id", "event_type")


@query("""WITH r AS (SELECT doc_id, sha256(text) AS h FROM documents), d AS (SELECT doc_id, sha256(text || CASE WHEN doc_id % 5 = 0 THEN '!' ELSE '' END) AS h FROM documents WHERE doc_id % 11 <> 3)
SELECT r.doc_id, CASE WHEN d.h IS NULL THEN 'missing' WHEN d.h <> r.h THEN 'mismatch' ELSE 'bound' END AS state FROM r LEFT JOIN d USING (doc_id)""")
def hash_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("doc_id").cast("string").alias("path"))
    reviewed = docs.select("doc_id", "path", F.sha2("text", 256).alias("sha256"))
    edited = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    disk = docs.where("doc_id % 11 <> 3").select("path", F.sha2(edited, 256).alias("sha256"))
    return review.hash_binding(reviewed, disk).select("doc_id", "state")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 4 <> 1")
def unreviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("doc_id").cast("string").alias("path")
    disk = table(spark, sf_dir, "documents").select("doc_id", path)
    left_out = disk.where("doc_id % 4 = 1").select("path")
    return review.unreviewed(disk, table(spark, sf_dir, "labels").select(path), left_out).select("doc_id")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS report FROM orders GROUP BY o_custkey")
def newest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = table(spark, sf_dir, "orders").select(F.col("o_custkey"), "o_orderkey", F.struct("o_orderdate", "o_orderkey").alias("iteration"))
    return review.newest(reports, "o_custkey").select("o_custkey", F.col("o_orderkey").alias("report"))
