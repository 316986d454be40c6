"""Agreement, simulated studies, monitoring, the knowledge graph and phases of a project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.operators import measure, retrieve
from auditloom.plans.registry import query
from auditloom.sources import ledger_files
from auditloom.sources.scratch import scratch_path
from auditloom.sources.tables import spread, table
from auditloom.streaming.monitor import monitor
from auditloom.streaming.sessions import sessions

# ---- agreement ----


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256(doc_id::VARCHAR || ':7'), doc_id) <= 3")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.stratified_sample(table(spark, sf_dir, "documents").select("source", "doc_id"), "doc_id", "source", 3, 7)


@query("""SELECT '{"key": "doc_id", "n": 3, "order": "sha256(key:seed)", "pool": ' || count(*) || ', "seed": 7, "strata": "source"}' AS design FROM documents""")
def sample_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = table(spark, sf_dir, "documents").count()
    return spark.createDataFrame([(measure.sample_design(3, pool, 7, "doc_id", "source"),)], "design string")


# ---- simulated studies ----


@query("SELECT c || '|' || c_custkey || '|' || r_regionkey || '|r' || r AS custom_id, c AS condition, c_custkey::VARCHAR AS persona_id, r_regionkey::VARCHAR AS item_id, r::INT AS rep FROM (VALUES ('base'), ('primed')) x(c), customer, region, generate_series(0, 1) g(r)")
def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    personas = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("persona_id"))
    items = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("item_id"))
    return measure.fan_out(spark.createDataFrame([("base",), ("primed",)], "condition string"), personas, items, 2)


@query("SELECT n AS n_requests, round(n * 0.002, 6) AS cost, n * 0.002 <= 100 AS within_cap FROM (SELECT 2 * (SELECT count(*) FROM customer) * (SELECT count(*) FROM part) * 3 AS n)")
def request_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure.request_estimate(spark.createDataFrame([("base",), ("primed",)], "condition string"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "part"), 3, 0.002, 100)
    return out.withColumn("cost", F.round("cost", 6))


_SIDES = "v AS (SELECT event_type AS item, user_id % 2 AS side, floor(value / 25)::DOUBLE AS x, (user_id % 3)::VARCHAR AS grp FROM events)"


@query(f"""WITH {_SIDES}, m AS (SELECT item, avg(x) FILTER (side = 0) AS ml, avg(x) FILTER (side = 1) AS mr, stddev_samp(x) FILTER (side = 1) AS sd, count(*) FILTER (side = 0) AS nl, count(*) FILTER (side = 1) AS nr FROM v GROUP BY item),
s AS (SELECT item, x, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM v GROUP BY item, x), c AS (SELECT item, x, a, b, sum(a) OVER w AS ca, sum(b) OVER w AS cb FROM s WINDOW w AS (PARTITION BY item ORDER BY x)),
f AS (SELECT item, max(abs(ca / nl - cb / nr)) AS ks, sum((CASE WHEN a > 0 THEN a / nl * log2(a / nl / ((a / nl + b / nr) / 2)) ELSE 0 END + CASE WHEN b > 0 THEN b / nr * log2(b / nr / ((a / nl + b / nr) / 2)) ELSE 0 END) / 2) AS jsd FROM c JOIN m USING (item) GROUP BY item),
p AS (SELECT item, abs(ml - mr) <= 0.5 AND ks <= 0.3 AND jsd <= 0.1 AS good, abs(ml - mr) <= 2 * sd / sqrt(nr) AS covered FROM m JOIN f USING (item)), g AS (SELECT item, grp, avg(x) FILTER (side = 0) AS a, avg(x) FILTER (side = 1) AS b FROM v GROUP BY item, grp), r AS (SELECT corr(a, b) AS r FROM g)
SELECT count(*) AS items, round(avg(good::INT), 6) AS item_pass_rate, round(avg(covered::INT), 6) AS coverage, round((SELECT r FROM r), 6) AS subgroup_r, CASE WHEN avg(good::INT) < 0.8 THEN 'item pass rate' WHEN avg(covered::INT) < 0.8 THEN 'coverage' WHEN (SELECT r FROM r) < 0.5 THEN 'subgroup correlation' END AS reason FROM p""")
def fidelity_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 2).alias("side"), F.floor(F.col("value") / 25).cast("double").alias("x"), (F.col("user_id") % 3).cast("string").alias("grp"))
    items = measure.fidelity(v, "event_type", "side", "x", 0, 1)
    out = measure.fidelity_gate(v, items, "event_type", "side", "x", 0, 1, subgroup="grp")
    return out.select("items", *[F.round(c, 6).alias(c) for c in ("item_pass_rate", "coverage", "subgroup_r")], "reason")


# ---- monitoring ----

POLLS = 5


@query(f"""WITH RECURSIVE b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
p AS (SELECT event_type AS source, (event_id % 701)::VARCHAR AS item, ts, ({POLLS} * (epoch_us(ts) - lo)) // (hi - lo + 1) AS poll FROM events, b),
i AS (SELECT source, poll, list(item ORDER BY t DESC, item) AS items FROM (SELECT source, poll, item, max(ts) AS t FROM p GROUP BY ALL) GROUP BY ALL),
r(source, poll, seen, fresh) AS (SELECT DISTINCT source, -1::BIGINT, []::VARCHAR[], []::VARCHAR[] FROM i
  UNION ALL SELECT source, poll + 1, list_slice(list_concat(f, seen), 1, 200), f FROM (SELECT r.source, r.poll, r.seen, list_filter(coalesce(i.items, []::VARCHAR[]), lambda x: NOT list_contains(r.seen, x)) AS f FROM r LEFT JOIN i ON i.source = r.source AND i.poll = r.poll + 1 WHERE r.poll < {POLLS - 1}))
SELECT source, poll, unnest(fresh) AS item FROM r""")
def monitor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New items of each type of event in five polls, the stream stopped and started again before each."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), (F.col("event_id") % 701).cast("string").alias("item"), F.col("ts").alias("at"), F.lit(None).cast("string").alias("error"))
    lo, hi = rows.agg(F.min(F.unix_micros("at")), F.max(F.unix_micros("at"))).first()
    poll = F.expr(f"({POLLS} * (unix_micros(at) - {lo})) DIV {hi - lo + 1}")
    folder = scratch_path(spark, "monitor")
    for k in range(POLLS):
        rows.where(poll == k).write.mode("append").parquet(f"{folder}/polls/{k}")
        polls = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/polls")
        found = monitor(polls, folder, cadence_days=3650)
    return found.where("kind = 'new'").select("source", poll.cast("long").alias("poll"), "item")


@query("""WITH l AS (SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, min(ts) AS start, max(ts) AS "end", count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users whose events lie less than six hours apart, in three batches and a closing one."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("ts").alias("at"), "value", F.lit(False).alias("closing"))
    lo, hi = rows.agg(F.min(F.unix_micros("at")), F.max(F.unix_micros("at"))).first()
    slice_, folder = F.expr(f"(3 * (unix_micros(at) - {lo})) DIV {hi - lo + 1}"), scratch_path(spark, "sessions")
    last = rows.select("key", F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("closing")).distinct()
    for k in range(4):
        (rows.where(slice_ == k) if k < 3 else last).write.parquet(f"{folder}/in/{k}")
        found = sessions(spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in"), folder, gap=6 * 3600, delay=3600)
    return found.where("kind = 'closed'").select(F.col("key").cast("long").alias("user_id"), "start", "end", "n", F.round("total", 4).alias("total"))


# ---- the knowledge graph ----

_EDGE = "e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst, CASE l_returnflag WHEN 'R' THEN 'contradicts' WHEN 'A' THEN 'supports' ELSE 'extends' END AS kind FROM lineitem)"


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_returnflag") == "R", "contradicts").when(F.col("l_returnflag") == "A", "supports").otherwise("extends")
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), kind.alias("kind")).distinct()


@query(f"""WITH {_EDGE}, s AS (SELECT dst, src FROM e WHERE kind = 'supports'), c AS (SELECT dst, src FROM e WHERE kind = 'contradicts'), n AS (SELECT s.dst, count(*) AS pairs FROM s JOIN c ON s.dst = c.dst AND s.src <> c.src GROUP BY s.dst)
SELECT dst, (SELECT count(*) FROM s WHERE s.dst = n.dst) AS supporters, (SELECT count(*) FROM c WHERE c.dst = n.dst) AS contradictors, pairs, (SELECT min(src) FROM s WHERE s.dst = n.dst) AS first_support, (SELECT min(src) FROM c WHERE c.dst = n.dst) AS first_against FROM n""")
def edge_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.contradictions(graph_edges(spark, sf_dir))


@query(f"WITH {_EDGE} SELECT p_partkey AS id FROM (SELECT p_partkey FROM part UNION ALL SELECT p_partkey + 1000000 FROM part) WHERE p_partkey NOT IN (SELECT dst FROM e) AND p_partkey NOT IN (SELECT src FROM e)")
def graph_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return retrieve.gaps(parts.union(parts.select(F.col("id") + 1_000_000)), graph_edges(spark, sf_dir))


# ---- retrieval ----

_PAPER = "'Title ' || doc_id || chr(10) || 'Abstract' || chr(10) || left(text, 300) || chr(10) || '1. Introduction' || chr(10) || text || chr(10) || '## Data and Methods:' || chr(10) || left(text, 1500) || chr(10) || 'RESULTS' || chr(10) || text || chr(10) || 'References' || chr(10) || 'Smith 2019'"
_HEAD = r"(?im)^[ \t]*(?:#{1,4}[ \t]+)?(?:\d+(?:\.\d+)*\.?[ \t]+)?(abstract|summary|introduction|background|theory|literature review|theoretical framework|related work|data|data and methods|sample|materials|methods?|methodology|analytic strategy|measures|results|findings|analysis|discussion|limitations|conclusions?|concluding remarks|references|bibliography|works cited|appendix|supplementary materials?)[ \t]*:?[ \t]*$"
_NAME = "CASE lower(h) WHEN 'abstract' THEN 'abstract' WHEN 'introduction' THEN 'introduction' WHEN 'data and methods' THEN 'data' WHEN 'results' THEN 'results' WHEN 'references' THEN 'references' ELSE 'front' END"


@query(f"""WITH d AS (SELECT doc_id, {_PAPER} AS text FROM documents), p AS (SELECT doc_id, unnest(list_concat([''], regexp_extract_all(text, '{_HEAD}', 1))) AS h, unnest(regexp_split_to_array(text, '{_HEAD}')) AS b, unnest(generate_series(0, len(regexp_extract_all(text, '{_HEAD}')))) AS part FROM d),
s AS (SELECT doc_id, part, {_NAME} AS section, trim(b, chr(10)) AS b FROM p)
SELECT doc_id, section, part::BIGINT AS part, chunk::BIGINT AS chunk, sha256(substr(b, (chunk * 1000 + 1)::INT, 1000)) AS body_sha256 FROM (SELECT *, unnest(generate_series(0, (length(b) + 999) // 1000 - 1)) AS chunk FROM s WHERE length(b) > 0) WHERE section IN ('abstract', 'data', 'results')""")
def section_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    paper = F.concat(F.lit("Title "), F.col("doc_id").cast("string"), F.lit("\nAbstract\n"), F.substring(t, 1, 300), F.lit("\n1. Introduction\n"), t, F.lit("\n## Data and Methods:\n"), F.substring(t, 1, 1500), F.lit("\nRESULTS\n"), t, F.lit("\nReferences\nSmith 2019"))
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("text", paper)
    return retrieve.section_chunks(docs, "doc_id", only=["abstract", "data", "results", "references"]).select("doc_id", "section", "part", "chunk", F.sha2("body", 256).alias("body_sha256"))


# ---- phases ----


_NAMED = "e AS (SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst, CASE l_returnflag WHEN 'R' THEN 'contradicts' WHEN 'A' THEN 'supports' ELSE 'extends' END AS kind FROM lineitem), n AS (SELECT 's' || s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT 'p' || p_partkey, p_name FROM part)"


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers and parts as nodes, what a supplier delivered as its relations."""
    edges = graph_edges(spark, sf_dir).select(F.concat(F.lit("s"), "src").alias("src"), F.concat(F.lit("p"), "dst").alias("dst"), "kind")
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return suppliers.union(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey"), "p_name")), edges


@query("""WITH RECURSIVE b AS (SELECT DISTINCT 's' || l_suppkey AS x, 'p' || l_partkey AS y FROM lineitem WHERE l_quantity >= 49 AND l_returnflag = 'R'), e AS (SELECT x AS src, y AS dst FROM b UNION ALL SELECT y, x FROM b),
r(id, steps) AS (SELECT 's' || s_suppkey, 0 FROM supplier WHERE s_nationkey < 10 UNION SELECT e.dst, r.steps + 1 FROM r JOIN e ON e.src = r.id WHERE r.steps < 60) SELECT id, min(steps) AS steps FROM r GROUP BY id""")
def graph_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the suppliers of ten nations reach through large returns of the same parts."""
    big = table(spark, sf_dir, "lineitem").where("l_quantity >= 49 AND l_returnflag = 'R'").select(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst"))
    starts = table(spark, sf_dir, "supplier").where("s_nationkey < 10").select(F.concat(F.lit("s"), "s_suppkey").alias("id"))
    return retrieve.distances(big.union(big.select("dst", "src")), starts)


@query(f"WITH {_NAMED} SELECT id, kind, direction, count(*) AS n FROM (SELECT src AS id, kind, 'out' AS direction FROM e UNION ALL SELECT dst, kind, 'in' FROM e) GROUP BY ALL")
def edge_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.relations(_graph(spark, sf_dir)[1])


@query(f"""WITH {_NAMED} SELECT 'nodes' AS what, count(*) AS n FROM n UNION ALL SELECT 'edges', count(*) FROM e UNION ALL SELECT 'edges: ' || kind, count(*) FROM e GROUP BY kind
UNION ALL SELECT 'isolated', count(*) FROM n WHERE id NOT IN (SELECT src FROM e) AND id NOT IN (SELECT dst FROM e)""")
def edge_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.graph_status(*_graph(spark, sf_dir))


@query(f"WITH {_NAMED}, k AS (SELECT id FROM n WHERE id LIKE 's%' OR name LIKE '%ring%') SELECT src, dst, kind FROM e WHERE src IN (SELECT id FROM k) AND dst IN (SELECT id FROM k)")
def edge_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = _graph(spark, sf_dir)
    return retrieve.export(nodes, edges, F.col("id").startswith("s") | F.col("name").contains("ring"))[1].select("src", "dst", "kind")


@query("""SELECT p_partkey AS id, (contains(lower(p_name), 'ring') OR contains(lower(p_name), 'large'))::BIGINT + (contains(lower(p_type), 'ring') OR contains(lower(p_type), 'large'))::BIGINT AS hits FROM part
WHERE (contains(lower(p_name), 'ring') OR contains(lower(p_type), 'ring')) AND (contains(lower(p_name), 'large') OR contains(lower(p_type), 'large'))""")
def part_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.search(table(spark, sf_dir, "part"), "ring LARGE", ["p_name", "p_type"]).select(F.col("p_partkey").alias("id"), "hits")


# ---- intervals of agreement ----


@query(f"""WITH p AS (SELECT doc_id AS k, quality AS a, toxic AS b FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL),
h AS (SELECT a, b, r, ('0x' || substr(md5('42:' || r || ':' || k), 1, 8))::BIGINT AS h FROM p, range(0, 201) t(r)),
w AS (SELECT r, a, b, sum(CASE WHEN r = 0 THEN 1 ELSE list_sum(list_transform({measure.POISSON_STEPS}, lambda x: (h >= x)::INT)) END)::DOUBLE AS w FROM h GROUP BY ALL),
n AS (SELECT r, sum(w) AS n, sum(w) FILTER (a = b) AS same FROM w GROUP BY r),
s AS (SELECT r, v, sum(wa) AS wa, sum(wb) AS wb FROM (SELECT r, a AS v, w AS wa, 0 AS wb FROM w UNION ALL SELECT r, b, 0, w FROM w) GROUP BY ALL),
c AS (SELECT r, sum(wa * wb) AS pe, sum((wa + wb) * (wa + wb - 1)) AS cc FROM s GROUP BY r),
k AS (SELECT r, n, (same / n - pe / (n * n)) / (1 - pe / (n * n)) AS kappa, 1 - (1 - same / n) / (1 - cc / (2 * n * (2 * n - 1))) AS alpha FROM n JOIN c USING (r)),
l AS (SELECT r, n, 'kappa' AS measure, kappa AS x FROM k UNION ALL SELECT r, n, 'alpha', alpha FROM k)
SELECT measure, round(max(x) FILTER (r = 0), 6) AS estimate, round(quantile_cont(x, 0.025) FILTER (r > 0), 6) AS low, round(quantile_cont(x, 0.975) FILTER (r > 0), 6) AS high, (max(n) FILTER (r = 0))::BIGINT AS n FROM l GROUP BY measure""")
def agreement_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure.agreement_intervals(table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    return out.select("measure", *[F.round(c, 6).alias(c) for c in ("estimate", "low", "high")], "n")


# ---- ledger files ----


@query("SELECT event_id, user_id, event_type, value, props, event_id % 2 AS append FROM events")
def ledger_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events written to a ledger in two appends, and read back by byte ranges."""
    ledger_files.register(spark)
    path = scratch_path(spark, "ledger")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    for k in (0, 1):
        spread(events).where(F.col("event_id") % 2 == k).write.format(ledger_files.NAME).mode("append").save(path)
    lines = spark.read.format(ledger_files.NAME).load(path)
    return lines.select(F.from_json("value", "event_id long, user_id long, event_type string, value double, props string").alias("r"), "append").select("r.*", "append")
