"""Cases of reports, monitors, graphs, phases and scanned files over declared rows, with the same rule in SQL."""

from __future__ import annotations

from cases import case as query
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.operators import measure, prose, retrieve, scan
from auditloom.plans.gate_oracle import EXT as _EXT
from auditloom.plans.gate_oracle import OPAQUE as _OPAQUE
from auditloom.plans.registry import Given
from auditloom.plans.scan_oracle import RED, YELLOW, flags

_GOLD = Given("id long, a string, b string", [(i, "xy"[i % 2], "pq"[i % 2] if i % 10 else "") for i in range(40)])


_PRED = Given("id long, a string, b string", [(i, "xy"[i % 2], "pq"[(i // 2) % 2] if i % 7 else None) for i in range(40) if i % 20])


def _field_sql(f: str) -> str:
    return f"""SELECT '{f}' AS field, g.{f} AS gold, p.{f} AS pred, CASE WHEN g.{f} = '' THEN 'gold_empty' WHEN p.id IS NULL THEN 'absent' WHEN coalesce(p.{f}, '') = '' THEN 'blank' END AS why FROM {_GOLD.sql} g LEFT JOIN {_PRED.sql} p USING (id)"""


@query(f"""WITH s AS ({_field_sql('a')} UNION ALL {_field_sql('b')}), n AS (SELECT field, count(*) FILTER (why IS DISTINCT FROM 'gold_empty') AS n_gold, count(*) FILTER (why IS NULL) AS n_scored, avg((gold = pred)::INT) FILTER (why IS NULL) AS po FROM s GROUP BY field),
e AS (SELECT field, sum(x.c * coalesce(y.c, 0)) AS pe FROM (SELECT field, gold AS v, count(*) AS c FROM s WHERE why IS NULL GROUP BY ALL) x LEFT JOIN (SELECT field, pred AS v, count(*) AS c FROM s WHERE why IS NULL GROUP BY ALL) y USING (field, v) GROUP BY field),
k AS (SELECT field, n_gold, n_scored, n_scored / n_gold AS coverage, (po - pe / (n_scored * n_scored)) / (1 - pe / (n_scored * n_scored)) AS kappa FROM n JOIN e USING (field))
SELECT field, n_gold, n_scored, round(coverage, 6) AS coverage, round(kappa, 6) AS kappa, CASE WHEN coverage < 0.9 THEN 'coverage' WHEN kappa < 0.7 THEN 'kappa' END AS reason, CASE WHEN coverage < 0.9 OR kappa < 0.7 THEN 'RED' ELSE 'GREEN' END AS verdict FROM k""")
def field_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measure.agreement(_GOLD.frame(spark), _PRED.frame(spark), "id", ["a", "b"], least_coverage=0.9)
    return out.withColumns({"coverage": F.round("coverage", 6), "kappa": F.round("kappa", 6)})


@query("SELECT unnest(['none', 'key', 'doubled', 'zero', 'waived']) AS \"case\", unnest(['no fields to validate', 'the key is no field', 'duplicate ids', 'coverage check disabled', NULL]) AS reason, unnest(['RED', 'RED', 'RED', 'RED', 'GREEN']) AS verdict")
def agreement_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, pred = _GOLD.frame(spark), _PRED.frame(spark)
    cases = {
        "none": measure.agreement(gold, pred, "id", ["", ""]), "key": measure.agreement(gold, pred, "id", ["id"]), "doubled": measure.agreement(gold.union(gold.limit(1)), pred, "id", ["a"]),
        "zero": measure.agreement(gold, pred, "id", ["a"], least_coverage=0.0), "waived": measure.agreement(gold, pred, "id", ["a"], least_coverage=0.0, allow_zero_coverage=True),
    }
    out = None
    for name, df in cases.items():
        one = df.select(F.lit(name).alias("case"), "reason", "verdict")
        out = one if out is None else out.unionByName(one)
    return out


_REPORTS = Given("id long, report string", [
    (1, '{"schema_version":2,"fields":[{"field":"a","kappa":null}],"instrument":{}}'), (2, '{"schema_version":2,"fields":[{"kappa":NaN}]}'), (3, '{"schema_version":1,"fields":[{}]}'), (4, '{"schema_version":2,"fields":[]}'), (5, '{"fields":[{}]}'), (6, "{")])


@query(f"""SELECT id, CASE WHEN NOT json_valid(report) OR contains(report, 'NaN') THEN 'not strict JSON' WHEN coalesce(json_extract_string(report, '$.schema_version'), '') <> '2' THEN 'another version' WHEN json_array_length(report, '$.fields') = 0 THEN 'no fields' END AS problem FROM {_REPORTS.sql}""")
def report_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _REPORTS.frame(spark).select("id", measure.report_problem(F.col("report")).alias("problem"))


_FIGURES = Given("field string, n_scored long, kappa double", [("a", 60, 0.75), ("b", 10, None)])


@query("""SELECT '{"schema_version":2,"fields":[{"field":"a","n_scored":60,"kappa":0.75},{"field":"b","n_scored":10,"kappa":null}],"instrument":{"declared":true,"waived":false,"instrument_id":"rel-v3"}}' AS report""")
def report_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _FIGURES.frame(spark).withColumn("kappa", F.coalesce("kappa", F.lit(float("nan"))))
    return measure.report_json(rows, "rel-v3")


_CELLS = Given("sex string, age string", [(s, a) for s in "fm" for a in ("o", "y")])


@query()
def persona_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded draws from raked cells; the draws follow no distribution that SQL could be held to."""
    rows = measure.rake(_CELLS.frame(spark), {"sex": {"f": 0.6, "m": 0.4}, "age": {"y": 0.3, "o": 0.7}})
    drawn = measure.draw_personas(spark.createDataFrame(rows, "sex string, age string, w double"), 10_000, 7)
    return drawn.groupBy("sex", "age").agg(F.count("*").alias("n"))


@query("SELECT unnest(['allowed', 'missing']) AS \"case\", unnest([NULL, 'no subgroup correlation']) AS reason, unnest(['PASS', 'FAIL']) AS verdict")
def fidelity_without_subgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(q, s, x) for q, human in (("q1", (3, 4)), ("q2", (2, 3))) for s in ("sim", "man") for x in human * 4]
    v = spark.createDataFrame([(q, s, float(x)) for q, s, x in rows], "item string, side string, x double")
    items, out = measure.fidelity(v, "item", "side", "x", "sim", "man"), None
    for name, allowed in (("allowed", True), ("missing", False)):
        one = measure.fidelity_gate(v, items, "item", "side", "x", "sim", "man", allow_missing_subgroup=allowed).select(F.lit(name).alias("case"), "reason", "verdict")
        out = one if out is None else out.unionByName(one)
    return out


_SOURCES = Given("source string, enabled boolean, cadence_days int", [("asr", True, 7), ("arxiv", True, 1), ("ajs", False, 1), ("nhb", True, 7), ("new", True, 30)])


_CURSORS = Given("source string, last_run string, seen array<string>, total_seen long, last_error string", [
    ("asr", "2024-01-01 00:00:00", ["10.1/a", "10.1/b"], 12, None), ("arxiv", "2024-01-05 12:00:00", ["2401.1"], 3, "timeout"), ("ajs", None, [], 0, None), ("nhb", "2024-01-03 00:00:00", ["x"], 1, None)])


_RUNS = Given("source string, ok boolean, at string, items array<string>, error string", [("arxiv", True, "2024-01-08 00:00:00", ["2401.2v2", "2401.1v3", "2401.2"], None), ("asr", False, "2024-01-08 00:00:00", ["10.1/c"], "network"), ("new", True, "2024-01-08 00:00:00", ["n1"], None)])


@query(f"SELECT source, last_run FROM {_SOURCES.sql} LEFT JOIN {_CURSORS.sql} USING (source) WHERE enabled AND (last_run IS NULL OR epoch(TIMESTAMP '2024-01-08 00:00:00') - epoch(last_run::TIMESTAMP) >= cadence_days * 86400)")
def due_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _CURSORS.frame(spark).withColumn("last_run", F.to_timestamp("last_run"))
    out = retrieve.due(_SOURCES.frame(spark), state, F.lit("2024-01-08 00:00:00").cast("timestamp"))
    return out.withColumn("last_run", F.date_format("last_run", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT * FROM (VALUES ('asr', '2024-01-01 00:00:00', '10.1/a,10.1/b', 12, 'network'), ('arxiv', '2024-01-08 00:00:00', '2401.2,2401.1', 4, NULL), ('ajs', NULL, '', 0, NULL), ('nhb', '2024-01-03 00:00:00', 'x', 1, NULL), ('new', '2024-01-08 00:00:00', 'n1', 1, NULL)) v(source, last_run, seen, total_seen, last_error)""")
def advanced_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.advanced(_CURSORS.frame(spark), _RUNS.frame(spark), keep=2).withColumn("seen", F.array_join("seen", ","))


_PAPERS = Given("id string, title string, authors array<string>, year int, topic string", [("p1", "Wage Gaps", ["Lee, A.", "Xu, B."], 2001, "labor"), ("p2", "Gaps in Care", ["Diaz, C."], 2015, "health"), ("p3", "Methods of wages", [], None, "labor"), ("p4", "Voting", ["Lee, A."], 2020, "politics")])


_LINKS = Given("src string, dst string, kind string", [("p1", "p2", "cites"), ("p2", "p3", "extends"), ("p3", "p1", "extends"), ("p1", "p2", "contradicts"), ("p2", "p9", "cites"), ("p9", "p3", "extends")])


@query(f"SELECT id, (contains(lower(title), 'gap') OR contains(lower(title), 'wage'))::BIGINT + (contains(topic, 'gap') OR contains(topic, 'wage'))::BIGINT AS hits FROM {_PAPERS.sql} WHERE (contains(lower(title), 'gap') OR contains(topic, 'gap')) AND (contains(lower(title), 'wage') OR contains(topic, 'wage'))")
def graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.search(_PAPERS.frame(spark), "Gap wage", ["title", "topic"]).select("id", "hits")


@query(f"SELECT kind, 'out' AS direction, dst AS other FROM {_LINKS.sql} WHERE src = 'p2' UNION SELECT kind, 'in', src FROM {_LINKS.sql} WHERE dst = 'p2'")
def graph_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.relate(_LINKS.frame(spark), "p2")


@query(f"WITH RECURSIVE r(id, steps) AS (SELECT dst, 1 FROM {_LINKS.sql} WHERE src = 'p2' AND kind = 'extends' UNION SELECT l.dst, steps + 1 FROM r JOIN {_LINKS.sql} l ON l.src = r.id AND l.kind = 'extends' WHERE steps < 5) SELECT id, min(steps) AS steps FROM r WHERE id <> 'p2' GROUP BY id")
def graph_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.lineage(_LINKS.frame(spark), "p2")


@query(f"WITH e AS {_LINKS.sql}, n AS {_PAPERS.sql} SELECT 'nodes' AS what, count(*) AS n FROM n UNION ALL SELECT 'edges', count(*) FROM e UNION ALL SELECT 'edges: ' || kind, count(*) FROM e GROUP BY kind UNION ALL SELECT 'isolated', count(*) FROM n WHERE id NOT IN (SELECT src FROM e UNION SELECT dst FROM e)")
def graph_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.graph_status(_PAPERS.frame(spark), _LINKS.frame(spark))


@query(f"""WITH k AS (SELECT * FROM {_PAPERS.sql} WHERE topic IN ('labor', 'health')) SELECT 'node' AS what, id AS a, NULL AS b, '@article{{' || id || ',' || chr(10) || concat_ws(',' || chr(10), '  title = {{{{' || title || '}}}}', CASE WHEN true THEN '  author = {{' || array_to_string(authors, ' and ') || '}}' END, '  year = {{' || year || '}}') || chr(10) || '}}' AS entry FROM k
UNION ALL SELECT 'edge', src, dst, kind FROM {_LINKS.sql} WHERE src IN (SELECT id FROM k) AND dst IN (SELECT id FROM k)""")
def graph_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = retrieve.export(_PAPERS.frame(spark), _LINKS.frame(spark), F.col("topic").isin("labor", "health"))
    listed = retrieve.bibtex(nodes).select(F.lit("node").alias("what"), F.col("id").alias("a"), F.lit(None).cast("string").alias("b"), "entry")
    return listed.union(edges.select(F.lit("edge"), "src", "dst", "kind"))


_PROJECT = Given("path string, n_words long", [
    ("logs/safety-2024.md", 40), ("brief/scholar-idea-1.md", 300), ("lit/scholar-lrh-1.md", 1999), ("logs/search-log.md", 9), ("design/blueprint.md", 700), ("tables/t1.html", 9), ("figures/f1.png", 0), ("scripts/a.R", 10), ("scripts/coding-decisions-log.md", 20),
    ("reports/code-review-1.md", 200), ("drafts/draft-intro.md", 6000), ("reports/verify-log.md", 3), ("drafts/manuscript-final-1.md", 8000), ("drafts/manuscript-final-1.docx", 8000), ("replication-package/data/x.txt", 5), ("logs/ethics.md", 7)])


_STATE = Given("line string", [("## Phase 4 - data",), ("Target Journal: ASR",), ("status: existing-data",), ("variable list: age, sex",)])


_EXPECT = [
    ("-1", "safety log", 1, "PASS"), ("0-PRE", "brainstorm report", 0, "WARN"), ("0", "idea", 1, "PASS"), ("1", "target journal", 1, "PASS"), ("2", "literature review", 1, "PASS"), ("2", "literature review''s words", 1999, "FAIL"), ("2", "search log", 1, "PASS"), ("3", "design", 1, "PASS"),
    ("4", "variables", 0, "PASS"), ("4", "data status", 1, "PASS"), ("5", "tables", 1, "PASS"), ("5", "figures", 1, "PASS"), ("5", "tables as CSV", 0, "WARN"), ("5", "scripts", 1, "PASS"), ("5", "coding decisions", 1, "PASS"), ("5", "script index", 0, "WARN"), ("5.5", "code review", 1, "PASS"),
    ("6", "branch output", 0, "WARN"), ("7", "draft", 2, "PASS"), ("7", "draft''s words", 6000, "PASS"), ("7b", "verification report", 0, "FAIL"), ("7c", "polished draft", 2, "PASS"), ("9", "cover letter", 0, "WARN"), ("9", "replication package", 1, "PASS"), ("9", "replication code", 0, "WARN"),
    ("9", "replication readme", 0, "WARN"), ("9b", "ethics report", 0, "FAIL"), ("10", "review simulation", 0, "FAIL"), ("11", "final md", 1, "PASS"), ("11", "final docx", 1, "PASS"), ("11", "final tex", 0, "FAIL"), ("11", "final pdf", 0, "FAIL"),
]


_EXPECTED = "(VALUES " + ", ".join(f"('{p}', '{label}', {n}, '{s}')" for p, label, n, s in _EXPECT) + ") v(phase, label, found, state)"


@query(f"SELECT phase, label, found::BIGINT AS found, state FROM {_EXPECTED}")
def phase_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prose.phase_states(_PROJECT.frame(spark), _STATE.frame(spark))


@query(f"SELECT phase, count(*) FILTER (state = 'FAIL') AS issues, count(*) FILTER (state = 'WARN') AS warnings, CASE WHEN count(*) FILTER (state = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) FILTER (state = 'WARN') > 0 THEN 'PASS with warnings' ELSE 'PASS' END AS verdict FROM {_EXPECTED} GROUP BY phase")
def phase_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prose.phase_verdict(prose.phase_states(_PROJECT.frame(spark), _STATE.frame(spark)))


_HEADINGS = Given("id long, line string", list(enumerate(["## Phase 7 — draft", "Phase 7", "Phase 7b", "## Phase 7-x", "- Phase 7: y", "see Phase 7", "### Phase 7(a)", "Phase 7.1", "## Phase 70", "# Phase 7"])))


@query(f"SELECT id, regexp_matches(line, '^(?:## |### |- )?Phase 7(?:[ \t]|—|:|[(]|$)') AS heading, contains(line, 'Phase 7') AS mentioned FROM {_HEADINGS.sql}")
def phase_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _HEADINGS.frame(spark).select("id", prose.phase_heading(F.col("line"), "7").alias("heading"), F.col("line").contains("Phase 7").alias("mentioned"))


@query("SELECT true AS seven, false AS eight, NULL::BOOLEAN AS none")
def phase_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _HEADINGS.frame(spark)
    return prose.logged(log, "7").toDF("seven").crossJoin(prose.logged(log, "8").toDF("eight")).crossJoin(prose.logged(log.limit(0), "7").toDF("none"))  # one row each


_LENGTHS = Given("path string, n_lines long", [("a.md", 2), ("b.md", 3)])


@query("SELECT 'too short' AS a, 'present' AS b, 'missing' AS c")
def phase_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _LENGTHS.frame(spark)
    return prose.file_present(files, "a.md").toDF("a").crossJoin(prose.file_present(files, "b.md").toDF("b")).crossJoin(prose.file_present(files, "c.md").toDF("c"))  # one row each


_FILES = Given("path string, text string", [
    ("/p/a.csv", "plain words"), ("/p/b.parquet", "plain words"), ("/p/c.DTA", "patient_id"), ("/p/d.pdf", "me@site.org"), ("/p/e", None), ("/p/f.xlsx", None), ("/p/g.tar.gz", "ok"),
    ("/p/h.txt ", "ok"), ("/p.wav/i", "ok"), ("/p/j.png", "SSN: 123-45-6789"), ("/p/k.md", "")])






@query(f"WITH g AS {_FILES.sql}, f AS (SELECT path, text, {flags('text')} FROM g) SELECT path, CASE WHEN {RED} > 0 THEN 'RED' WHEN {YELLOW} > 0 OR text IS NULL OR {_EXT} IN ({_OPAQUE}) THEN 'YELLOW' ELSE 'GREEN' END AS verdict FROM f")
def scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.scan(_FILES.frame(spark), path="path").select("path", "verdict")


@query(f"SELECT path, 'BINARY_FORMAT' AS entity, 1.0::DOUBLE AS score, '.' || {_EXT} AS value FROM {_FILES.sql} WHERE {_EXT} IN ({_OPAQUE})")
def opaque_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.opaque_findings(_FILES.frame(spark), ["path"], "path")
