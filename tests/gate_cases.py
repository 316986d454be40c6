"""Gates over declared rows: each case of a rule once, with the same rule written in SQL beside it."""

from __future__ import annotations

from cases import case as query
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.operators import anonymize, ledger, measure, review, scan, status, trace
from auditloom.plans.gate_oracle import AUDIT_OK as _AUDIT_OK, failed as _FAILED, IN as _IN, IS_DATA as _IS_DATA, KNOWN_EXT as _KNOWN_EXT, MEDIA as _MEDIA, QUAL_SQL as _QUAL_SQL, RAW_SQL as _RAW_SQL, SYSTEM as _SYSTEM, TAIL as _TAIL, VALID as _VALID, WRITING as _WRITING
from auditloom.plans.registry import Given, quoted
from auditloom.sources import sinks
from auditloom.sources.tables import parse_ndjson

# ---- safety status ----

_STATES = Given("status string", [(x,) for x in ("CLEARED", "ANONYMIZED", "OVERRIDE", "LOCAL_MODE", "HALTED", "NEEDS_REVIEW", "NEEDS_REVIEW:RED", "NEEDS_REVIEW:", "cleared", "TYPOED", "", None)])


@query(f"SELECT status, {_VALID} AS valid FROM {_STATES.sql}")
def status_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _STATES.frame(spark).select("status", status.valid_status(F.col("status")).alias("valid"))


_SIDECARS = Given("json string", [('{"/d/a.csv":"CLEARED","/d/b":"TYPO","_safety_level":"bogus","_other":"x","/d/c":{"a":1},"/d/e":"NEEDS_REVIEW:"}',), ('{"/d/f":"HALTED","_safety_level":"strict"}',), ('["CLEARED"]',), ("{broken",)])


@query(f"""WITH s AS {_SIDECARS.sql}, e AS (SELECT unnest(json_keys(json)) AS path, json FROM s WHERE json_valid(json) AND json_type(json) = 'OBJECT'), v AS (SELECT path, json_type(json, '/' || replace(path, '/', '~1')) AS kind, json_extract_string(json, '/' || replace(path, '/', '~1')) AS status FROM e)
SELECT path, reason FROM (SELECT path, CASE WHEN path = '_safety_level' THEN CASE WHEN status NOT IN ('standard', 'strict', 'lockdown') THEN 'invalid safety level' END WHEN starts_with(path, '_') THEN 'unknown meta key' WHEN kind <> 'VARCHAR' THEN 'status is not a string' WHEN NOT {_VALID} THEN 'invalid status' END AS reason FROM v) WHERE reason IS NOT NULL
UNION ALL SELECT '<root>', 'not a JSON object' FROM s WHERE NOT json_valid(json) OR json_type(json) <> 'OBJECT'""")
def sidecar_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.sidecar_problems(_SIDECARS.frame(spark))


_SETTINGS = Given("id long, project string, environment string", [(1, "strict", "lockdown"), (2, None, "lockdown"), (3, "odd", None), (4, "odd", "strict"), (5, None, None), (6, "Strict", "odd")])


@query(f"SELECT id, CASE WHEN project IN ('standard', 'strict', 'lockdown') THEN project WHEN environment IN ('standard', 'strict', 'lockdown') THEN environment ELSE 'standard' END AS level FROM {_SETTINGS.sql}")
def safety_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _SETTINGS.frame(spark).select("id", status.safety_level(F.col("project"), F.col("environment")).alias("level"))


_PATHS = Given("path string, lexical string", [(p, p) for p in (
    "/p/x.csv", "/p/x.WAV", "/p/a.trs", "/p/a.geojson", "/p/a.png", "/p/notes.txt", "/p/README.md", "/p/data/README.md", "/p/materials/consent.odt", "/p/subjects/s1.doc", "/p/config.json", "/p/corpus/c.json", "/p/materials/c.json",
    "/p/data/raw/dump", "/p/inputs/secret", "/p/photos/x.py", "/p/field_notes/n1", "/p/Transcripts/t.rtf", "/p/script.py", "/p/x.csv ", "/p/source_images/i.tiff", "/p/media/a.xyz", "/p/scans", "/p/transcripts", "/p/data/interim", "/p/output/t.tex", "/data.d/x")] + [
    ("/else/x.bin", "/p/data/raw/x.bin"), ("/else/x.py", "/p/interviews/x.py")])


@query(f"WITH g AS (SELECT path, lower(path) AS p, lower(lexical) AS l FROM {_PATHS.sql}), e AS (SELECT *, {_TAIL} AS ext FROM g) SELECT path, {_IS_DATA} AS data, {_RAW_SQL('p')} OR {_RAW_SQL('l')} AS raw, {_QUAL_SQL('p')} OR {_QUAL_SQL('l')} AS qualitative FROM e")
def path_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, w = F.col("path"), F.col("lexical")
    return _PATHS.frame(spark).select("path", status.is_data(p, w).alias("data"), status.is_raw(p, w).alias("raw"), status.is_qualitative(p, w).alias("qualitative"))


_READS = Given("path string, status string, verdict string", [
    ("/p/data/a.csv", "CLEARED", "RED"), ("/p/data/a.csv", "ANONYMIZED", "RED"), ("/p/data/a.csv", "OVERRIDE", "RED"), ("/p/data/a.csv", "LOCAL_MODE", "GREEN"), ("/p/data/a.csv", "HALTED", "GREEN"), ("/p/data/a.csv", "NEEDS_REVIEW:RED", "GREEN"),
    ("/p/data/a.csv", "NEEDS_REVIEW", "GREEN"), ("/p/data/a.csv", None, "GREEN"), ("/p/data/a.csv", None, "YELLOW"), ("/p/data/a.csv", None, None), ("/p/a.csv", "cleared", "GREEN"), ("/p/a.wav", "OVERRIDE", "GREEN"), ("/p/a.cha", "OVERRIDE", "GREEN"),
    ("/p/a.praat", "CLEARED", "RED"), ("/p/transcripts/a.txt", "OVERRIDE", "GREEN"), ("/p/participants/a.odt", "OVERRIDE", "GREEN"), ("/p/materials/consent/p1.txt", "OVERRIDE", "GREEN"), ("/p/materials/code.py", "OVERRIDE", "GREEN"), ("/p/notes/a.txt", None, "RED"),
    ("/p/data/raw/a.png", None, None), ("/p/fig/a.png", None, None), ("/p/fig/a.png", "HALTED", None), ("/etc/passwd", "CLEARED", "GREEN"), ("/System/x.csv", "CLEARED", "GREEN"), ("/var/db/x.csv", None, "GREEN"), ("/private/var/log/x.csv", "CLEARED", "GREEN"),
    ("/private/etc", None, None), ("/root/x.csv", None, "GREEN"), ("/boot/x.csv", "CLEARED", "RED"), ("/etcetera/x.csv", None, "GREEN"), ("/p/script.py", None, "RED")])


@query(f"""WITH g AS (SELECT *, lower(path) AS p, lower(path) AS l FROM {_READS.sql}), e AS (SELECT *, {_TAIL} AS ext FROM g),
r AS (SELECT path, status, verdict, CASE WHEN {_SYSTEM} THEN 'system path' WHEN NOT {_IS_DATA} THEN 'not data' WHEN status IS NOT NULL AND NOT {_VALID} THEN 'invalid status'
  WHEN status = 'OVERRIDE' AND (ext IN ({_MEDIA}) OR (ext IN ({_WRITING}) AND {_QUAL_SQL('p')})) THEN 'override refused' WHEN status IN ('CLEARED', 'ANONYMIZED', 'OVERRIDE') THEN 'status allows' WHEN status IS NOT NULL THEN 'status blocks'
  WHEN ext IN ('jpg', 'jpeg', 'png', 'tiff', 'tif', 'heic', 'heif', 'bmp', 'webp', 'gif') THEN CASE WHEN {_RAW_SQL('p')} THEN 'raw image' ELSE 'image' END WHEN verdict = 'GREEN' THEN 'scan is green' ELSE 'scan blocks' END AS reason FROM e)
SELECT *, CASE WHEN reason IN ('not data', 'status allows', 'image', 'scan is green') THEN 'ALLOW' ELSE 'BLOCK' END AS decision FROM r""")
def read_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision, reason = status.decide(F.col("path"), F.col("status"), F.col("verdict"), F.col("path"))
    return _READS.frame(spark).select("path", "status", "verdict", reason.alias("reason"), decision.alias("decision"))


_FILES = Given("path string", [("/a/b/c/f.csv",), ("/a/x.csv",), ("/z/y.csv",), ("/a/b",), ("/ab/c/f",), ("f",)])
_ROOTS = Given("dir string", [("/a",), ("/a/b",), ("/ab/c",)])


@query(f"SELECT path, (SELECT dir FROM {_ROOTS.sql} r WHERE starts_with(f.path, r.dir || '/') ORDER BY length(dir) DESC LIMIT 1) AS root FROM {_FILES.sql} f")
def nearest_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.nearest_root(_FILES.frame(spark), _ROOTS.frame(spark))


_ASKED = Given("canonical string, lexical string, raw string", [("/r/a.csv", "/l/a.csv", "a.csv"), ("/r/b.csv", "/l/b.csv", "b.csv"), ("/r/c.csv", "/l/c.csv", "x/c.csv"), ("/r/d.csv", "/l/d.csv", "y/d.csv")])
_SAID = Given("path string, status string", [("/l/a.csv", "HALTED"), ("/r/a.csv", "CLEARED"), ("/l/b.csv", "HALTED"), ("c.csv", "OVERRIDE"), ("y/d.csv", "LOCAL_MODE")])


@query(f"WITH s AS {_SAID.sql} SELECT canonical, coalesce((SELECT status FROM s WHERE path = canonical), (SELECT status FROM s WHERE path = lexical), (SELECT status FROM s WHERE path = raw)) AS status FROM {_ASKED.sql}")
def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.lookup_status(_ASKED.frame(spark), _SAID.frame(spark)).select("canonical", "status")


_CALLS = Given("id long, tool string, path string, cwd string, root string, pattern string, is_folder boolean, exists boolean, status string, verdict string, target string, dumps boolean, promotes boolean", [
    (1, "Grep", "/p/data/raw", "/p", "/p", "x", True, True, None, None, None, None, None), (2, "Grep", None, "/p", "/p", "x", True, True, None, None, None, None, None), (3, "Grep", "/p/sub", "/p", "/p", "x", True, True, None, None, None, None, None),
    (4, "Grep", "/p/t.csv", "/p", "/p", "x", False, True, None, None, None, None, None), (5, "Grep", None, None, None, "x", None, True, None, None, None, None, None), (6, "Grep", "/p/interviews/i1.txt", "/p", "/p", "x", False, True, None, None, None, None, None),
    (7, "Glob", None, "/p", "/p", "**/*.py", None, True, None, None, None, None, None), (8, "Glob", None, "/p", "/p", "Scripts/**/*.py", None, True, None, None, None, None, None), (9, "Glob", None, "/p", "/p", "./output/**/*.csv", None, True, None, None, None, None, None),
    (10, "Glob", "/p", "/p/sub", "/p", "*.py", None, True, None, None, None, None, None), (11, "Glob", None, "/q", None, "data/raw/**/*.txt", None, True, None, None, None, None, None), (12, "Glob", None, "/q", None, "**/*.csv*", None, True, None, None, None, None, None),
    (13, "Glob", None, "/q", None, "", None, True, None, None, None, None, None), (14, "Glob", None, "/q", None, "src/*.py", None, True, None, None, None, None, None), (15, "Read", "/p/data/a.csv", "/p", "/p", None, False, True, None, "RED", None, None, None),
    (16, "Read", "/p/data/a.csv", "/p", "/p", None, False, False, None, "RED", None, None, None), (17, "NotebookRead", "/p/x.ipynb", "/p", "/p", None, False, True, None, None, None, None, None), (18, "Bash", None, "/p", "/p", None, None, None, None, None, "/p/data/raw/x.csv", True, None),
    (19, "Bash", None, "/p", "/p", None, None, None, None, None, "/p/data/raw/x.csv", False, None), (20, "Bash", None, "/p", "/p", None, None, None, None, None, None, True, None), (21, "Write", "/p/.claude/safety-status.json", "/p", "/p", None, None, True, None, None, None, None, True),
    (22, "Edit", "/p/.claude/safety-status.json", "/p", "/p", None, None, True, None, None, None, None, False), (23, "MultiEdit", "/p/m.md", "/p", "/p", None, None, True, None, None, None, None, True), (24, "Task", "/p/data/raw/x.csv", "/p", "/p", None, None, True, None, None, None, None, None),
    (25, "Read", None, "/p", "/p", None, None, None, None, None, None, None, None)])
_SAFE = " OR ".join(f"q = '{n}' OR starts_with(q, '{n}/')" for n in ("scripts", "drafts", "output", "figures", "tables", "reports", "protocols", "logs", "eda", "replication", "presentation", "citations", ".claude"))
_RAW_S, _QUAL_S, _RAW_T, _QUAL_T = _RAW_SQL("lower(scope)"), _QUAL_SQL("lower(scope)"), _RAW_SQL("place"), _QUAL_SQL("place")


@query(f"""WITH c AS (SELECT *, coalesce(path, cwd) AS scope, lower(path) AS p, lower(path) AS l, regexp_extract(pattern, '^[^*?\\[{{]*') AS plain FROM {_CALLS.sql}),
d AS (SELECT *, {_TAIL} AS ext, regexp_replace(lower(plain), '^[.]/', '') AS q, CASE WHEN plain <> '' THEN lower(rtrim(CASE WHEN starts_with(plain, '/') THEN plain ELSE cwd || '/' || regexp_replace(plain, '^[.]/', '') END, '/')) END AS place,
  regexp_extract(lower(pattern), '[.]([^.*?\\[{{]*)[^.]*$', 1) AS wild, {_TAIL.replace('(p', '(lower(coalesce(path, cwd))')} AS tail FROM c),
r AS (SELECT id, tool, CASE
  WHEN tool IN ('Read', 'NotebookRead', 'NotebookEdit') THEN CASE WHEN path IS NULL THEN 'no target' WHEN NOT exists THEN 'no such file' WHEN NOT {_IS_DATA} THEN 'not data' WHEN verdict = 'GREEN' THEN 'scan is green' ELSE 'scan blocks' END
  WHEN tool = 'Grep' THEN CASE WHEN scope IS NULL THEN 'no scope' WHEN {_RAW_S} OR {_QUAL_S} THEN 'data folder' WHEN scope = root THEN 'project root' WHEN tail IN ({_KNOWN_EXT}) AND NOT coalesce(is_folder, false) THEN 'data file' ELSE 'outside' END
  WHEN tool = 'Glob' THEN CASE WHEN scope = root AND NOT ({_SAFE}) THEN 'project root' WHEN pattern = '' THEN 'no pattern' WHEN {_RAW_T} OR {_QUAL_T} THEN 'data folder' WHEN wild IN ({_KNOWN_EXT}) THEN 'data extension' WHEN scope = root THEN 'safe subtree' ELSE 'outside' END
  WHEN tool = 'Bash' THEN CASE WHEN target IS NULL THEN 'no target' WHEN dumps THEN 'prints data' ELSE 'aggregate only' END
  WHEN tool IN ('Edit', 'Write', 'MultiEdit') THEN CASE WHEN NOT ends_with(path, '/safety-status.json') THEN 'not the sidecar' WHEN promotes THEN 'promotion without review' ELSE 'no promotion' END ELSE 'not gated' END AS reason FROM d)
SELECT id, reason, CASE WHEN reason IN ('no scope', 'data folder', 'project root', 'data file', 'data extension', 'scan blocks', 'prints data', 'promotion without review') THEN 'BLOCK' ELSE 'ALLOW' END AS decision FROM r""")
def tool_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.route(_CALLS.frame(spark).withColumn("lexical", F.col("path"))).select("id", "reason", "decision")


_COMMANDS = Given("id long, command string", list(enumerate([
    "cat data/raw/x.csv", "head -5 data/raw/x.csv", "sed -n '1,5p' data/raw/x.csv", "awk 'NR<5' data/raw/x.csv", "od -c data/raw/x.csv", "base64 data/raw/x.csv", "echo $(cat data/raw/x.csv)", "cat < data/raw/x.csv", "env cat data/raw/x.csv",
    "grep 123 data/raw/x.csv", "python3 -c \"print(open('data/raw/x.csv').read())\"", "Rscript -e 'd<-read.csv(\"data/raw/x.csv\"); print(head(d))'", 'D=data/raw; cat "$D/x.csv"', "ruby -e 'puts File.read(\"data/raw/x.csv\")'", "cat output/tables/results.csv", "jq . .claude/safety-status.json",
    "grep -c 123 data/raw/x.csv", "wc -l data/raw/x.csv", "cp data/raw/x.csv data/interim/y.csv", "Rscript -e 'd<-read.csv(\"data/raw/x.csv\"); cat(\"N=\", nrow(d))'", "python3 -c \"import pandas as pd; df=pd.read_csv('data/raw/x.csv'); print(df.dtypes)\"", "ls -la data/raw", "cat cleared.csv", "cat README.md",
    "git status", "", "ruby -e 'IO.foreach(\"data/raw/x.csv\"){|l| puts l}'", 'grep -nE "nodata/raw|nodata/" script.sh', "cat data/raw/*.csv", "cat corpus/transcripts/*.txt", 'D=data; cat "$D/raw/x.csv"', 'D=data/raw; cat "${D}/x.csv"', 'export D=data/raw; cat "$D/x.csv"', 'BASE=data; D="$BASE/raw"; cat "$D/x.csv"',
    'D=nowhere/data/raw; cat "$D/x.csv"', 'D=output/tables; cat "$D/results.csv"', "file data/raw/x.csv", "Rscript -e 'd<-read.csv(\"/b s/data/raw/x.csv\"); print(d)'", "python3 -c \"import pandas as pd; print(len(pd.read_csv('/b s/data/raw/x.csv')))\"",
    "python3 -c \"import pandas as pd; print(pd.read_csv('/b s/data/raw/x.csv').to_string())\"", "/usr/bin/time -p /bin/cat data/raw/x.csv", "A=1 sudo tail data/raw/x.csv", "rg -l x data/raw", "cat link.csv"])))
_VERB = r"^\s*(?:(?:\S*=\S*|env|command|builtin|nohup|nice|stdbuf|time|sudo|exec|then|do)\s+)*(\S+)"
_FIRST = lambda c: f"lower(regexp_replace(regexp_extract({c}, {quoted(_VERB)}, 1), '^.*/', ''))"
_CODE = r"open\s*\([^)\n]*\)\s*\.\s*read\s*\(|readLines\s*\(|\.to_string\s*\(|\.to_csv\s*\(\s*\)|\.(?:head|tail|sample|iloc|values|to_dict)\s*[(\[]|(?:^|[^\w.])(?:head|tail|str|View)\s*\(\s*[A-Za-z_.]|(?:^|[^\w.])print\s*\(\s*[A-Za-z_]\w*\s*\)|cat\s*\([^)\n]*\$|File\.read|readFileSync|file_get_contents|io\.read"


@query(f"""WITH c AS {_COMMANDS.sql}, s AS (SELECT id, unnest(regexp_split_to_array(command, '[|;&()`\n]')) AS seg FROM c),
g AS (SELECT id, bool_or({_FIRST('seg')} IN ('cat', 'tac', 'nl', 'rev', 'head', 'tail', 'more', 'less', 'bat', 'fold', 'od', 'xxd', 'hexdump', 'hd', 'strings', 'base64', 'base32', 'column', 'csvlook', 'csvcut', 'xsv', 'mlr', 'datamash', 'pbcopy', 'zcat', 'gzcat', 'bzcat', 'xzcat', 'sqlite3', 'duckdb', 'jq', 'yq', 'open', 'textutil', 'sed', 'awk', 'gawk', 'nawk', 'mawk', 'perl')
  OR ({_FIRST('seg')} IN ('grep', 'egrep', 'fgrep', 'rg', 'ag', 'ack') AND NOT regexp_matches(' ' || seg || ' ', ' (?:-c|--count|-l|--files-with-matches|-L|--files-without-match|-q|--quiet) '))) AS dumps FROM s GROUP BY id)
SELECT id, CASE WHEN {_FIRST('command')} IN ('python', 'python2', 'python3', 'rscript', 'r', 'ruby', 'node', 'nodejs', 'php', 'lua') THEN regexp_matches(command, {quoted(_CODE)}) ELSE coalesce(dumps, false) END AS dumps FROM c LEFT JOIN g USING (id)""")
def shell_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _COMMANDS.frame(spark).select("id", status.dumps_data(F.col("command")).alias("dumps"))


_THERE = Given("path string", [(f"/proj/{p}",) for p in ("data", "data/raw", "data/raw/x.csv", "output/tables/results.csv", ".claude/safety-status.json", "cleared.csv", "README.md", "script.sh", "corpus/transcripts", "corpus/transcripts/i01.txt", "link.csv")] + [("/b s/data/raw/x.csv",)])
_REVIEWED = Given("path string, status string", [("/proj/data/raw/x.csv", "NEEDS_REVIEW:RED"), ("/proj/cleared.csv", "CLEARED"), ("/far/x.csv", "LOCAL_MODE")])
_LINKS = Given("path string, target string", [("/proj/link.csv", "/far/x.csv")])


@query()
def shell_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands, what they read and whether they may; their words follow no grammar that SQL knows."""
    commands = _COMMANDS.frame(spark).withColumn("cwd", F.lit("/proj"))
    found = status.sensitive_targets(commands, _THERE.frame(spark), _REVIEWED.frame(spark), _LINKS.frame(spark))
    calls = found.withColumns({"tool": F.lit("Bash"), "dumps": status.dumps_data(F.col("command")), "path": F.lit(None).cast("string"), "lexical": F.lit(None).cast("string"), "root": F.lit("/proj"), "pattern": F.lit(None).cast("string"),
        "is_folder": F.lit(None).cast("boolean"), "exists": F.lit(True), "status": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string"), "promotes": F.lit(False)})
    return status.route(calls).select("id", "command", "target", "reason", "decision")


_BEFORE = Given("path string, status string", [("/p/a", "HALTED"), ("/p/b", "NEEDS_REVIEW:RED"), ("/p/c", "CLEARED"), ("/p/d", "LOCAL_MODE"), ("/p/e", "NEEDS_REVIEW:YELLOW"), ("/p/f", "NEEDS_REVIEW:YELLOW"), ("/p/g", "HALTED"), ("_safety_level", "HALTED")])
_AFTER = Given("path string, status string", [("/p/a", "CLEARED"), ("/p/b", "OVERRIDE"), ("/p/c", "CLEARED"), ("/p/d", "OVERRIDE"), ("/p/e", "CLEARED"), ("/p/f", "CLEARED"), ("/p/g", "LOCAL_MODE"), ("/p/new", "CLEARED"), ("_safety_level", "CLEARED")])
_LOG = Given("path string", [("/p/b",), ("d",)])
_SCANS = Given("path string, verdict string", [("/p/f", "RED"), ("/p/new", "RED"), ("/p/e", "YELLOW")])


@query(f"""WITH b AS {_BEFORE.sql}, a AS {_AFTER.sql}, l AS {_LOG.sql}, s AS {_SCANS.sql} SELECT a.path, b.status AS was, a.status FROM a LEFT JOIN b USING (path) LEFT JOIN s USING (path)
WHERE a.status IN ('CLEARED', 'OVERRIDE') AND NOT starts_with(a.path, '_') AND (b.status IN ('NEEDS_REVIEW:RED', 'HALTED', 'LOCAL_MODE') OR s.verdict = 'RED') AND a.path NOT IN (FROM l) AND parse_filename(a.path) NOT IN (FROM l)""")
def sidecar_tamper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.promoted_without_review(_BEFORE.frame(spark), _AFTER.frame(spark), _LOG.frame(spark), _SCANS.frame(spark))


_FOLDERS = Given("path string", [("/d/raw",), ("/d/interim",)])
_CLOSED = Given("path string, status string", [("/d/raw/a", "HALTED"), ("/e/b", "NEEDS_REVIEW"), ("/f", "CLEARED"), ("/g", "LOCAL_MODE"), ("/x/y", "NEEDS_REVIEW:RED")])
_TARGETS = Given("target string", [("/x/y",), ("/d/raw/z",), ("/d/raw",), ("/x/w",)])


@query(f"""WITH f AS {_FOLDERS.sql}, m AS (SELECT path FROM {_CLOSED.sql} WHERE regexp_matches(status, 'LOCAL_MODE|HALTED|NEEDS_REVIEW') UNION SELECT target FROM {_TARGETS.sql})
SELECT path FROM f UNION SELECT path FROM m WHERE NOT EXISTS (SELECT 1 FROM f WHERE m.path = f.path OR starts_with(m.path, f.path || '/'))""")
def deny_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.deny_set(_FOLDERS.frame(spark), _CLOSED.frame(spark), _TARGETS.frame(spark))


@query(f"""WITH f AS {_FOLDERS.sql}, m AS (SELECT path FROM {_CLOSED.sql} WHERE regexp_matches(status, 'LOCAL_MODE|HALTED|NEEDS_REVIEW') UNION SELECT target FROM {_TARGETS.sql}),
d AS (SELECT path FROM f UNION SELECT path FROM m WHERE NOT EXISTS (SELECT 1 FROM f WHERE m.path = f.path OR starts_with(m.path, f.path || '/')))
SELECT 0 AS line_no, '[permissions]' AS markdown UNION ALL SELECT (row_number() OVER (ORDER BY encode(path)))::INT, '"' || path || '" = "none"' FROM d""")
def deny_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.deny_toml(status.deny_set(_FOLDERS.frame(spark), _CLOSED.frame(spark), _TARGETS.frame(spark)))


@query(f"SELECT '{{' || string_agg('\"' || path || '\":\"' || status || '\"', ',' ORDER BY encode(path)) || '}}' AS value FROM {_CLOSED.sql}")
def sidecar_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.sidecar_json(_CLOSED.frame(spark))


_TREE = Given("path string", [("/p/a.py",), ("/p/a.csv",), ("/p/data/raw/n.md",), ("/p/b.py",), ("/p/x.wav",), ("/p/materials/a.txt",), ("/p/media/a.png",), ("/p/y.por",), ("/p/z.RDA",), ("/p/sub/b.py",), ("/p/.git/config",), ("/p/notes.md",), ("/p/t.sas7bdat",)])
_MARKED = Given("path string, status string", [("/q/b.py", "NEEDS_REVIEW:RED"), ("/q/notes.md", "CLEARED")])
_MICRO = "'dta', 'sav', 'por', 'zsav', 'rds', 'rdata', 'rda', 'parquet', 'feather', 'sas7bdat', 'xpt', 'dbf'"
_KEPT = f"NOT {_IN('data raw materials .git node_modules', 'path')} AND ext NOT IN ({_MICRO}) AND parse_filename(path) NOT IN (SELECT parse_filename(path) FROM {_MARKED.sql} WHERE regexp_matches(status, '^(LOCAL_MODE|HALTED|NEEDS_REVIEW)'))"


@query(f"WITH g AS (SELECT path, lower(path) AS p, lower(path) AS l FROM {_TREE.sql}), e AS (SELECT *, {_TAIL} AS ext FROM g) SELECT path, NOT {_IS_DATA} AS strictly FROM e WHERE {_KEPT}")
def mirror_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    strictly = status.shareable(_TREE.frame(spark), _MARKED.frame(spark)).withColumn("strictly", F.lit(True))
    return status.shareable(_TREE.frame(spark), _MARKED.frame(spark), strict=False).join(strictly, "path", "left").fillna(False)


_MIRROR = Given("path string, target string", [("/m/a.py", None), ("/m/x.dta", None), ("/m/s/b.py", None), ("/m/data/x.md", None), ("/m/l1", "/m/a.py"), ("/m/l2", "/etc/x")])


@query(f"""SELECT path, CASE WHEN lower(path) LIKE '%.dta' THEN 'microdata' WHEN parse_filename(path) = 'b.py' THEN 'restricted file' WHEN contains(path, '/data/') THEN 'data folder' ELSE 'link leads out' END AS reason FROM {_MIRROR.sql}
WHERE lower(path) LIKE '%.dta' OR parse_filename(path) = 'b.py' OR contains(path, '/data/') OR NOT starts_with(target, '/m/')""")
def mirror_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.leaks(_MIRROR.frame(spark), _MARKED.frame(spark), "/m")


_PLACES = Given("path string", [("/a/b/f",), ("/z",), ("/a",), ("/k",), ("/" + "/".join("abcdefghijkl"),), ("/z/deep/er",)])
_CARS = Given("dir string, text string", [("/a/b", '{"x":"local_mode"}'), ("/z", "{}"), ("/k/m/n", "LOCAL_MODE"), ("/a", "LOCAL_MODE here")])


@query(f"""WITH m AS (SELECT dir FROM {_CARS.sql} WHERE contains(lower(text), 'local_mode')) SELECT path, EXISTS (SELECT 1 FROM m WHERE dir = path OR starts_with(dir, path || '/') OR
(starts_with(path, dir || '/') AND len(string_split(path, '/')) - len(string_split(dir, '/')) <= 7)) AS local_mode FROM {_PLACES.sql}""")
def local_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.local_mode(_PLACES.frame(spark), _CARS.frame(spark)).select("path", "local_mode")


_GUARDS = Given("level string, restricted long", [("standard", 5), ("strict", 0), ("strict", 1), ("lockdown", 2), (None, 3)])


@query(f"SELECT level, restricted, level IN ('strict', 'lockdown') AND restricted > 0 AS active FROM {_GUARDS.sql}")
def output_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _GUARDS.frame(spark).select("level", "restricted", scan.guard_active(F.col("level"), F.col("restricted")).alias("active"))


# ---- anonymisation ----

_FINDS = Given("start long, value string, entity string, score double", [
    (0, "Ann", "PERSON", 0.9), (0, "Ann", "NRP", 0.95), (9, "Bo", "PERSON", 0.59), (20, "Bo", "PERSON", 0.6), (30, "x@y.org", "EMAIL_ADDRESS", 0.4), (40, "1.2.3.4", "IP_ADDRESS", 0.39), (50, "Oslo", "LOCATION", 0.85), (60, "dob", "DATE_OF_BIRTH", 0.85),
    (70, "  ", "PERSON", 0.9), (80, "today", "DATE_TIME", 0.99), (90, "http://x", "URL", 0.9), (95, "Ann", "PERSON", 0.7), (99, "mrn", "HIPAA_IDENTIFIER", 0.7), (110, "5555", "CREDIT_CARD", 1.0), (120, "Rome", "LOCATION", 0.85), (130, "555-1212", "PHONE_NUMBER", 0.75), (140, "IBAN", "IBAN_CODE", 1.0), (150, "123-45-6789", "US_SSN", 0.5)])
_FLOORS = "CASE entity WHEN 'PERSON' THEN 0.6 WHEN 'LOCATION' THEN 0.5 WHEN 'INSTITUTION' THEN 0.5 WHEN 'EMAIL_ADDRESS' THEN 0.4 WHEN 'PHONE_NUMBER' THEN 0.4 WHEN 'US_SSN' THEN 0.4 WHEN 'CREDIT_CARD' THEN 0.4 WHEN 'IP_ADDRESS' THEN 0.4 WHEN 'DATE_OF_BIRTH' THEN 0.7 WHEN 'HIPAA_IDENTIFIER' THEN 0.6 END"
_REPLACED = f"d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY score DESC, entity) AS r FROM {_FINDS.sql} WHERE score >= 0.35) WHERE r = 1 AND score >= {_FLOORS} AND trim(value) <> '')"


@query(f"WITH {_REPLACED} SELECT start, entity, value, score FROM d")
def replaced_finds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anonymize.detections(_FINDS.frame(spark), ["start"]).select("start", "entity", "value", "score")


@query(f"""WITH {_REPLACED}, f AS (SELECT entity, value, max(score) AS s, min(start) AS place FROM d GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY s DESC, place, encode(value)) + CASE entity WHEN 'PERSON' THEN 11 ELSE 0 END AS i FROM f)
SELECT value AS original, CASE entity WHEN 'PERSON' THEN 'P' || i WHEN 'LOCATION' THEN 'LOC0' || i WHEN 'EMAIL_ADDRESS' THEN '[EMAIL REMOVED]' WHEN 'DATE_OF_BIRTH' THEN '[DOB REMOVED]' WHEN 'HIPAA_IDENTIFIER' THEN '[HIPAA REMOVED]' WHEN 'CREDIT_CARD' THEN '[CARD REMOVED]'
WHEN 'PHONE_NUMBER' THEN '[PHONE REMOVED]' WHEN 'US_SSN' THEN '[SSN REMOVED]' END AS pseudonym, entity AS type FROM n""")
def replacement_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anonymize.detections(_FINDS.frame(spark), ["start"]).withColumnRenamed("start", "at")
    return anonymize.pseudonym_key(found, {"PERSON": 11})


_AUTO = Given("original string, pseudonym string, type string, confidence double", [("Ann", "P01", "PERSON", 0.9), ("Oslo", "LOC01", "LOCATION", 0.7), ("Bo", "P12", "PERSON", 0.6), ("x@y.org", "[EMAIL REMOVED]", "EMAIL_ADDRESS", 1.0)])
_OWN = Given("original string, pseudonym string", [("ANN", "Anna"), ("Zed", "Z9")])


@query(f"""WITH a AS {_AUTO.sql}, u AS {_OWN.sql} SELECT coalesce(a.original, u.original) AS original, coalesce(u.pseudonym, a.pseudonym) AS pseudonym, coalesce(a.type, 'user-defined') AS type, CASE WHEN a.original IS NULL THEN 1.0 ELSE a.confidence END AS confidence,
CASE WHEN u.original IS NULL THEN 'auto' ELSE 'user' END AS notes FROM a FULL JOIN u ON lower(a.original) = lower(u.original)""")
def merged_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anonymize.merge_keys(_AUTO.frame(spark), _OWN.frame(spark))


@query(f"SELECT regexp_extract(pseudonym, '^(P|LOC|ORG)', 1) AS prefix, max(regexp_extract(pseudonym, '[0-9]+$')::INT) AS last FROM {_AUTO.sql} WHERE regexp_matches(pseudonym, '^(P|LOC|ORG)[0-9]+$') GROUP BY 1")
def key_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anonymize.next_ordinals(_AUTO.frame(spark))


# ---- evidence ----

_ANCHOR = ("claim-anchor/v1", "autor2013-3f9a1c2e", "autor2013", "map_cell", "supports", "source_verbatim", "T1_fulltext", "lit-review", "2024-01-01T00:00:00Z", None)
_FIELDS = "schema anchor_id cite_key claim_kind stance evidence_form access_tier produced_by ts _corrupt".split()


def _changed(base: tuple, names: list[str], *changes: dict) -> list[tuple]:
    return [(i, *(c.get(n, v) for n, v in zip(names, base, strict=True))) for i, c in enumerate(changes)]


_ANCHORS = Given("id long, " + ", ".join(f"{k} string" for k in _FIELDS), _changed(
    _ANCHOR, _FIELDS, {}, {"schema": "x"}, {"anchor_id": "BADID"}, {"claim_kind": "direct_quote"}, {"claim_kind": "reading_list", "stance": "qualifies"}, {"stance": "context"}, {"evidence_form": None}, {"evidence_form": "kg_paraphrase"}, {"access_tier": "T1"},
    {"access_tier": "T4_none"}, {"produced_by": ""}, {"ts": "yesterday"}, {"cite_key": None}, {"_corrupt": "{"}, {"stance": None, "ts": None}))
_ANCHOR_OK = {
    "schema": "schema = 'claim-anchor/v1'", "anchor_id": "regexp_full_match(anchor_id, '[a-z0-9_-]+-[0-9a-f]{8}')", "cite_key": "cite_key <> ''",
    "claim_kind": "claim_kind IN ('prose_sentence', 'map_cell', 'hypothesis', 'mechanism_status', 'magnitude', 'theory_attribution', 'gap_claim', 'reading_list')", "stance": "stance IN ('supports', 'contradicts', 'qualifies')",
    "evidence_form": "evidence_form IN ('source_verbatim', 'abstract_verbatim', 'kg_paraphrase', 'metadata_only')", "access_tier": "access_tier IN ('T0_kg_fulltext', 'T1_fulltext', 'T2_oa_fulltext', 'T3_abstract', 'T4_none')", "produced_by": "produced_by <> ''", "ts": "ts <> ''",
}


@query(f"SELECT id, CASE WHEN _corrupt IS NOT NULL THEN 'unparseable' ELSE {_FAILED(_ANCHOR_OK)} END AS problems FROM {_ANCHORS.sql}")
def anchor_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.anchor_problems(_ANCHORS.frame(spark)).select("id", F.array_join("problems", ",").alias("problems"))


_LINES = Given("n long, line string", [
    (1, "Work falls (Autor 2013). <!--ev: autor2013-3f9a1c2e, ghost9999-deadbeef -->"), (2, "No author here <!--ev: autor2013-3f9a1c2e-->"), (3, "As (Autor and Dorn 2013a) say"), (4, "See [@autor2013] <!-- ev: autor2013-3f9a1c2e -->"), (5, "nothing"), (6, "(Lee 2001) <!--note-->"),
    (7, "Autor 2013 <!--ev: nokey-00000000-->"), (8, "autor in 2014 <!--ev: autor2013-3f9a1c2e-->")])
_CITED = Given("anchor_id string, cite_key string", [("autor2013-3f9a1c2e", "Autor2013"), ("nokey-00000000", "nokey")])


@query(f"SELECT count(*) FILTER (c) AS citing, count(*) FILTER (c AND t) AS tagged, (count(*) FILTER (c AND t) * 100 // count(*) FILTER (c))::BIGINT AS pct, 'YELLOW' AS verdict FROM (SELECT regexp_matches(line, '\\(([A-Z][A-Za-z-]+[^)]*[12][0-9]{{3}}[a-z]?)\\)|\\[@[a-zA-Z]') AS c, regexp_matches(line, '<!--[ \t]*ev:[ \t]*[a-z0-9_, \t-]*-->') AS t FROM {_LINES.sql})")
def tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.tag_coverage(_LINES.frame(spark))


@query(f"""WITH t AS (SELECT n, line, trim(unnest(regexp_extract_all(regexp_extract(line, '<!--[ ]*ev:([^>]*)-->', 1), '[a-z0-9_-]+-[0-9a-f]{{8}}'))) AS anchor_id FROM {_LINES.sql}), k AS (SELECT t.*, lower(cite_key) AS k, lower(regexp_replace(line, '<!--[^>]*-->', '', 'g')) AS bare FROM t LEFT JOIN {_CITED.sql} USING (anchor_id))
SELECT n, anchor_id, coalesce(contains(bare, regexp_replace(k, '[0-9].*$', '')) AND contains(bare, regexp_extract(k, '[12][0-9]{{3}}')), false) AS adjacent FROM k""")
def tag_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.adjacent(ledger.tags(_LINES.frame(spark)), _CITED.frame(spark)).select("n", "anchor_id", "adjacent")


_AUDITED = ("claim-audit-record/v1", "c1", "k", "p. 3", "q", "support", "CLAIM-VERIFIED", "OK", "T1_fulltext", True, ["SUPPORTED|because"], ["autor2013-3f9a1c2e"], None)
_AUDIT_FIELDS = "schema claim_id cite_key manuscript_loc manuscript_quote citation_function sentence_verdict severity access_tier_max evidence_retrieved subs anchor_refs _corrupt".split()
_AUDIT_TYPES = {"evidence_retrieved": "boolean", "subs": "array<string>", "anchor_refs": "array<string>"}
_AUDITS = Given("id long, " + ", ".join(f"{k} {_AUDIT_TYPES.get(k, 'string')}" for k in _AUDIT_FIELDS), _changed(
    _AUDITED, _AUDIT_FIELDS, {}, {"schema": "x"}, {"subs": []}, {"subs": None, "anchor_refs": None}, {"evidence_retrieved": None}, {"evidence_retrieved": False}, {"severity": "HIGH"}, {"severity": None}, {"sentence_verdict": "VERIFIED"}, {"sentence_verdict": "CLAIM-REVERSED", "severity": "HIGH"},
    {"sentence_verdict": "CLAIM-IMPRECISE", "severity": "MED"}, {"sentence_verdict": "CLAIM-UNSUPPORTED", "severity": "HIGH", "access_tier_max": "T3_abstract"}, {"sentence_verdict": "CLAIM-UNSUPPORTED", "severity": "HIGH", "access_tier_max": "T0_kg_fulltext"},
    {"sentence_verdict": "CLAIM-NOT-CHECKABLE", "severity": "UNVERIFIABLE", "evidence_retrieved": False}, {"subs": ["CONTRADICTED|"]}, {"subs": ["NOT_FOUND|"]}, {"anchor_refs": ["BAD"]}, {"manuscript_loc": ""}, {"citation_function": None}, {"_corrupt": "{"}))


def _audits(spark: SparkSession) -> DataFrame:
    sub = lambda x: F.struct(F.lit("finding").alias("kind"), F.split(x, r"\|")[0].alias("verdict"), F.split(x, r"\|")[1].alias("evidence_quote"))
    return _AUDITS.frame(spark).withColumn("sub_claims", F.transform("subs", sub))


@query(f"SELECT id, CASE WHEN _corrupt IS NOT NULL THEN 'unparseable' ELSE {_FAILED(_AUDIT_OK)} END AS problems FROM {_AUDITS.sql}")
def audit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.audit_problems(_audits(spark)).select("id", F.array_join("problems", ",").alias("problems"))


@query(f"SELECT count(*) AS records, count(*) FILTER (problems <> '') AS failed, 'RED' AS verdict FROM (SELECT CASE WHEN _corrupt IS NOT NULL THEN 'unparseable' ELSE {_FAILED(_AUDIT_OK)} END AS problems FROM {_AUDITS.sql})")
def audit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.audit_verdict(ledger.audit_problems(_audits(spark)))


@query(f"SELECT count(*) FILTER (severity = 'HIGH') AS n_high FROM {_AUDITS.sql}")
def audit_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.high_count(_audits(spark))


_NAMED = Given("name string", [("claim-audit-2024-02-01.ndjson",), ("claim-audit-2024-11-30.ndjson",), ("claim-audit-2023-12-31.ndjson",)])


@query(f"SELECT max(name) AS newest, 'claim-audit-2024-02-01.ndjson' AS pointed, max(name) AS lost FROM {_NAMED.sql}")
def audit_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, pick = _NAMED.frame(spark), lambda p, name: ledger.chosen_audit(_NAMED.frame(spark), p).select(F.col("name").alias(name))
    return ledger.chosen_audit(files).select(F.col("name").alias("newest")).crossJoin(pick("claim-audit-2024-02-01.ndjson", "pointed")).crossJoin(pick("gone.ndjson", "lost"))


_JUDGED = Given("claim_id string, cite_key string, severity string, sentence_verdict string, claim_fingerprint string", [
    ("c1", "k1", "HIGH", "CLAIM-REVERSED", "5e2bf57d3f40c4b6df69daf1936cb766f832374b4fc0259a7cbff06e2f70f269"), ("c2", "k2", "MED", "CLAIM-OVERCAUSAL", None), ("c3", "k3", "MED", "CLAIM-IMPRECISE", "00"), ("c4", "k4", "OK", "CLAIM-VERIFIED", "")])
_ACTIVE = Given("anchor_id string, cite_key string, evidence_form string, access_tier string", [("a-1", "k1", "source_verbatim", "T1_fulltext"), ("a-2", "k2", "metadata_only", "T3_abstract"), ("a-3", "k3", "kg_paraphrase", "T4_none")])
_TAGS = Given("anchor_id string", [("a-1",), ("a-9",), ("a-9",), ("a-2",)])
_DRAFT = Given("sentence string", [("One.",), ("Two <!--ev: a-1-->",)])


@query(f"""WITH d AS (SELECT sha256(trim(regexp_replace(lower(regexp_replace(sentence, '<!--[^>]*-->', '', 'g')), '\\s+', ' ', 'g'))) AS f FROM {_DRAFT.sql})
SELECT 'verdict' AS reason, claim_id AS id, cite_key FROM {_JUDGED.sql} WHERE severity = 'HIGH' OR sentence_verdict IN ('CLAIM-REVERSED', 'CLAIM-UNSUPPORTED', 'CLAIM-MISCHARACTERIZED', 'CLAIM-OVERCAUSAL', 'CLAIM-WRONG-POPULATION')
UNION ALL SELECT 'stale', claim_id, cite_key FROM {_JUDGED.sql} WHERE claim_fingerprint <> '' AND claim_fingerprint NOT IN (SELECT f FROM d)
UNION ALL SELECT DISTINCT 'unmatched tag', anchor_id, NULL FROM {_TAGS.sql} WHERE anchor_id NOT IN (SELECT anchor_id FROM {_ACTIVE.sql})
UNION ALL SELECT 'metadata only', anchor_id, cite_key FROM {_ACTIVE.sql} WHERE evidence_form = 'metadata_only' OR access_tier = 'T4_none'""")
def action_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.action_required(_JUDGED.frame(spark), _ACTIVE.frame(spark), _TAGS.frame(spark), _DRAFT.frame(spark))


_RECORDS = Given("line_no long, value string", [(0, '{"id":"a","v":"1"}'), (1, ""), (2, "{broken"), (3, '{"id":"a","v":"2"}'), (4, "   "), (5, '{"id":"b"}')])


@query(f"SELECT line_no, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.id') END AS id, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.v') END AS v, NOT json_valid(value) AS malformed FROM {_RECORDS.sql} WHERE trim(value) <> ''")
def ndjson_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import StringType, StructType

    parsed = parse_ndjson(_RECORDS.frame(spark), StructType().add("id", StringType()).add("v", StringType()))
    return parsed.select("line_no", "id", "v", F.col("_corrupt").isNotNull().alias("malformed"))


# ---- traces ----

_KEYS = '"ts":"2024-01-02T03:04:05Z","seq":%d,"run_id":"r","skill":"s","phase":"p","agent":"a","agentId":"%s","refs":["x","y"],"status":"%s"'
_TRACE = Given("line_no long, value string", [
    (0, "{" + _KEYS % (2, "id-1", "ok") + ',"step":"one|two","reasoning":"r","action":"","observation":""}'), (1, "{broken"), (2, '{"ts":"t"}'), (3, "{" + _KEYS % (1, "", "fail") + ',"step":" ","reasoning":"r","action":"","observation":""}'),
    (4, "{" + _KEYS % (3, "", "odd") + ',"step":"s","reasoning":"","action":"","observation":""}'), (5, "{" + _KEYS % (4, "", "skipped") + ',"step":"s","reasoning":" ","action":"","observation":""}')])
_MUST = "['ts', 'seq', 'run_id', 'skill', 'phase', 'agent', 'agentId', 'step', 'reasoning', 'action', 'observation', 'refs', 'status']"
_GET = lambda k: f"coalesce(json_extract_string(value, '$.{k}'), '')"


@query(f"""SELECT line_no, CASE WHEN NOT json_valid(value) THEN 'malformed' WHEN len(list_filter({_MUST}, lambda k: NOT list_contains(json_keys(value), k))) > 0 THEN 'missing ' || array_to_string(list_filter({_MUST}, lambda k: NOT list_contains(json_keys(value), k)), ',')
WHEN trim({_GET('step')}) = '' THEN 'empty step' WHEN {_GET('reasoning')} || {_GET('action')} || {_GET('observation')} = '' THEN 'empty triad' END AS reason FROM (SELECT line_no, CASE WHEN json_valid(value) THEN value ELSE 'x' END AS value FROM {_TRACE.sql})""")
def trace_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.trace_problem(_TRACE.frame(spark)).select("line_no", "reason")


@query("SELECT 6::BIGINT AS records, 'malformed' AS reason")
def trace_first_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.first_problem(trace.trace_problem(_TRACE.frame(spark)))


_SIDE = Given("line_no long, value string", [(0, '{"step":" a ","action":"x","status":"odd","refs":["p","q r"]}'), (1, "{"), (2, '{"step":"b","observation":"y","status":"fail","refs":"m, n"}'), (3, '{"step":"c"}'), (4, '{"step":"  ","action":"z"}'), (5, '{"step":"d","reasoning":" "}')])


@query(f"""WITH s AS (SELECT line_no, value FROM {_SIDE.sql} WHERE json_valid(value)) SELECT line_no, trim({_GET('step')}) AS step, CASE WHEN {_GET('status')} IN ('ok', 'fail', 'skipped') THEN {_GET('status')} ELSE 'ok' END AS status, 'id-1' AS "agentId",
array_to_string(list_filter(regexp_split_to_array(replace(replace(replace(coalesce(json_extract_string(value, '$.refs'), ''), '[', ''), ']', ''), '"', ''), '[, ]+'), lambda x: x <> ''), ' ') AS refs
FROM s WHERE trim({_GET('step')}) <> '' AND {_GET('reasoning')} || {_GET('action')} || {_GET('observation')} <> ''""")
def sidecar_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.fold_sidecar(_SIDE.frame(spark), "id-1", "worker").select("line_no", "step", "status", "agentId", F.array_join("refs", " ").alias("refs"))


@query("SELECT 3::BIGINT AS records, 'OK' AS state UNION ALL SELECT 0, 'ERROR'")
def sidecar_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = trace.fold_sidecar(_SIDE.frame(spark), "id-1", "worker")
    return trace.fold_state(folded).union(trace.fold_state(folded.limit(0)))


@query(f"""WITH t AS (SELECT line_no, value FROM {_TRACE.sql} WHERE json_valid(value)), r AS (SELECT *, row_number() OVER (ORDER BY coalesce((value->>'$.seq')::INT, 0), line_no) + 7 AS place FROM t),
c AS (SELECT place, value, lambda_cells.* FROM r, LATERAL (SELECT list_transform(['phase', 'step', 'reasoning', 'action', 'observation'], lambda k: CASE WHEN trim(coalesce(json_extract_string(value, '$.' || k), '')) = '' THEN '—' ELSE trim(replace(json_extract_string(value, '$.' || k), '|', '\\|')) END) AS x) lambda_cells)
SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS line_no, unnest(['# Process Log: /s', '- **Run**: r', '- **Steps**: 5', '', '## Steps', '', '| # | Time | Phase | Agent | Step | Reasoning | Action | Observation | Refs | Status |', '|---|---|---|---|---|---|---|---|---|---|']) AS markdown
UNION ALL SELECT place, '| ' || coalesce(value->>'$.seq', '') || ' | ' || CASE WHEN value->>'$.ts' = 't' THEN 't' ELSE '03:04:05' END || ' | ' || x[1] || ' | ' || CASE WHEN value->>'$.agent' IS NULL THEN '—' WHEN value->>'$.agentId' <> '' THEN 'a (agentId=' || (value->>'$.agentId') || ')' ELSE 'a' END || ' | ' || x[2] || ' | ' || x[3] || ' | ' || x[4] || ' | ' || x[5] || ' | '
  || CASE WHEN value->>'$.agent' IS NULL THEN '—' ELSE 'x; y' END || ' | ' || CASE value->>'$.status' WHEN 'ok' THEN '✓' WHEN 'fail' THEN '✗' WHEN 'skipped' THEN 'SKIPPED' WHEN 'odd' THEN 'odd' ELSE '—' END || ' |' FROM c
UNION ALL SELECT 13, '> WARNING: 1 malformed line(s) were skipped.'""")
def trace_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.render(_TRACE.frame(spark).withColumn("run", F.lit("t")), "run").select(F.col("line_no").cast("long").alias("line_no"), "markdown")


_REQUESTS = Given("ts string, agentId string, subagent string, purpose string, phase string, manuscript string", [("t1", "agent-0123456789", "a", "draft", "7", "drafts/m.md"), ("t2", "Agent", "a", "draft", "7", "drafts/m.md"), ("t3", "task_abcdefghijkl", "b", "check", "8", "gone.md")])
_DRAFTS = Given("path string, text string, modified timestamp", [("drafts/m.md", "text", "2024-01-02 00:00:00"), ("drafts/manuscript-2024.md", "old", "2024-03-02 00:00:00"), ("drafts/manuscript-final-1.md", "f1", "2024-01-01 00:00:00"), ("drafts/manuscript-final-2.md", "f2", "2024-02-01 00:00:00")])


def _drafts(spark: SparkSession) -> DataFrame:
    rows = [(p, t, m) for p, t, m in _DRAFTS.rows]
    return spark.createDataFrame(rows, "path string, text string, modified string").withColumn("modified", F.to_timestamp("modified"))


@query(f"SELECT ts, \"agentId\", subagent, purpose, (SELECT sha256(text) FROM {_DRAFTS.sql} d WHERE d.path = manuscript) AS manuscript_sha256, phase FROM {_REQUESTS.sql} WHERE regexp_matches(\"agentId\", '^[a-z][a-z0-9_-]{{12,}}$')")
def dispatch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.dispatches(_REQUESTS.frame(spark), _drafts(spark))


@query(f"SELECT path, sha256(text) AS sha256 FROM {_DRAFTS.sql} WHERE path = 'drafts/manuscript-final-2.md'")
def dispatch_manuscript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.newest_manuscript(_drafts(spark))


# ---- reviews ----

_VERDICTS = Given("id long, line string", list(enumerate(
    [f"{label} {v}" for label in ("Overall Verdict:", "overall verdict:", "VERDICT:", "**Overall Verdict**:") for v in ("CRITICAL", "HALT", "FAIL", "MAJOR ISSUES", "FIXES  NEEDED", "DO NOT TRUST RESULTS", "PASS", "MINOR ISSUES")]
    + ["Findings included two CRITICAL items, both resolved before this verdict.", "PREVIOUS VERDICT: CRITICAL (superseded)", "the Overall Verdict: HALT", "Verdict: FAIL"])))


@query(f"SELECT id, regexp_matches(line, '(?:Overall|overall)\\s+(?:Verdict|verdict)\\s*:\\s*(?:CRITICAL|HALT|FAIL|MAJOR\\s+ISSUES|FIXES\\s+NEEDED|DO\\s+NOT\\s+TRUST)|^VERDICT\\s*:\\s*(?:CRITICAL|HALT|FAIL|MAJOR\\s+ISSUES|FIXES\\s+NEEDED|DO\\s+NOT\\s+TRUST)') AS blocking FROM {_VERDICTS.sql}")
def blocking_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _VERDICTS.frame(spark).select("id", review.blocking_line(F.col("line")).alias("blocking"))


_REPORTS = Given("path string, text string", [("r.md", "critic-a says\n[EXCUSED: ill] critic-b\ncritic-a again critic-a\nrev-1 done"), ("q.md", "critic-b [EXCUSED: x]\ncritic-d")])
_NEEDED = Given("name string", [("critic-a",), ("critic-b",), ("critic-c",), ("critic-d",)])


@query(f"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM {_REPORTS.sql}), c AS (SELECT name, count(line) AS total, count(*) FILTER (regexp_matches(line, '\\[EXCUSED:[^]]*\\][ \t]+' || name || '|' || name || '[ \t]+\\[EXCUSED:')) AS excused FROM {_NEEDED.sql} LEFT JOIN l ON contains(line, name) GROUP BY name)
SELECT name, total, excused, CASE WHEN total > excused THEN 'dispatched' WHEN excused > 0 THEN 'excused' ELSE 'missing' END AS state FROM c""")
def reviewer_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.token_coverage(_REPORTS.frame(spark), _NEEDED.frame(spark))


_MANIFESTS = Given("review_id string, report string, supersedes_review_id string, remaining_blocking_count int, escalated boolean", [("rev-1", "r.md", None, 0, False), ("rev-2", "r.md", "rev-1", 1, False), ("rev-3", "x.md", "rev-0", 0, True), ("rev-4", "q.md", "rev-2", None, None)])


@query(f"SELECT review_id, CASE WHEN text IS NULL THEN 'no report' WHEN contains(text, review_id) THEN 'paired' ELSE 'report lacks id' END AS state FROM {_MANIFESTS.sql} m LEFT JOIN {_REPORTS.sql} r ON r.path = m.report")
def review_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.paired(_MANIFESTS.frame(spark), _REPORTS.frame(spark)).select("review_id", "state")


@query(f"WITH m AS {_MANIFESTS.sql} SELECT review_id, coalesce(remaining_blocking_count, 0) > 0 OR coalesce(escalated, false) AS blocked, supersedes_review_id IS NOT NULL AND supersedes_review_id NOT IN (SELECT review_id FROM m) AS broken FROM m")
def review_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = review.broken_chain(_MANIFESTS.frame(spark)).select("review_id", F.lit(True).alias("broken"))
    return review.blocking_left(_MANIFESTS.frame(spark)).select("review_id", "blocked").join(broken, "review_id", "left").fillna(False, ["broken"])


_PHASED = Given("there boolean, phase string, verdict string", [(a, p, v) for a in (True, False) for p in ("7", None) for v in ("GREEN", "YELLOW", "RED")])


@query(f"WITH e AS (SELECT there, phase, verdict, CASE WHEN NOT there AND phase IS NOT NULL AND verdict = 'GREEN' THEN 'YELLOW' ELSE verdict END AS explicit FROM {_PHASED.sql}) SELECT *, CASE explicit WHEN 'YELLOW' THEN 'RED' ELSE explicit END AS delegated FROM e")
def review_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    explicit = _PHASED.frame(spark).withColumn("explicit", review.explicit_phase(F.col("there"), F.col("phase"), F.col("verdict")))
    return explicit.withColumn("delegated", review.delegated(F.col("explicit")))


# ---- measurement ----

_DECLARED_JSON = Given("json string", [('{"constants":[{"a":1},{"a":2}]}',), ('[{"a":3}]',), ('{"a":4}',), ("garbage",), ('{"constants":[]}',)])


@query("SELECT unnest(['{\"a\":1}', '{\"a\":2}', '{\"a\":3}', '{\"a\":4}', NULL, NULL]) AS declaration, unnest(['OK', 'OK', 'OK', 'OK', 'RED', 'OK']) AS state")
def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.normalise_declarations(_DECLARED_JSON.frame(spark), "constants")


_INSTRUMENTED = Given("report string, json string", [("a", '{"instrument":{"declared":true,"instrument_id":"i"}}'), ("b", '{"instrument":{"waived":true}}'), ("c", "{}"), ("d", "{"), ("e", '{"instrument":{"declared":"true"}}'), ("f", '{"instrument":{"declared":true}}'), ("g", '{"instrument":{"declared":false}}')])
_I = lambda k: f"json_extract(json, '$.instrument.{k}')"


@query(f"""WITH g AS (SELECT report, json_valid(json) AS ok, CASE WHEN json_valid(json) THEN json ELSE '{{}}' END AS json FROM {_INSTRUMENTED.sql}), r AS (SELECT report, CASE WHEN {_I('declared')}::VARCHAR = '"true"' THEN NULL ELSE json_extract_string(json, '$.instrument.instrument_id') END AS instrument_id, CASE WHEN NOT ok THEN 'unreadable' WHEN json_extract(json, '$.instrument') IS NULL THEN 'no instrument'
WHEN {_I('declared')}::VARCHAR = 'true' THEN CASE WHEN coalesce(json_extract_string(json, '$.instrument.instrument_id'), '') = '' THEN 'no id' END WHEN {_I('waived')}::VARCHAR = 'true' THEN 'waived' ELSE 'not declared' END AS reason FROM g)
SELECT *, CASE WHEN reason IS NULL THEN 'GREEN' WHEN reason = 'waived' THEN 'YELLOW' ELSE 'RED' END AS state FROM r""")
def instrument_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.instrument_state(_INSTRUMENTED.frame(spark))


_SCRIPTS = Given("script string, text string", [("a.R", "RECALL <- 0.62 # RECALL <- 0.99\nx = 3\n# OLD_RATE = 1\nTEST_SPEC=.5\nMY_RECALL = 1e-3"), ("b.py", "pass\nBASE_RATE = 0.25\nBASE_RATE = 0.5")])
_CONSTANTS = Given("name string, script string, value double", [("RECALL", "a.R", 0.612), ("x", "a.R", 3.0), ("gone", "a.R", 1.0), ("y", "c.R", 1.0), ("TEST_SPEC", "a.R", 0.5), (None, "a.R", 1.0)])
_ASSIGNED = rf"""a AS (SELECT script, name, arg_min(value, ln) AS value FROM (SELECT script, ln, regexp_extract(l, '(?:^|[^A-Za-z0-9_.])([A-Za-z_.][A-Za-z0-9_.]*)[ \t]*(?:<-|=)[ \t]*[-+]?(?:[0-9]+(?:[.][0-9]+)?|[.][0-9]+)', 1) AS name, regexp_extract(l, '(?:<-|=)[ \t]*([-+]?(?:[0-9]+(?:[.][0-9]+)?|[.][0-9]+)(?:[eE][-+]?[0-9]+)?)', 1) AS value
  FROM (SELECT script, unnest(generate_series(1, len(string_split(text, chr(10))))) AS ln, regexp_replace(unnest(string_split(text, chr(10))), '#.*', '') AS l FROM {_SCRIPTS.sql})) WHERE name <> '' GROUP BY script, name)"""


@query(f"WITH {_ASSIGNED} SELECT script, name, value::DOUBLE AS value FROM a")
def script_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.assignments(_SCRIPTS.frame(spark))


@query(f"""WITH {_ASSIGNED}, d AS {_CONSTANTS.sql}, r AS (SELECT d.name, d.script, CASE WHEN d.name IS NULL OR d.script IS NULL THEN 'malformed declaration' WHEN d.script NOT IN (SELECT script FROM {_SCRIPTS.sql}) THEN 'script not found' WHEN a.value IS NULL THEN 'no assignment' WHEN abs(a.value::DOUBLE - d.value) > 1e-12 THEN 'drift' END AS reason
FROM d LEFT JOIN a ON a.script = d.script AND a.name = d.name) SELECT *, CASE WHEN reason IS NULL THEN 'GREEN' ELSE 'RED' END AS state FROM r""")
def constant_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.constant_drift(_CONSTANTS.frame(spark), _SCRIPTS.frame(spark)).select("name", "script", "reason", "state")


@query(f"WITH {_ASSIGNED} SELECT script, name, value::DOUBLE AS value FROM a WHERE regexp_matches(name, '^[A-Z][A-Z0-9_]*(RECALL|PRECISION|_SE|_SP|SENS|SPEC|KAPPA|ACCURACY|_RATE|_FPR|_FNR)$') AND name NOT IN (SELECT name FROM {_CONSTANTS.sql} WHERE name IS NOT NULL)")
def undeclared_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.undeclared_literals(_SCRIPTS.frame(spark), _CONSTANTS.frame(spark)).select("script", "name", "value")


_INSTRUMENTS = Given("instrument_id string", [("i",), ("j",), ("k",), ("l",), ("m",), (None,)])
_MATCHES = Given("instrument_id string, asked string, needed string, verdict string", [("i", "q", "q", "MATCH"), ("j", "q", "q", "BROADER"), ("k", None, "q", "MATCH"), ("m", "q", "q", None)])


@query(f"SELECT i.instrument_id, CASE WHEN m.verdict IS NULL OR m.verdict <> 'MATCH' THEN 'RED' WHEN asked IS NULL OR needed IS NULL THEN 'YELLOW' ELSE 'GREEN' END AS state, i.instrument_id IS NOT NULL AND m.instrument_id IS NULL AS without_record FROM {_INSTRUMENTS.sql} i LEFT JOIN {_MATCHES.sql} m USING (instrument_id)")
def construct_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = measure.construct_match(_INSTRUMENTS.frame(spark), _MATCHES.frame(spark)).select("instrument_id", "state")
    lost = measure.without_record(_INSTRUMENTS.frame(spark), _MATCHES.frame(spark)).withColumn("without_record", F.lit(True))
    return states.join(lost, "instrument_id", "left").fillna(False, ["without_record"])


_EXPECTED = Given("key string, value string", [("n", "100"), ("seed", None), ("pool", "5"), ("same", "x")])
_ACTUAL = Given("key string, value string", [("n", "99"), ("seed", None), ("lexicon", "l"), ("same", "x")])


@query(f"SELECT key, e.value AS expected, a.value AS actual FROM {_EXPECTED.sql} e FULL JOIN {_ACTUAL.sql} a USING (key) WHERE e.value IS DISTINCT FROM a.value")
def design_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.design_drift(_EXPECTED.frame(spark), _ACTUAL.frame(spark))


_FINDINGS = Given("state string", [("GREEN",), ("YELLOW",), ("YELLOW",)])


@query("SELECT unnest([0, 0, 0])::BIGINT AS red, unnest([2, 0, 0])::BIGINT AS yellow, unnest(['YELLOW', 'INERT', 'GREEN']) AS verdict")
def measurement_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = _FINDINGS.frame(spark).limit(0)
    return measure.combined_verdict(_FINDINGS.frame(spark), 3).union(measure.combined_verdict(none, 0)).union(measure.combined_verdict(none, 2))


_RATERS = Given("id long, a string, b string, c string", [(1, "x", "x", "x"), (2, "x", "y", "x"), (3, "y", "y", "y"), (4, "z", "x", "z"), (5, "x", None, "x"), (6, "y", "y", "z"), (7, None, None, "x"), (8, "z", "z", "z")])


@query(f"""WITH l AS (SELECT id, unnest([a, b, c]) AS v FROM {_RATERS.sql}), w AS (SELECT id, v FROM l WHERE v IS NOT NULL), m AS (SELECT id, count(*) AS m FROM w GROUP BY id HAVING count(*) >= 2), c AS (SELECT id, m, v, count(*) AS c FROM w JOIN m USING (id) GROUP BY ALL),
i AS (SELECT id, m, sum(c * (c - 1)) AS s FROM c GROUP BY id, m), t AS (SELECT v, sum(c) AS n, sum(c) FILTER (m = 3) AS n3 FROM c GROUP BY v), o AS (SELECT count(*) FILTER (m = 3) AS n, avg(s / 6.0) FILTER (m = 3) AS po, sum(m) AS k, sum(s / (m - 1)) AS ok FROM i),
x AS (SELECT sum(n * (n - 1)) AS cc, sum(n3 * n3) AS c2, count(n3) AS q FROM t), r AS (SELECT n, po, 1 - ok / k AS d, 1 - cc / (k * (k - 1)) AS e, c2 / (9.0 * n * n) AS p, q FROM o, x)
SELECT n, round(po, 6) AS po, round(1 - d / e, 6) AS alpha, round((po - p) / (1 - p), 6) AS fleiss, round((po - (1 - p) / (q - 1)) / (1 - (1 - p) / (q - 1)), 6) AS ac1 FROM r""")
def three_raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.rater_suite(_RATERS.frame(spark), ["a", "b", "c"]).select("n", *[F.round(k, 6).alias(k) for k in ("po", "alpha", "fleiss", "ac1")])


