"""Trace logs: order, validity, coverage of dispatched work, rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.functions.rules import EMAIL_OR_SSN

# Keys of a record, statuses and their signs, and the form of an agent's id.
REQUIRED = "ts seq run_id skill phase agent agentId step reasoning action observation refs status".split()
SIGNS = {"ok": "✓", "fail": "✗", "skipped": "SKIPPED"}
EMPTY = "—"
AGENT_ID = r"^[a-z][a-z0-9_-]{12,}$"


def numbered(events: DataFrame, run: str, order: list[str]) -> DataFrame:
    """Records with ``seq``, their place in their run."""
    return events.withColumn("seq", F.row_number().over(Window.partitionBy(run).orderBy(*order)).cast("long"))


def normalised(text: Column) -> Column:
    """One line: line ends and tabs become blanks, other control characters go."""
    return F.regexp_replace(F.regexp_replace(text, r"[\n\r\t]", " "), r"[\x00-\x1F\x7F]", "")


def refs(text: Column) -> Column:
    return F.filter(F.split(text, r"[, \t\n\r]+"), lambda x: x != "")


def valid_record(step: Column, status: Column, *triad: Column) -> Column:
    """A step, a known status, and at least one of reasoning, action, observation."""
    any_of = triad[0].isNotNull() & (triad[0] != "")
    for c in triad[1:]:
        any_of = any_of | (c.isNotNull() & (c != ""))
    return F.coalesce((step != "") & status.isin("ok", "fail", "skipped") & any_of, F.lit(False))


def warns(observation: Column) -> Column:
    """Whether an observation seems to hold personal data; it warns and blocks nothing."""
    return F.coalesce(observation.rlike(EMAIL_OR_SSN), F.lit(False))


def fold_sidecar(lines: DataFrame, agent_id: str, agent: str) -> DataFrame:
    """A worker's own records: malformed or empty ones skipped, unknown statuses ok, ids stamped.

    References may be a list or a text. ``fold_state`` tells whether any record was left.
    """
    schema = "step string, reasoning string, action string, observation string, status string"
    got = lines.select("line_no", F.from_json("value", schema).alias("r"), F.get_json_object("value", "$.refs").alias("_refs")).select("line_no", "r.*", "_refs")
    listed = F.coalesce(F.from_json("_refs", "array<string>"), F.array(F.coalesce("_refs", F.lit(""))))
    triad = F.concat_ws("", "reasoning", "action", "observation")
    kept = got.where((F.trim(F.coalesce("step", F.lit(""))) != "") & (triad != ""))
    status = F.when(F.col("status").isin(*SIGNS), F.col("status")).otherwise("ok")
    return kept.withColumns({"step": F.trim("step"), "refs": refs(F.array_join(listed, ",")), "status": status, "agentId": F.lit(agent_id), "agent": F.lit(agent)}).drop("_refs")


def fold_state(folded: DataFrame) -> DataFrame:
    """``records, state``: a sidecar without a valid record is an error."""
    n = F.count("*")
    return folded.agg(n.alias("records"), F.when(n > 0, "OK").otherwise("ERROR").alias("state"))


def trace_problem(lines: DataFrame) -> DataFrame:
    """``lines(value, line_no)`` with ``reason``: the first thing wrong with each, or null."""
    keys = F.json_object_keys("value")
    get = lambda k: F.coalesce(F.get_json_object("value", f"$.{k}"), F.lit(""))
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), keys)
    reason = (
        F.when(keys.isNull(), "malformed")
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
        .when(F.trim(get("step")) == "", "empty step")
        .when(F.concat(get("reasoning"), get("action"), get("observation")) == "", "empty triad")
    )
    return lines.withColumn("reason", reason)


def first_problem(checked: DataFrame) -> DataFrame:
    """One row: how many records, and the first failure; no record is one too."""
    first = F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col("line_no")))
    return checked.agg(F.count("*").alias("records"), F.when(F.count("*") == 0, "empty trace").otherwise(first).alias("reason"))


def missing_traces(dispatched: DataFrame, traces: DataFrame, key: str) -> DataFrame:
    """Dispatched ids without any trace."""
    return dispatched.select(key).distinct().join(traces.select(key).distinct(), key, "left_anti")


def bound(traces: DataFrame, manifest: DataFrame, key: str = "agentId") -> DataFrame:
    """Whether each record's agent is in the manifest."""
    known = manifest.select(key).distinct().withColumn("_b", F.lit(True))
    return traces.join(known, key, "left").withColumn("bound", F.coalesce("_b", F.lit(False))).drop("_b")


def purposes(manifest: DataFrame, key: str, purpose: str, order: list[str]) -> DataFrame:
    """The purpose an id was first seen with, and whether it was given another."""
    at = F.struct(*order)
    return manifest.groupBy(key).agg(F.min_by(purpose, at).alias("purpose"), (F.count_distinct(purpose) > 1).alias("conflict"))


def cell(text: Column) -> Column:
    """Text for a table cell: bars escaped, line ends as blanks, nothing as a dash."""
    plain = F.trim(F.replace(F.regexp_replace(text, "\n", " "), F.lit("|"), F.lit("\\|")))
    return F.when(F.coalesce(plain, F.lit("")) == "", EMPTY).otherwise(plain)


def clock(ts: Column) -> Column:
    """The time of day of a stamp; what is no stamp stays, nothing is a dash."""
    time = F.substring(F.regexp_replace(F.regexp_extract(ts, "^[^T]*T(.*)$", 1), "Z+$", ""), 1, 8)
    return F.when(F.coalesce(ts, F.lit("")) == "", EMPTY).when(ts.contains("T"), time).otherwise(ts)


def rendered(status: Column) -> Column:
    """A status as its sign; an unknown one as it is."""
    out = F.when(F.lit(False), "")
    for name, sign in SIGNS.items():
        out = out.when(status == name, sign)
    return out.otherwise(cell(status))


HEAD = "| # | Time | Phase | Agent | Step | Reasoning | Action | Observation | Refs | Status |"


def render(lines: DataFrame, key: str) -> DataFrame:
    """``key, line_no, markdown``: the log of every trace (``key, value, line_no``), its steps in order of seq.

    A trace's first skill and run id head it; malformed lines are counted at its end.
    """
    schema = "ts string, seq long, run_id string, skill string, phase string, agent string, agentId string, step string, reasoning string, action string, observation string, refs array<string>, status string"
    parsed = lines.where(F.trim("value") != "").select(key, "line_no", F.json_object_keys("value").isNull().alias("_bad"), F.from_json("value", schema).alias("r"))
    good = parsed.where("NOT _bad").select(key, "line_no", "r.*")
    agent = F.when(F.coalesce("agentId", F.lit("")) != "", F.concat(F.coalesce("agent", F.lit("None")), F.lit(" (agentId="), "agentId", F.lit(")"))).otherwise(F.col("agent"))
    cells = [F.coalesce(F.col("seq").cast("string"), F.lit("")), clock(F.col("ts")), cell(F.col("phase")), cell(agent), *[cell(F.col(k)) for k in ("step", "reasoning", "action", "observation")], cell(F.array_join("refs", "; ")), rendered(F.col("status"))]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    at = F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce("seq", F.lit(0)), "line_no"))
    first = lambda c: F.min_by(F.col(f"r.{c}"), F.when(~F.col("_bad") & (F.coalesce(F.col(f"r.{c}"), F.lit("")) != ""), F.col("line_no")))
    heads = parsed.groupBy(key).agg(first("skill").alias("_skill"), first("run_id").alias("_run"), F.count_if(~F.col("_bad")).alias("_n"), F.count_if("_bad").alias("_lost"))
    said = F.array(
        F.concat(F.lit("# Process Log: /"), F.coalesce("_skill", F.lit("?"))), F.concat(F.lit("- **Run**: "), F.coalesce("_run", F.lit(EMPTY))), F.concat(F.lit("- **Steps**: "), F.col("_n").cast("string")),
        F.lit(""), F.lit("## Steps"), F.lit(""), F.lit(HEAD), F.lit("|" + "---|" * 10),
    )
    top = heads.select(key, F.posexplode(said).alias("line_no", "markdown"))
    steps = good.select(key, (at + 7).alias("line_no"), row.alias("markdown"))
    note = F.concat(F.lit("> WARNING: "), F.col("_lost").cast("string"), F.lit(" malformed line(s) were skipped."))
    end = heads.where("_lost > 0").select(key, (F.col("_n") + 8).cast("int").alias("line_no"), note.alias("markdown"))
    return top.unionByName(steps).unionByName(end)


def newest_manuscript(files: DataFrame) -> DataFrame:
    """``path, sha256`` of the manuscript that counts: by kind of name first, then the newest (``path, modified, text``)."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    kind = F.when(F.lit(False), 0)
    for i, prefix in enumerate(("manuscript-submission-", "manuscript-final-", "draft-manuscript-", "manuscript-")):
        kind = kind.when(name.startswith(prefix) & name.endswith(".md"), i)
    ranked = files.withColumn("_k", kind).where("_k IS NOT NULL")
    best = F.min_by(F.struct("path", F.sha2("text", 256).alias("sha256")), F.struct("_k", (-F.unix_micros("modified")).alias("age"), "path")).alias("b")
    return ranked.agg(best).where("b IS NOT NULL").select("b.*")


def dispatches(requests: DataFrame, manuscripts: DataFrame) -> DataFrame:
    """``requests`` (ts, agentId, subagent, purpose, phase, manuscript) with ``manuscript_sha256``, ready to be appended.

    Requests without a real agent's id are left out; a manuscript that isn't there has no hash.
    """
    hashes = manuscripts.select(F.col("path").alias("manuscript"), F.sha2("text", 256).alias("manuscript_sha256"))
    return requests.where(dispatch_valid(F.col("agentId"))).join(hashes, "manuscript", "left").select("ts", "agentId", "subagent", "purpose", "manuscript_sha256", "phase")


def dispatch_valid(agent_id: Column) -> Column:
    return F.coalesce(agent_id.rlike(AGENT_ID), F.lit(False))
