"""Evidence ledgers: which record counts, what is covered, what is stale, what is unused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.functions.text import fingerprint, floor_percent
from auditloom.operators.order import numbered

# What a record of evidence may say, and an audit of one.
ANCHOR_SCHEMA = "claim-anchor/v1"
CLAIM_KINDS = "prose_sentence map_cell hypothesis mechanism_status magnitude theory_attribution gap_claim reading_list".split()
STANCES = "supports contradicts qualifies".split()
EVIDENCE_FORMS = "source_verbatim abstract_verbatim kg_paraphrase metadata_only".split()
ACCESS_TIERS = "T0_kg_fulltext T1_fulltext T2_oa_fulltext T3_abstract T4_none".split()
FULL_TEXT_TIERS = ACCESS_TIERS[:3]
TIER_RANK = {"T1_fulltext": 0, "T2_oa_fulltext": 1, "T0_kg_fulltext": 2, "T3_abstract": 3, "T4_none": 4}
AUDIT_SCHEMA = "claim-audit-record/v1"
VERDICT_SEVERITY = {
    "CLAIM-REVERSED": "HIGH", "CLAIM-UNSUPPORTED": "HIGH", "CLAIM-MISCHARACTERIZED": "MED", "CLAIM-OVERCAUSAL": "MED", "CLAIM-WRONG-POPULATION": "MED",
    "CLAIM-IMPRECISE": "MED", "CLAIM-VERIFIED": "OK", "CLAIM-NOT-A-CLAIM": "OK", "CLAIM-NOT-CHECKABLE": "UNVERIFIABLE",
}
ACTION_VERDICTS = "CLAIM-REVERSED CLAIM-UNSUPPORTED CLAIM-MISCHARACTERIZED CLAIM-OVERCAUSAL CLAIM-WRONG-POPULATION".split()
AUDIT_REQUIRED = "claim_id cite_key manuscript_loc manuscript_quote citation_function sentence_verdict severity access_tier_max".split()
ANCHOR_ID = r"^[a-z0-9_-]+-[0-9a-f]{8}$"
CITING = r"\(([A-Z][A-Za-z-]+[^)]*[12][0-9]{3}[a-z]?)\)|\[@[a-zA-Z]"
TAG = r"<!--[ \t]*ev:[ \t]*[a-z0-9_, \t-]*-->"


def last_wins(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last record of each key."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return records.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def first_wins(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first capture of each key; feeding the same records again changes nothing."""
    w = Window.partitionBy(key).orderBy(*order)
    return records.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def without_superseded(records: DataFrame, key: str = "anchor_id", by: str = "supersedes") -> DataFrame:
    gone = records.where(F.col(by).isNotNull()).select(F.col(by).alias(key)).distinct()
    return records.join(gone, key, "left_anti")


def anchor_id(cite_key: Column, quote_sha256: Column, source_loc: Column) -> Column:
    return F.concat(F.lower(cite_key), F.lit("-"), F.substring(F.sha1(F.concat_ws("|", cite_key, quote_sha256, source_loc)), 1, 8))


def anchor_problems(anchors: DataFrame) -> DataFrame:
    """``anchors`` with ``problems``: what each record fails; an unreadable one fails at once."""
    c, filled = F.col, lambda k: F.length(F.col(k)) > 0
    checks = {
        "schema": c("schema") == ANCHOR_SCHEMA, "anchor_id": c("anchor_id").rlike(ANCHOR_ID), "cite_key": filled("cite_key"),
        "claim_kind": c("claim_kind").isin(CLAIM_KINDS), "stance": c("stance").isin(STANCES), "evidence_form": c("evidence_form").isin(EVIDENCE_FORMS),
        "access_tier": c("access_tier").isin(ACCESS_TIERS), "produced_by": filled("produced_by"), "ts": filled("ts"),
    }
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in checks.items()]))
    return anchors.withColumn("problems", F.when(c("_corrupt").isNotNull(), F.array(F.lit("unparseable"))).otherwise(failed))


def over_quote_cap(text: Column, most: int = 60) -> Column:
    return F.size(F.filter(F.split(text, r"[ \t\n\r\f\x0b]+"), lambda x: x != "")) > most


def coverage(inventory: DataFrame, row: str, item: str, known: DataFrame) -> DataFrame:
    """``row, covered``: a row is covered if one of its ids is known. Known ids are made distinct."""
    ids = known.select(F.col(known.columns[0]).alias(item)).distinct().withColumn("_hit", F.lit(True))
    return inventory.join(ids, item, "left").groupBy(row).agg(F.bool_or(F.coalesce("_hit", F.lit(False))).alias("covered"))


def coverage_gate(covered: DataFrame, least: int = 70) -> DataFrame:
    n, hit = F.count("*"), F.count_if(F.col("covered"))
    pct = floor_percent(hit, n)
    return covered.agg(n.alias("total"), hit.alias("covered"), pct.alias("pct"), F.when(n == 0, "INERT").when(pct >= least, "GREEN").otherwise("RED").alias("verdict"))


def unresolved(mentions: DataFrame, item: str, known: DataFrame) -> DataFrame:
    """Mentions of ids that aren't known, with multiplicity."""
    return mentions.join(known.select(F.col(known.columns[0]).alias(item)).distinct(), item, "left_anti")


def tags(lines: DataFrame, line: str = "line") -> DataFrame:
    """Evidence tags of draft lines: one row per id."""
    body = F.regexp_extract_all(line, F.lit(r"<!--[ ]*ev:[ ]*([^>]*?)[ ]*-->"), F.lit(1))
    ids = F.filter(F.flatten(F.transform(body, lambda b: F.split(b, r"[, ]+"))), lambda x: x != "")
    return lines.select("*", F.explode(ids).alias("anchor_id"))


def tag_coverage(lines: DataFrame, line: str = "line", least: int = 60) -> DataFrame:
    """``citing, tagged, pct, verdict``: lines that cite and how many of them carry an evidence tag.

    Below ``least`` percent is YELLOW; where nothing is cited there is nothing to cover.
    """
    cites, has_tag = F.col(line).rlike(CITING), F.col(line).rlike(TAG)
    citing, tagged = F.count_if(cites), F.count_if(cites & has_tag)
    pct = floor_percent(tagged, citing)
    return lines.agg(citing.alias("citing"), tagged.alias("tagged"), pct.alias("pct"), F.when(pct < least, "YELLOW").otherwise("GREEN").alias("verdict"))


def adjacent(tagged: DataFrame, anchors: DataFrame, line: str = "line") -> DataFrame:
    """Whether a tag's author and year stand in its line, comments left out; a key may lack either."""
    bare = F.lower(F.regexp_replace(line, r"<!--[^>]*-->", ""))
    keyed = tagged.join(anchors.select("anchor_id", "cite_key"), "anchor_id", "left")
    author, year = F.regexp_replace(F.lower("cite_key"), r"[0-9].*$", ""), F.regexp_extract("cite_key", r"([12][0-9]{3})", 1)
    there = bare.contains(author) & bare.contains(year)
    return keyed.withColumn("adjacent", F.coalesce(there, F.lit(False)))


def reconcile(draft: DataFrame, audited: DataFrame) -> DataFrame:
    """``side, n``: audited sentences the draft no longer has, tagged ones never audited."""
    d, a = (x.select(fingerprint(F.col("sentence")).alias("f")).distinct() for x in (draft, audited))
    count = lambda x, name: x.agg(F.lit(name).alias("side"), F.count("*").alias("n"))
    return count(a.join(d, "f", "left_anti"), "stale").union(count(d.join(a, "f", "left_anti"), "unaudited"))


def unused(ledger: DataFrame, *uses: DataFrame) -> DataFrame:
    """Anchors that nothing tags, audits or lists."""
    used = uses[0]
    for other in uses[1:]:
        used = used.union(other)
    return ledger.select("anchor_id").distinct().join(used.toDF("anchor_id").distinct(), "anchor_id", "left_anti")


def running_heading(lines: DataFrame, key: str, order: str = "line_no", line: str = "line") -> DataFrame:
    """Each line's section: the last heading of one to three hashes before it."""
    head = F.when(F.col(line).rlike(r"^#{1,3} "), F.regexp_replace(line, r"^#{1,3} +", ""))
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(head, ignorenulls=True).over(w))


def phase_verdict(red: Column, yellow: Column, total: Column, strict: bool = False) -> Column:
    """INERT without input, then RED, then YELLOW (RED where strict), then GREEN."""
    return F.when(total == 0, "INERT").when(red > 0, "RED").when(yellow > 0, "RED" if strict else "YELLOW").otherwise("GREEN")


def brief(anchors: DataFrame) -> DataFrame:
    """Evidence in reading order: verified first, then by access tier, then by id.

    The order goes by ranges of rows, not by class, so a class that most anchors share is
    spread like any other.
    """
    tier = F.create_map(*[F.lit(x) for kv in TIER_RANK.items() for x in kv])[F.col("access_tier")]
    classed = anchors.withColumn("_c", F.when(F.col("verified"), 0).otherwise(10) + F.coalesce(tier, F.lit(9)))
    return numbered(classed, [F.col("_c"), F.col("anchor_id")], "rank").withColumn("rank", F.col("rank") + 1).drop("_c")


def audit_problems(audits: DataFrame) -> DataFrame:
    """Audit records with ``problems`` by the seven consistency rules."""
    c, subs = F.col, F.coalesce(F.col("sub_claims"), F.array())
    severity = F.create_map(*[F.lit(x) for kv in VERDICT_SEVERITY.items() for x in kv])[c("sentence_verdict")]
    complete = F.forall(F.array(*[c(k) for k in AUDIT_REQUIRED]), lambda x: F.coalesce(F.length(x) > 0, F.lit(False)))
    unquoted = F.exists(subs, lambda s: s["verdict"].isin("SUPPORTED", "CONTRADICTED") & (F.length(F.coalesce(s["evidence_quote"], F.lit(""))) == 0))
    said = c("sentence_verdict").eqNullSafe
    rules = {
        "R1 schema": c("schema") == AUDIT_SCHEMA,
        "R2 required": complete & (F.size(subs) > 0) & c("evidence_retrieved").isNotNull(),
        "R3 verdict": severity.isNotNull(),
        "R3 severity": severity.isNull() | (severity == c("severity")),
        "R4 quote": ~unquoted,
        "R5 tier": ~said("CLAIM-UNSUPPORTED") | c("access_tier_max").isin(FULL_TEXT_TIERS),
        "R6 retrieval": ~said("CLAIM-VERIFIED") | c("evidence_retrieved"),
        "R7 anchors": F.forall(F.coalesce(c("anchor_refs"), F.array()), lambda r: r.rlike(ANCHOR_ID)),
    }
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(k)) for k, ok in rules.items()]))
    return audits.withColumn("problems", F.when(c("_corrupt").isNotNull(), F.array(F.lit("unparseable"))).otherwise(failed))


def audit_verdict(checked: DataFrame) -> DataFrame:
    """RED where any record fails or there is none."""
    n, bad = F.count("*"), F.count_if(F.size("problems") > 0)
    return checked.agg(n.alias("records"), bad.alias("failed"), F.when((n == 0) | (bad > 0), "RED").otherwise("GREEN").alias("verdict"))


def action_required(audits: DataFrame, anchors: DataFrame, tagged: DataFrame, draft: DataFrame | None = None) -> DataFrame:
    """``reason, id, cite_key``: what needs a hand.

    Audited claims of high severity or a verdict that asks for a change; where a draft is
    given (``sentence``), audited claims whose fingerprint it no longer has; tags
    (``anchor_id``) that no active anchor has; anchors that rest on metadata alone.
    """
    wanted = (F.col("severity") == "HIGH") | F.col("sentence_verdict").isin(ACTION_VERDICTS)
    out = audits.where(wanted).select(F.lit("verdict").alias("reason"), F.col("claim_id").alias("id"), "cite_key")
    if draft is not None:
        now = draft.select(fingerprint(F.col("sentence")).alias("claim_fingerprint")).distinct()
        gone = audits.where(F.length("claim_fingerprint") > 0).join(now, "claim_fingerprint", "left_anti")
        out = out.union(gone.select(F.lit("stale"), "claim_id", "cite_key"))
    loose = tagged.select("anchor_id").distinct().join(anchors.select("anchor_id"), "anchor_id", "left_anti")
    weak = anchors.where((F.col("evidence_form") == "metadata_only") | (F.col("access_tier") == "T4_none"))
    return out.union(loose.select(F.lit("unmatched tag"), "anchor_id", F.lit(None).cast("string"))).union(weak.select(F.lit("metadata only"), "anchor_id", "cite_key"))


def metadata_rate(anchors: DataFrame, producer: str, most: int = 40) -> DataFrame:
    """``n, pct, warns``: the share of a producer's anchors that rest on metadata alone; null without any."""
    own = anchors.where(F.col("produced_by") == producer)
    weak = F.count_if((F.col("evidence_form") == "metadata_only") | (F.col("access_tier") == "T4_none"))
    pct = floor_percent(weak, F.count("*"))
    return own.agg(F.count("*").alias("n"), pct.alias("pct"), F.coalesce(pct > most, F.lit(False)).alias("warns"))


def audit_coverage(tagged: DataFrame, audited: DataFrame, least: int = 70) -> DataFrame:
    """``tagged, audited, pct, verdict``: distinct tagged ids and how many of them an audit refers to."""
    ids = tagged.select("anchor_id").distinct()
    known = audited.select("anchor_id").distinct().withColumn("_hit", F.lit(True))
    n, hit = F.count("*"), F.count("_hit")
    pct = floor_percent(hit, n)
    return ids.join(known, "anchor_id", "left").agg(n.alias("tagged"), hit.alias("audited"), pct.alias("pct"), F.when(n == 0, "INERT").when(pct < least, "YELLOW").otherwise("GREEN").alias("verdict"))


def dashboard(records: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, level, n``: counts by each key and in all; a missing value shows as ``?``, one that was summed over as ``(all)``.

    ``level`` has a bit for each key that was summed over, so the two can't be mixed up.
    """
    columns = [F.col(k) for k in keys]
    sets = records.groupingSets([[c] for c in columns] + [columns, []], *columns).agg(F.grouping_id().alias("level"), F.count("*").alias("n"))
    bit = lambda i: F.col("level").bitwiseAND(F.lit(1 << (len(keys) - 1 - i))) > 0
    return sets.select(*[F.when(bit(i), "(all)").otherwise(F.coalesce(k, F.lit("?"))).alias(k) for i, k in enumerate(keys)], F.col("level").cast("long").alias("level"), "n")


def chosen_audit(files: DataFrame, pointer: str | None = None) -> DataFrame:
    """The audit file a pointer names, else the last of the dated ones by name."""
    last = files.agg(F.max("name").alias("name"))
    named = files.where(F.col("name") == F.lit(pointer)).agg(F.max("name").alias("p")) if pointer else files.limit(0).agg(F.max("name").alias("p"))
    return last.crossJoin(named).select(F.coalesce("p", "name").alias("name"))  # one row each


def high_count(audits: DataFrame) -> DataFrame:
    return audits.agg(F.count_if(F.col("severity") == "HIGH").alias("n_high"))


def source_index(anchors: DataFrame, per_row: int = 10_000) -> DataFrame:
    """``cite_key, page, anchor_ids``: anchor ids by source, in order, ``per_row`` of them a row; a source that most cite has many rows."""
    placed = numbered(anchors.select("cite_key", "anchor_id"), [F.col("cite_key"), F.col("anchor_id")], "_n")
    first = placed.groupBy(F.col("cite_key").alias("_k")).agg(F.min("_n").alias("_f"))
    paged = placed.join(first, F.col("cite_key").eqNullSafe(F.col("_k"))).withColumn("page", F.floor((F.col("_n") - F.col("_f")) / per_row))
    return paged.groupBy("cite_key", "page").agg(F.sort_array(F.collect_list("anchor_id")).alias("anchor_ids"))
