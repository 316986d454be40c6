"""Citation, claim-marker and manuscript checks over lines of text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.rules import CAUSAL, CITATION, CITED, MARKERS
from auditloom.functions.text import count_lines, few, lines

# Headings of reference lists, and absolute paths into data in scripts.
REFERENCES = r"^(## References|# References|## Bibliography|## Works Cited)"
REFERENCE_START = r"^#.*([Rr]eferences|[Bb]ibliography)"
MICRODATA = "dta|sav|por|zsav|rds|rdata|rda|RData|parquet|feather|sas7bdat|xpt|dbf"
ABSOLUTE_DATA_PATH = rf"""["']/[^"' ]*\.({MICRODATA})["']?|["']/[^"' ]*/(data|raw)/[^"' ]*["']?|setwd\(["']/[^"' ]*/(data|raw)[^"' ]*["']\)"""


def citations(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Distinct in-text citations."""
    return df.select(*keys, F.explode(F.regexp_extract_all(text, F.lit(CITATION), F.lit(0))).alias("citation")).distinct()


def future(found: DataFrame, latest: int = 2030) -> DataFrame:
    year = F.regexp_extract("citation", r"([12][0-9]{3})[a-z]?\)$", 1).cast("int")
    return found.withColumn("year", year).where(F.col("year") > latest)


def unreferenced(text: Column | str) -> Column:
    """Citations in a text without a section of references."""
    cited = F.col(text).rlike(CITATION) if isinstance(text, str) else text.rlike(CITATION)
    return F.coalesce(cited & (count_lines(text, REFERENCES) == 0), F.lit(False))


def line_table(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, line_no, line``."""
    return df.select(*keys, F.posexplode(lines(text)).alias("line_no", "line"))


def duplicate_lines(df: DataFrame, key: str, text: str = "text", after_header: bool = True) -> DataFrame:
    """Lines that repeat exactly in a document, after its header of references where asked."""
    all_lines = lines(text)
    if after_header:
        # What follows the first heading, in the same pass.
        head = F.array_position(F.transform(all_lines, lambda x: x.rlike(REFERENCE_START)), True)
        all_lines = F.when(head > 0, F.slice(all_lines, (head + 1).cast("int"), F.size(all_lines))).otherwise(F.array().cast("array<string>"))
    kept = F.filter(all_lines, lambda x: (x != "") & ~x.startswith("#"))
    return df.select(key, F.explode(kept).alias("line")).groupBy(key, "line").agg(F.count("*").alias("n")).where("n > 1")


def data_path_lines(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, line_no, line``: lines, from 1, that name data by an absolute path."""
    found = line_table(df, keys, text).where(F.col("line").rlike(ABSOLUTE_DATA_PATH))
    return found.withColumn("line_no", (F.col("line_no") + 1).cast("long"))


def marker_counts(text: Column | str) -> dict[str, Column]:
    """Lines that hold each claim marker."""
    return {name.lower().replace("-", "_"): count_lines(text, rf"\[CLAIM-{name}[\]:]") for name, _ in MARKERS}


def marker_verdict(counts: dict[str, Column]) -> Column:
    kinds = {name.lower().replace("-", "_"): kind for name, kind in MARKERS}
    total = lambda kind: sum((c for k, c in counts.items() if kinds[k] == kind), F.lit(0))
    return F.when(total("error") > 0, "FAIL").when(total("warning") > 0, "PASS_WITH_WARNINGS").otherwise("PASS")


def causal_lines(text: Column | str, reach: int = 80) -> Column:
    """Lines with a causal verb near a citation, on either side."""
    return count_lines(text, rf"({CAUSAL})[^\n]{{0,{reach}}}{CITED}|{CITED}[^\n]{{0,{reach}}}({CAUSAL})")


def word_count(text: Column | str) -> Column:
    return F.size(F.filter(F.split(text, r"[ \t\n\r\f\x0b]+"), lambda x: x != "")).cast("long")


def length_tier(words: Column) -> Column:
    return F.when(words < 3000, "FAIL").when(words < 6000, "WARN").otherwise("PASS")


def dash_density(text: Column | str) -> tuple[Column, Column, Column]:
    """Em-dashes, pages of fifty lines, and dashes a page, rounded down."""
    t = F.col(text) if isinstance(text, str) else text
    dashes = F.coalesce(F.length(t) - F.length(F.replace(t, F.lit("—"), F.lit(""))), F.lit(0)).cast("long")
    ends = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    pages = F.floor((ends + 49) / 50).cast("long")
    return dashes, pages, F.when(pages > 0, F.floor(dashes / pages)).cast("long")


@dataclass(frozen=True)
class Artifact:
    """What a phase leaves behind: files by name, or lines of the state, at least so many, else a severity.

    ``kind`` names what is counted: ``files`` whose path matches ``pattern``, ``state`` lines
    that do, or ``words`` of the first such file. ``unless`` is a pattern of the state that
    does as well, ``if_state`` a pattern of the state without which the severity is WARN;
    ``only_if`` is a pattern of files without which nothing is asked.
    """

    phase: str
    label: str
    pattern: str
    severity: str = "FAIL"
    kind: str = "files"
    least: int = 1
    unless: str = ""
    if_state: str = ""
    not_in: str = ""
    only_if: str = ""


_LOG = r"log"
# The phases and what each must leave in a project's folder. Paths are relative
# to it; names match as a shell's wildcards do, at any depth unless a folder is given.
PHASE_ARTIFACTS = (
    Artifact("-1", "safety log", r"^logs/.*[^/]*safety[^/]*$"),
    Artifact("0-PRE", "brainstorm report", r"(^|/)[^/]*brainstorm[^/]*$", "WARN"),
    Artifact("0", "idea", r"(^|/)[^/]*idea[^/]*$"),
    Artifact("1", "target journal", r"(?i)target.*journal|journal.*:", kind="state"),
    Artifact("2", "literature review", r"(^|/)[^/]*(lit-review|scholar-lrh|lrh-)[^/]*$"),
    Artifact("2", "literature review's words", r"(^|/)[^/]*(lit-review|scholar-lrh|lrh-)[^/]*$", kind="words", least=2000, only_if=r"(^|/)[^/]*(lit-review|scholar-lrh|lrh-)[^/]*$"),
    Artifact("2", "search log", r"^logs/(.*/)?[^/]*search-log[^/]*$", "WARN"),
    Artifact("3", "design", r"(^|/)[^/]*(design|blueprint)[^/]*$"),
    Artifact("4", "variables", r"(^|/)[^/]*(variable|var-dict|data-blueprint|data-plan)[^/]*$", unless=r"(?i)variable|var.*dict|data.*source|sample.*N"),
    Artifact("4", "data status", r"(?i)data.*status|existing-data|no-data|collecting", "WARN", kind="state"),
    Artifact("5", "tables", r"^tables/.+$", if_state=r"(?i)existing-data|DATA-AVAILABLE"),
    Artifact("5", "figures", r"^figures/.+$", if_state=r"(?i)existing-data|DATA-AVAILABLE"),
    Artifact("5", "tables as CSV", r"^tables/(.*/)?[^/]*\.csv$", "WARN", only_if=r"^tables/.+$"),
    Artifact("5", "scripts", r"^scripts/(.*/)?[^/]*\.(R|py)$", "WARN"),
    Artifact("5", "coding decisions", r"^scripts/coding-decisions-log\.md$", "WARN"),
    Artifact("5", "script index", r"^scripts/script-index\.md$", "WARN"),
    Artifact("5.5", "code review", r"(^|/)[^/]*code-review[^/]*$"),
    Artifact("6", "branch output", r"(^|/)[^/]*(compute|ling|annotate)[^/]*$", "WARN", not_in="log|SKILL"),
    Artifact("7", "draft", r"^drafts/(.*/)?[^/]*\.md$"),
    Artifact("7", "draft's words", r"^drafts/(.*/)?[^/]*\.md$", kind="words", least=5000, only_if=r"^drafts/(.*/)?[^/]*\.md$"),
    Artifact("7b", "verification report", r"(^|/)[^/]*(verification|verify)[^/]*$", not_in=_LOG),
    Artifact("7c", "polished draft", r"(^|/)[^/]*(polish|style)[^/]*$|^drafts/(.*/)?[^/]*\.md$"),
    Artifact("9", "cover letter", r"(^|/)[^/]*cover-letter[^/]*$", "WARN"),
    Artifact("9", "replication package", r"^replication-package/.+$"),
    Artifact("9", "replication code", r"^replication-package/code/(.*/)?[^/]*\.(R|py)$", "WARN", only_if=r"^replication-package/.+$"),
    Artifact("9", "replication readme", r"^replication-package/README\.md$", "WARN", only_if=r"^replication-package/.+$"),
    Artifact("9b", "ethics report", r"(^|/)[^/]*ethics[^/]*$", not_in=_LOG),
    Artifact("10", "review simulation", r"(^|/)[^/]*(triage|review-sim|respond)[^/]*$"),
    Artifact("11", "final md", r"^drafts/(.*/)?manuscript-final[^/]*\.md$"),
    Artifact("11", "final docx", r"^drafts/(.*/)?manuscript-final[^/]*\.docx$"),
    Artifact("11", "final tex", r"^drafts/(.*/)?manuscript-final[^/]*\.tex$"),
    Artifact("11", "final pdf", r"^drafts/(.*/)?manuscript-final[^/]*\.pdf$"),
)
#: Phases without mandatory artifacts of their own: 8 counts markers, the rest are optional.
FREE_PHASES = ("8", "12", "13", "14")
PHASE_ALIASES = {
    "safety": "-1", "0pre": "0-PRE", "brainstorm": "0-PRE", "idea": "0", "brief": "1", "lit": "2", "theory": "2", "design": "3", "data": "4", "analysis": "5", "code-review": "5.5",
    "compute": "6", "ling": "6", "draft": "7", "write": "7", "verify": "7b", "polish": "7c", "citation": "8", "review": "10", "submission": "9", "ethics": "9b", "assembly": "11",
    "grant": "12", "presentation": "13", "auto-improve": "14",
}


def phase_name(phase: Column) -> Column:
    """A phase by its number, whichever of its names is used; null for one that is not known."""
    known = {**PHASE_ALIASES, **{a.phase: a.phase for a in PHASE_ARTIFACTS}, **{p: p for p in FREE_PHASES}}
    return F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[phase]


def phase_states(inventory: DataFrame, state: DataFrame) -> DataFrame:
    """``phase, label, found, state``: every rule against ``inventory(path, n_words)`` and the lines of ``state(line)``.

    The rules are the fixed table above, so each input is read once, and one row of counts
    meets the rules. Words are those of the rule's first file by path.
    """
    counts = []
    for i, a in enumerate(PHASE_ARTIFACTS):
        hit = F.col("path").rlike(a.pattern)
        if a.not_in:
            hit = hit & ~F.col("path").rlike(a.not_in)
        if a.kind == "words":
            counts.append(F.coalesce(F.min_by("n_words", F.when(hit, F.col("path"))), F.lit(0)).cast("long").alias(f"f{i}"))
        else:
            counts.append((F.lit(0).cast("long") if a.kind == "state" else F.count_if(hit)).alias(f"f{i}"))
    counts += [F.count_if(F.col("path").rlike(a.only_if or "(?!)")).alias(f"o{i}") for i, a in enumerate(PHASE_ARTIFACTS)]
    lines_ = [F.count_if(F.col("line").rlike(a.pattern if a.kind == "state" else a.unless or a.if_state or "(?!)")).alias(f"s{i}") for i, a in enumerate(PHASE_ARTIFACTS)]
    one = inventory.agg(*counts).crossJoin(state.agg(*lines_))  # one row each
    rows = []
    for i, a in enumerate(PHASE_ARTIFACTS):
        files, said = F.col(f"f{i}"), F.col(f"s{i}")
        found = said if a.kind == "state" else files
        enough = found >= a.least
        enough = enough | (said > 0) if a.unless else enough
        enough = enough | (F.col(f"o{i}") == 0) if a.only_if else enough
        missed = F.when(said > 0, "FAIL").otherwise("WARN") if a.if_state else F.lit(a.severity)
        rows.append(F.struct(F.lit(a.phase).alias("phase"), F.lit(a.label).alias("label"), found.alias("found"), F.when(enough, "PASS").otherwise(missed).alias("state")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def phase_verdict(states: DataFrame) -> DataFrame:
    """``phase, issues, warnings, verdict`` of rule states."""
    issues, warnings = F.count_if(F.col("state") == "FAIL"), F.count_if(F.col("state") == "WARN")
    verdict = F.when(issues > 0, "FAIL").when(warnings > 0, "PASS with warnings").otherwise("PASS")
    return states.groupBy("phase").agg(issues.alias("issues"), warnings.alias("warnings"), verdict.alias("verdict"))


def phase_rules(rules: DataFrame, inventory: DataFrame) -> DataFrame:
    """``rules(phase, pattern, least, severity)`` of one's own against ``inventory(path)``: files, and the state."""
    hits = inventory.join(few(rules), F.expr("path rlike pattern")).groupBy("phase", "pattern").agg(F.count("*").alias("files"))
    out = rules.join(hits, ["phase", "pattern"], "left").withColumn("files", F.coalesce("files", F.lit(0)))
    return out.withColumn("state", F.when(F.col("files") >= F.col("least"), "PASS").otherwise(F.col("severity")))


def embedded(text: Column | str) -> tuple[Column, Column]:
    """Lines with a table or its heading, and lines with a figure."""
    return count_lines(text, r"^## Table|^\|.*\|.*\|"), count_lines(text, r"!\[")


def phase_heading(line: Column, phase: str) -> Column:
    """A line that records a phase; what follows its number must be a blank, dash, colon, bracket or nothing."""
    number = "".join(f"[{c}]" if not c.isalnum() else c for c in phase)
    return F.coalesce(line.rlike(rf"^(## |### |- )?Phase {number}([ \t]|—|:|\(|$)"), F.lit(False))


def file_present(inventory: DataFrame, path: str, least_lines: int = 3) -> DataFrame:
    """Whether a file is there and has enough lines: one row, also for an empty inventory."""
    n = F.max(F.when(F.col("path") == path, F.col("n_lines")))
    return inventory.agg(F.when(n.isNull(), "missing").when(n < least_lines, "too short").otherwise("present").alias("state"))


def logged(log: DataFrame, phase: str) -> DataFrame:
    """Whether a process log mentions a phase; null where there is no log, which is nothing to check."""
    return log.agg(F.bool_or(F.col("line").contains(f"Phase {phase}")).alias("logged"))
