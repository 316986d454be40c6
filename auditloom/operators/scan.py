"""Sensitivity scan: rules to verdicts, entities with offsets, redaction, one pass per table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from auditloom.functions.rules import ANY_STEM, ANY_WORD, OPAQUE_EXTENSIONS, RULES
from auditloom.functions.text import clip, lines

#: Per gate, what a text must hold for the gate's rules to be tried.
GATES = {"words": lambda t: t.rlike(ANY_WORD), "digit": lambda t: t.rlike("[0-9]"), "at": lambda t: t.contains("@")}


def rule_hit(rule, text: Column | str = "text") -> Column:
    """Whether a rule fires anywhere in a text; a null text fires nothing."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(t.rlike(rule.pattern), F.lit(False))


def hits(text: Column | str = "text", severity: str | None = None) -> Column:
    """The labels of the rules that fire; every rule counts once, and none in a null text.

    The rules of a gate are tried only where the gate's one cheap pass finds something.
    """
    t = F.col(text) if isinstance(text, str) else text
    none, parts = F.array().cast("array<string>"), []
    for gate, opens in GATES.items():
        rules = [r for r in RULES if r.gate == gate and severity in (None, r.severity)]
        if rules:
            fired = F.array_compact(F.array(*[F.when(t.rlike(r.pattern), F.lit(r.label)) for r in rules]))
            parts.append(F.when(opens(t), fired).otherwise(none))
    return F.concat(*parts)


def with_hits(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``hits``."""
    return df.withColumn("hits", hits(text))


def verdict(found: Column, unreadable: Column | None = None) -> Column:
    """RED before YELLOW before GREEN; what can't be read is YELLOW, never GREEN."""
    red = F.exists(found, lambda x: x.startswith("RED:"))
    out = F.when(red, "RED").when(F.size(found) > 0, "YELLOW")
    return (out.when(unreadable, "YELLOW") if unreadable is not None else out).otherwise("GREEN")


def scan(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with ``hits, verdict, red_count, yellow_count``.

    A null text is unreadable; a path with an opaque extension and no finding is YELLOW.
    """
    unreadable = F.col(text).isNull()
    if path:
        unreadable = unreadable | extension(F.col(path)).isin(OPAQUE_EXTENSIONS)
    out = with_hits(df, text)
    red = F.size(F.filter("hits", lambda x: x.startswith("RED:"))).cast("long")
    return out.withColumns({"verdict": verdict(F.col("hits"), unreadable), "red_count": red, "yellow_count": F.size("hits").cast("long") - red})


def extension(path: Column) -> Column:
    """What stands after a path's last dot up to a blank, in lower case; empty without a dot in its last part."""
    return F.lower(F.regexp_extract(path, r"\.([^./\s]*)(\s[^./]*)?$", 1))


def spans(df: DataFrame, keys: list[str], name: str, pattern: str, group: int, text: str = "text") -> DataFrame:
    """One row per match: ``keys, rule, ord, snippet``."""
    found = df.select(*keys, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("ord", "value"))
    return found.select(*keys, F.lit(name).alias("rule"), F.col("ord").cast("long").alias("ord"), clip(F.col("value")).alias("snippet"))


# ---- entity recognisers ---------------------------------------------------------------


@dataclass(frozen=True)
class Recogniser:
    entity: str
    name: str
    pattern: str
    score: float


def _terms(entity: str, name: str, body: str, score: float) -> Recogniser:
    return Recogniser(entity, name, rf"\b({body})\b", score)


# The recognisers' vocabulary, with the score of each pattern. Patterns ignore
# case, and a dot matches line ends too.
RECOGNISERS = (
    _terms("HIPAA_IDENTIFIER", "medical_record", r"medical[\s_]?record|patient[\s_]?id|mrn|health[\s_]?plan|beneficiary", 0.7),
    _terms("HIPAA_IDENTIFIER", "clinical_data", r"diagnosis|icd[\s_]?[0-9]|prescription|medication|treatment[\s_]?plan|discharge[\s_]?summary", 0.5),
    _terms("MENTAL_HEALTH_DATA", "high_sensitivity", r"suicid(?:e|al|ality)|self[\s_]?harm|bipolar|schizophren(?:ia|ic)|psychosis|eating[\s_]?disorder", 0.7),
    Recogniser("MENTAL_HEALTH_DATA", "with_data_markers", r"\b(?:patient|subject|respondent|participant|score|scale|diagnosis|_id|_code)\b.*\b(?:depression|ptsd|anxiety[\s_]?disorder|psychiatric|mental[\s_]?health[\s_]?diagnosis)\b", 0.85),
    _terms("IMMIGRATION_STATUS", "immigration", r"undocumented|immigration[\s_]?status|deportat|asylum[\s_]?seek|visa[\s_]?status|DACA|refugee[\s_]?status|legal[\s_]?status|citizenship[\s_]?status", 0.8),
    _terms("IMMIGRATION_STATUS", "criminal", r"arrest[\s_]?record|criminal[\s_]?record|conviction|incarcerat|parole|probation|mugshot|booking", 0.8),
    _terms("FINANCIAL_DATA", "accounts", r"credit[\s_]?card|account[\s_]?number|bank[\s_]?account|routing[\s_]?number|tax[\s_]?id|ein", 0.8),
    _terms("FINANCIAL_DATA", "individual_finance", r"income[\s_]?amount|salary|wage[\s_]?rate|net[\s_]?worth", 0.5),
    _terms("BIOMETRIC_DATA", "biometric", r"biometric|fingerprint|retina|facial[\s_]?recognition|dna[\s_]?sample|genetic[\s_]?data|genome", 0.8),
    _terms("NAME_FIELD", "name_column", r"first_?name|last_?name|full_?name|respondent_?name|participant_?name", 0.85),
    _terms("DATE_OF_BIRTH", "dob", r"date[\s_.]?of[\s_.]?birth|dob|birth[\s_.]?date", 0.85),
    _terms("SOGI_DATA", "sogi", r"sexual[\s_]?orientation|gender[\s_]?identity|transgender|lgbtq|non[\s_]?binary|sexual[\s_]?preference|coming[\s_]?out", 0.5),
    _terms("BELIEF_DATA", "belief", r"religious[\s_]?affiliation|political[\s_]?affiliation|party[\s_]?registration|church[\s_]?membership|mosque|synagogue|temple[\s_]?membership", 0.5),
    _terms("RESTRICTED_MARKER", "restricted", r"restricted[\s_]?use|confidential|under[\s_]?embargo|data[\s_]?use[\s_]?agreement|DUA", 0.5),
    _terms("GEO_IDENTIFIER", "geo", r"census[\s_]?tract|block[\s_]?group|zip[\s_]?code|street[\s_]?address|latitude|longitude|geocode", 0.5),
    _terms("US_SSN", "ssn_broad", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.8),
)

#: Stand-ins, by pattern, for recognisers that a library brings along.
BUILT_IN = (
    _terms("EMAIL_ADDRESS", "email", r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}", 1.0),
    Recogniser("PHONE_NUMBER", "phone", r"(?<![0-9.])\+?1?[-. ]?\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9.])", 0.75),
    _terms("IP_ADDRESS", "ip", r"(?:(?:1?[0-9]{1,2}|2[0-4][0-9]|25[0-5])\.){3}(?:1?[0-9]{1,2}|2[0-4][0-9]|25[0-5])", 0.95),
)

# Entities whose severity depends on the score, with the least score that is
# RED; entities that are always RED; entities that are left out; the longest text that is read.
RED_FROM = {"PERSON": 0.85, "HIPAA_IDENTIFIER": 0.6, "MENTAL_HEALTH_DATA": 0.85, "FINANCIAL_DATA": 0.7}
RED_ENTITIES = ("US_SSN", "CREDIT_CARD", "US_BANK_NUMBER", "IBAN_CODE", "IMMIGRATION_STATUS", "BIOMETRIC_DATA", "NAME_FIELD", "DATE_OF_BIRTH")
SKIPPED_ENTITIES = ("DATE_TIME", "NRP", "URL", "US_DRIVER_LICENSE")
TEXT_LIMIT = 9_500_000

SPAN = "entity string, start long, end long, score double"

#: Letters beyond ASCII that a pattern of ASCII letters takes for one of them when case is ignored.
_ODD_CASE = re.compile("[\u0130\u0131\u017f\u212a]")


def seeds(pattern: str) -> list[str] | None:
    """What a find of ``pattern`` can begin with, in lower case: the leading letters of each alternative; None where one has none."""
    head = re.match(r"\\b\((?:\?:)?", pattern)
    if not head:
        return None
    out, depth, at, inside = [], 1, head.end(), False
    for i in range(head.end(), len(pattern)):
        c, escaped = pattern[i], pattern[i - 1] == "\\"
        inside = not escaped and ((inside and c != "]") or c == "[")
        if inside or escaped:
            continue
        depth += (c == "(") - (c == ")")
        if (c == "|" and depth == 1) or depth == 0:
            letters = re.match(r"[A-Za-z_]*", pattern[at:i])[0]
            if letters and pattern[at + len(letters) :][:1] in ("?", "*", "{"):
                letters = letters[:-1]  # the last one may be missing
            if not letters:
                return None
            out.append(letters.lower())
            at = i + 1
        if depth == 0:
            break
    return sorted(set(out))


class Finder:
    """All recognisers over a text: one automaton finds where terms begin, and patterns are tried there alone.

    A pattern without leading letters runs over the texts that hold a digit or an at-sign, as
    its finds do, and over what holds letters that only differ from ASCII ones by case.
    """

    def __init__(self, recognisers: list[tuple[str, float, str]]) -> None:
        import ahocorasick

        self.ready = [(entity, score, re.compile(pattern, re.I | re.S | re.M)) for entity, score, pattern in recognisers]
        begins: dict[str, list[int]] = {}
        self.free = []
        for i, (_, _, pattern) in enumerate(recognisers):
            own = seeds(pattern)
            for x in own or []:
                begins.setdefault(x, []).append(i)
            if own is None:
                self.free.append(i)
        self.terms = ahocorasick.Automaton()
        for x, which in begins.items():
            self.terms.add_word(x, (len(x), which))
        if begins:
            self.terms.make_automaton()
        self.lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        self.marked = re.compile("[0-9@]")

    def __call__(self, body: str) -> Iterator[tuple[int, int, int, str]]:
        """``(recogniser, start, end, value)`` of every find; those of one recogniser in order, without overlaps."""
        if _ODD_CASE.search(body):
            whole, hits = range(len(self.ready)), {}
        else:
            whole, hits = (self.free if self.marked.search(body) else ()), {}
            # ASCII alone changes case, so places stay what they are.
            for last, (n, which) in self.terms.iter(body.lower() if body.isascii() else body.translate(self.lower)) if len(self.terms) else ():
                for i in which:
                    hits.setdefault(i, []).append(last - n + 1)
        for i in whole:
            for m in self.ready[i][2].finditer(body):
                yield i, m.start(), m.end(), m[0]
        for i, places in hits.items():
            upto, match = 0, self.ready[i][2].match
            for at in sorted(set(places)):
                if at >= upto and (m := match(body, at)):
                    yield i, at, m.end(), m[0]
                    upto = m.end()


def recognise(df: DataFrame, keys: list[str], text: str = "text", recognisers: tuple[Recogniser, ...] = RECOGNISERS + BUILT_IN, limit: int = TEXT_LIMIT) -> DataFrame:
    """``keys, entity, start, end, score, value, truncated``: a row per find, in code points, ends exclusive.

    Finds of one pattern don't overlap; finds of several do. A text beyond ``limit``
    characters is read up to there, and its finds say so in ``truncated``; ``truncations``
    names such texts, whether or not anything was found. Offsets need an engine that gives
    them, so texts go to Python workers in Arrow batches, but only those that hold the
    beginning of a term, a digit or an at-sign.
    """
    schema = StructType([df.schema[k] for k in keys]).add("entity", "string").add("start", "long").add("end", "long").add("score", "double").add("value", "string").add("truncated", "boolean")
    compiled = [(r.entity, r.score, r.pattern) for r in recognisers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(compiled)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, place = [], []
                for i, body in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                    part, cut = body[:limit], len(body) > limit
                    for which, start, end, value in find(part):
                        entity, score, _ = compiled[which]
                        rows.append((entity, start, end, score, value, cut))
                        place.append(i)
                if rows:
                    taken = [batch.column(i).take(pa.array(place, pa.int32())) for i in range(batch.num_columns - 1)]
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([*taken, *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=schema.names)

    t = F.col(text)
    may = t.rlike(ANY_STEM) | t.rlike("[0-9]") | t.contains("@")
    return df.where(may).select(*keys, t.alias("_text")).mapInArrow(run, schema)


def truncations(df: DataFrame, keys: list[str], text: str = "text", limit: int = TEXT_LIMIT) -> DataFrame:
    """``keys, n_chars``: texts that ``recognise`` reads in part."""
    return df.where(F.length(text) > limit).select(*keys, F.length(text).cast("long").alias("n_chars"))


def opaque_findings(df: DataFrame, keys: list[str], path: str) -> DataFrame:
    """``keys, entity, score, value``: one synthetic finding for each path that can't be read as text."""
    ext = extension(F.col(path))
    return df.where(ext.isin(OPAQUE_EXTENSIONS)).select(*keys, F.lit("BINARY_FORMAT").alias("entity"), F.lit(1.0).alias("score"), F.concat(F.lit("."), ext).alias("value"))


def best_spans(found: DataFrame, keys: list[str], least: float = 0.4) -> DataFrame:
    """Spans of at least a score, one per place and entity, the best first."""
    place = [*keys, "start", "end", "entity"]
    best = F.max_by(F.struct(*[c for c in found.columns if c not in place]), "score").alias("b")
    return found.where(F.col("score") >= least).groupBy(*place).agg(best).select(*place, "b.*")


def entity_severity(entity: Column, score: Column) -> Column:
    """RED, YELLOW, or null for entities that are skipped; unknown ones are YELLOW."""
    out = F.when(entity.isin(*SKIPPED_ENTITIES), F.lit(None).cast("string"))
    for name, red in RED_FROM.items():
        out = out.when(entity == name, F.when(score >= red, "RED").otherwise("YELLOW"))
    return out.when(entity.isin(*RED_ENTITIES), "RED").otherwise("YELLOW")


def entity_verdicts(df: DataFrame, found: DataFrame, keys: list[str], path: str | None = None) -> DataFrame:
    """``df`` with ``verdict, red_count, yellow_count`` from recognised spans.

    Keys identify rows; a null text, and an opaque path without a RED find, is YELLOW.
    """
    if path:
        synthetic = opaque_findings(df, keys, path).withColumns({"start": F.lit(0).cast("long"), "end": F.lit(0).cast("long"), "truncated": F.lit(False)})
        found = found.unionByName(synthetic)
    graded = best_spans(found, keys).withColumn("_s", entity_severity(F.col("entity"), F.col("score"))).where("_s IS NOT NULL")
    counts = graded.groupBy(*keys).agg(F.count_if(F.col("_s") == "RED").alias("red_count"), F.count_if(F.col("_s") == "YELLOW").alias("yellow_count"))
    out = df.join(counts, keys, "left").fillna(0, ["red_count", "yellow_count"])
    return out.withColumn("verdict", F.when(F.col("red_count") > 0, "RED").when((F.col("yellow_count") > 0) | F.col("text").isNull(), "YELLOW").otherwise("GREEN"))


BACKENDS = ("regex", "entities", "model")


def scan_with(df: DataFrame, keys: list[str], backend: str = "regex", path: str | None = None, model: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """``keys, verdict, red_count, yellow_count, backend``: texts graded by a chosen backend.

    ``entities`` runs the recognisers; ``model`` adds the spans that ``model(df, keys)``
    gives, in the columns of ``recognise``. Where no model is at hand, or it names none of
    the known columns, the rules take over, and ``backend`` says so.
    """
    if backend not in BACKENDS:
        raise ValueError(f"backend is one of {', '.join(BACKENDS)}")
    used, found = backend, None
    if backend == "model":
        extra = model(df, keys) if model else None
        columns = {*keys, "entity", "start", "end", "score", "value", "truncated"}
        if extra is None or not columns <= set(extra.columns):
            used = "regex"
        else:
            found = recognise(df, keys).unionByName(extra.select(*recognise(df, keys).columns))
    elif backend == "entities":
        found = recognise(df, keys)
    out = scan(df, "text", path) if found is None else entity_verdicts(df, found, keys, path)
    return out.select(*keys, "verdict", F.col("red_count").cast("long").alias("red_count"), F.col("yellow_count").cast("long").alias("yellow_count"), F.lit(used).alias("backend"))


def level_tally(levels: DataFrame, level: str = "verdict") -> DataFrame:
    """``level, n``: a row for each of the four levels, what is none of them as UNKNOWN."""
    known = F.when(F.col(level).isin("GREEN", "YELLOW", "RED"), F.col(level)).otherwise("UNKNOWN")
    counts = levels.agg(*[F.count_if(known == k).alias(k) for k in ("GREEN", "YELLOW", "RED", "UNKNOWN")])
    rows = F.array(*[F.struct(F.lit(k).alias("level"), F.col(k).alias("n")) for k in ("GREEN", "YELLOW", "RED", "UNKNOWN")])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


# ---- output ---------------------------------------------------------------------------


def is_bulk(text: Column | str, limit: int = 200) -> Column:
    """More than ``limit`` lines with two commas or two tabs."""
    wide = F.filter(lines(text), lambda x: x.rlike("(,[^\n]*,)|(\t[^\n]*\t)"))
    return F.coalesce(F.size(wide) > limit, F.lit(False))


def redact(df: DataFrame, text: str = "text", limit: int = 200, out: str = "redacted", stream: str = "stdout") -> DataFrame:
    """Texts replaced where the scan is RED or, on stdout, the output is a bulk of rows."""
    red = F.coalesce(F.size(hits(text, "RED")) > 0, F.lit(False))
    gone = red | is_bulk(text, limit) if stream == "stdout" else red
    return df.withColumn(out, F.when(gone, F.lit("[REDACTED]")).otherwise(F.col(text)))


def guard_active(level: Column, restricted: Column) -> Column:
    """Output is guarded at strict levels once anything is restricted."""
    return level.isin("strict", "lockdown") & (restricted > 0)


def risk(red: Column, yellow: Column) -> Column:
    """A composite: any RED is HIGH, three YELLOW or more MEDIUM."""
    return F.when(red > 0, "HIGH").when(yellow >= 3, "MEDIUM").otherwise("LOW")


def unique_names(df: DataFrame, name: str, order: str, out: str = "unique_name", existing: DataFrame | None = None) -> DataFrame:
    """Names without collisions: a name's first row keeps it, further rows get ``-2``, ``-3`` before the extension.

    Numbers that another row's own name, or one of ``existing(name)``, has already taken are
    passed over; a name that exists is taken from the first row on.
    """
    stem, ext = r"^(.*?)(\.[^.]*)?$", r"(\.[^.]*)$"
    there = df.select(F.col(name).alias("_t")).distinct()
    if existing is not None:
        there = there.union(existing.select("name")).distinct()
    # Names such as a-2.csv, by the name that they would be a number of.
    numbered = there.select(F.regexp_replace("_t", r"-([0-9]+)(\.[^.]*)?$", "$2").alias("_g"), F.regexp_extract("_t", r"-([0-9]+)(\.[^.]*)?$", 1).alias("_k")).where("_k <> ''")
    taken = numbered.select("_g", F.expr("try_cast(_k AS long)").alias("_k")).where("_k >= 2")
    if existing is not None:
        taken = taken.union(existing.select("name", F.lit(1).cast("long")))
    taken = taken.distinct().groupBy("_g").agg(F.sort_array(F.collect_list("_k")).alias("_taken"))
    n = F.row_number().over(Window.partitionBy(name).orderBy(order)).cast("long")
    ranked = df.withColumn("_n", n).join(taken, F.col(name) == F.col("_g"), "left")
    # The i-th free number is i plus the taken ones that lie before it.
    before = F.size(F.filter(F.transform(F.coalesce("_taken", F.array().cast("array<long>")), lambda t, i: t - i), lambda u: u <= F.col("_n")))
    ranked = ranked.withColumn("_n", F.col("_n") + before)
    renamed = F.concat(F.regexp_extract(name, stem, 1), F.lit("-"), F.col("_n").cast("string"), F.regexp_extract(name, ext, 1))
    return ranked.withColumn(out, F.when(F.col("_n") == 1, F.col(name)).otherwise(renamed)).drop("_n", "_g", "_taken")
