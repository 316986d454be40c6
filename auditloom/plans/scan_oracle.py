"""The scan's rules once more, as DuckDB's engine takes them, typed apart from the rules themselves.

That engine has no look-around, so a boundary is a character that is consumed.
"""

from __future__ import annotations

from auditloom.plans.registry import quoted

_OPEN, _SHUT = r"(?:^|[^\pL\pM\pN_])(?:", r")(?:$|[^\pL\pM\pN_])"


def _w(body: str) -> str:
    return f"(?i){_OPEN}{body}{_SHUT}"


#: rule -> (severity, category, pattern)
SQL_RULES = {
    "ssn": ("RED", 1, _OPEN + r"\d{3}-\d{2}-\d{4}" + _SHUT),
    "phone": ("RED", 1, r"(?:^|[^0-9.])\+?1?[-. ]?\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}(?:[^0-9.]|$)"),
    "birth_date": ("RED", 1, _w("date.?of.?birth|birth.?date|dob")),
    "name_field": ("RED", 1, _w("(?:first|last|full|respondent|participant)_?name")),
    "email": ("YELLOW", 2, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    "street_address": ("YELLOW", 2, r"(?i)(?:^|[^\pL\pM\pN_])\d{1,5}[ \t]+(?:north|south|east|west|[nsew]\.)?[ \t]*(?:(?:street|avenue|road|boulevard|drive|lane|court)(?:$|[^\pL\pM\pN_])|(?:st|ave|rd|blvd|dr|ln|ct)\.[\pL\pM\pN_])"),
    "geography": ("YELLOW", 3, _w("census.?tract|block.?group|zip.?code|street.?address|latitude|longitude|geocode")),
    "ip_address": ("YELLOW", 3, _OPEN + r"(?:(?:1?\d{1,2}|2[0-4]\d|25[0-5])\.){3}(?:1?\d{1,2}|2[0-4]\d|25[0-5])" + _SHUT),
    "health_id": ("RED", 4, _w("medical.?record|patient.?id|mrn|health.?plan|beneficiary")),
    "clinical": ("YELLOW", 4, _w(r"diagnosis|icd.?\d|prescription|medication|treatment.?plan|discharge.?summary")),
    "mental_health": ("YELLOW", 5, _w("suicide|suicidal|suicidality|self.?harm|bipolar|schizophrenia|schizophrenic|psychosis|eating.?disorder")),
    "mental_health_record": (
        "RED", 5,
        r"(?i)(?:^|[^\pL\pM\pN_])(?:patient|subject|respondent|participant|score|scale|diagnosis|_id|_code)[^\pL\pM\pN_\n][^\n]*(?:depression|ptsd|anxiety.?disorder|psychiatric|mental.?health.?diagnosis)(?:$|[^\pL\pM\pN_])"
        r"|(?:^|[^\pL\pM\pN_])(?:depression|ptsd|anxiety.?disorder|psychiatric|mental.?health.?diagnosis)[^\pL\pM\pN_\n][^\n]*(?:patient|subject|respondent|participant|score|scale|diagnosis|_id|_code)(?:$|[^\pL\pM\pN_])",
    ),
    "legal_status": ("RED", 6, _w("undocumented|(?:immigration|visa|refugee|legal|citizenship).?status|deportat|asylum.?seek|daca")),
    "criminal_history": ("RED", 6, _w("(?:arrest|criminal).?record|conviction|incarcerat|parole|probation|mugshot|booking")),
    "orientation": ("YELLOW", 7, _w("sexual.?(?:orientation|preference)|gender.?identity|transgender|lgbtq|non.?binary|coming.?out")),
    "affiliation": ("YELLOW", 8, _w("(?:religious|political).?affiliation|party.?registration|(?:church|temple).?membership|mosque|synagogue")),
    "account": ("RED", 9, _w("credit.?card|account.?number|bank.?account|routing.?number|ssn|tax.?id|ein")),
    "finance": ("YELLOW", 9, _w("income.?amount|salary|wage.?rate|net.?worth")),
    "restricted_use": ("YELLOW", 10, _w("restricted.?use|confidential|under.?embargo|data.?use.?agreement|dua")),
    "biometric": ("RED", 10, _w("biometric|fingerprint|retina|facial.?recognition|dna.?sample|genetic.?data|genome")),
}

_RED = " + ".join(f"{name}::INT" for name, (severity, _, _) in SQL_RULES.items() if severity == "RED")
_YELLOW = " + ".join(f"{name}::INT" for name, (severity, _, _) in SQL_RULES.items() if severity == "YELLOW")
RED, YELLOW = _RED, _YELLOW
VERDICT = f"CASE WHEN {_RED} > 0 THEN 'RED' WHEN {_YELLOW} > 0 THEN 'YELLOW' ELSE 'GREEN' END"


def flags(text: str) -> str:
    """A boolean column for every rule."""
    return ", ".join(f"coalesce(regexp_matches({text}, {quoted(p)}), false) AS {name}" for name, (_, _, p) in SQL_RULES.items())


def scan_sql(source: str, keys: str, text: str) -> str:
    return f"""WITH f AS (SELECT {keys}, {flags(text)} FROM {source})
SELECT {keys}, {VERDICT} AS verdict, ({_RED})::BIGINT AS red_count, ({_YELLOW})::BIGINT AS yellow_count FROM f"""


DOC_FLAGS = f"f AS (SELECT doc_id, lang, source, {flags('text')} FROM documents)"
DOC_VERDICT = f"{DOC_FLAGS}, v AS (SELECT doc_id, lang, source, {VERDICT} AS verdict FROM f)"

# Recognisers: letters and digits beyond ASCII count as words, which the engine's own boundary
# doesn't know, so they are replaced by an ASCII letter first, and other signs by a sign;
# places stay the same.
_ENTITIES = (
    ("HIPAA_IDENTIFIER", 0.7, r"medical[\s_]?record|patient[\s_]?id|mrn|health[\s_]?plan|beneficiary"),
    ("HIPAA_IDENTIFIER", 0.5, r"diagnosis|icd[\s_]?\d|prescription|medication|treatment[\s_]?plan|discharge[\s_]?summary"),
    ("MENTAL_HEALTH_DATA", 0.7, r"suicide|suicidal|suicidality|self[\s_]?harm|bipolar|schizophrenia|schizophrenic|psychosis|eating[\s_]?disorder"),
    ("MENTAL_HEALTH_DATA", 0.85, r"(?:patient|subject|respondent|participant|score|scale|diagnosis|_id|_code)\b.*\b(?:depression|ptsd|anxiety[\s_]?disorder|psychiatric|mental[\s_]?health[\s_]?diagnosis)"),
    ("IMMIGRATION_STATUS", 0.8, r"undocumented|(?:immigration|visa|refugee|legal|citizenship)[\s_]?status|deportat|asylum[\s_]?seek|daca"),
    ("IMMIGRATION_STATUS", 0.8, r"(?:arrest|criminal)[\s_]?record|conviction|incarcerat|parole|probation|mugshot|booking"),
    ("FINANCIAL_DATA", 0.8, r"credit[\s_]?card|account[\s_]?number|bank[\s_]?account|routing[\s_]?number|tax[\s_]?id|ein"),
    ("FINANCIAL_DATA", 0.5, r"income[\s_]?amount|salary|wage[\s_]?rate|net[\s_]?worth"),
    ("BIOMETRIC_DATA", 0.8, r"biometric|fingerprint|retina|facial[\s_]?recognition|dna[\s_]?sample|genetic[\s_]?data|genome"),
    ("NAME_FIELD", 0.85, r"(?:first|last|full|respondent|participant)_?name"),
    ("DATE_OF_BIRTH", 0.85, r"date[\s_.]?of[\s_.]?birth|dob|birth[\s_.]?date"),
    ("SOGI_DATA", 0.5, r"sexual[\s_]?(?:orientation|preference)|gender[\s_]?identity|transgender|lgbtq|non[\s_]?binary|coming[\s_]?out"),
    ("BELIEF_DATA", 0.5, r"(?:religious|political)[\s_]?affiliation|party[\s_]?registration|(?:church|temple)[\s_]?membership|mosque|synagogue"),
    ("RESTRICTED_MARKER", 0.5, r"restricted[\s_]?use|confidential|under[\s_]?embargo|data[\s_]?use[\s_]?agreement|dua"),
    ("GEO_IDENTIFIER", 0.5, r"census[\s_]?tract|block[\s_]?group|zip[\s_]?code|street[\s_]?address|latitude|longitude|geocode"),
    ("US_SSN", 0.8, r"\d{3}-\d{2}-\d{4}"),
    ("EMAIL_ADDRESS", 1.0, r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}"),
    ("IP_ADDRESS", 0.95, r"(?:(?:1?\d{1,2}|2[0-4]\d|25[0-5])\.){3}(?:1?\d{1,2}|2[0-4]\d|25[0-5])"),
)


def _entity_sql(source: str, entity: str, score: float, body: str) -> str:
    p = quoted(rf"(?is)\b(?:{body})\b")
    before = "list_sum(list_transform(pieces[1:k], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0)::BIGINT"
    return (
        f"SELECT doc_id, '{entity}' AS entity, {score}::DOUBLE AS score, {before} AS start, {before} + length(hits[k]) AS \"end\" FROM (SELECT doc_id, hits, pieces, unnest(generate_series(1, len(hits))) AS k FROM "
        f"(SELECT doc_id, regexp_extract_all(t, {p}) AS hits, regexp_split_to_array(t, {p}) AS pieces FROM {source}) WHERE len(hits) > 0)"
    )


def entities_sql(source: str) -> str:
    """Common table ``e``: doc_id, entity, score, start, end of all finds in ``source(doc_id, text)``."""
    plain = rf"p AS (SELECT doc_id, regexp_replace(regexp_replace(text, '[^\x00-\x7F\pL\pN]', '~', 'g'), '[^\x00-\x7F]', 'z', 'g') AS t FROM {source})"
    return plain + ", e AS (" + " UNION ALL ".join(_entity_sql("p", *x) for x in _ENTITIES) + ")"


SEVERITY = """CASE WHEN entity IN ('IMMIGRATION_STATUS', 'BIOMETRIC_DATA', 'NAME_FIELD', 'DATE_OF_BIRTH', 'US_SSN') THEN 'RED'
  WHEN entity = 'HIPAA_IDENTIFIER' AND score >= 0.6 OR entity = 'MENTAL_HEALTH_DATA' AND score >= 0.85 OR entity = 'FINANCIAL_DATA' AND score >= 0.7 THEN 'RED' ELSE 'YELLOW' END"""
