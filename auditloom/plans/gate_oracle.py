"""SQL of the rules of paths, statuses and audit records, for oracles: columns path, p (lower case), l (lexical), ext, status, and those of a record."""

from __future__ import annotations

# Fixed values of the rules, as the operators have them.
VALID = "coalesce(status IN ('CLEARED', 'ANONYMIZED', 'OVERRIDE', 'LOCAL_MODE', 'HALTED', 'NEEDS_REVIEW') OR (starts_with(status, 'NEEDS_REVIEW:') AND length(status) > 13), false)"
TAIL = "CASE WHEN contains(string_split(p, '/')[-1], '.') THEN regexp_replace(string_split(string_split(p, '/')[-1], '.')[-1], '\\s.*$', '') ELSE '' END"
IN = lambda names, p: "(" + " OR ".join(f"contains({p}, '/{n}/')" for n in names.split()) + ")"
AT = lambda names, p: "(" + " OR ".join(f"contains({p}, '/{n}/') OR ends_with({p}, '/{n}')" for n in names.split()) + ")"
DATA_IN = "data raw datasets dataset corpus corpora"
RAW_SQL = lambda p: f"({IN(DATA_IN + ' input inputs photos subjects participants respondents media imagery scans originals source_images', p)} OR {AT('materials transcripts interviews field-notes fieldnotes field_notes', p)} OR ends_with({p}, '/data/raw') OR ends_with({p}, '/data/interim') OR ends_with({p}, '/data/processed'))"
QUAL_SQL = lambda p: AT("transcripts interviews field-notes fieldnotes field_notes materials participants subjects respondents", p)
KNOWN_EXT = "'csv', 'tsv', 'dta', 'sav', 'rds', 'rdata', 'xlsx', 'xls', 'parquet', 'feather', 'arrow', 'db', 'sqlite', 'jsonl', 'ndjson', 'wav', 'mp3', 'flac', 'm4a', 'ogg', 'aac', 'aiff', 'mp4', 'mov', 'avi', 'mkv', 'webm', 'jpg', 'jpeg', 'png', 'tiff', 'tif', 'heic', 'heif', 'bmp', 'webp', 'gif', 'eaf', 'textgrid', 'trs', 'cha', 'praat', 'shp', 'geojson', 'kml', 'gpx'"
WRITING = "'txt', 'rtf', 'docx', 'doc', 'odt', 'md'"
IS_DATA = f"(ext IN ({KNOWN_EXT}) OR (ext = 'json' AND {IN(DATA_IN, 'p')}) OR (ext IN ({WRITING}) AND {IN(DATA_IN + ' materials interviews transcripts field-notes fieldnotes subjects participants respondents', 'p')}) OR {RAW_SQL('p')} OR {RAW_SQL('l')})"
MEDIA = "'wav', 'mp3', 'flac', 'm4a', 'ogg', 'aac', 'aiff', 'mp4', 'mov', 'avi', 'mkv', 'webm', 'eaf', 'textgrid', 'trs', 'cha', 'praat'"
SYSTEM = "(" + " OR ".join(f"path = '{d}' OR starts_with(path, '{d}/')" for d in ("/etc", "/dev", "/proc", "/sys", "/System", "/var/db", "/var/log", "/private/etc", "/private/var/db", "/private/var/log")) + ")"
OPAQUE = "'xlsx', 'xls', 'ods', 'parquet', 'feather', 'arrow', 'dta', 'sav', 'rds', 'rdata', 'sqlite', 'db', 'h5', 'hdf5', 'mat', 'pkl', 'npy', 'npz', 'pickle', 'wav', 'mp3', 'flac', 'm4a', 'ogg', 'aac', 'aiff', 'mp4', 'mov', 'avi', 'mkv', 'webm', 'jpg', 'jpeg', 'png', 'tiff', 'tif', 'heic', 'heif', 'bmp', 'webp', 'gif', 'pdf', 'doc', 'docx', 'xlsm', 'pptx', 'ppt'"
EXT = "CASE WHEN contains(parse_filename(path), '.') THEN lower(trim(string_split(parse_filename(path), '.')[-1])) ELSE '' END"

# Rules of audit records.

def failed(rules: dict[str, str]) -> str:
    """The names of the rules that don't hold, in order."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{k}' END" for k, ok in rules.items()) + ")"

SEV = "CASE sentence_verdict WHEN 'CLAIM-REVERSED' THEN 'HIGH' WHEN 'CLAIM-UNSUPPORTED' THEN 'HIGH' WHEN 'CLAIM-MISCHARACTERIZED' THEN 'MED' WHEN 'CLAIM-OVERCAUSAL' THEN 'MED' WHEN 'CLAIM-WRONG-POPULATION' THEN 'MED' WHEN 'CLAIM-IMPRECISE' THEN 'MED' WHEN 'CLAIM-VERIFIED' THEN 'OK' WHEN 'CLAIM-NOT-A-CLAIM' THEN 'OK' WHEN 'CLAIM-NOT-CHECKABLE' THEN 'UNVERIFIABLE' END"

AUDIT_OK = {
    "R1 schema": "schema = 'claim-audit-record/v1'",
    "R2 required": "claim_id <> '' AND cite_key <> '' AND manuscript_loc <> '' AND manuscript_quote <> '' AND citation_function <> '' AND sentence_verdict <> '' AND severity <> '' AND access_tier_max <> '' AND coalesce(len(subs), 0) > 0 AND evidence_retrieved IS NOT NULL",
    "R3 verdict": f"({SEV}) IS NOT NULL", "R3 severity": f"({SEV}) IS NULL OR ({SEV}) = severity", "R4 quote": "coalesce(len(list_filter(subs, lambda x: x IN ('SUPPORTED|', 'CONTRADICTED|'))), 0) = 0",
    "R5 tier": "sentence_verdict <> 'CLAIM-UNSUPPORTED' OR access_tier_max IN ('T0_kg_fulltext', 'T1_fulltext', 'T2_oa_fulltext')", "R6 retrieval": "sentence_verdict <> 'CLAIM-VERIFIED' OR evidence_retrieved",
    "R7 anchors": "coalesce(len(list_filter(anchor_refs, lambda x: NOT regexp_full_match(x, '[a-z0-9_-]+-[0-9a-f]{8}'))), 0) = 0",
}
