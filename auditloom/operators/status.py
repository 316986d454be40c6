"""Safety status of files and the access decisions that follow from it."""

from __future__ import annotations

import posixpath
import re
import shlex
from collections.abc import Iterator
from string import Template

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from auditloom.functions.rules import STATUSES
from auditloom.operators.scan import extension

LEVELS = ("standard", "strict", "lockdown")

# What counts as data by its extension, and which of it is what.
TABULAR = "csv tsv dta sav rds rdata xlsx xls parquet feather arrow db sqlite jsonl ndjson".split()
AUDIO_VIDEO = "wav mp3 flac m4a ogg aac aiff mp4 mov avi mkv webm".split()
IMAGE_EXTENSIONS = "jpg jpeg png tiff tif heic heif bmp webp gif".split()
LINGUISTIC = "eaf textgrid trs cha praat".split()
GEOSPATIAL = "shp geojson kml gpx".split()
DATA_EXTENSIONS = TABULAR + AUDIO_VIDEO + IMAGE_EXTENSIONS + LINGUISTIC + GEOSPATIAL
TEXT_EXTENSIONS = "txt rtf docx doc odt md".split()
MEDIA_EXTENSIONS = AUDIO_VIDEO + LINGUISTIC
MICRODATA = "dta sav por zsav rds rdata rda parquet feather sas7bdat xpt dbf".split()

# Folders, in lower case. Of the qualitative ones and of the three stages of
# data, the folder itself counts as well as what lies in it.
DATA_FOLDERS = "data raw datasets dataset corpus corpora".split()
QUALITATIVE_FOLDERS = "transcripts interviews field-notes fieldnotes field_notes materials participants subjects respondents".split()
TEXT_FOLDERS = DATA_FOLDERS + "materials interviews transcripts field-notes fieldnotes subjects participants respondents".split()
RAW_FOLDERS = DATA_FOLDERS + "input inputs photos subjects participants respondents media imagery scans originals source_images".split()
RAW_ENDS = "materials transcripts interviews field-notes fieldnotes field_notes".split()
DATA_STAGES = "raw interim processed".split()
MIRROR_EXCLUDED = "data raw materials .git node_modules".split()
SAFE_SUBTREES = "scripts drafts output figures tables reports protocols logs eda replication presentation citations .claude".split()
SYSTEM_FOLDERS = "etc dev proc sys System var/db var/log private/etc private/var/db private/var/log".split()


def _inside(folders: list[str]) -> str:
    return f"/({'|'.join(map(re.escape, folders))})/"


RAW_PATH = f"{_inside(RAW_FOLDERS)}|/({'|'.join(RAW_ENDS)})(/|$)|/data/({'|'.join(DATA_STAGES)})$"
QUALITATIVE_PATH = f"/({'|'.join(QUALITATIVE_FOLDERS)})(/|$)"
SYSTEM_PATH = f"^/({'|'.join(SYSTEM_FOLDERS)})(/|$)"
#: Statuses that forbid reading.
RESTRICTED = r"^(LOCAL_MODE|HALTED|NEEDS_REVIEW)"


def initial_status(verdict: Column) -> Column:
    """GREEN is cleared; anything else waits for review under its level."""
    return F.when(verdict == "GREEN", "CLEARED").otherwise(F.concat(F.lit("NEEDS_REVIEW:"), F.coalesce(verdict, F.lit("UNKNOWN"))))


def valid_status(status: Column) -> Column:
    return F.coalesce(status.rlike(r"^(" + "|".join(STATUSES) + r"|NEEDS_REVIEW(:.+)?)$"), F.lit(False))


def restricted(status: Column) -> Column:
    return F.coalesce(status.rlike(RESTRICTED), F.lit(False))


def sidecar_problems(sidecar: DataFrame) -> DataFrame:
    """``sidecar(json)`` to one row per bad entry: ``path, reason``; a root that is no object is one entry."""
    entries = sidecar.select(F.explode(F.from_json("json", "map<string,string>")).alias("path", "status"))
    meta = F.col("path").startswith("_")
    reason = (
        F.when(F.col("path") == "_safety_level", F.when(~F.col("status").isin(*LEVELS) | F.col("status").isNull(), "invalid safety level"))
        .when(meta, "unknown meta key")
        .when(F.col("status").startswith("{") | F.col("status").startswith("["), "status is not a string")
        .when(~valid_status(F.col("status")), "invalid status")
    )
    root = sidecar.where(F.json_object_keys("json").isNull()).select(F.lit("<root>").alias("path"), F.lit("not a JSON object").alias("reason"))
    return entries.select("path", reason.alias("reason")).where("reason IS NOT NULL").union(root)


def safety_level(project: Column, environment: Column) -> Column:
    """The project's level, else the environment's, else standard; invalid ones don't count."""
    ok = lambda c: F.when(c.isin(*LEVELS), c)
    return F.coalesce(ok(project), ok(environment), F.lit("standard"))


def _matches(pattern: str, *paths: Column | None) -> Column:
    """Whether any of the paths, in lower case, matches."""
    out = F.lit(False)
    for p in paths:
        if p is not None:
            out = out | F.coalesce(F.lower(p).rlike(pattern), F.lit(False))
    return out


def is_raw(path: Column, lexical: Column | None = None) -> Column:
    """In a folder of data, by the resolved path or as written."""
    return _matches(RAW_PATH, path, lexical)


def is_qualitative(path: Column, lexical: Column | None = None) -> Column:
    return _matches(QUALITATIVE_PATH, path, lexical)


def is_data(path: Column, lexical: Column | None = None) -> Column:
    """Data by extension; JSON and documents in folders of data; whatever lies in a raw folder."""
    ext = extension(path)
    return (
        ext.isin(DATA_EXTENSIONS) | ((ext == "json") & _matches(_inside(DATA_FOLDERS), path))
        | (ext.isin(TEXT_EXTENSIONS) & _matches(_inside(TEXT_FOLDERS), path)) | is_raw(path, lexical)
    )


def nearest_root(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """``path`` with ``root``, its deepest ancestor among ``roots(dir)``."""
    up = paths.select("path", F.explode(_ancestors("path")).alias("dir"))
    best = up.join(roots, "dir").groupBy("path").agg(F.max_by("dir", F.length("dir")).alias("root"))
    return paths.join(best, "path", "left")


def _ancestors(path: str, own: bool = False) -> Column:
    """The folders above a path, the nearest last, and where asked the path itself."""
    parts, most = F.split(path, "/"), F.size(F.split(path, "/")) - (0 if own else 1)
    prefixes = F.transform(F.sequence(F.lit(1), most), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.when(most >= 1, prefixes).otherwise(F.array().cast("array<string>"))


def lookup_status(paths: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Status by canonical, then lexical, then raw path; a base name never matches."""
    out = paths
    for k in ("canonical", "lexical", "raw"):
        out = out.join(sidecar.select(F.col("path").alias(k), F.col("status").alias(f"_{k}")), k, "left")
    return out.withColumn("status", F.coalesce("_canonical", "_lexical", "_raw")).drop("_canonical", "_lexical", "_raw")


def decide(path: Column, status: Column, verdict: Column, lexical: Column | None = None, sidecar_valid: Column | None = None) -> tuple[Column, Column]:
    """The decision on reading a file and its reason.

    ``path`` is resolved, ``lexical`` as written; ``sidecar_valid`` tells whether all of the
    file's sidecar is.
    """
    ext = extension(path)
    refused = (status == "OVERRIDE") & (ext.isin(MEDIA_EXTENSIONS) | (ext.isin(TEXT_EXTENSIONS) & is_qualitative(path, lexical)))
    broken = status.isNotNull() & ~valid_status(status)
    if sidecar_valid is not None:
        broken = broken | ~F.coalesce(sidecar_valid, F.lit(True))
    reason = (
        F.when(path.rlike(SYSTEM_PATH), "system path")
        .when(~is_data(path, lexical), "not data")
        .when(broken, "invalid status")
        .when(refused, "override refused")
        .when(status.isin("CLEARED", "ANONYMIZED", "OVERRIDE"), "status allows")
        .when(status.isNotNull(), "status blocks")
        .when(ext.isin(IMAGE_EXTENSIONS), F.when(is_raw(path, lexical), "raw image").otherwise("image"))
        .when(verdict == "GREEN", "scan is green")
        .otherwise("scan blocks")
    )
    return _allowed(reason), reason


def _allowed(reason: Column) -> Column:
    allow = reason.isin("not data", "status allows", "image", "scan is green", "no pattern", "safe subtree", "outside", "no such file", "no target", "aggregate only", "not the sidecar", "no promotion", "not gated")
    return F.when(allow, "ALLOW").otherwise("BLOCK")


# ---- routing by tool ------------------------------------------------------------------

READERS = ("Read", "NotebookRead", "NotebookEdit")
EDITORS = ("Edit", "Write", "MultiEdit")


def absolute(path: Column, cwd: Column) -> Column:
    """A path made absolute and without ``.``, ``..`` and doubled slashes; links aren't followed."""
    joined = F.when(path.startswith("/"), path).otherwise(F.concat(F.coalesce(cwd, F.lit("")), F.lit("/"), path))
    parts = F.filter(F.split(joined, "/"), lambda x: (x != "") & (x != "."))
    up = lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), up), "/"))


def _folder_reason(path: Column, lexical: Column) -> Column:
    return F.when(is_raw(path, lexical) | is_qualitative(path, lexical), "data folder")


def search_reason(target: Column, lexical: Column, root: Column, is_folder: Column) -> Column:
    """A search returns lines: never from folders of data, a whole project or a data file."""
    return F.coalesce(
        F.when(target.isNull(), "no scope"), _folder_reason(target, lexical), F.when(target == root, "project root"),
        F.when(extension(target).isin(DATA_EXTENSIONS) & ~F.coalesce(is_folder, F.lit(False)), "data file"), F.lit("outside"),
    )


def listing_reason(scope: Column, root: Column, pattern: Column, cwd: Column) -> Column:
    """A listing returns names: at a project's root only below folders that are known to be safe."""
    plain = F.regexp_extract(pattern, r"^([^*?\[{]*)", 1)
    safe = F.lower(F.regexp_replace(plain, r"^\./", "")).rlike(f"^({'|'.join(map(re.escape, SAFE_SUBTREES))})(/|$)")
    place = F.when(plain != "", absolute(plain, cwd))
    ext = F.regexp_extract(F.lower(pattern), r"\.([^.*?\[{]*)[^.]*$", 1)
    return F.coalesce(
        F.when((scope == root) & ~F.coalesce(safe, F.lit(False)), "project root"), F.when(F.coalesce(pattern, F.lit("")) == "", "no pattern"),
        _folder_reason(place, place), F.when(ext.isin(DATA_EXTENSIONS), "data extension"), F.when(scope == root, "safe subtree"), F.lit("outside"),
    )


def route(calls: DataFrame) -> DataFrame:
    """``calls`` with ``decision, reason`` of a tool's call, each tool by its own rule.

    ``calls`` has ``tool, path`` (resolved), ``lexical, cwd, root`` (the project that the
    scope lies in), ``pattern, is_folder, exists, status, verdict`` and, of shell calls,
    ``target, dumps`` (``sensitive_targets``, ``dumps_data``), of edits ``promotes`` (whether a
    restricted path is raised without a review). Readers, searches and listings fail closed;
    the shell, edits and unknown tools fail open.
    """
    c = F.col
    scope, named = F.coalesce("path", "cwd"), F.coalesce("lexical", "cwd")
    _, read = decide(c("path"), c("status"), c("verdict"), c("lexical"))
    read = F.when(c("path").isNull(), "no target").when(~F.coalesce("exists", F.lit(True)), "no such file").otherwise(read)
    shell = F.when(c("target").isNull(), "no target").when(F.coalesce("dumps", F.lit(False)), "prints data").otherwise("aggregate only")
    sidecar = F.coalesce(c("path").rlike(r"(^|/)safety-status\.json$"), F.lit(False))
    edit = F.when(~sidecar, "not the sidecar").when(F.coalesce("promotes", F.lit(False)), "promotion without review").otherwise("no promotion")
    reason = (
        F.when(c("tool").isin(*READERS), read).when(c("tool") == "Grep", search_reason(scope, named, c("root"), c("is_folder")))
        .when(c("tool") == "Glob", listing_reason(scope, c("root"), c("pattern"), c("cwd"))).when(c("tool") == "Bash", shell)
        .when(c("tool").isin(*EDITORS), edit).otherwise("not gated")
    )
    return calls.withColumn("reason", reason).withColumn("decision", _allowed(F.col("reason")))


# ---- shell commands -------------------------------------------------------------------

# Verbs that print what a file holds, searches that print lines unless told to
# count or list, interpreters, words that stand before a verb, and code that prints rows.
DUMP_VERBS = (
    "cat tac nl rev head tail more less bat fold od xxd hexdump hd strings base64 base32 column csvlook csvcut xsv mlr datamash "
    "pbcopy zcat gzcat bzcat xzcat sqlite3 duckdb jq yq open textutil sed awk gawk nawk mawk perl"
).split()
SEARCH_VERBS = "grep egrep fgrep rg ag ack".split()
SEARCH_COUNTS = "-c --count -l --files-with-matches -L --files-without-match -q --quiet".split()
INTERPRETERS = "python python2 python3 rscript r ruby node nodejs php lua".split()
BEFORE_VERBS = r"env command builtin nohup nice stdbuf time sudo exec then do \{ \(".split()
ROW_CODE = "|".join(
    (
        r"open[ \t]*\([^)\n]*\)[ \t]*\.[ \t]*read[ \t]*\(", r"readLines[ \t]*\(", r"\.to_string[ \t]*\(", r"\.to_csv[ \t]*\([ \t]*\)",
        r"\.(head|tail|sample|iloc|values|to_dict)[ \t]*[(\[]", r"(^|[^A-Za-z0-9_.])(head|tail|str|View)[ \t]*\([ \t]*[A-Za-z_.]",
        r"(^|[^A-Za-z0-9_.])print[ \t]*\([ \t]*[A-Za-z_][A-Za-z0-9_]*[ \t]*\)", r"cat[ \t]*\([^)\n]*\$", r"File\.read", "readFileSync", "file_get_contents", r"io\.read",
    )
)


def first_verb(segment: Column) -> Column:
    """The command of a segment: assignments and wrappers before it are passed over, its folder is left out."""
    skipped = rf"^\s*+(?:(?:\S*=\S*|{'|'.join(BEFORE_VERBS)})(?:\s++|$))*+(\S+)"
    return F.lower(F.regexp_replace(F.regexp_extract(segment, skipped, 1), "^.*/", ""))


def dumps_data(command: Column) -> Column:
    """Whether a command shows what files hold.

    An interpreter's code may hold separators itself, so it is judged as a whole, by what it
    prints; otherwise each segment is judged by its verb. Which file is meant is another question.
    """
    segments = F.split(command, r"[|;&()`\n]")
    counts = rf"(^|\s)({'|'.join(SEARCH_COUNTS)})(\s|$)"
    prints = lambda s: first_verb(s).isin(DUMP_VERBS) | (first_verb(s).isin(SEARCH_VERBS) & ~s.rlike(counts))
    code = F.when(first_verb(command).isin(INTERPRETERS), command.rlike(f"(?m){ROW_CODE}"))
    return F.coalesce(code, F.exists(segments, prints), F.lit(False))


#: Signs that end a word outside quotes.
SIGNS = ";&|<>()[]{},`"
#: How often values are put into values: names may be made of names.
EXPANSIONS = 3


def _lexed(text: str) -> list[str]:
    """The words of a text by a shell's quoting; none where a quote stays open."""
    lexer = shlex.shlex(text, posix=True, punctuation_chars=SIGNS)
    lexer.whitespace_split, lexer.commenters = True, ""
    try:
        return [w for w in lexer if w.strip(SIGNS)]
    except ValueError:
        return []


def _parts(text: str) -> Iterator[str]:
    """Words, what stands behind their equals signs, the words of code in quotes, and bare pieces."""
    for word in _lexed(text):
        yield word
        yield word.partition("=")[2]
        if " " in word or "(" in word:
            yield from _lexed(word)
    yield from text.translate(str.maketrans(dict.fromkeys(SIGNS + "\"'=", " "))).split()


def shell_words(command: str, environment: dict[str, str]) -> Iterator[str]:
    """What in a command may be a path: the parts of it as it stands, and with variables put in.

    A variable has the value that the command itself gives it, or the environment's; others
    stay as they are written.
    """
    known = dict(environment)
    for word in _lexed(command):
        name, _, value = word.partition("=")
        if value and name.isidentifier():
            known[name] = value
    for _ in range(EXPANSIONS):
        known = {k: Template(v).safe_substitute(known) for k, v in known.items()}
    yield from _parts(command)
    if "$" in command:
        yield from _parts(Template(command).safe_substitute(known))


def path_candidates(command: str, cwd: str, environment: dict[str, str]) -> list[str]:
    """Absolute paths that a command may read, in the order of finding; a wildcard stands for its folder."""
    out: dict[str, None] = {}
    for word in shell_words(command, environment):
        word = word.replace("\\", "")
        if not word or word[0] == "-" or "$" in word:
            continue
        plain = re.split(r"[*?\[]", word, maxsplit=1)[0]
        if plain != word:
            plain = plain.rpartition("/")[0]
        if "/" in plain or plain.rpartition(".")[2].lower() in DATA_EXTENSIONS and "." in plain:
            out[posixpath.normpath(posixpath.join(cwd or "/", plain))] = None
    return list(out)


def sensitive_targets(commands: DataFrame, inventory: DataFrame, status: DataFrame, links: DataFrame | None = None, environment: dict[str, str] | None = None) -> DataFrame:
    """``commands`` (id, command, cwd) with ``target``, the first sensitive path that a command names, or null.

    Only paths of ``inventory(path)``, files and folders, count: what isn't there can't be
    read. A path is sensitive by its folder, as written or as ``links(path, target)`` resolve
    it, or by its status. Tokens follow no grammar that expressions could hold, so they are
    taken apart in Arrow batches of commands; the rest is joins on paths.
    """
    ambient = dict(environment or {})

    @F.pandas_udf("array<string>")
    def candidates(command: pd.Series, cwd: pd.Series) -> pd.Series:
        return pd.Series([path_candidates(c or "", w or "/", {**ambient, "PWD": w or "/"}) for c, w in zip(command, cwd, strict=True)], dtype=object)

    named = commands.select("id", F.posexplode(candidates("command", "cwd")).alias("at", "path"))
    there = named.join(inventory.select("path").distinct(), "path", "left_semi")
    resolved = there.withColumn("real", F.col("path"))
    if links is not None:
        resolved = there.join(links.select("path", F.col("target").alias("real")), "path", "left").withColumn("real", F.coalesce("real", "path"))
    said = status.select(F.col("path").alias("_p"), F.col("status").alias("_s"))
    graded = resolved.join(said.select(F.col("_p").alias("real"), F.col("_s").alias("_a")), "real", "left").join(said.select(F.col("_p").alias("path"), F.col("_s").alias("_b")), "path", "left")
    bad = is_raw(F.col("real"), F.col("path")) | is_qualitative(F.col("real"), F.col("path")) | restricted(F.coalesce("_a", "_b"))
    first = graded.where(bad).groupBy("id").agg(F.min_by("real", "at").alias("target"))
    return commands.join(first, "id", "left")


# ---- sidecars -------------------------------------------------------------------------


def promoted_without_review(before: DataFrame, after: DataFrame, log: DataFrame, scans: DataFrame | None = None) -> DataFrame:
    """``path, was, status``: paths raised to CLEARED or OVERRIDE without a review entry.

    Suspect are paths that were NEEDS_REVIEW:RED, HALTED or LOCAL_MODE, and those whose scan
    (``scans(path, verdict)``) is RED. An entry names the path or its base name. Keys that
    begin with an underscore are no paths.
    """
    base = lambda p: F.regexp_extract(p, r"([^/]*)/*$", 1)
    now = after.where(F.col("status").isin("CLEARED", "OVERRIDE") & ~F.col("path").startswith("_")).select("path", "status")
    was = now.join(before.select("path", F.col("status").alias("was")), "path", "left")
    suspect = F.coalesce(F.col("was").isin("NEEDS_REVIEW:RED", "HALTED", "LOCAL_MODE"), F.lit(False))
    if scans is not None:
        was = was.join(scans.select("path", F.col("verdict").alias("_v")), "path", "left")
        suspect = suspect | F.coalesce(F.col("_v") == "RED", F.lit(False))
    told = log.select(F.col("path").alias("_l")).distinct()
    suspects = was.where(suspect).select("path", "was", "status").withColumn("_b", base(F.col("path")))
    return suspects.join(told, F.col("path") == F.col("_l"), "left_anti").join(told, F.col("_b") == F.col("_l"), "left_anti").drop("_b")


def breakdown(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("n"))


def unresolved(status: DataFrame, strict_compat: bool = False) -> DataFrame:
    """How many paths wait for review; a bare NEEDS_REVIEW counts unless ``strict_compat``."""
    waiting = F.col("status").startswith("NEEDS_REVIEW:" if strict_compat else "NEEDS_REVIEW")
    n = F.count_if(waiting)
    return status.agg(n.alias("unresolved"), F.when(n > 0, "BLOCKED").otherwise("OPEN").alias("gate"))


def deny_set(folders: DataFrame, status: DataFrame, links: DataFrame) -> DataFrame:
    """Data folders, restricted paths outside them, and what links resolve to outside them, each once."""
    roots = folders.select(F.col("path").alias("dir"))
    more = status.where(F.col("status").rlike("LOCAL_MODE|HALTED|NEEDS_REVIEW")).select("path").union(links.select(F.col("target").alias("path"))).distinct()
    own = more.join(roots, F.col("path") == F.col("dir"), "left_anti")
    outside = nearest_root(own, roots).where("root IS NULL").select("path")
    return folders.select("path").union(outside).distinct()


def shareable(files: DataFrame, status: DataFrame, strict: bool = True) -> DataFrame:
    """Files for a mirror: none in excluded folders, no microdata, none with a restricted file's base name.

    ``strict`` leaves out whatever counts as data as well, recordings and images included.
    """
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    left_out = F.col("path").rlike(_inside(MIRROR_EXCLUDED)) | extension(F.col("path")).isin(MICRODATA)
    if strict:
        left_out = left_out | is_data(F.col("path"))
    closed = status.where(restricted(F.col("status"))).select(base.alias("_base")).distinct()
    return files.where(~left_out).withColumn("_base", base).join(closed, "_base", "left_anti").drop("_base")


def leaks(mirror: DataFrame, status: DataFrame, root: str = "") -> DataFrame:
    """``path, reason``: what must not be in a mirror; any row fails it. ``mirror`` may have ``target``, what a link resolves to."""
    base = F.regexp_extract("path", r"([^/]*)$", 1)
    closed = status.where(restricted(F.col("status"))).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("_base")).distinct().withColumn("_c", F.lit(True))
    target = F.col("target") if "target" in mirror.columns else F.lit(None).cast("string")
    reason = (
        F.when(extension(F.col("path")).isin(MICRODATA), "microdata").when(F.col("_c"), "restricted file").when(F.col("path").rlike("/data/"), "data folder")
        .when(target.isNotNull() & ~target.startswith(root + "/"), "link leads out")
    )
    return mirror.withColumn("_base", base).join(closed, "_base", "left").select("path", reason.alias("reason")).where("reason IS NOT NULL")


#: How many folders, the path itself among them, are searched upwards.
UPWARDS = 8


def local_mode(paths: DataFrame, sidecars: DataFrame) -> DataFrame:
    """``paths`` with ``local_mode``: a sidecar (``dir, text``) below a path, or at most seven folders above it, says LOCAL_MODE."""
    marked = sidecars.where(F.lower("text").contains("local_mode")).select("dir").distinct()
    above = paths.select("path", F.explode(F.slice(F.reverse(_ancestors("path", own=True)), 1, UPWARDS)).alias("dir")).join(marked, "dir").select("path")
    below = marked.select(F.explode(_ancestors("dir", own=True)).alias("path"))
    found = above.union(below).distinct().withColumn("_l", F.lit(True))
    return paths.join(found, "path", "left").withColumn("local_mode", F.coalesce("_l", F.lit(False))).drop("_l")


def latest_per_path(records: DataFrame) -> DataFrame:
    w = Window.partitionBy("path").orderBy(F.desc("line_no"))
    return records.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
