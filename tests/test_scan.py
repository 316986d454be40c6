import random
import re

import duckdb
import pytest
from compare import same
from pyspark.sql import functions as F

from auditloom.functions.text import clip
from auditloom.operators import anonymize, scan
from auditloom.plans import catalog

CASES = [
    ("This is a normal research paper about voting patterns.", "GREEN", set()),
    ("Subject SSN: 123-45-6789", "RED", {"ssn", "account"}),
    ("Contact: researcher@university.edu", "YELLOW", {"email"}),
    ("patient_id,medical_record,diagnosis", "RED", {"health_id", "clinical"}),
    ("Subjects were screened for depression and suicidal ideation.", "YELLOW", {"mental_health"}),
    ("Respondents reported their immigration status: undocumented, DACA, visa holder.", "RED", {"legal_status"}),
    ("subject depression", "RED", {"mental_health_record"}),
    ("depression of the subject", "RED", {"mental_health_record"}),
    ("depression,participant_id", "RED", {"mental_health_record"}),
    ("depression,age,respondent_code", "RED", {"mental_health_record"}),
    ("PTSD, outscore", "RED", {"mental_health_record"}),
    ("outscore, PTSD", "GREEN", set()),
    ("subject,postdepression", "RED", {"mental_health_record"}),
    ("subject, depressions", "GREEN", set()),
    ("123-45-6789", "RED", {"ssn"}),
    ("a123-45-6789", "GREEN", set()),
    ("\u00e9SSN", "GREEN", set()),
    ("x\u00a0SSN.", "RED", {"account"}),
    ("patient_id depression", "RED", {"health_id"}),
    ("subject one\nmild depression", "GREEN", set()),
    ("facing deportation", "GREEN", set()),
    ("incarceration rate", "GREEN", set()),
    ("12 street", "YELLOW", {"street_address"}),
    ("12 st.x", "YELLOW", {"street_address"}),
    ("12 st. x", "GREEN", set()),
    ("12 Main Street", "GREEN", set()),
    ("das ist ein Haus", "RED", {"account"}),
    ("einä mal", "GREEN", set()),
    ("call 212-555-0199 now", "RED", {"phone"}),
    ("v3.212-555-0199", "GREEN", set()),
    ("date of birth", "RED", {"birth_date"}),
    ("birthdays", "GREEN", set()),
    ("first_name,x", "RED", {"name_field"}),
    ("firstly names", "GREEN", set()),
    ("census tract 5", "YELLOW", {"geography"}),
    ("zip codes", "GREEN", set()),
    ("host 10.0.0.255 up", "YELLOW", {"ip_address"}),
    ("version 300.1.1.1", "GREEN", set()),
    ("icd 9 codes", "YELLOW", {"clinical"}),
    ("two convictions", "GREEN", set()),
    ("on parole", "RED", {"criminal_history"}),
    ("transgender", "YELLOW", {"orientation"}),
    ("the synagogue", "YELLOW", {"affiliation"}),
    ("mosques", "GREEN", set()),
    ("net worth", "YELLOW", {"finance"}),
    ("confidential", "YELLOW", {"restricted_use"}),
    ("genome wide", "RED", {"biometric"}),
    ("genomes", "GREEN", set()),
    ("", "GREEN", set()),
]


def test_rules(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "id int, text string")
    got = {r.id: (r.verdict, {h.split(":")[1] for h in r.hits}) for r in scan.scan(rows).collect()}
    wrong = {CASES[i][0]: got[i] for i in got if got[i] != CASES[i][1:]}
    assert not wrong


def test_unreadable_is_never_green(spark):
    rows = spark.createDataFrame([("x.parquet", "clean"), ("a.txt", None), ("b.txt", "clean"), ("c.PDF", "ssn")], "path string, text string")
    got = {r.path: r.verdict for r in scan.scan(rows, path="path").collect()}
    assert got == {"x.parquet": "YELLOW", "a.txt": "YELLOW", "b.txt": "GREEN", "c.PDF": "RED"}


def test_bulk_and_redaction(spark):
    rows = spark.createDataFrame([("at", "a,b,c\n" * 200), ("over", "a,b,c\n" * 201), ("tabs", "a\tb\tc\n" * 250), ("red", "my ssn"), ("yellow", "a@b.org"), ("none", None)], "id string, text string")
    got = {r.id: r.redacted for r in scan.redact(rows).collect()}
    assert got["over"] == got["tabs"] == got["red"] == "[REDACTED]"
    assert got["at"].startswith("a,b,c") and got["yellow"] == "a@b.org" and got["none"] is None
    assert {r.id: r.redacted for r in scan.redact(rows, stream="stderr").collect()}["over"].startswith("a,b,c")


@pytest.mark.parametrize("level,n,want", [("standard", 3, False), ("strict", 0, False), ("strict", 1, True), ("lockdown", 2, True)])
def test_guard(spark, level, n, want):
    assert spark.range(1).select(scan.guard_active(F.lit(level), F.lit(n))).first()[0] is want


def test_entities(spark):
    text = "diagnosis,prescription,medication for patient id 7, dob, ssn 123-45-6789 987-65-4321"
    docs = spark.createDataFrame([(1, text), (2, "patient\nwith depression"), (3, None), (4, "plain")], "doc_id int, text string")
    found = scan.best_spans(scan.recognise(docs, ["doc_id"]), ["doc_id"])
    rows = found.withColumn("sev", scan.entity_severity(F.col("entity"), F.col("score"))).collect()
    texts = {1: text, 2: "patient\nwith depression"}
    assert all(texts[r.doc_id][r.start : r.end] == r.value and not r.truncated for r in rows)
    got = {(r.doc_id, r.entity, r.value, r.sev) for r in rows}
    want = {(1, "HIPAA_IDENTIFIER", v, "YELLOW") for v in ("diagnosis", "prescription", "medication")} | {(1, "US_SSN", v, "RED") for v in ("123-45-6789", "987-65-4321")}
    assert want | {(1, "DATE_OF_BIRTH", "dob", "RED"), (1, "HIPAA_IDENTIFIER", "patient id", "RED"), (2, "MENTAL_HEALTH_DATA", texts[2], "RED")} <= got
    skip = spark.createDataFrame([("URL", 0.9), ("PERSON", 0.8), ("PERSON", 0.85), ("ODD", 0.5)], "e string, s double")
    assert [r[0] for r in skip.select(scan.entity_severity(F.col("e"), F.col("s"))).collect()] == [None, "YELLOW", "RED", "YELLOW"]


def test_truncated_finds_say_so(spark):
    docs = spark.createDataFrame([(1, "salary " + "x" * 50 + " mrn"), (2, "mrn")], "doc_id int, text string")
    got = {(r.doc_id, r.value, r.truncated) for r in scan.recognise(docs, ["doc_id"], limit=20).collect()}
    assert got == {(1, "salary", True), (2, "mrn", False)}
    assert [tuple(r) for r in scan.truncations(docs, ["doc_id"], limit=20).collect()] == [(1, 61)]


def test_backends(spark):
    docs = spark.createDataFrame([(1, "call 212-555-0199", "a.txt"), (2, "plain", "b.dta"), (3, None, "c.txt"), (4, "plain", "d.txt")], "doc_id int, text string, path string")
    by = lambda *a, **k: {r.doc_id: (r.verdict, r.backend) for r in scan.scan_with(docs, ["doc_id"], *a, **k).collect()}
    # A telephone number is RED by rule and YELLOW as an entity.
    assert by() == {1: ("RED", "regex"), 2: ("GREEN", "regex"), 3: ("YELLOW", "regex"), 4: ("GREEN", "regex")}
    assert by("entities", "path") == {1: ("YELLOW", "entities"), 2: ("YELLOW", "entities"), 3: ("YELLOW", "entities"), 4: ("GREEN", "entities")}
    assert by("model")[1] == ("RED", "regex") and by("model", model=lambda df, keys: df.select("doc_id"))[1] == ("RED", "regex")

    def person(df, keys):
        return df.where("doc_id = 4").select("doc_id", F.lit("PERSON").alias("entity"), F.lit(0).cast("long").alias("start"), F.lit(5).cast("long").alias("end"), F.lit(0.9).alias("score"), F.lit("plain").alias("value"), F.lit(False).alias("truncated"))

    assert by("model", model=person)[4] == ("RED", "model")
    with pytest.raises(ValueError):
        scan.scan_with(docs, ["doc_id"], "other")


def test_names_and_clip(spark):
    rows = spark.createDataFrame([(1, "a.csv"), (2, "a.csv"), (3, "b"), (4, "b")], "id int, name string")
    assert {r.id: r.unique_name for r in scan.unique_names(rows, "name", "id").collect()} == {1: "a.csv", 2: "a-2.csv", 3: "b", 4: "b-2"}
    more = rows.union(spark.createDataFrame([(5, "a.csv"), (6, "a-3.csv")], "id int, name string"))
    there = spark.createDataFrame([("a-2.csv",), ("b",)], "name string")
    assert {r.id: r.unique_name for r in scan.unique_names(more, "name", "id", existing=there).collect()} == {1: "a.csv", 2: "a-4.csv", 3: "b-2", 4: "b-3", 5: "a-5.csv", 6: "a-3.csv"}
    out = spark.createDataFrame([("x" * 60,), ("x" * 61,)], "s string").select(clip(F.col("s"))).collect()
    assert [len(r[0]) for r in out] == [60, 60] and out[1][0].endswith("...")


def test_anonymise(spark):
    text = F.lit("Mail a.b@c.org or +1 212-555-0199, SSN 123-45-6789, Ann Lee and ann")
    pairs = [("Ann", "P02"), ("Ann Lee", "P01"), ("$x\\", "y")]
    got = spark.range(1).select(anonymize.scrub(anonymize.replace_longest_first(text, pairs))).first()[0]
    assert got == "Mail [EMAIL REMOVED] or [PHONE REMOVED], SSN [SSN REMOVED], P01 and P02"
    again = spark.range(1).select(anonymize.scrub(anonymize.scrub(text)) == anonymize.scrub(text)).first()[0]
    assert again


def test_keys(spark):
    found = spark.createDataFrame([("PERSON", "Zoe", 0.9, 5), ("PERSON", "Ann", 0.9, 2), ("PERSON", "Bob", 0.95, 9), ("EMAIL_ADDRESS", "a@b.c", 1.0, 1)], "entity string, value string, score double, at int")
    key = {r.original: r.pseudonym for r in anonymize.pseudonym_key(found).collect()}
    assert key == {"Bob": "P01", "Ann": "P02", "Zoe": "P03", "a@b.c": "[EMAIL REMOVED]"}
    more = {r.original: r.pseudonym for r in anonymize.pseudonym_key(found, {"PERSON": 9}).collect()}
    assert more["Bob"] == "P10"
    auto = spark.createDataFrame([("Ann", "P01", "PERSON", 0.9), ("Bob", "P02", "PERSON", 0.9)], "original string, pseudonym string, type string, confidence double")
    user = spark.createDataFrame([("ann", "Alice"), ("Cy", "X")], "original string, pseudonym string")
    merged = {r.original: (r.pseudonym, r.type, r.confidence, r.notes) for r in anonymize.merge_keys(auto, user).collect()}
    assert merged == {"Ann": ("Alice", "PERSON", 0.9, "user"), "Bob": ("P02", "PERSON", 0.9, "auto"), "Cy": ("X", "user-defined", 1.0, "user")}
    assert {r.prefix: r.last for r in anonymize.next_ordinals(auto).collect()} == {"P": 2}
    left = spark.createDataFrame([("[EMAIL REMOVED]",), ("P01",), ("LOC12",), ("Ann",)], "value string")
    assert [r.value for r in anonymize.residual(left).collect()] == ["Ann"]


def test_detection_floors(spark):
    found = spark.createDataFrame([(1, 0, 3, "PERSON", "Ann", 0.5), (1, 5, 8, "PERSON", "Bob", 0.7), (1, 5, 8, "LOCATION", "Bob", 0.6), (1, 9, 10, "PERSON", " ", 0.9)], "doc int, a int, b int, entity string, value string, score double")
    assert [(r.entity, r.value) for r in anonymize.detections(found, ["doc", "a", "b"]).collect()] == [("PERSON", "Bob")]


def test_entities_without_replacement(spark):
    found = spark.createDataFrame([(1, 0, 3, "NRP", "Ann", 0.9), (1, 0, 3, "PERSON", "Ann", 0.8), (1, 9, 12, "URL", "x.y", 0.9), (1, 20, 24, "DATE_TIME", "1999", 0.9), (1, 30, 33, "IP_ADDRESS", "::1", 0.5)], "doc int, a int, b int, entity string, value string, score double")
    kept = anonymize.detections(found, ["doc", "a", "b"])
    assert [r.entity for r in kept.collect()] == ["IP_ADDRESS"]
    assert [r.pseudonym for r in anonymize.pseudonym_key(kept.withColumnRenamed("a", "at")).collect()] == ["[IP REMOVED]"]


def test_institutions(spark):
    rows = spark.createDataFrame([(1, "at Stanford University and University of Michigan today")], "id int, text string")
    assert {r.value for r in anonymize.institutions(rows, ["id"]).collect()} == {"Stanford University", "University of Michigan"}


PARTS = [
    "Patient", "patient_id", "medical record", "MRN", "mrn1", "suicidality", "self harm", "depression", "DACA", "dua", "EIN", "being", "date.of.birth", "birth_date", "non binary", "123-45-6789", "a@b.co",
    "10.0.0.1", "555-123-4567", "score", "PTSD", "salary", "\u017falary", "\u017fcore", "ban\u212a account", "lgbtq", "zip code", "zipcode", "\u00e9", "\u0130", "net worth", "first_name", "firstname", "ICD 9", "icd9",
]


def test_one_automaton_finds_what_all_patterns_find():
    recognisers = scan.RECOGNISERS + scan.BUILT_IN
    find = scan.Finder([(r.entity, r.score, r.pattern) for r in recognisers])
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice(PARTS) + draw.choice([" ", ",", "", "_", "\n"]) for _ in range(draw.randint(0, 14)))
        plain = [(i, m.start(), m.end(), m[0]) for i, r in enumerate(recognisers) for m in re.finditer(r.pattern, text, re.I | re.S | re.M)]
        assert sorted(find(text)) == sorted(plain), text


def test_seeds():
    assert scan.seeds(r"\b(first_?name|dob)\b") == ["dob", "first"]
    assert scan.seeds(r"\b(?:a[|)]b|c\|d(?:e|f)|g)\b.*x|y") == ["a", "c", "g"]
    assert scan.seeds(r"\b([0-9]+|x)\b") is None and scan.seeds("x") is None


@pytest.mark.parametrize("name", ["span_ipv4", "pii_value_summary", "pseudonym_key"])
def test_addresses_side_by_side_as_in_sql(spark, tmp_path, name):
    """Addresses that share a sign between them, and longer rows of numbers, drawn at random and by hand."""
    rng = random.Random(5)
    texts = ["1.2.3.4 5.6.7.8", "1.2.3.4,5.6.7.8,9.9.9.9", "1.2.3.4.5.6.7.8.9", "10.0.0.1\n", "\n10.0.0.1\r\n10.0.0.2", "é1.2.3.4", "०1.2.3.4", "_1.2.3.4 8.8.8.8", "256.1.1.1", None, ""]
    texts += ["".join(rng.choice(["1", "25", "256", "7", ".", ".", ".", ".", " ", "\n", "a", "é"]) for _ in range(60)) for _ in range(400)]
    texts += ["".join(f"{rng.randrange(12)}.{rng.randrange(300)}.0.1" + rng.choice([" ", ", ", ".", "\n", "x", "\r\n"]) for _ in range(6)) for _ in range(100)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert same(catalog.QUERIES[name](spark, str(tmp_path)), con.sql(catalog.ORACLES[name]))
