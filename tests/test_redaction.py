import re

import pytest
from pyspark.sql import functions as F

from clinweave.operators import redaction

CASES = [
    ("mail a.b+c@site.example.org now", "mail [REDACTED_EMAIL] now", ["email_address"]),
    ("SSN 541-72-3306.", "SSN [REDACTED_US_SSN].", ["us_ssn"]),
    ("SSN 666-72-3306 and 900-72-3306", "SSN 666-72-3306 and 900-72-3306", []),
    ("CPF 804.117.236-55", "CPF [REDACTED_CPF]", ["brazilian_cpf"]),
    ("MRN: QX-7702", "MRN: [REDACTED_MEDICAL_RECORD_NUMBER]", ["medical_record_number"]),
    ("Patient ID is required", "Patient ID is [REDACTED_MEDICAL_RECORD_NUMBER]", ["medical_record_number"]),
    ("Patient name: Ana Maria Souza; ok", "Patient name: [REDACTED_PATIENT_NAME]; ok", ["patient_name"]),
    ("patient name: ana souza; ok", "patient name: ana souza; ok", []),
    ("DOB: 1980-02-03", "DOB: [REDACTED_DATE_OF_BIRTH]", ["date_of_birth"]),
    ("DOB: 13/45/99999", "DOB: [REDACTED_DATE_OF_BIRTH]9", ["date_of_birth"]),
    ("date of birth - March 3, 1980", "date of birth - [REDACTED_DATE_OF_BIRTH]", ["date_of_birth"]),
    ("at (602) 555-0148 x", "at [REDACTED_PHONE] x", ["phone_number"]),
    ("1-877-2-HEALTH now more", "[REDACTED_PHONE] more", ["phone_number"]),
    ("18445550147", "[REDACTED_PHONE]", ["phone_number"]),
    ("3125550147", "[REDACTED_PHONE]", ["phone_number"]),
    ("fax: 5550148", "fax: [REDACTED_PHONE]", ["phone_number"]),
    ("calling +351912345678", "calling [REDACTED_PHONE]", ["phone_number"]),
    ("John Smith was born in 1980", "John Smith was born in 1980", []),
    ("x@y.co, 541-72-3306, 312-555-0147", "[REDACTED_EMAIL], [REDACTED_US_SSN], [REDACTED_PHONE]", ["email_address", "phone_number", "us_ssn"]),
    ("a@b.co and c@d.co", "[REDACTED_EMAIL] and [REDACTED_EMAIL]", ["email_address"]),
    ("[REDACTED_EMAIL] stays", "[REDACTED_EMAIL] stays", []),
    ("K@b.co", "[REDACTED_EMAIL]", ["email_address"]),
    ("", "", []),
    (None, None, []),
]


def test_rules(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, v string")
    got = redaction.redact_columns(rows, ["v"]).orderBy("i").collect()
    assert [(r.v, r.v_types) for r in got] == [(c[1], c[2]) for c in CASES]


def test_rules_leave_neighbours_alone(spark):
    text = "Take 20 mg at 10.30, ratio 1:200, room 12-345; see 2001-2004."
    row = redaction.redact_columns(spark.createDataFrame([(text,)], "v string"), ["v"]).first()
    assert row.v == text and row.v_types == []


def test_plain_python_agrees_on_simple_rules(spark):
    """The two rules without letters, transcribed for another regex engine, on many digit strings."""
    import random

    rng = random.Random(1)
    texts = ["".join(rng.choice("0123456789-. ") for _ in range(30)) for _ in range(400)]
    ssn = re.compile(r"(?<!\d)(?!000|666|9\d\d)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?!\d)")
    cpf = re.compile(r"(?<!\d)\d{3}\.\d{3}\.\d{3}-\d\d(?!\d)")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    first = F.regexp_replace("v", redaction.RULES[1][2], "[REDACTED_US_SSN]")
    got = [r.x for r in rows.select("i", F.regexp_replace(first, redaction.RULES[2][2], "[REDACTED_CPF]").alias("x")).orderBy("i").collect()]
    assert got == [cpf.sub("[REDACTED_CPF]", ssn.sub("[REDACTED_US_SSN]", t)) for t in texts]


@pytest.mark.parametrize("n", [0, 3])
def test_audit_counts(spark, n):
    schema = "record_id string, document_id string, source struct<relative_path:string,upstream_pair_id:string>, curation struct<pii_status:string,pii_types:array<string>>"
    rows = [(f"r{i}", "d", ("p", "1"), ("redacted", ["us_ssn"]) if i else ("detected", [])) for i in range(n)]
    df = spark.createDataFrame(rows, schema)
    audit = redaction.pii_audit(df).first()
    assert (audit.records_scanned, audit.type_us_ssn, audit.unresolved) == (n, max(0, n - 1), min(n, 1))
    assert redaction.pii_findings(df).count() == max(0, n - 1)


def test_the_sql_of_the_rules_agrees():
    import duckdb

    from clinweave import queries

    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, c[0]) for i, c in enumerate(CASES)])
    got = con.execute(f"SELECT v2, {queries._found_types('v', 'v2')} FROM (SELECT i, v, {queries._redacted('v')} AS v2 FROM t) ORDER BY i").fetchall()
    assert [(v, sorted(t or [])) for v, t in got] == [(c[1], sorted(c[2])) for c in CASES]
