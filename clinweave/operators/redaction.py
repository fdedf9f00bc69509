"""Direct identifiers replaced by ordered rules, by built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICY_VERSION = "1.0"
FIELDS = ("focus", "question", "answer", "synonyms")

# The rules in the order in which they run, as Java expressions. (?iu) ignores case; \x{212A} and
# \x{0130} join the letter ranges, which other engines match there when case is ignored. A first group is kept.
_L = r"\x{212A}\x{0130}"
_W = r"[\p{L}\p{N}_]"
RULES: tuple[tuple[str, str, str], ...] = (
    ("email_address", "[REDACTED_EMAIL]", rf"(?iu)()(?<![\p{{L}}\p{{N}}_.+\-])[A-Z0-9._%+\-{_L}]+@[A-Z0-9.\-{_L}]+\.[A-Z{_L}]{{2,63}}(?![\p{{L}}\p{{N}}_\-])"),
    ("us_ssn", "[REDACTED_US_SSN]", r"()(?<!\p{Nd})(?!000|666|9\p{Nd}{2})\p{Nd}{3}-(?!00)\p{Nd}{2}-(?!0000)\p{Nd}{4}(?!\p{Nd})"),
    ("brazilian_cpf", "[REDACTED_CPF]", r"()(?<!\p{Nd})\p{Nd}{3}\.\p{Nd}{3}\.\p{Nd}{3}-\p{Nd}{2}(?!\p{Nd})"),
    ("medical_record_number", "[REDACTED_MEDICAL_RECORD_NUMBER]", rf"(?iuU)(\b(?:medical\s+record(?:\s+(?:number|no\.?|#))?|mrn|patient\s+(?:id|identifier))\s*(?::|=|#|\bis\b)\s*)[A-Z0-9{_L}][A-Z0-9\-{_L}]{{3,31}}"),
    ("patient_name", "[REDACTED_PATIENT_NAME]", r"(?U)((?i:\b(?:patient\s+name|name\s+of\s+(?:the\s+)?patient)\s*[:=\-]\s*))[A-ZÀ-ÖØ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'\-]+(?:\s+[A-ZÀ-ÖØ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'\-]+){1,5}(?=\s*(?:[;,|]|\b(?i:DOB|date\s+of\s+birth|MRN|medical\s+record)\b|$))"),
    ("date_of_birth", "[REDACTED_DATE_OF_BIRTH]", r"(?iuU)(\b(?:date\s+of\s+birth|dob)\s*[:=\-]\s*)(?:\d{4}-\d{2}-\d{2}|\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\.?\s+\d{1,2},?\s+\d{4})"),
    ("phone_number", "[REDACTED_PHONE]", rf"(?U)()(?<!{_W})(?:\+?1[\s.\-]?)?(?:\(\d{{3}}\)|\d{{3}})[\s.\-]\d{{3}}[\s.\-]\d{{4}}(?!{_W})"),
    ("phone_number", "[REDACTED_PHONE]", rf"(?iuU)()(?<!{_W})1[\s.\-]?(?:800|833|844|855|866|877|888)(?:[\s.\-]?[A-Z0-9{_L}]){{7,11}}(?!{_W})"),
    ("phone_number", "[REDACTED_PHONE]", r"(?U)()(?<!\d)1(?:800|833|844|855|866|877|888)\d{7}(?!\d)"),
    ("phone_number", "[REDACTED_PHONE]", r"(?U)()(?<!\d)1?[2-9]\d{2}[2-9]\d{6}(?!\d)"),
    ("phone_number", "[REDACTED_PHONE]", r"(?iuU)(\b(?:phone|telephone|tel|mobile|cell|fax|tty)\s*:?[ \t]*)\+?\d{7,15}(?!\d)"),
    ("phone_number", "[REDACTED_PHONE]", r"(?iuU)(\bcall(?:ing)?\s+)\+?\d{10,15}(?!\d)"),
)
# The order in which detected types are reported.
TYPE_ORDER = ("email_address", "phone_number", "us_ssn", "brazilian_cpf", "medical_record_number", "patient_name", "date_of_birth")
PLACEHOLDER = {kind: placeholder for kind, placeholder, _ in RULES}


#: Rules that can match a text without any digit: those of addresses, record numbers and names.
_WITHOUT_DIGITS = ("email_address", "medical_record_number", "patient_name")


def _in_turn(text: Column, leave_out: tuple[str, ...] = (), only: tuple[str, ...] | None = None) -> Column:
    for kind, placeholder, pattern in RULES:
        if kind not in leave_out and (only is None or kind in only):
            text = F.regexp_replace(text, pattern, "$1" + placeholder.replace("[", r"\[").replace("]", r"\]"))
    return text


def redact(text: Column) -> Column:
    """The text after all rules; each works on the result of the one before.

    Rules that cannot match are passed over: most need a digit, one an @, and no placeholder brings in either.
    """
    digit, at = text.rlike(r"\p{Nd}"), F.contains(text, F.lit("@"))
    label = text.rlike("(?iu)mrn|medical|patient")
    with_digits = F.when(at, _in_turn(text)).otherwise(_in_turn(text, leave_out=("email_address",)))
    return F.when(digit, with_digits).when(at | label, _in_turn(text, only=_WITHOUT_DIGITS)).otherwise(text)


def detected_types(text: Column, redacted: Column) -> Column:
    """Types of the placeholders that redaction added, in TYPE_ORDER."""

    def times(c: Column, placeholder: str) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(placeholder), F.lit(placeholder[1:])))

    added = [F.when(times(redacted, PLACEHOLDER[k]) > times(text, PLACEHOLDER[k]), F.lit(k)) for k in TYPE_ORDER]
    none = F.array().cast("array<string>")
    return F.when(redacted.isNull() | (redacted == text), none).otherwise(F.array_compact(F.array(*added)))


def redact_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Redacts string columns in place and adds ``<column>_types``. Null stays null, with no types."""
    df = df.select("*", *[redact(F.col(c)).alias(f"_{c}") for c in columns])
    df = df.select("*", *[detected_types(F.col(c), F.col(f"_{c}")).alias(f"{c}_types") for c in columns])
    return df.withColumns({c: F.col(f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def pii_audit(records: DataFrame) -> DataFrame:
    """One row: records by status and by detected type, and how many are unresolved.

    ``records`` has ``curation`` with ``pii_status`` and ``pii_types``. A type counts once per record.
    """
    status, types = F.col("curation.pii_status"), F.col("curation.pii_types")
    return records.agg(
        F.lit(POLICY_VERSION).alias("policy_version"),
        F.count("*").alias("records_scanned"),
        *[F.count_if(status == s).alias(f"status_{s}") for s in ("not_evaluated", "not_detected", "detected", "redacted")],
        *[F.count_if(F.array_contains(types, k)).alias(f"type_{k}") for k in TYPE_ORDER],
        F.count_if(status.isin("not_evaluated", "detected")).alias("unresolved"),
    )


def pii_findings(records: DataFrame) -> DataFrame:
    """One row per redacted record, without any value."""
    return records.filter("curation.pii_status = 'redacted'").select(
        "record_id", "document_id", F.col("source.relative_path").alias("source_relative_path"), F.col("source.upstream_pair_id").alias("upstream_pair_id"),
        F.col("curation.pii_types").alias("detected_types"), F.lit("redacted").alias("action"),
    )
