"""Rules for JSON values: typed guards, timed texts, diagnostics, canonical and sparse serialisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The states of speech coverage.
STATUSES = ("no_speech", "no_transcript", "alignment_failed", "low_coverage", "sufficient")


def kind_of(value: Column, path: str) -> Column:
    """The type of a variant's field, such as STRING; VOID for an explicit null, null where it is missing."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(value, path, "variant")), "^[A-Z]+", 0)


def guard(value: Column, path: str, *kinds: str) -> Column:
    """ok, missing, null or wrong_type: three ways in which a field can fail, told apart."""
    kind = kind_of(value, path)
    return F.when(kind.isNull(), "missing").when(kind == "VOID", "null").when(kind.isin(*kinds), "ok").otherwise("wrong_type")


def whole(value: Column, path: str) -> Column:
    """A whole number; null for booleans, fractions, texts and missing fields."""
    return F.when(kind_of(value, path) == "BIGINT", F.try_variant_get(value, path, "bigint"))


def timed_texts(value: Column) -> Column:
    """A variant's array of timed texts as structs; an empty array for null, null if it is none or any item is wrong:
    text not blank, 0 <= start <= end (zero length is allowed), confidence missing or a number from 0 to 1."""
    items = F.try_variant_get(value, "$", "array<variant>")

    def item(x: Column) -> Column:
        confidence = F.try_variant_get(x, "$.confidence", "double")
        text, low, high = F.try_variant_get(x, "$.text", "string"), whole(x, "$.start_ms"), whole(x, "$.end_ms")
        sure = F.coalesce(kind_of(x, "$.confidence"), F.lit("VOID"))
        good = (kind_of(x, "$.text") == "STRING") & (text != "") & (low >= 0) & (low <= high) & ((sure == "VOID") | (sure.isin("BIGINT", "DOUBLE", "DECIMAL") & (confidence >= 0) & (confidence <= 1)))
        return F.when(F.coalesce(good, F.lit(False)), F.struct(text.alias("text"), low.alias("start_ms"), high.alias("end_ms"), confidence.alias("confidence")))

    parsed = F.transform(items, item)
    none = F.when(value.isNull() | F.is_variant_null(value), F.slice(F.array(item(value)), 1, 0))
    return F.coalesce(none, F.when(~F.exists(parsed, lambda x: x.isNull()), parsed))


def lenient_alignments(value: Column) -> Column:
    """An array of aligned tokens without those that are malformed or end no later than they start."""
    found = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: F.struct(F.try_variant_get(x, "$.text", "string").alias("text"), whole(x, "$.start_ms").alias("start_ms"), whole(x, "$.end_ms").alias("end_ms")))
    return F.filter(found, lambda x: x["text"].isNotNull() & (x["start_ms"] < x["end_ms"]))


def coverage_state(assessment: Column) -> Column:
    """The state of an assessment; older ones without it: nothing covered, marked as low, or sufficient. Null if invalid."""
    ratio = F.try_variant_get(assessment, "$.speech_coverage_ratio", "double")
    given, kind = F.try_variant_get(assessment, "$.speech_coverage_status", "string"), kind_of(assessment, "$.speech_coverage_status")
    low = F.when(kind_of(assessment, "$.has_low_speech_coverage") == "BOOLEAN", F.try_variant_get(assessment, "$.has_low_speech_coverage", "boolean"))
    legacy = F.when(ratio <= 0, "no_transcript").when(low, "low_coverage").otherwise("sufficient")
    number = kind_of(assessment, "$.speech_coverage_ratio").isin("BIGINT", "DOUBLE", "DECIMAL")
    return F.when(number, F.when(kind.isNull() | (kind == "VOID"), legacy).when(given.isin(*STATUSES), given))


def diagnostics(value: Column) -> Column:
    """selected_attempt and attempts (attempt, status, gap_ms, gap_start_ms, gap_end_ms); null if any part is invalid."""
    attempts = F.transform(
        F.try_variant_get(value, "$.attempts", "array<variant>"),
        lambda a: F.struct(
            whole(a, "$.attempt").alias("attempt"), coverage_state(F.try_variant_get(a, "$.assessment", "variant")).alias("status"), whole(a, "$.assessment.longest_uncovered_speech_ms").alias("gap_ms"),
            F.coalesce(whole(a, "$.assessment.longest_uncovered_speech_start_ms"), F.lit(0)).alias("gap_start_ms"),
            F.coalesce(whole(a, "$.assessment.longest_uncovered_speech_end_ms"), whole(a, "$.assessment.longest_uncovered_speech_ms")).alias("gap_end_ms"),
            F.when(kind_of(a, "$.assessment.has_long_uncovered_speech") == "BOOLEAN", F.try_variant_get(a, "$.assessment.has_long_uncovered_speech", "boolean")).alias("long_gap"),
        ),
    )
    wrong = lambda a: a["attempt"].isNull() | a["status"].isNull() | a["gap_ms"].isNull() | a["long_gap"].isNull()
    chosen = whole(value, "$.selected_attempt")
    return F.when(chosen.isNotNull() & (F.size(attempts) > 0) & ~F.exists(attempts, wrong), F.struct(chosen.alias("selected_attempt"), attempts.alias("attempts")))


def canonical_hash(**fields: Column) -> Column:
    """SHA-256 of the fields as compact JSON with sorted keys, nulls included."""
    body = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)


def sparse_json(**fields: Column) -> Column:
    """JSON without the keys whose value is null; pass arrays through ``filled``."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def filled(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)
