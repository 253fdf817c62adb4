"""Request bodies as JSON: objects or lists of objects, checked with the types they were sent in.

A body is parsed once into a VARIANT, so ``12`` and ``"12"`` stay different, as do a field that
was not sent and one that was sent as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.bands import number
from ebbtide.operators.linear import MAIN, LinearScorer
from ebbtide.operators.scoring import record_table
from ebbtide.operators.validation import LENIENT_FIELDS, LENIENT_MESSAGES, MISSING, STRICT_FIELDS, STRICT_MESSAGES
from ebbtide.schema import DOMAINS, ID, REQUEST

NOT_RECORDS = "Expected a list of customer data"  # fixed value: message


def payload_records(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """The columns of ``payloads`` but ``column``, then ``position`` and ``record`` (VARIANT).

    A list gives a row per element, an object one row, an empty list none. What is neither, and
    an element that is no object, gives a row with a null record.
    """
    kept = [c for c in payloads.columns if c != column]
    parsed = payloads.select(*kept, F.try_parse_json(F.col(column)).alias("_body"))
    kind = F.schema_of_variant("_body")
    listed = F.try_variant_get("_body", "$", "array<variant>")
    records = F.when(kind.startswith("ARRAY"), listed).otherwise(F.array("_body"))
    rows = parsed.select(*kept, F.posexplode(records).alias("position", "_record"))
    is_object = F.schema_of_variant("_record").startswith("OBJECT")
    return rows.select(*kept, "position", F.when(is_object, F.col("_record")).alias("record"))


def _sent(field: str) -> Column:
    """Type a field was sent in; null if it was not sent."""
    return F.schema_of_variant(F.try_variant_get("record", f"$.{field}", "variant"))


def _value(field: str, kind: str = "string") -> Column:
    return F.try_variant_get("record", f"$.{field}", kind)


def _is_number(field: str) -> Column:
    # Booleans count as the numbers 0 and 1.
    return _sent(field).rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL|BOOLEAN)")


def payload_error(strict: bool = True) -> Column:
    """First failing message of ``record``; null when it is fine. The strict rules want numbers
    sent as numbers, the lenient ones take text that reads as a number."""
    if strict:
        fields, messages = STRICT_FIELDS, STRICT_MESSAGES
        checks = [
            _is_number("tenure") & (_value("tenure", "double") >= 0),
            _is_number("MonthlyCharges") & (_value("MonthlyCharges", "double") > 0),
            _value("Contract").isin(*DOMAINS["Contract"]),
            _value("InternetService").isin(*DOMAINS["InternetService"]),
        ]
    else:
        fields, messages = LENIENT_FIELDS, LENIENT_MESSAGES
        checks = [number(_value(c)).isNotNull() for c in ("tenure", "MonthlyCharges")]
    gaps = F.concat_ws(", ", *[F.when(_sent(c).isNull(), F.lit(c)) for c in fields])
    arms = [F.when(F.col("record").isNull(), F.lit(NOT_RECORDS)), F.when(gaps != "", F.concat(F.lit(MISSING), gaps))]
    arms += [F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in zip(checks, messages)]
    return F.coalesce(*arms)


def checked_payloads(payloads: DataFrame, strict: bool = True, column: str = "payload") -> DataFrame:
    """customer_id, error and the request columns of every record, in one narrow pass."""
    records = payload_records(payloads, column)
    typed = [_value(f.name, f.dataType.simpleString()).alias(f.name) for f in REQUEST.fields]
    return records.select(F.coalesce(_value(ID), F.lit("Unknown")).alias("customer_id"), payload_error(strict).alias("error"), *typed)


def score_payloads(
    payloads: DataFrame, strict: bool = False, threshold: float = 0.5, scorer: LinearScorer = MAIN, column: str = "payload"
) -> DataFrame:
    """customer_id, error, probability, decision and risk of every record of the bodies."""
    typed = checked_payloads(payloads, strict, column).withColumns(
        {
            "tenure": number("tenure"),
            "MonthlyCharges": number("MonthlyCharges"),
            "SeniorCitizen": F.coalesce(F.col("SeniorCitizen"), F.lit(0)),
        }
    )
    return record_table(typed, scorer.probability(), threshold)
