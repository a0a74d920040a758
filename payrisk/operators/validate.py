"""Strict validation of raw JSON payment messages and dead-letter routing
(FLT-5, SNK-3, AGG-17).

Each message is parsed once into a VARIANT (``try_parse_json``); every rule is
a column expression over it, so validation runs in whole-stage codegen on the
executors and works the same on a batch or a streaming frame.

Rules (JSON Schema draft semantics): the document must be an object; all 19
fields are required; ``number`` accepts integers and decimals, ``integer``
accepts whole numbers (``1.0`` too), booleans are neither; JSON ``null`` fails
every type; ``channel`` ∈ {pos, ecom}, ``is_fraud`` ∈ {0, 1}; extra fields
are allowed.  Bytes that are not valid UTF-8 are an error (strict decode); the
dead-letter ``raw`` text is the repaired string (bad bytes → U+FFFD).  A
document with duplicate keys or a bare ``NaN`` does not parse as VARIANT and is
routed as ``not_json`` (a lenient Python parser would have accepted it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrisk import schemas as S
from payrisk.functions.columns import once

_NUMBER_TYPES = ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT", "INT", "SMALLINT", "TINYINT")


def _vtype(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def _is_number(t: Column) -> Column:
    return F.regexp_like(t, F.lit("^(" + "|".join(_NUMBER_TYPES) + ")"))


def _field_error(t: Column, num: Column, sval: Column, field: str, jtype: str) -> Column:
    """At most one error for ``field`` (type first, then enum) from its variant
    type name ``t``; an absent field (t null) yields none here (the required
    rule reports it)."""
    if jtype == "string":
        ok = t == "STRING"
    elif jtype == "number":
        ok = _is_number(t)
    elif jtype == "integer":
        ok = (t == "BIGINT") | (_is_number(t) & (num == F.floor(num)))
    elif jtype == "boolean":
        ok = t == "BOOLEAN"
    else:
        raise ValueError(jtype)
    err = F.when(t.isNotNull() & ~ok, F.lit(f"type:{field}"))
    if field == "channel":
        err = F.coalesce(err, F.when(t.isNotNull() & ok & ~sval.isin(*S.CHANNELS), F.lit(f"enum:{field}")))
    if field == "is_fraud":
        err = F.coalesce(err, F.when(t.isNotNull() & ok & ~num.isin(*[float(x) for x in S.FRAUD_LABELS]),
                                     F.lit(f"enum:{field}")))
    return err


def with_validation(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``errors`` (array<string>, empty when valid) for a binary or string
    message column.  Order: bytes, JSON, object, required, then each field in
    schema order.

    Three steps: parse once into a VARIANT, read every field's type name
    once, then build the error list from those columns.  Each step is computed once (``once``): over
    plain projections a filter on the outcome is pushed down with a copy of the parse for each use of a field."""
    raw = F.col(value).cast("string")
    v = F.col("_v")
    parsed = messages.select("*", once(F.is_valid_utf8(raw).alias("_utf8"), F.try_parse_json(raw).alias("_v")))
    typed = parsed.select("*", once(F.struct(
        # a document that parsed and starts with "{" is an object (cheaper than typing the root)
        F.regexp_like(raw, F.lit(r"^[ \t\r\n]*\{")).alias("_is_object"),
        *[_vtype(v, f).alias(f) for f in S.PAYMENT_REQUIRED_FIELDS],
        F.try_variant_get(v, "$.is_fraud", "double").alias("_num_is_fraud"),
        F.try_variant_get(v, "$.channel", "string").alias("_str_channel"),
    ).alias("_t")))
    t = lambda f: F.col(f"_t.{f}")
    is_obj = F.coalesce(t("_is_object"), F.lit(False))
    missing = [F.when(t(f).isNull(), F.lit(f"missing_required:{f}")) for f in S.PAYMENT_REQUIRED_FIELDS]
    field_errs = [_field_error(t(f), t("_num_is_fraud"), t("_str_channel"), f, S.PAYMENT_FIELD_TYPES[f])
                  for f in S.PAYMENT_REQUIRED_FIELDS]
    errors = (F.when(~F.col("_utf8"), F.array(F.lit("invalid_utf8")))
               .when(v.isNull(), F.array(F.lit("not_json")))
               .when(~is_obj, F.array(F.lit("not_object")))
               .otherwise(F.array_compact(F.array(*missing, *field_errs))))
    return typed.select("*", once(errors.alias("errors"))).drop("_utf8", "_t")


def validate_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``errors`` (array), ``error`` (first error or null) and ``is_valid``."""
    return (with_validation(messages, value)
            .withColumn("error", F.get(F.col("errors"), 0))
            .withColumn("is_valid", F.size("errors") == 0))


def parse_payment(v: Column) -> Column:
    """Typed struct of the 19 fields from a valid message's VARIANT (PRJ-1);
    ``is_fraud`` goes through double so a whole ``1.0`` reads as 1."""
    fields = []
    for f in S.PAYMENTS_RAW.fields:
        if f.name == "is_fraud":
            c = F.try_variant_get(v, "$.is_fraud", "double").cast("int")
        else:
            c = F.try_variant_get(v, f"$.{f.name}", f.dataType.simpleString())
        fields.append(c.alias(f.name))
    return F.struct(*fields)


def route(checked: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split an already validated frame (see :func:`validate_messages`) into
    (valid typed payments, dead-letter records).

    Dead-letter schema: error, raw (UTF-8 repaired), topic, partition, offset —
    the Kafka source columns are passed through when present.
    """
    valid = (checked.where(F.col("is_valid"))
                    .select(parse_payment(F.col("_v")).alias("p"))
                    .select("p.*"))
    cols = checked.columns
    meta = {c: F.col(c) for c in ("topic", "partition", "offset") if c in cols}
    dlq = checked.where(~F.col("is_valid")).select(
        F.col("error"),
        F.make_valid_utf8(F.col(value).cast("string")).alias("raw"),
        meta.get("topic", F.lit(None).cast("string")).alias("topic"),
        meta.get("partition", F.lit(None).cast("int")).cast("int").alias("partition"),
        meta.get("offset", F.lit(None).cast("long")).cast("long").alias("offset"),
    )
    return valid, dlq


def split_valid(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Validate and route messages: (valid typed payments, dead-letter records)."""
    return route(validate_messages(messages, value), value)


def validation_counts(messages: DataFrame, value: str = "value") -> DataFrame:
    """AGG-17 and DLQ reasons: one row per outcome (``ok`` or the first error)."""
    checked = validate_messages(messages, value)
    return (checked.groupBy(F.coalesce(F.col("error"), F.lit("ok")).alias("outcome"))
                   .agg(F.count(F.lit(1)).alias("n")))
