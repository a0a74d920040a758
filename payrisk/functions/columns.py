"""Column expressions shared by operators and plans.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from payrisk import schemas as S


def once(*cols: Column) -> Column:
    """``cols`` as columns of a one-row ``inline``.  Filters and projections after it can't be merged into what is before, which over
    a projection would be copied for each use, so each of ``cols`` is computed once a row."""
    return F.inline(F.array(F.struct(*cols)))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def window_end(ts, width: str) -> Column:
    """End of the epoch-aligned tumbling window ``[start, end)`` containing ``ts``
    (e.g. ``floor(ts, 5 min) + 5 min``)."""
    return F.window(_c(ts), width).end


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 for TIMESTAMP or TIMESTAMP_NTZ input,
    independent of the session zone for NTZ values."""
    return _epoch_seconds(_c(ts))


def _epoch_seconds(col: Column) -> Column:
    # timestampdiff works on NTZ without a zone; LTZ values are cast with the
    # session zone (UTC, set by payrisk.session.configure).
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            col.cast("timestamp_ntz"))


def seconds_between(later, earlier) -> Column:
    """``later - earlier`` in seconds, as double with microsecond precision."""
    return F.timestamp_diff("MICROSECOND", _c(earlier).cast("timestamp_ntz"),
                            _c(later).cast("timestamp_ntz")).cast("double") / 1e6


def iso_to_timestamp(s) -> Column:
    """Lenient ISO-8601 parse (``T`` or space, optional fraction, optional ``Z`` /
    offset) to a UTC TIMESTAMP_NTZ; unparseable → null."""
    return _c(s).try_cast("timestamp").cast("timestamp_ntz")


def try_double(c) -> Column:
    """Numeric coercion, bad values and NaN → null."""
    x = _c(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def json_number(c) -> Column:
    """A number read as JSON text: ``12.5``, ``"12.5"``, ``true`` (1) or ``false`` (0); anything else → null."""
    s = _c(c)
    return F.when(s == "true", F.lit(1.0)).when(s == "false", F.lit(0.0)).otherwise(try_double(s))


def try_label(c) -> Column:
    """Label coercion: numeric parse through double, truncated to int; null, NaN and values beyond int → 0."""
    return F.coalesce(try_double(c).try_cast("int"), F.lit(0))


def default_if_falsy(c, default) -> Column:
    """Python ``x or default`` for a number column: null or 0 → default."""
    col = _c(c)
    return F.when(col.isNull() | (col == 0), F.lit(default)).otherwise(col)


def heuristic_probability(amount="amount", txn_1m="txn_count_1m", txn_5m="txn_count_5m") -> Column:
    """Fallback model: sigmoid(-6 + amount/250 + 0.35*txn_1m + 0.08*txn_5m), clipped to [0.001, 0.999]."""
    logit = (F.lit(S.HEURISTIC_INTERCEPT) + _c(amount).cast("double") / F.lit(S.HEURISTIC_AMOUNT_DIVISOR)
             + _c(txn_1m).cast("double") * F.lit(S.HEURISTIC_TXN_1M_WEIGHT)
             + _c(txn_5m).cast("double") * F.lit(S.HEURISTIC_TXN_5M_WEIGHT))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    lo, hi = S.HEURISTIC_CLIP
    return F.least(F.greatest(p, F.lit(lo)), F.lit(hi))


def decision(prob="fraud_probability", threshold: float = S.DECISION_THRESHOLD) -> Column:
    """``'fraud'`` when p >= threshold else ``'approve'``."""
    return F.when(_c(prob) >= F.lit(threshold), F.lit("fraud")).otherwise(F.lit("approve"))


def missing_feature_flags(features=tuple(S.ONLINE_FEATURES)) -> Column:
    """Names of the features that are null, in feature order."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in features]))


def round6(c) -> Column:
    return F.round(_c(c), 6)


def uuid5_expr(name: Column, namespace: str = S.INGEST_UUID_NAMESPACE) -> Column:
    """RFC 4122 name-based UUID (version 5) in SQL: sha1(namespace bytes ‖ utf8(name)),
    with version and variant bits set.  Equal to Python's ``uuid.uuid5``."""
    ns_hex = uuid.UUID(namespace).hex
    h = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )
