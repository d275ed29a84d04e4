"""Column-level building blocks. Built-in functions only, no UDFs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact decimal(18,2) for meters and amounts."""
    return col(c).cast(MONEY)


def null(dtype) -> Column:
    """A typed NULL literal (an untyped one is written as ``void``)."""
    return F.lit(None).cast(dtype)


def priority(type_col, mapping: dict, default: int | None) -> Column:
    """Map an event type to its sort priority; ``default`` for unknown types."""
    c = col(type_col)
    items = list(mapping.items())
    expr = F.when(c == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(c == k, F.lit(v))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr.cast("int")


def whole_seconds(ts) -> Column:
    """Seconds since the epoch, truncated to the whole second.

    Differences of these count second boundaries, so 0.9 s -> 1.1 s is 1.
    Works for TIMESTAMP and TIMESTAMP_NTZ (read in the UTC session zone).
    """
    return F.unix_seconds(col(ts).cast("timestamp"))


def seconds_between(start, end) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (NULL if either is)."""
    return whole_seconds(end) - whole_seconds(start)


def micros(ts) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def clamp_negative(c) -> Column:
    """Negative values become 0; NULL stays NULL."""
    c = col(c)
    return F.when(c < 0, F.lit(0).cast(MONEY)).otherwise(c)


def movement(type_col, amount, payout, mapping: dict) -> Column:
    """Credit movement of one event: +/- amount, plus payout where it counts."""
    t, a, p = col(type_col), col(amount), col(payout)
    expr = None
    for k, (sign, with_payout) in mapping.items():
        v = (a if sign > 0 else -a)
        if with_payout:
            v = p + v
        expr = F.when(t == k, v) if expr is None else expr.when(t == k, v)
    return expr.otherwise(F.lit(None)).cast(T.DecimalType(20, 2))


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def session_id_expr(egm, ts, number, fmt: str) -> Column:
    """``<egm>_<yyyyMMddHHmmss>_<n>``."""
    return F.concat_ws("_", col(egm), F.date_format(col(ts), fmt), col(number).cast("string"))
