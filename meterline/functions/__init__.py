"""Column expressions shared by the operators (all JVM-side built-ins)."""

from meterline.functions.exprs import (  # noqa: F401
    MONEY, clamp_negative, movement, priority, seconds_between, whole_seconds,
)
