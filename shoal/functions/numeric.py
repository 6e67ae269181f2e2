"""Rounding that gives the same double in Spark and in any SQL engine.

``round`` implementations differ near ties (exact decimal expansion vs.
scaled float); ``sign(x) * floor(abs(x) * 10^k + 0.5) / 10^k`` is the same
sequence of IEEE operations everywhere (half away from zero)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(c: Column, k: int) -> Column:
    scale = float(10 ** k)
    x = c.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def sql_round_half(expr: str, k: int) -> str:
    """SQL text of :func:`round_half` for the oracle queries."""
    scale = f"{float(10 ** k)!r}"
    return (f"(sign(cast({expr} AS double)) * floor(abs(cast({expr} AS double)) * {scale} + 0.5)"
            f" / {scale})")


def ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` as DOUBLE, never raising under ANSI mode."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))
