"""Aggregate and scalar expressions.

Everything stays in exact decimal or integer arithmetic so results equal an
independent SQL engine's to the last digit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cargomart.functions.predicates import ColumnOrName, _c

# Fixed value: the text form of run stamps (load_timestamp columns).
RUN_STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def count_where(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` — BIGINT, 0 for no match."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_or_zero(col: ColumnOrName, result_type: DecimalType = DecimalType(18, 2)) -> Column:
    """NULL-safe decimal sum, cast to the table's type (ANSI raises on overflow)."""
    return F.sum(F.coalesce(_c(col), F.lit(Decimal(0)))).cast(result_type)


def percent_string(numer: ColumnOrName, denom: ColumnOrName) -> Column:
    """``numer*100/denom`` rounded HALF_UP to two places, as ``'NN.NN%'``.

    Decimal arithmetic (``100.0`` is a decimal literal), so 1/32 gives
    ``3.13%`` and 2/3 gives ``66.67%``; a zero denominator gives ``0.00%``.
    """
    n, d = _c(numer), _c(denom)
    pct = F.round(n * F.lit(Decimal("100.0")) / d, 2)
    return F.when(d == 0, F.lit("0.00%")).otherwise(F.concat(pct.cast("string"), F.lit("%")))


def int_percent(numer: ColumnOrName, denom: ColumnOrName) -> Column:
    """H7: truncating integer percent ``numer*100 div denom``; 0 when denom is 0."""
    n, d = _c(numer).cast("bigint"), _c(denom).cast("bigint")
    # Exact integer arithmetic: subtract the remainder, then divide evenly.
    scaled = n * F.lit(100)
    quotient = ((scaled - F.pmod(scaled, d)).cast("decimal(38,0)") / d.cast("decimal(38,0)"))
    return F.when(d == 0, F.lit(0).cast("bigint")).otherwise(quotient.cast("bigint"))


def run_stamp(literal: str | None = None) -> Column:
    """Run time as ``yyyy-MM-dd HH:mm:ss`` text, or a fixed literal."""
    if literal is not None:
        return F.lit(literal)
    return F.date_format(F.current_timestamp(), RUN_STAMP_FORMAT)


def render_cell(col: ColumnOrName) -> Column:
    """NULL -> ``''``, any other value -> its string form (0 stays ``0``,
    decimal(18,2) keeps its scale: ``1750.00``)."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def truncate_text(col: ColumnOrName, n: int = 4000) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(col), 1, n)


def describe_missing_key(prefix: str, col: ColumnOrName, suffix: str) -> Column:
    """H1/H2: ``CONCAT(prefix, COALESCE(col, ''), suffix)``."""
    return F.concat(F.lit(prefix), F.coalesce(_c(col), F.lit("")), F.lit(suffix))
