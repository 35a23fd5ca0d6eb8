"""Boolean Column builders.

Landing text tables map an empty field to NULL, but warehouse and in-memory
rows can still hold ``''``; every "present" test therefore treats both alike.
All builders return plain Columns, so Catalyst can push them into scans.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exclude_value(col: ColumnOrName, value) -> Column:
    """``col <> value``.  NULL fails as well (three-valued logic)."""
    return _c(col) != F.lit(value)


def include_values(col: ColumnOrName, values: Iterable) -> Column:
    """IN-list."""
    return _c(col).isin(list(values))


def at_least(col: ColumnOrName, minimum: Decimal | int | float) -> Column:
    """Inclusive minimum; NULL fails."""
    return _c(col) >= F.lit(minimum)


def is_present(col: ColumnOrName) -> Column:
    """Not NULL and not the empty string."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


def is_missing(col: ColumnOrName) -> Column:
    """Negation of B6 that is never NULL."""
    c = _c(col)
    return c.isNull() | (c == F.lit(""))


def slice_eq(col: ColumnOrName, value) -> Column:
    """Partition slice by equality (becomes a PartitionFilter on tables)."""
    return _c(col) == F.lit(value)


def active_as_of(
    as_of: str,
    status_col: ColumnOrName = "status",
    eff_col: ColumnOrName = "eff_dt",
    exp_col: ColumnOrName = "exp_dt",
    active: str = "A",
) -> Column:
    """Status matches, start <= as_of, end missing or >= as_of.

    Both ends are inclusive; ISO date strings compare lexicographically (H11).
    """
    eff, exp = _c(eff_col), _c(exp_col)
    return (
        (_c(status_col) == F.lit(active))
        & (eff <= F.lit(as_of))
        & (is_missing(exp) | (exp >= F.lit(as_of)))
    )


def month_slice(date_col: ColumnOrName, month: str, partition_col: ColumnOrName | None = None) -> Column:
    """Rows whose ISO date starts with ``month + '-'`` (H10 ``LIKE 'm-%'``).

    When the table is partitioned by month, pass ``partition_col`` too: the
    prefix test alone is only a Parquet filter, the equality prunes partitions.
    """
    cond = _c(date_col).startswith(month + "-")
    if partition_col is not None:
        cond = (_c(partition_col) == F.lit(month)) & cond
    return cond


def any_negative(*cols: ColumnOrName) -> Column:
    """``a < 0 OR b < 0`` (TRUE OR NULL is TRUE, NULL OR FALSE is NULL)."""
    return reduce(or_, [_c(c) < F.lit(0) for c in cols])


def any_missing(text_cols: Iterable[ColumnOrName] = (), null_cols: Iterable[ColumnOrName] = ()) -> Column:
    """Any text column missing (NULL or '') or any other column NULL."""
    parts = [is_missing(c) for c in text_cols] + [_c(c).isNull() for c in null_cols]
    return reduce(or_, parts)


def all_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(and_, conds) if conds else F.lit(True)
