"""Latest record per key.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC) = 1`` is re-expressed
as a grouped ``max`` over a struct whose leading fields are the ordering
columns.  A grouped aggregate combines map-side, so each input partition
ships at most one row per key to the shuffle: a key holding a third of all
rows costs no more reduce-side work than any other key.  Struct comparison
puts NULL fields lowest, which is exactly ``DESC NULLS LAST``; the remaining
fields act as final tie-breakers, so the survivor is deterministic (Q14).

``latest_per_key_window`` is the literal window form, kept for equivalence
tests and plan comparisons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargomart.session import materialize

_LATEST = "__latest"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] = (),
    take: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_by`` values
    (NULLs lowest), then the greatest ``tie_breakers``.

    Returns ``keys`` + ``take`` (default: every other column).
    """
    keys = list(keys)
    ranking = list(order_by) + [c for c in tie_breakers if c not in order_by]
    if take is None:
        take = [c for c in df.columns if c not in keys]
    # The output columns follow the ranking in the struct, so rows that tie on
    # the ranking are decided by the output values themselves: the result is
    # deterministic without carrying any other column through the shuffle.
    payload = ranking + [c for c in take if c not in ranking]
    fields = [F.col(c).alias(f"f{i}") for i, c in enumerate(payload)]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias(_LATEST))
    pos = {c: i for i, c in enumerate(payload)}
    return agg.select(*keys, *[F.col(f"{_LATEST}.f{pos[c]}").alias(c) for c in take])


def latest_per_key_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] = (),
    take: Sequence[str] | None = None,
) -> DataFrame:
    """Window form of ``latest_per_key`` (row_number = 1)."""
    keys = list(keys)
    if take is None:
        take = [c for c in df.columns if c not in keys]
    ranking = list(order_by) + [c for c in tie_breakers if c not in order_by]
    rest = [c for c in df.columns if c not in keys and c not in ranking]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ranking + rest])
    return (
        df.withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .select(*keys, *take)
    )


def number_rows(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], name: str = "line_no", start: int = 1) -> DataFrame:
    """adds each row's place in its group by ``order_by`` (ascending, nulls
    first), counted from ``start``; no group has to fit into one task.

    The rows are range-partitioned by group and order and written once; a group
    then lies in neighbouring partitions, and a row's place is its place among
    the group's rows of its partition plus the rows of the partitions before,
    which one small table (a row for each group and partition) says.  Rows that
    are alike in all of these columns take their places in any order."""
    group_by = list(group_by)
    keys = [F.asc_nulls_first(c) for c in [*group_by, *order_by]]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialize(ordered.withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    sizes = rows.groupBy(*group_by, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group_by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *[F.col(f"`{c}`").alias(f"__g{i}") for i, c in enumerate(group_by)], F.col("__part").alias("__p"), "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    same = F.col("__part") == F.col("__p")
    for i, c in enumerate(group_by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__g{i}"))
    place = F.col("__before") + F.col("__at") - F.col("__first") + start
    return rows.join(sizes, same).withColumn(name, place).select(*df.columns, name)
