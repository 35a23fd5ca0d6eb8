"""Aggregations.

Every grouped aggregate here is decomposable (count/sum/max), so Spark runs a
partial aggregate before the shuffle: a hot key is combined map-side and
reaches the reduce side as one row per input partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargomart.functions.measures import count_where, percent_string, sum_or_zero
from cargomart.functions.predicates import all_of, is_present
from cargomart.operators.joins import bounded_broadcast
from cargomart.operators.windows import latest_per_key


def duplicate_keys(df: DataFrame, keys: Sequence[str], present: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once, with their count ``cnt``.

    Rows whose ``present`` columns are NULL or blank are ignored (Q19).
    """
    if present:
        df = df.where(all_of(is_present(c) for c in present))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .where(F.col("cnt") > 1)
    )


def duplicate_keys_hashed(df: DataFrame, keys: Sequence[str], present: Sequence[str] = ()) -> DataFrame:
    """D2 in two steps, for wide keys and few duplicates: the rows' 64-bit key
    hashes are counted (8 bytes a key are shuffled), and only rows whose hash
    occurs more than once are grouped by their full keys, so a collision of
    hashes costs a row of work and no wrong result.  ``df`` is read twice."""
    if present:
        df = df.where(all_of(is_present(c) for c in present))
    # A null hashes as its seed does: say which keys are null.
    parts = [x for c in keys for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashed = df.select(*keys, F.xxhash64(*parts).alias("__h"))
    twice = hashed.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")
    rows = hashed.join(bounded_broadcast(twice), "__h", "left_semi")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def duplicate_key_count(df: DataFrame, keys: Sequence[str], present: Sequence[str] = ()) -> DataFrame:
    """D3: one row ``dup_count`` = number of duplicated keys (not surplus rows)."""
    return duplicate_keys(df, keys, present).agg(F.count(F.lit(1)).alias("dup_count"))


def summarize(df: DataFrame, keys: Sequence[str | Column], measures: Mapping[str, Column]) -> DataFrame:
    """Multi-key grouped summary; ``measures`` maps name -> aggregate Column."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def shipment_measures(
    approved: str,
    rejected: Sequence[str],
    status_col: str = "shipment_status_code",
) -> dict[str, Column]:
    """The summary's measures (D5, D6).  ``approval_rate`` (D7) is derived after
    aggregation from the two counts; see ``with_approval_rate``."""
    status = F.col(status_col)
    return {
        "total_count": F.count(F.lit(1)),
        "approved_count": count_where(status == F.lit(approved)),
        "rejected_count": count_where(status.isin(*rejected)),
        "total_amount": sum_or_zero("declared_value"),
        "total_weight_kg": sum_or_zero("weight_kg"),
    }


def with_approval_rate(summary: DataFrame) -> DataFrame:
    return summary.withColumn("approval_rate", percent_string("approved_count", "total_count"))


def combined_count(sources: Mapping[str, DataFrame], total: str = "active_cnt") -> DataFrame:
    """One row with ``<label>_cnt`` per source and their sum ``total``.

    Each source is counted by its own single-row aggregate; the rows are
    unioned and folded, so no source is joined to another.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n")).withColumn("label", F.lit(label)) for label, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    cols = [F.sum(F.when(F.col("label") == F.lit(label), F.col("n"))).cast("bigint").alias(f"{label}_cnt") for label in sources]
    return u.agg(*cols, F.sum("n").cast("bigint").alias(total))


def rollup_counts(summary: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Re-aggregate a summary by coarser ``keys`` (sums of counts/amounts)."""
    out = summary.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])
    return out.select(*keys, *[F.col(c).cast(summary.schema[c].dataType).alias(c) for c in cols])


def rollup_levels(summary: DataFrame, levels: Sequence[Sequence[str]], cols: Sequence[str]) -> DataFrame:
    """D9 at several levels from one pass (GROUPING SETS): the columns of all
    levels (null where a level hasn't got one), ``level_id`` and the sums.
    ``level_id`` has a bit for each column, the first the highest, set where the
    column is summed over, which tells such nulls from null values."""
    keys = list(dict.fromkeys(c for level in levels for c in level))
    sets = [[F.col(f"`{c}`") for c in level] for level in levels]
    sums = [F.sum(c).cast(summary.schema[c].dataType).alias(c) for c in cols]
    out = summary.groupingSets(sets, *[F.col(f"`{c}`") for c in keys]).agg(F.grouping_id().cast("int").alias("level_id"), *sums)
    return out.select(*keys, "level_id", *cols)


def error_counts(dq: DataFrame, by: Sequence[str] = ("trans_dt", "error_code")) -> DataFrame:
    """Rows per error code (the consumer query the DQ table exists for)."""
    return dq.groupBy(*by).agg(F.count(F.lit(1)).alias("error_cnt"))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key.  Deterministic: the survivor is the greatest row
    by ``order_by`` then by all remaining columns (``dropDuplicates`` keeps an
    arbitrary one)."""
    out = latest_per_key(df, keys, order_by)
    return out.select(*df.columns)


def calendar_days(bounds: DataFrame, lo: str = "lo", hi: str = "hi", name: str = "trans_dt") -> DataFrame:
    """Every day from ``lo`` to ``hi`` (DATE columns of a one-row ``bounds``)
    as ``'yyyy-MM-dd'`` strings in column ``name``."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("__d")).select(
        F.date_format("__d", "yyyy-MM-dd").alias(name)
    )


def missing_days(source: DataFrame, target: DataFrame, col: str = "trans_dt") -> DataFrame:
    """Q12: days between the first and last ``source`` day that have no row in
    ``target`` (e.g. a weekday the daily schedule never loads).

    The calendar between the source bounds (one small aggregate) and the
    target's day column are unioned and grouped once by day: the target side
    is combined map-side to one row per day and partition, and a day is
    missing when only the calendar contributed to its group.  No join.
    """
    bounds = source.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    cal = calendar_days(bounds, name=col).select(col, F.lit(True).alias("__cal"), F.lit(False).alias("__tgt"))
    tgt = target.select(col, F.lit(False).alias("__cal"), F.lit(True).alias("__tgt"))
    per_day = cal.unionByName(tgt).groupBy(col).agg(F.max("__cal").alias("__cal"), F.max("__tgt").alias("__tgt"))
    return per_day.where(F.col("__cal") & ~F.col("__tgt")).select(col)


def unloaded_days(source: DataFrame, target: DataFrame, col: str = "trans_dt") -> DataFrame:
    """Q12: days present in ``source`` but absent from ``target`` (distinct
    day values on both sides, combined map-side before the anti join)."""
    return source.select(col).distinct().join(target.select(col).distinct(), col, "left_anti")
