"""Joins: size-checked broadcast, latest-record enrichment (C1), star join
and orphan detection (C3, C4).

Broadcast policy: a side is broadcast only after a probe has measured that
it holds at most ``max_rows`` rows and ``max_bytes`` bytes.  The probe is one
distributed aggregate (count and byte sum, combined map-side, one row per
input partition reaches the final task), so it never funnels data into a
single task.  Probes are meant for dimension-like sides; sides that grow with
the facts are joined with a shuffle join without probing.  A side that fails
the probe is left unhinted and Spark plans a shuffle join (with AQE
re-planning and skew splitting at runtime).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, StringType, StructType

from cargomart.operators.windows import latest_per_key
from cargomart.session import materialize

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def _row_bytes(schema: StructType) -> Column:
    """Approximate in-memory row size: 8 bytes per field plus variable data."""
    parts: list[Column] = [F.lit(8 * max(len(schema.fields), 1))]
    for f in schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        elif isinstance(f.dataType, DecimalType) and f.dataType.precision > 18:
            parts.append(F.lit(16))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("bigint")


@dataclass(frozen=True)
class SizeProbe:
    rows: int
    bytes: int
    bounded: bool  # rows <= the row limit


def probe_size(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> SizeProbe:
    """Count rows and bytes of ``df`` as it is now, with one map-side-combined
    aggregate.  Nothing is remembered: files may be replaced under their name."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df.schema)).alias("b")).first()
    n, b = int(r["n"]), int(r["b"] or 0)
    return SizeProbe(n, b, n <= max_rows)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    p = probe_size(df, max_rows)
    return p.bounded and p.bytes <= max_bytes


def bounded_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES
) -> DataFrame:
    """``F.broadcast(df)`` if a probe proves it small, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def _join_cond(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lk, rk in pairs:
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


def enrich_latest(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    order_by: Sequence[str],
    take: Mapping[str, str],
    tie_breakers: Sequence[str] = (),
    probe: bool = False,
) -> DataFrame:
    """Keep every left row; attach columns of the latest matching right row.

    ``on`` pairs (left column, right column); the right side is first reduced
    to one row per right key (E1), so the left cardinality is unchanged.
    ``take`` maps right column -> output name.  Unmatched left rows get NULLs.

    The reduced right side grows with the facts (one row per shipment), so by
    default it is shuffle-joined; ``probe=True`` broadcasts it if a probe
    proves it small.
    """
    rkeys = [rk for _, rk in on]
    latest = latest_per_key(right, rkeys, order_by, tie_breakers, take=list(take))
    renamed = latest.select(
        *[F.col(rk).alias(f"__rk{i}") for i, rk in enumerate(rkeys)],
        *[F.col(src).alias(dst) for src, dst in take.items()],
    )
    if probe:
        renamed = bounded_broadcast(renamed)
    cond = _join_cond(left, renamed, [(lk, f"__rk{i}") for i, (lk, _) in enumerate(on)])
    out = left.join(renamed, cond, "left")
    return out.drop(*[f"__rk{i}" for i in range(len(on))])


@dataclass(frozen=True)
class DimSpec:
    """One dimension of a star join: ``fact[fact_key] = dim[dim_key]``."""

    dim: DataFrame
    fact_key: str
    dim_key: str
    columns: Sequence[str]


def star_join(
    fact: DataFrame,
    dims: Sequence[DimSpec],
    how: str = "inner",
    max_rows: int = DEFAULT_MAX_ROWS,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Join a fact to each dimension on a single-column equi key.

    Only ``columns`` of each dimension are carried; dimension keys are dropped
    (the fact's key column stays).  Inner by default: unmatched facts drop.
    Before facts are shuffled to a filtered dimension that is too large to
    broadcast, Spark drops most of those without a match by a Bloom filter of
    the dimension's keys (``session.RUNTIME_CONF``; a few MB at most).
    """
    out = fact
    for i, d in enumerate(dims):
        k = f"__dk{i}"
        side = d.dim.select(F.col(d.dim_key).alias(k), *[F.col(c) for c in d.columns])
        side = bounded_broadcast(side, max_rows, max_bytes)
        out = out.join(side, out[d.fact_key] == side[k], how).drop(k)
    return out


def orphan_rows(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows without a matching dimension key (NULL keys included).

    Written as ``left_anti``; Catalyst does not turn left-join + IS NULL into
    an anti join, and the anti join never multiplies rows.
    """
    keys = bounded_broadcast(dim.select(F.col(dim_key).alias("__ok")))
    return fact.join(keys, fact[fact_key] == keys["__ok"], "left_anti")


def orphan_rows_by_keys(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
    max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """C3/C4 against a dimension that is too large to broadcast.

    The facts themselves are not shuffled to it: their distinct keys are (they
    combine map-side, so a hot key is one row an input partition), and the keys
    that the dimension lacks are written.  These are few as a rule; a probe
    proves it before they are broadcast to the facts, and beyond the bound Spark
    shuffles both sides.  Same rows as ``orphan_rows``: a NULL fact key is an
    orphan, repeated facts stay, repeated dimension keys don't multiply them.
    """
    own = fact.select(F.col(fact_key).alias("__fk")).distinct()
    keys = dim.select(F.col(dim_key).alias("__ok"))
    lost = materialize(own.join(keys, own["__fk"] == keys["__ok"], "left_anti"))
    lost = bounded_broadcast(lost, max_rows, max_bytes)
    return fact.join(lost, fact[fact_key].eqNullSafe(lost["__fk"]), "left_semi")


def orphan_rows_left_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """C3/C4 in the reference's literal form: left join, keep rows whose
    dimension side is NULL.  Same rows as ``orphan_rows``; kept to compare the
    two shapes (Catalyst does not rewrite this one into an anti join)."""
    keys = bounded_broadcast(dim.select(F.col(dim_key).alias("__ok")))
    joined = fact.join(keys, fact[fact_key] == keys["__ok"], "left")
    return joined.where(F.col("__ok").isNull()).drop("__ok")


def key_presence(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, flag: str,
    max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """Adds boolean ``flag``: does ``fact[fact_key]`` exist in ``dim[dim_key]``.

    A left join to the distinct dimension keys: a fact row is never multiplied,
    a NULL key gives FALSE, and unlike an existence join Spark can split a hot
    key's facts when the dimension is too large to broadcast.
    """
    k = f"__pk_{flag}"
    # Distinct by (hash, key): the join then shuffles the keys itself, and only
    # joins right above their shuffles are split by Spark.
    keys = dim.select(F.xxhash64(dim_key).alias("__h"), F.col(dim_key).alias(k))
    keys = keys.where(F.col(k).isNotNull()).distinct().select(k)
    keys = bounded_broadcast(keys, max_rows, max_bytes)
    return fact.join(keys, fact[fact_key] == keys[k], "left").withColumn(flag, F.col(k).isNotNull()).drop(k)
