"""Co-located joins (C1, C2): tables bucketed and sorted by their join key.

Two tables with as many buckets of the same key are joined, and grouped by it,
without a shuffle: it is paid once, when a table is written.  That suits a fact
table that many jobs join on one key.  A bucket is read by one task and can't be
split, so a key that holds a large share of the rows belongs in the shuffle
forms of ``operators.joins`` instead, where Spark splits it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cargomart.operators.joins import probe_size

BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(*sides: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are joined with each other: a power of two that
    gives the largest one buckets of about ``bucket_bytes`` (one probe a side)."""
    most = max((probe_size(s).bytes for s in sides), default=0)
    return 1 << max(0, -(-most // bucket_bytes) - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Writes ``df`` as a Parquet table with ``buckets`` buckets of ``keys``,
    each sorted by them, and returns the table.  The rows of a bucket meet
    before they are written, so that it is one file.  Null keys share a bucket;
    repeated rows stay; an empty ``df`` makes an empty table."""
    df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)
