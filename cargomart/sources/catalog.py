"""Catalog-table reads (A3, A4, A6) and in-memory row sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cargomart.functions.predicates import month_slice
from cargomart.operators.files import list_folders
from cargomart.operators.sinks import folder_exists, sql_text
from cargomart.operators.versions import BATCH, location
from cargomart.schemas import EXPORT_COLUMNS


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A3: warehouse table scan (Parquet), partitioned or not."""
    return spark.table(name)


def _arrived(spark: SparkSession, folder: str, names: Sequence[str]) -> list[list[tuple[str, str]]]:
    """Partitions that have a folder ``k=v[/l=w...]`` below ``folder``."""
    if not names:
        return [[]]
    out = []
    for path in list_folders(spark, folder):
        key, _, value = path.rsplit("/", 1)[-1].partition("=")
        if key == names[0] and value:
            out += [[(key, unquote(value)), *rest] for rest in _arrived(spark, path, names[1:])]
    return out


def discover_partitions(spark: SparkSession, name: str) -> list[str]:
    """A4: registers the partition folders that arrived since the last time and
    returns them (``k=v/l=w``).  The listing is compared with the catalog and
    only what is new is added, BATCH partitions at a time; partitions that the
    catalog has on folders of their own stay where they are."""
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?", name):
        raise ValueError(f"not a plain table identifier: {name!r}")
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    known = {tuple(unquote(x) for x in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = [s for s in _arrived(spark, location(spark, name), by) if tuple(f"{k}={v}" for k, v in s) not in known]
    spec = lambda s: "PARTITION (" + ", ".join(f"`{k}` = {sql_text(v)}" for k, v in s) + ")"
    for at in range(0, len(new), BATCH):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(spec(s) for s in new[at : at + BATCH]))
    spark.catalog.refreshTable(name)
    return ["/".join(f"{k}={v}" for k, v in s) for s in new]


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """A4: register partition folders written outside Spark, without repairing
    the whole table; catalogs that list partitions from the file system only
    need their file index refreshed.
    """
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?", name):
        raise ValueError(f"not a plain table identifier: {name!r}")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "Partition Provider" in about and folder_exists(spark, about["Location"]):
        discover_partitions(spark, name)
    else:  # not partitioned, listed from its folders, or no folder has arrived yet
        spark.catalog.refreshTable(name)


def fetch_summary(spark: SparkSession, table: str, month: str, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """One month of the summary table as a lazy DataFrame (nothing is
    collected); the month predicate prunes partitions (B9, Q3)."""
    rows = spark.table(table).where(month_slice("report_date", month, partition_col="report_month"))
    return rows.select(*columns)


def rows_to_df(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Rows built in driver memory, always with an explicit schema (Q15).

    Only for small, bounded inputs such as fixtures and audit rows.
    """
    return spark.createDataFrame(list(rows), schema)
