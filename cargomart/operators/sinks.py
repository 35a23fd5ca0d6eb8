"""Sinks (A5, A7-A15): catalog DDL, partition and table overwrites, snapshots,
appends, the framed CSV export and its publication.

Partition overwrites replace exactly the named partition, also when the new
data is empty (Q2), and leave every other partition untouched (Q1), whatever
the session's ``spark.sql.sources.partitionOverwriteMode``.  Identifiers and
partition values are validated before they are placed in SQL text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cargomart.functions.measures import render_cell
from cargomart.operators import versions
from cargomart.operators.files import make_folder

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")
_VALUE = re.compile(r"^[A-Za-z0-9_\-:. ]*$")

HEADER_TAG, ROW_TAG, TRAILER_TAG = 0, 1, 2
# Fixed value: the export's trailer line is this prefix followed by the row count.
TRAILER_PREFIX = "TRAILER,"


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table identifier: {name!r}")
    return name


def _value(v: str) -> str:
    if not isinstance(v, str) or not _VALUE.match(v):
        raise ValueError(f"unsafe partition value: {v!r}")
    return v


def sql_text(v: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_ident(name))


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    comment: str | None = None,
) -> None:
    """A5: create the table if it does not exist (never drop: Q13).

    Partition columns are listed last in ``schema``, as Spark requires.
    """
    _ident(name)
    if table_exists(spark, name):
        check_table(spark, name, schema, partition_by)
        return
    names = [f.name for f in schema.fields]
    if list(partition_by) != names[len(names) - len(partition_by):]:
        raise ValueError("partition columns must be the last columns of the schema")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet"
    if partition_by:
        # Any INSERT OVERWRITE into this table replaces only the partitions it
        # writes, whatever the writer's session setting.
        ddl += " OPTIONS ('partitionOverwriteMode' 'dynamic')"
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if location:
        make_folder(spark, location)  # versions of the table will lie beside it
        ddl += f" LOCATION {sql_text(location)}"
    if comment:
        ddl += f" COMMENT {sql_text(comment)}"
    spark.sql(ddl)


def check_table(spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
    """A5: an existing table must have these columns and partitions, and its
    overwrites must be limited to the partitions they write."""
    have = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    if have != [(f.name, f.dataType) for f in schema.fields]:
        raise ValueError(f"{name} exists with other columns: {have}")
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if by != list(partition_by):
        raise ValueError(f"{name} exists with partitions {by}, not {list(partition_by)}")
    if by:
        _require_dynamic(spark, name)


def _temp_view(df: DataFrame) -> str:
    name = f"__cargomart_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def _require_dynamic(spark: SparkSession, table: str) -> None:
    """The table's own option, not the session, must limit an overwrite to the
    partitions that are written."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Storage Properties").collect()
    if not any("partitionoverwritemode=dynamic" in r["data_type"].lower().replace(" ", "") for r in rows):
        raise ValueError(f"{table} lacks the option 'partitionOverwriteMode' 'dynamic'; create it with ensure_table")


def _static_overwrite(df: DataFrame, table: str, spec: Mapping[str, str], data_cols: Sequence[str]) -> None:
    spark = df.sparkSession
    view = _temp_view(df.select(*data_cols))
    try:
        part = ", ".join(f"`{k}` = '{_value(v)}'" for k, v in spec.items())
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({part}) "
            f"SELECT {', '.join(f'`{c}`' for c in data_cols)} FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def overwrite_partition(df: DataFrame, table: str, spec: Mapping[str, str]) -> int:
    """Replace one (possibly multi-level) partition with ``df``'s rows;
    returns the number of rows written.

    ``df`` may or may not carry the partition columns; the table's other
    columns are selected by name, in table order, and the partition columns
    are set to ``spec``.  The rows are written with dynamic partition
    overwrite: files are staged and the named partition is swapped at job
    commit, so a failed job leaves the previous day intact.  The rows are
    counted in the same pass (``Observation``); when there are none, the
    partition is cleared with a static overwrite (Q2).  The table must carry
    the dynamic mode as an option, as those made by ``ensure_table`` do; no
    session setting is touched, so jobs in other threads aren't either.
    """
    spark = df.sparkSession
    cols = spark.table(_ident(table)).columns
    for k, v in spec.items():
        if k not in cols:
            raise ValueError(f"{k!r} is not a column of {table}")
        _value(v)
    data_cols = [c for c in cols if c not in spec]
    rows = df.select(*[F.lit(spec[c]).alias(c) if c in spec else F.col(c) for c in cols])
    obs = Observation("rows_written")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("n"))
    _require_dynamic(spark, table)
    rows.write.insertInto(table, overwrite=True)
    written = int(obs.get["n"])
    if written == 0:
        _static_overwrite(df.limit(0), table, spec, data_cols)
    spark.catalog.refreshTable(table)
    return written


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the whole (unpartitioned) table.  The new rows get a folder of
    their own and the table's location is switched to it last, so a write that
    fails or is killed leaves the table as it was."""
    versions.replace_table(df, _ident(table))


def snapshot_table(spark: SparkSession, src: str, dst: str) -> None:
    """A10: keep ``src`` as it is now under the name ``dst``; no row is copied,
    and the snapshot before it stays until the new one has its name."""
    versions.snapshot(spark, _ident(src), _ident(dst))


def restore_table(spark: SparkSession, snapshot: str, dst: str) -> None:
    """Roll ``dst`` back to ``snapshot`` by switching its location."""
    versions.restore(spark, _ident(snapshot), _ident(dst))


def append_rows(df: DataFrame, table: str) -> None:
    """Append, columns put in the table's order by name first.  A table
    that has versions gets a new one: the folder it is on may be a snapshot's."""
    spark = df.sparkSession
    cols = spark.table(_ident(table)).columns
    if versions.is_versioned(spark, table):
        versions.replace_table(spark.table(table).unionByName(df.select(*cols)), table)
    else:
        df.select(*cols).write.insertInto(table, overwrite=False)


# --------------------------------------------------------------------------- A13/A14


def _csv_cell(c: Column, quote: str) -> Column:
    text = render_cell(c)
    special = text.contains(",") | text.contains('"') | text.contains("\n") | text.contains("\r")
    if quote == "minimal":
        quoted = F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))
        return F.when(special, quoted).otherwise(text)
    # quote == "none": the reference format has no quoting (Q5); a cell that
    # would break the framing fails the job instead of shifting columns.
    return F.when(special, F.raise_error(F.lit("framed CSV cell holds a comma, quote or newline"))).otherwise(text)


def frame_lines(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str] = (),
    group_by: Sequence[str] = (),
    quote: str = "none",
) -> DataFrame:
    """Lines of a framed CSV: header, one line per row, ``TRAILER,<n>``.

    Returns ``group_by`` + ``line_tag`` (0 header, 1 row, 2 trailer) +
    ``order_by`` keys + ``line``.  With ``group_by`` one frame per group is
    produced (e.g. one file per month).  Nothing is collected: the trailer
    count is an aggregate and the header is derived from it, so an empty
    input still yields ``header`` + ``TRAILER,0``.
    """
    if quote not in ("none", "minimal"):
        raise ValueError("quote must be 'none' or 'minimal'")
    group_by, order_by = list(group_by), list(order_by)
    header = ",".join(columns)
    keys = [F.col(c) for c in order_by]
    rows = df.select(
        *group_by,
        F.lit(ROW_TAG).alias("line_tag"),
        *[k.alias(f"__o{i}") for i, k in enumerate(keys)],
        F.concat_ws(",", *[_csv_cell(F.col(c), quote) for c in columns]).alias("line"),
    )
    # Header and trailer of a group come from one count of its rows.
    counts = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias("__n"))
    nulls = [F.lit(None).cast(df.schema[c].dataType).alias(f"__o{i}") for i, c in enumerate(order_by)]
    trailer = F.concat(F.lit(TRAILER_PREFIX), F.col("__n").cast("string"))
    frame = F.array(
        F.struct(F.lit(HEADER_TAG).alias("line_tag"), F.lit(header).alias("line")),
        F.struct(F.lit(TRAILER_TAG).alias("line_tag"), trailer.alias("line")),
    )
    ends = counts.select(*group_by, F.inline(frame)).select(*group_by, "line_tag", *nulls, "line")
    out = rows.unionByName(ends)
    return out.select(*group_by, "line_tag", *[F.col(f"__o{i}").alias(c) for i, c in enumerate(order_by)], "line")


def write_framed_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    order_by: Sequence[str] = (),
    single_file: bool = False,
    quote: str = "none",
) -> str:
    """Write the framed CSV to directory ``path``; returns ``path``.

    Rows are ordered ascending with NULLs first (F1).  By default the sort is
    a distributed range sort and the lines land in ordered part files (their
    name order is the line order; header in the first, trailer in the last).
    ``single_file=True`` writes exactly one part file through one task, for
    partners that require a single file; use it only for aggregated outputs
    such as a month of the summary.
    """
    lines = frame_lines(df, columns, order_by, quote=quote)
    sort_cols = [F.col("line_tag").asc()] + [F.col(c).asc_nulls_first() for c in order_by]
    if single_file:
        ordered = lines.repartition(1).sortWithinPartitions(*sort_cols)
    else:
        ordered = lines.orderBy(*sort_cols)
    ordered.select("line").write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.exists(p)


def part_files(spark: SparkSession, directory: str) -> list[str]:
    fs, p, _ = _hadoop_fs(spark, directory)
    names = [s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    return sorted(names)


def publish(spark: SparkSession, src_dir: str, dest: str, single_file: bool) -> str:
    """Move a written export to its outbound name, replacing a stale one.

    ``single_file`` says what ``dest`` becomes, whatever the number of rows: the
    one part file of ``src_dir``, or the folder of ordered parts itself (their
    name order is the line order).  The new data is moved next to ``dest``
    first, then the old export is set aside, then the new one takes its name;
    the old one goes last.  If any rename fails, the export that was published
    is put back and the staging folder stays.  Renames are metadata operations
    on the target file system: no data passes through the driver.
    """
    fs, _, jvm = _hadoop_fs(spark, dest)
    path = jvm.org.apache.hadoop.fs.Path
    target, stage = path(dest), path(src_dir)
    new = stage
    if single_file:
        parts = part_files(spark, src_dir)
        if len(parts) != 1:
            raise ValueError(f"{src_dir} holds {len(parts)} part files, not one")
        new = path(parts[0])
    parent = target.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    token = uuid.uuid4().hex
    ready, aside = path(f"{dest}.new-{token}"), path(f"{dest}.old-{token}")

    def move(a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"publish failed: {a} -> {b}")

    move(new, ready)
    stale = fs.exists(target)
    try:
        if stale:
            move(target, aside)
        move(ready, target)
    except Exception:
        if stale and not fs.exists(target) and fs.exists(aside):
            fs.rename(aside, target)
        fs.rename(ready, new)
        raise
    if stale:
        fs.delete(aside, True)
    if single_file:
        fs.delete(stage, True)
    return dest
