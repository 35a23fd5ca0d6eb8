"""A1/A2: delimited landing files with a header line, empty field = NULL and a
fixed schema (no inference, no quoting).

The reference's landing tables are tab-delimited text without quote or escape
clauses, with ``skip.header.line.count=1`` and ``serialization.null.format=''``.
The options below reproduce that with Spark's CSV source.  A value that does
not parse (for instance a bad decimal) becomes NULL, as in the text SerDe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cargomart.operators.gates import GateError
from cargomart.operators.sinks import append_rows, ensure_table, sql_text
from cargomart.operators.versions import location as table_location

# Quote disabled: a field starting with '"' is data, not the start of a quoted
# field that would swallow the next separator.
READ_OPTIONS = {
    "quote": "",
    "nullValue": "",
    "emptyValue": "",
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "enforceSchema": "true",
    # Only a newline ends a line: a carriage return is data.
    "lineSep": "\n",
}

WRITE_OPTIONS = {
    "quote": "",
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


def _plain_cells(df: DataFrame, sep: str, partition_by: Sequence[str]) -> DataFrame:
    """The format has no quotes: a text that holds the separator, a newline or a
    carriage return (Spark's writer would quote it) fails the write instead of shifting columns."""

    def cell(name: str) -> Column:
        c = F.col(f"`{name}`")
        breaks = F.contains(c, F.lit(sep)) | F.contains(c, F.lit("\n")) | F.contains(c, F.lit("\r"))
        return F.when(breaks, F.raise_error(F.lit(f"{name}: a cell holds the separator or a line end"))).otherwise(c).alias(name)

    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)} - set(partition_by)
    return df.select(*[cell(c) if c in text else F.col(f"`{c}`") for c in df.columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    header: bool = True,
    sep: str = "\t",
) -> DataFrame:
    """Scan delimited text with ``schema``.  For a partitioned directory
    (``.../trans_dt=2026-05-14/``) list the partition column last in
    ``schema`` so it stays a STRING."""
    reader = spark.read.schema(schema).options(**READ_OPTIONS).option("sep", sep)
    reader = reader.option("header", "true" if header else "false")
    return reader.csv(path if isinstance(path, str) else list(path))


#: Why a line is set aside.
FIELDS, VALUE = "FIELD_COUNT", "UNPARSABLE_VALUE"
_LINE = "__line"
REJECTS = StructType().add("source", "string").add("file", "string").add("reason", "string").add("line", "string").add("load_timestamp", "string")


def read_checked(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, header: bool = True, sep: str = "\t"
) -> tuple[DataFrame, DataFrame]:
    """A1/A2 with nothing lost: the rows of lines that parse, and the other lines
    (file, reason, line): a field too few or too many, or a value that isn't of
    its column's type.  Every line is in exactly one of them, however few columns
    a query takes; blank lines are in none, and neither are lines that repeat the
    column names where files have a header."""
    names, options = schema.names, READ_OPTIONS | {"sep": sep, "columnNameOfCorruptRecord": _LINE}
    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, StructField(_LINE, StringType())])
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    lines = text.where(F.trim("value") != "").withColumn("__file", F.input_file_name())
    if header:
        lines = lines.where(F.col("value") != sep.join(names))
    # With options given the parser looks at every field, whatever is selected.
    parsed = lines.select("value", "__file", F.from_csv("value", full, options).alias("p"))
    fields = F.length("value") - F.length(F.replace(F.col("value"), F.lit(sep), F.lit(""))) + 1
    reason = F.when(fields != len(names), F.lit(FIELDS)).otherwise(F.lit(VALUE))
    rejected = F.col(f"p.{_LINE}").isNotNull()
    good = parsed.where(~rejected).select(*[F.col(f"p.`{n}`").alias(n) for n in names])
    bad = parsed.where(rejected).select(F.col("__file").alias("file"), reason.alias("reason"), F.col("value").alias("line"))
    return good, bad


def keep_rejects(bad: DataFrame, table: str, source: str, stamp: str) -> str:
    """Appends rejected lines to a quarantine table, made if it is missing."""
    spark = bad.sparkSession
    ensure_table(spark, table, REJECTS)
    append_rows(bad.withColumn("source", F.lit(source)).withColumn("load_timestamp", F.lit(stamp)), table)
    return table


def reject_gate(good: DataFrame, bad: DataFrame, threshold_pct: int, label: str = "") -> dict[str, int]:
    """K1/K3 on a landing file: raises when more than ``threshold_pct`` percent of
    its lines were set aside, or none is left; returns both counts, by reason."""
    counts = {"good": good.count()} | {r["reason"]: r["count"] for r in bad.groupBy("reason").count().collect()}
    rejected = sum(n for k, n in counts.items() if k != "good")
    if counts["good"] == 0:
        raise GateError(f"{label}: no rows")
    if 100 * rejected > threshold_pct * (rejected + counts["good"]):
        raise GateError(f"{label}: {rejected} of {rejected + counts['good']} lines rejected, more than {threshold_pct}%")
    return counts


def write_delimited(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = "\t",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    compression: str | None = None,
) -> None:
    """Write ``df`` in the landing format (header line, empty = NULL), as plain
    text, or by a codec that readers know by the files' names (``gzip``)."""
    w = _plain_cells(df, sep, partition_by).write.mode(mode).options(**WRITE_OPTIONS).option("sep", sep)
    w = w.option("header", "true" if header else "false")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def _check_landing_table(spark: SparkSession, name: str, schema: StructType, location: str, partition_by: Sequence[str]) -> None:
    """A5: a table of that name must be this landing table."""
    have = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if have != [(f.name, f.dataType) for f in schema.fields] or by != list(partition_by):
        raise ValueError(f"{name} exists with other columns or partitions: {have}, {by}")
    there, plain = table_location(spark, name), lambda p: p.split(":", 1)[-1].rstrip("/").lstrip("/")
    if plain(there) != plain(location):
        raise ValueError(f"{name} exists over another folder: {there}")


def ensure_landing_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str,
    partition_by: Sequence[str] = (),
    sep: str = "\t",
    header: bool = True,
) -> None:
    """A1/A2 + A5: declare an external landing table over delimited files in
    ``location`` (created if missing, never dropped), read with the same
    options as ``read_delimited``.  New day folders written by the upstream
    system become visible after ``sources.catalog.refresh_partitions``.
    """
    if spark.catalog.tableExists(name):
        _check_landing_table(spark, name, schema, location, partition_by)
        return
    names = [f.name for f in schema.fields]
    if list(partition_by) != names[len(names) - len(partition_by):]:
        raise ValueError("partition columns must be the last columns of the schema")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    opts = dict(READ_OPTIONS, sep=sep, header="true" if header else "false")
    options = ", ".join(f"'{k}' {sql_text(v)}" for k, v in opts.items())
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING csv OPTIONS ({options})"
    if partition_by:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    ddl += f" LOCATION {sql_text(location)}"
    spark.sql(ddl)
