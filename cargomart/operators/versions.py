"""Versions of tables and partitions (A7-A11): data is written to a folder of
its own, and a location in the catalog is switched to it.

A write that is killed leaves the old folder in place and in use.  A snapshot
is a second table on the same folder, so neither taking one nor going back to
it copies a row.  Several partitions are replaced by one staged write and one
commit file: before the file exists nothing has changed, and once it does
``recover`` finishes what a killed commit began.

Folders live beside the table's own, in ``<location>__versions``; ``vacuum``
removes those that no location names any more.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cargomart.operators.files import delete, exists, list_folders, make_folder, read_text, write_text
from cargomart.schemas import conform

_SUFFIX = "__versions"
_NAME = re.compile(r"^[A-Za-z_]\w*(\.[A-Za-z_]\w*)?$")
_VALUE = re.compile(r"^[A-Za-z0-9_.\- ]+$")
#: Partitions named by one ALTER TABLE.
BATCH = 100
#: Rows of one file, where the rows of a partition are known beforehand.
FILE_ROWS = 2_000_000
COMMIT, APPLIED = "_commit.json", "_applied"


def _checked(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a plain table identifier: {name!r}")
    return name


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _about(spark: SparkSession, table: str, spec: str = "") -> dict[str, str]:
    """What the catalog says of a table, or of one of its partitions."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_checked(table)}{spec}").collect()
    names = [r["col_name"] for r in rows]
    out: dict[str, str] = {}
    # A partition's own lines come before the table's; columns come before both.
    for r in rows[names.index(f"# Detailed {'Partition' if spec else 'Table'} Information") :]:
        out.setdefault(r["col_name"], r["data_type"])
    return out


def location(spark: SparkSession, table: str) -> str:
    """Where the table's current version lies."""
    return _about(spark, table)["Location"].rstrip("/")


def _versions(place: str) -> str:
    """The folder of a table's versions, from its location now."""
    return place.rsplit("/", 1)[0] if place.rsplit("/", 1)[0].endswith(_SUFFIX) else place + _SUFFIX


def is_versioned(spark: SparkSession, table: str) -> bool:
    return location(spark, table).rsplit("/", 1)[0].endswith(_SUFFIX)


def _switch(spark: SparkSession, table: str, place: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(place)}")
    spark.catalog.refreshTable(table)


def replace_table(df: DataFrame, table: str) -> str:
    """The whole (unpartitioned) table becomes ``df``; returns the new folder.

    Rows are written first and the location is switched last, so a failed write
    leaves the old version, and readers see the old rows or the new ones."""
    spark = df.sparkSession
    schema = spark.table(_checked(table)).schema
    place = f"{_versions(location(spark, table))}/v-{uuid.uuid4().hex}"
    conform(df, schema).write.mode("error").parquet(place)
    _switch(spark, table, place)
    return place


def _declare(spark: SparkSession, table: str, schema: StructType, place: str) -> None:
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION {_quoted(place)}")


def snapshot(spark: SparkSession, src: str, dst: str) -> None:
    """A10: ``dst`` names the folder that ``src`` is on now.

    The old snapshot stays until the new one is there: an external table of the
    same columns is switched, and any other table under that name is dropped
    only after its successor has been declared under a name of its own."""
    place, schema = location(spark, src), spark.table(_checked(src)).schema
    plain = lambda s: [(f.name, f.dataType) for f in s.fields]
    if not spark.catalog.tableExists(_checked(dst)):
        _declare(spark, dst, schema, place)
    elif _about(spark, dst).get("Type") == "EXTERNAL" and plain(spark.table(dst).schema) == plain(schema):
        _switch(spark, dst, place)
    else:
        ready = f"{dst}_{uuid.uuid4().hex[:12]}"
        _declare(spark, ready, schema, place)
        spark.sql(f"DROP TABLE {dst}")
        spark.sql(f"ALTER TABLE {ready} RENAME TO {dst}")


def restore(spark: SparkSession, kept: str, dst: str) -> None:
    """``dst`` goes back to the folder that the snapshot ``kept`` names."""
    _switch(spark, _checked(dst), location(spark, kept))


# ------------------------------------------------------------------ partitions


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(_checked(table)) if c.isPartition]


def _spec_sql(spec: Mapping[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"`{k}` = {_quoted(v)}" for k, v in spec.items()) + ")"


def _known(spark: SparkSession, table: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def folder_of(spec: Mapping[str, str]) -> str:
    return "/".join(f"{k}={v}" for k, v in spec.items())


@dataclass(frozen=True)
class Staged:
    """Partitions that are written but not yet the table's: rows by partition
    (``k=v`` or ``k=v/l=w``)."""

    spark: SparkSession
    table: str
    folder: str
    specs: tuple[dict[str, str], ...]
    counts: dict[str, int]

    def commit(self, specs: Sequence[Mapping[str, str]] | None = None) -> dict[str, int]:
        """Makes them (or only ``specs`` of them) the table's.  The commit is one
        rename, which happens or doesn't; the rest can be finished by ``recover``."""
        chosen = [dict(s) for s in (self.specs if specs is None else specs)]
        if chosen:
            write_text(self.spark, f"{self.folder}/{COMMIT}", json.dumps(chosen))
            apply_commit(self.spark, self.table, self.folder)
        return {folder_of(s): self.counts[folder_of(s)] for s in chosen}


def stage_partitions(
    df: DataFrame, table: str, specs: Sequence[Mapping[str, str]], at_most: Mapping[str, int] | None = None
) -> Staged:
    """Writes the rows of the named partitions, in one job, beside the table; a
    gate can look at their counts before anything of the table is replaced.

    ``at_most``: how many rows a partition may get (``k=v``), where that is known;
    it says into how many files each goes.  Otherwise Spark sizes the files."""
    spark = df.sparkSession
    by, schema = _partition_columns(spark, table), spark.table(table).schema
    for spec in specs:
        if list(spec) != by:
            raise ValueError(f"partitions of {table} are named by {by}, not {list(spec)}")
        if not all(isinstance(v, str) and _VALUE.match(v) for v in spec.values()):
            raise ValueError(f"unsafe partition value in {dict(spec)!r}")
    recover(spark, table)
    stage = f"{location(spark, table)}{_SUFFIX}/p-{uuid.uuid4().hex}"
    files = {folder_of(s): -(-(at_most or {}).get(folder_of(s), 1) // FILE_ROWS) or 1 for s in specs}
    named = spark.createDataFrame([(*(s[c] for c in by), files[folder_of(s)]) for s in specs], ", ".join(f"`{c}` string" for c in by) + ", `__files` long")
    # One row a partition that the caller names: as many as the catalog gets.
    rows = conform(df, schema).join(F.broadcast(named), by)
    # Files by partition; a partition far larger than the others is split.
    if at_most is None:
        rows = rows.hint("rebalance", *by)
    else:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(at_most.values()) // FILE_ROWS)
        # Rows are hashed whole only if a partition goes into several files.
        salt = [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]), F.col("__files"))] if max(files.values(), default=1) > 1 else []
        rows = rows.repartition(tasks, *by, *salt)
    rows.select(*schema.names).write.mode("error").partitionBy(*by).parquet(stage)
    types = StructType([f for f in schema.fields if f.name in by])
    counted = spark.read.schema(types).parquet(stage).groupBy(*by).count().collect() if list_folders(spark, stage) else []
    counts = {folder_of({c: r[c] for c in by}): r["count"] for r in counted}
    for spec in specs:
        if folder_of(spec) not in counts:
            make_folder(spark, f"{stage}/{folder_of(spec)}")
    return Staged(spark, table, stage, tuple(dict(s) for s in specs), {folder_of(s): counts.get(folder_of(s), 0) for s in specs})


def apply_commit(spark: SparkSession, table: str, stage: str) -> None:
    """Each committed partition's location becomes its staged folder.  Doing it
    again changes nothing."""
    specs = json.loads(read_text(spark, f"{stage}/{COMMIT}"))
    known = _known(spark, table)
    place = lambda s: f"{_spec_sql(s)} LOCATION {_quoted(f'{stage}/{folder_of(s)}')}"
    new = [s for s in specs if folder_of(s) not in known]
    for at in range(0, len(new), BATCH):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(place(s) for s in new[at : at + BATCH]))
    for spec in specs:
        if folder_of(spec) in known:
            spark.sql(f"ALTER TABLE {table} {_spec_sql(spec)} SET LOCATION {_quoted(f'{stage}/{folder_of(spec)}')}")
    spark.catalog.refreshTable(table)
    write_text(spark, f"{stage}/{APPLIED}", "")


def replace_partitions(df: DataFrame, table: str, specs: Sequence[Mapping[str, str]]) -> dict[str, int]:
    """A7/A8 for many partitions at once: each named partition becomes exactly
    ``df``'s rows of it (none: empty), the others stay; returns rows by partition.

    All rows are written in one job.  The commit is one file; a reader sees each
    partition as it was or as it will be, and ``recover`` finishes a commit that
    was killed.  The driver holds names of partitions only."""
    return stage_partitions(df, table, specs).commit() if specs else {}


def recover(spark: SparkSession, table: str) -> list[str]:
    """Applies commits that were written but not finished; returns their folders.
    A staged folder without a commit file changed nothing and is left to ``vacuum``."""
    done = []
    base = location(spark, table) + _SUFFIX
    for stage in list_folders(spark, base):
        if exists(spark, f"{stage}/{COMMIT}") and not exists(spark, f"{stage}/{APPLIED}"):
            apply_commit(spark, table, stage)
            done.append(stage)
    return done


def vacuum(spark: SparkSession, table: str, snapshots: Sequence[str] = ()) -> list[str]:
    """Removes the table's version folders that neither it, one of its
    partitions nor one of ``snapshots`` is on; returns them.  Not while a write
    to the table is under way."""
    by = _partition_columns(spark, table)
    place = location(spark, table)
    used = {place, *(location(spark, s) for s in snapshots)}
    if by:
        for name in _known(spark, table):
            spec = dict(x.split("=", 1) for x in name.split("/"))
            used.add(_about(spark, table, " " + _spec_sql(spec))["Location"].rstrip("/"))
    plain = lambda p: re.sub(r"^file:/+", "/", p)
    used = {plain(p) for p in used}
    gone = []
    for folder in list_folders(spark, place + _SUFFIX if by else _versions(place)):
        if not any(p == plain(folder) or p.startswith(plain(folder) + "/") for p in used):
            delete(spark, folder)
            gone.append(folder)
    return gone
