"""Data gates and audit (K1-K8).

Gates decide whether data may proceed.  Instead of mail and exit codes they
raise ``GateError`` (fatal) or return a ``GateResult`` (warnings).  Each gate
brings back at most a handful of aggregate values or sample keys to the
driver, never data.
"""

from __future__ import annotations

import traceback
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargomart.functions.measures import truncate_text
from cargomart.functions.predicates import all_of, is_present
from cargomart.operators.aggregates import duplicate_keys
from cargomart.operators.sinks import TRAILER_PREFIX, append_rows, part_files
from cargomart.schemas import EXPORT_LOG
from cargomart.sources.catalog import rows_to_df


class GateError(RuntimeError):
    """A fatal gate: the run must stop before (further) targets change."""


@dataclass(frozen=True)
class GateResult:
    name: str
    ok: bool
    value: int | None = None
    message: str = ""
    details: dict = field(default_factory=dict)


def require_rows(df: DataFrame, label: str) -> int:
    """K1: at least one row; returns the count."""
    n = df.count()
    if n == 0:
        raise GateError(f"{label}: no rows")
    return n


def require_unique(
    df: DataFrame, keys: Sequence[str], present: Sequence[str] = (), label: str = "", sample: int = 5
) -> int:
    """K2: no duplicated key; the error names up to ``sample`` offending keys.

    A clean input costs one grouping of the rows by key; only a failure groups
    them again, to count the duplicated keys.
    """
    dups = duplicate_keys(df, keys, present)
    found = dups.limit(sample).collect()
    if not found:
        return 0
    n = dups.count()
    shown = ", ".join(str(tuple(r[k] for k in keys)) for r in found)
    raise GateError(f"{label or 'duplicate keys'}: {n} duplicated key(s) on {list(keys)}, e.g. {shown}")


def require_rows_unique(
    df: DataFrame, keys: Sequence[str], present: Sequence[str] = (), label: str = "", sample: int = 5
) -> int:
    """K1 + K2 in one pass: the rows are grouped by ``keys`` once (combined
    map-side) and one aggregate yields both the row count and the number of
    duplicated keys (keys with a blank ``present`` column are ignored, Q19).
    Sample keys are fetched only when the gate fails.  Returns the row count.
    """
    ok_key = all_of(is_present(c) for c in present)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    r = per_key.agg(
        F.sum("cnt").alias("rows"),
        F.count(F.when((F.col("cnt") > 1) & ok_key, F.lit(1))).alias("dups"),
    ).first()
    rows, dups = int(r["rows"] or 0), int(r["dups"])
    if rows == 0:
        raise GateError(f"{label}: no rows")
    if dups:
        require_unique(df, keys, present, label, sample)
    return rows


def error_rate(err_cnt: int, base_cnt: int) -> int:
    """H7: truncating integer percent; 0 when there is no base row."""
    return 0 if base_cnt == 0 else (err_cnt * 100) // base_cnt


def rate_gate(err_cnt: int, base_cnt: int, threshold_pct: int) -> GateResult:
    """K3: warn (non-fatal) when the integer error rate is strictly above the threshold."""
    rate = error_rate(err_cnt, base_cnt)
    warn = rate > threshold_pct
    msg = f"error rate {rate}% ({err_cnt}/{base_cnt}) {'exceeds' if warn else 'within'} {threshold_pct}%"
    return GateResult("error_rate", not warn, rate, msg, {"err_cnt": err_cnt, "base_cnt": base_cnt})


def counts(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several DataFrames in one job (single-row aggregates,
    unioned): used by K3, K4 and K8."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit(k).alias("k"), "n") for k, df in frames.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return {r["k"]: int(r["n"]) for r in u.collect()}


def content(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """K4, K8: one row with the number of rows and a checksum of their content
    that doesn't depend on their order: the sum of the rows' 64-bit hashes, as a
    decimal so that it can't overflow, over ``columns`` (all, in order of name).
    Combined map-side: one row a partition is shuffled."""
    names = sorted(df.columns if columns is None else columns)
    # A null hashes as its seed does, so each value comes with whether it is null.
    parts = [x for c in names for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    one, two = (F.xxhash64(F.lit(salt), *parts).cast("decimal(38,0)") for salt in (1, 2))
    return df.agg(
        F.count(F.lit(1)).alias("row_cnt"), F.coalesce(F.sum(one), F.lit(0).cast("decimal(38,0)")).alias("sum1"),
        F.coalesce(F.sum(two), F.lit(0).cast("decimal(38,0)")).alias("sum2"),
    )


def compare_content(left: DataFrame, right: DataFrame) -> DataFrame:
    """K4, K8: left_cnt, right_cnt, same_cnt and same_content of two DataFrames
    with the same column names, in one row."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    a, b = content(left).withColumn("side", F.lit("l")), content(right).withColumn("side", F.lit("r"))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    same = lambda c: of("l", c) == of("r", c)
    return a.unionByName(b).agg(
        of("l", "row_cnt").alias("left_cnt"), of("r", "row_cnt").alias("right_cnt"), same("row_cnt").alias("same_cnt"),
        (same("row_cnt") & same("sum1") & same("sum2")).alias("same_content"),
    )


def snapshot_report(spark: SparkSession, src: str, dst: str) -> GateResult:
    """K4: both counts exist (zero allowed); ours also requires equal content."""
    r = compare_content(spark.table(src), spark.table(dst)).first()
    c = {"src": r["left_cnt"], "dst": r["right_cnt"]}
    msg = f"snapshot {dst}: {c['dst']} rows, source {src}: {c['src']} rows"
    ok = r["same_content"]
    if not ok:
        raise GateError(msg if not r["same_cnt"] else f"{msg}, of other content")
    return GateResult("snapshot", ok, c["dst"], msg, c)


def validate_framed_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> GateResult:
    """K5: the written export is well framed.

    One aggregate per part file (line count, header and trailer counts, the
    trailer's number, and the file's first and last line by split offset and
    row position) brings one small row per file to the driver.  Checks: more
    than two lines, exactly one header equal to the column list and it is the
    first line of the first part, exactly one ``TRAILER,<n>`` line and it is
    the last line of the last part, and ``n`` = lines - 2 (Q6).
    """
    header = ",".join(columns)
    files = part_files(spark, path)
    if not files:
        raise GateError(f"{path}: no file written")
    lines = spark.read.text(files).select(
        "value",
        F.input_file_name().alias("f"),
        F.struct(F.input_file_block_start(), F.monotonically_increasing_id()).alias("pos"),
    )
    is_trailer = F.col("value").startswith(TRAILER_PREFIX)
    per_file = lines.groupBy("f").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.when(F.col("value") == header, 1).otherwise(0)).alias("headers"),
        F.sum(F.when(is_trailer, 1).otherwise(0)).alias("trailers"),
        F.max(F.when(is_trailer, F.substr(F.col("value"), F.lit(len(TRAILER_PREFIX) + 1)))).alias("n"),
        F.min_by("value", "pos").alias("first_line"),
        F.max_by("value", "pos").alias("last_line"),
    ).collect()
    by_name = {_path_key(r["f"]): r for r in per_file}
    ordered = [by_name[_path_key(f)] for f in files if _path_key(f) in by_name]
    total = sum(r["lines"] for r in ordered)
    headers = sum(r["headers"] for r in ordered)
    trailers = [r["n"] for r in ordered if r["trailers"]]
    problems = []
    if total <= 2:
        problems.append(f"only {total} line(s)")
    if headers != 1:
        problems.append(f"{headers} header line(s)")
    elif not ordered or ordered[0]["first_line"] != header:
        problems.append("header is not the first line of the first part")
    n_trailers = sum(r["trailers"] for r in ordered)
    if n_trailers != 1:
        problems.append(f"{n_trailers} trailer line(s)")
    else:
        if not ordered[-1]["last_line"].startswith(TRAILER_PREFIX):
            problems.append("trailer is not the last line of the last part")
        if trailers[0] != str(total - 2):
            problems.append(f"trailer says {trailers[0][:60]!r} but file has {total - 2} data line(s)")
    if problems:
        raise GateError(f"{path}: " + "; ".join(problems))
    return GateResult("framed_csv", True, total - 2, f"{path}: {total - 2} rows", {"files": len(files)})


def _path_key(p: str) -> str:
    """Scheme- and slash-insensitive file key (``file:/x`` == ``file:///x``)."""
    return p.split(":", 1)[-1].lstrip("/") if ":" in p else p.lstrip("/")


def run_report(entries: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """K8: a small DataFrame of (step, label, row_cnt), one row per entry."""
    out = None
    for step, label, df in entries:
        r = df.agg(F.count(F.lit(1)).cast("bigint").alias("row_cnt")).select(
            F.lit(step).alias("step"), F.lit(label).alias("label"), "row_cnt"
        )
        out = r if out is None else out.unionByName(r)
    return out


@dataclass
class AuditHandle:
    record_cnt: int = 0


@contextmanager
def audited(
    spark: SparkSession,
    log_table: str,
    job_name: str,
    run_dt: str,
    export_month: str,
    export_file: str,
) -> Iterator[AuditHandle]:
    """K6: append one audit row per attempt.

    SUCCESS with the handle's ``record_cnt`` when the block completes; FAILED
    with 0 and the error text (truncated to 4000 characters, H12) when it
    raises — the exception is then re-raised.  ``load_timestamp`` is the time
    the row is written.
    """
    handle = AuditHandle()

    def write(status: str, cnt: int, message: str) -> None:
        row = [(job_name, run_dt, export_month, export_file, int(cnt), status, message, datetime.now())]
        df = rows_to_df(spark, row, EXPORT_LOG)
        append_rows(df.withColumn("error_message", truncate_text("error_message")), log_table)

    try:
        yield handle
    except BaseException as exc:
        text = f"{type(exc).__name__}: {exc}\n{traceback.format_exc()}"
        try:
            write("FAILED", 0, text)
        except Exception as audit_exc:  # keep the job's own error as the one raised
            exc.add_note(f"audit row could not be written: {audit_exc!r}")
        raise
    write("SUCCESS", handle.record_cnt, "")
