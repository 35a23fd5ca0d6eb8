"""Versioned tables and partitions: kills between the steps, shared folders, recovery."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cargomart.operators import sinks, versions

SCHEMA = StructType().add("id", "long").add("name", "string")
DAYS = StructType().add("id", "long").add("month", "string").add("day", "string")


class Killed(BaseException):
    """What a lost driver looks like to the code: nothing catches it."""


@pytest.fixture
def db(spark):
    name = f"v_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def some(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], SCHEMA)


def days(spark, *rows_):
    return spark.createDataFrame(list(rows_), "id long, month string, day string")


def spec(month, day):
    return {"month": month, "day": day}


def data_files(place):
    place = place.removeprefix("file:")
    return sorted(os.path.join(r, f) for r, _, fs in os.walk(place) for f in fs if f.endswith(".parquet"))


def test_a_killed_replacement_leaves_the_old_version(spark, db, monkeypatch):
    t = f"{db}.dim"
    sinks.ensure_table(spark, t, SCHEMA)
    sinks.overwrite_table(some(spark, 1, 2), t)
    broken = some(spark, 3).withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_table(broken, t)
    assert rows(spark, t) == [(1, "n1"), (2, "n2")]

    def die(*a):
        raise Killed

    monkeypatch.setattr(versions, "_switch", die)
    with pytest.raises(Killed):
        sinks.overwrite_table(some(spark, 4), t)
    monkeypatch.undo()
    assert rows(spark, t) == [(1, "n1"), (2, "n2")]
    sinks.overwrite_table(some(spark, 5), t)
    assert rows(spark, t) == [(5, "n5")]
    gone = versions.vacuum(spark, t)
    assert len(gone) == 3 and rows(spark, t) == [(5, "n5")]


def test_an_overwrite_may_read_the_table_itself(spark, db):
    t = f"{db}.dim"
    sinks.ensure_table(spark, t, SCHEMA)
    sinks.overwrite_table(some(spark, 1, 2, 3), t)
    sinks.overwrite_table(spark.table(t).where("id > 1"), t)
    assert rows(spark, t) == [(2, "n2"), (3, "n3")]


def test_snapshots_and_restores_copy_nothing(spark, db):
    t, kept = f"{db}.dim", f"{db}.dim_bkp"
    sinks.ensure_table(spark, t, SCHEMA)
    sinks.overwrite_table(some(spark, 1, 2), t)
    before = data_files(versions.location(spark, t))
    sinks.snapshot_table(spark, t, kept)
    assert versions.location(spark, kept) == versions.location(spark, t)
    sinks.overwrite_table(some(spark, 9), t)
    assert rows(spark, kept) == [(1, "n1"), (2, "n2")] and rows(spark, t) == [(9, "n9")]
    sinks.restore_table(spark, kept, t)
    assert data_files(versions.location(spark, t)) == before and rows(spark, t) == rows(spark, kept)
    # Appending must not reach the snapshot, whose folder the table is on.
    sinks.append_rows(some(spark, 7), t)
    assert rows(spark, t) == [(1, "n1"), (2, "n2"), (7, "n7")] and rows(spark, kept) == [(1, "n1"), (2, "n2")]
    versions.vacuum(spark, t, [kept])
    assert rows(spark, kept) == [(1, "n1"), (2, "n2")] and rows(spark, t)[-1] == (7, "n7")
    # Dropping a snapshot drops a name, not the data.
    sinks.restore_table(spark, kept, t)
    spark.sql(f"DROP TABLE {kept}")
    assert rows(spark, t) == [(1, "n1"), (2, "n2")]


def test_the_old_snapshot_stays_until_the_new_one_is_there(spark, db, monkeypatch):
    t, kept = f"{db}.dim", f"{db}.dim_bkp"
    sinks.ensure_table(spark, t, SCHEMA)
    sinks.overwrite_table(some(spark, 1), t)
    spark.sql(f"CREATE TABLE {kept} USING parquet AS SELECT * FROM {t}")  # a copy, as older releases made
    sinks.overwrite_table(some(spark, 2), t)

    def die(*a):
        raise Killed

    monkeypatch.setattr(versions, "_declare", die)
    with pytest.raises(Killed):
        sinks.snapshot_table(spark, t, kept)
    monkeypatch.undo()
    assert rows(spark, kept) == [(1, "n1")]
    sinks.snapshot_table(spark, t, kept)
    assert rows(spark, kept) == [(2, "n2")]


@pytest.fixture
def partitioned(spark, db):
    t = f"{db}.facts"
    sinks.ensure_table(spark, t, DAYS, ["month", "day"])
    days(spark, (1, "m1", "a"), (2, "m1", "b"), (3, "m2", "a")).write.insertInto(t, overwrite=True)
    return t


def test_many_partitions_are_replaced_cleared_and_added_at_once(spark, partitioned):
    t = partitioned
    new = days(spark, (10, "m1", "a"), (11, "m1", "a"), (12, "m3", "c"), (99, "m2", "a"))
    got = versions.replace_partitions(new, t, [spec("m1", "a"), spec("m1", "b"), spec("m3", "c"), spec("m4", "d")])
    assert got == {"month=m1/day=a": 2, "month=m1/day=b": 0, "month=m3/day=c": 1, "month=m4/day=d": 0}
    assert rows(spark, t) == [(3, "m2", "a"), (10, "m1", "a"), (11, "m1", "a"), (12, "m3", "c")]  # m2/a wasn't named
    versions.replace_partitions(new.limit(0), t, [spec("m3", "c")])
    assert rows(spark, t) == [(3, "m2", "a"), (10, "m1", "a"), (11, "m1", "a")]
    assert len(versions.vacuum(spark, t)) == 0 and len(rows(spark, t)) == 3  # other days of both folders are in use
    # A plain overwrite of one partition goes on working on a switched one.
    sinks.overwrite_partition(days(spark, (20, "m1", "a")), t, spec("m1", "a"))
    assert (20, "m1", "a") in rows(spark, t) and (10, "m1", "a") not in rows(spark, t)


def test_nothing_changes_before_the_commit_and_a_killed_commit_is_finished(spark, partitioned, monkeypatch):
    t = partitioned
    old, new = rows(spark, t), days(spark, (10, "m1", "a"), (12, "m3", "c"))
    specs = [spec("m1", "a"), spec("m1", "b"), spec("m3", "c")]
    broken = new.withColumn("id", F.when(F.col("id") == 12, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        versions.replace_partitions(broken, t, specs)
    assert rows(spark, t) == old and versions.recover(spark, t) == []

    def die(*a):
        raise Killed

    monkeypatch.setattr(versions, "write_text", die)
    with pytest.raises(Killed):
        versions.replace_partitions(new, t, specs)
    monkeypatch.undo()
    assert rows(spark, t) == old and versions.recover(spark, t) == []

    # Killed after the commit file, between two partitions.
    staged = versions.stage_partitions(new, t, specs)
    stage = staged.folder
    assert rows(spark, t) == old and staged.counts == {"month=m1/day=a": 1, "month=m1/day=b": 0, "month=m3/day=c": 1}
    monkeypatch.setattr(versions, "apply_commit", die)
    with pytest.raises(Killed):
        staged.commit()
    monkeypatch.undo()
    assert rows(spark, t) == old
    spark.sql(f"ALTER TABLE {t} PARTITION (`month` = 'm1', `day` = 'a') SET LOCATION '{stage}/month=m1/day=a'")
    assert [x.rsplit("/", 1)[-1] for x in versions.recover(spark, t)] == [stage.rsplit("/", 1)[-1]]
    assert rows(spark, t) == [(3, "m2", "a"), (10, "m1", "a"), (12, "m3", "c")]
    assert versions.recover(spark, t) == []
    assert len(versions.vacuum(spark, t)) == 1  # the one that was never committed; a failed write removes its own


def test_a_commit_may_leave_partitions_out(spark, partitioned):
    staged = versions.stage_partitions(days(spark, (10, "m1", "a"), (12, "m3", "c")), partitioned, [spec("m1", "a"), spec("m3", "c")])
    assert staged.commit([spec("m3", "c")]) == {"month=m3/day=c": 1}
    assert rows(spark, partitioned) == [(1, "m1", "a"), (2, "m1", "b"), (3, "m2", "a"), (12, "m3", "c")]
    assert staged.commit([]) == {}


def test_partitions_are_named_in_full_and_plainly(spark, partitioned):
    for bad in ({"day": "a", "month": "m1"}, {"month": "m1"}, spec("m1", "a/b"), spec("m1", "x'y")):
        with pytest.raises(ValueError):
            versions.replace_partitions(spark.createDataFrame([], DAYS), partitioned, [bad])
    assert versions.replace_partitions(spark.createDataFrame([], DAYS), partitioned, []) == {}


def test_an_existing_table_must_be_partitioned_alike(spark, partitioned):
    with pytest.raises(ValueError, match="partitions"):
        sinks.ensure_table(spark, partitioned, DAYS, ["day"])
    sinks.ensure_table(spark, partitioned, DAYS, ["month", "day"])
