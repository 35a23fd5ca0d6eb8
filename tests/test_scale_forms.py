"""Forms for data that no task, key or catalog repair can take whole."""

import random
import time
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cargomart.operators.aggregates import duplicate_keys, duplicate_keys_hashed, rollup_levels
from cargomart.operators.gates import GateError, compare_content, content, snapshot_report
from cargomart.operators.windows import number_rows
from cargomart.schemas import SRC_CARRIER_MASTER, SRC_SHIPMENTS, pad_to
from cargomart.sources import testdata as td
from cargomart.sources.catalog import discover_partitions
from cargomart.sources.delimited import ensure_landing_table, keep_rejects, read_checked, read_delimited, reject_gate


@pytest.fixture
def db(spark):
    name = f"s_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_places_of_rows_are_those_of_a_window(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None, "c"]), rng.choice([None, *range(400)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, id int").repartition(7)
    got = number_rows(df, ["g"], ["k", "id"], start=5)
    order = Window.partitionBy("g").orderBy(F.asc_nulls_first("k"), F.asc_nulls_first("id"))
    want = df.withColumn("line_no", F.row_number().over(order) + 4)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert number_rows(df, [], ["id"], "n").agg(F.max("n"), F.count_distinct("n")).first() == (3000, 3000)
    assert number_rows(df.limit(0), ["g"], ["k"]).collect() == []


def test_no_task_orders_a_whole_group(spark, monkeypatch):
    from cargomart.operators import windows

    written = []
    monkeypatch.setattr(windows, "materialize", lambda df, real=windows.materialize: written.append(real(df)) or written[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(spark.range(0, 20_000, numPartitions=8).select(F.lit("one group").alias("g"), "id"), ["g"], ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert "row_number" not in got._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in written[0].groupBy(F.shiftright("__at", 33)).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 10_000 and got.where("line_no <> id + 1").count() == 0


def test_hashed_duplicates_are_the_duplicates(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), ("", 3), ("", 3), ("b", None), ("b", None), ("b", 42)]
    df = spark.createDataFrame(rows, "k string, v int")
    for present in ((), ("k",)):
        want = sorted(map(str, duplicate_keys(df, ["k", "v"], present).collect()))
        assert sorted(map(str, duplicate_keys_hashed(df, ["k", "v"], present).collect())) == want and want


def test_levels_tell_summed_columns_from_null_values(spark):
    df = spark.createDataFrame([("m", "x", 1), ("m", None, 2), ("n", "x", 4)], "a string, b string, n long")
    got = sorted(map(tuple, rollup_levels(df, [["a", "b"], ["a"], []], ["n"]).collect()), key=str)
    assert got == sorted([("m", "x", 0, 1), ("m", None, 0, 2), ("n", "x", 0, 4), ("m", None, 1, 3), ("n", None, 1, 4), (None, None, 3, 7)], key=str)
    plan = rollup_levels(df, [["a", "b"], []], ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


def test_content_is_compared_whatever_the_order(spark, db):
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (2, None, "a"), (3, "", "x")], "i int, a string, b string")
    same = lambda x: compare_content(df, x).first()["same_content"]
    assert same(df.orderBy(F.desc("i")).select("b", "i", "a"))
    assert not same(df.withColumn("a", F.col("b")).withColumn("b", F.lit("a")))
    assert not same(df.withColumn("a", F.coalesce("a", F.lit(""))))  # null isn't empty
    assert not same(df.distinct()) and not same(df.distinct().unionByName(df.where("i = 1")))  # nor is a count enough
    assert not same(df.select("i", F.col("b").alias("a"), F.col("a").alias("b")))
    assert tuple(content(df.limit(0)).first()) == (0, 0, 0)
    with pytest.raises(ValueError):
        compare_content(df, df.drop("a"))
    df.write.saveAsTable(f"{db}.x")
    df.withColumn("b", F.lit("y")).write.saveAsTable(f"{db}.y")
    with pytest.raises(GateError, match="other content"):
        snapshot_report(spark, f"{db}.x", f"{db}.y")


LANDED = "id\tname\tweight\n1\tone\t1.50\n2\ttwo\tn/a\n3\tthree\n\n4\tfour\t4.00\textra\n5\t\t\n6\t\"six\t6.00\n7\tseven\t1e9\n"


def test_lines_that_do_not_parse_are_kept_apart(spark, db, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "a.txt").write_text(LANDED)
    (tmp_path / "b.txt").write_text("id\tname\tweight\n8\teight\t8.00")
    schema = StructType().add("id", "integer").add("name", "string").add("weight", "decimal(6,2)")
    good, bad = read_checked(spark, str(tmp_path), schema)
    assert sorted((r["id"], r["name"], None if r["weight"] is None else str(r["weight"])) for r in good.collect()) == [
        (1, "one", "1.50"), (5, None, None), (6, '"six', "6.00"), (8, "eight", "8.00")]
    assert sorted((r["reason"], r["line"]) for r in bad.collect()) == [
        ("FIELD_COUNT", "3\tthree"), ("FIELD_COUNT", "4\tfour\t4.00\textra"),
        ("UNPARSABLE_VALUE", "2\ttwo\tn/a"), ("UNPARSABLE_VALUE", "7\tseven\t1e9")]
    # A query that takes one column still sets the same lines aside.
    assert good.select("name").count() == 4 and good.count() == 4
    parsed = read_delimited(spark, str(tmp_path), schema)
    assert sorted(map(str, parsed.where("id in (1, 5, 6, 8)").collect())) == sorted(map(str, good.collect()))
    table = keep_rejects(bad, f"{db}.rejects", "x", "2026-05-10 02:00:00")
    keep_rejects(bad.limit(1), table, "x", "2026-05-11 02:00:00")
    assert spark.table(table).count() == 5 and spark.table(table).where("file like '%a.txt'").count() == 5
    assert reject_gate(good, bad, 50) == {"good": 4, "FIELD_COUNT": 2, "UNPARSABLE_VALUE": 2}
    with pytest.raises(GateError, match="4 of 8 lines"):
        reject_gate(good, bad, 49)
    with pytest.raises(GateError, match="no rows"):
        reject_gate(good.limit(0), bad, 100)


def test_only_new_folders_are_registered(spark, db, tmp_path):
    place = tmp_path / "landing"
    t = f"{db}.landing"
    spark.sql(f"CREATE TABLE {t} (id int, m string, d string) USING parquet PARTITIONED BY (m, d) LOCATION '{place}'")
    put = lambda m, d: spark.createDataFrame([(1,)], "id int").write.parquet(f"{place}/m={m}/d={d}")
    assert discover_partitions(spark, t) == []
    put("a", "1")
    put("a", "2 x%3A")
    (place / "m=a" / "other").mkdir()
    (place / "_tmp").mkdir()
    assert discover_partitions(spark, t) == ["m=a/d=1", "m=a/d=2 x:"]
    put("b", "1")
    assert discover_partitions(spark, t) == ["m=b/d=1"] and discover_partitions(spark, t) == []
    assert sorted(map(tuple, spark.table(t).collect())) == [(1, "a", "1"), (1, "a", "2 x:"), (1, "b", "1")]


def test_a_landing_table_must_be_the_one_declared(spark, db, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    ensure_landing_table(spark, f"{db}.c", SRC_CARRIER_MASTER, one)
    ensure_landing_table(spark, f"{db}.c", SRC_CARRIER_MASTER, one)
    with pytest.raises(ValueError, match="folder"):
        ensure_landing_table(spark, f"{db}.c", SRC_CARRIER_MASTER, two)
    with pytest.raises(ValueError, match="columns"):
        ensure_landing_table(spark, f"{db}.c", SRC_CARRIER_MASTER, one, ["exp_dt"])


@pytest.mark.parametrize("query", ["landing_round_trip", "partition_overwrite", "partition_overwrite_two_level"])
def test_no_task_writes_a_whole_partition(spark, monkeypatch, query):
    """Rows of one year: several tasks write its folder, and no row is lost."""
    from cargomart.plans.table_queries import TABLE_QUERIES

    rows = spark.range(0, 20_000, numPartitions=8).select(
        F.concat(F.lit("s"), "id").alias("shipment_id"), F.md5(F.col("id").cast("string")).alias("carrier_id"),
        F.lit("RAW").alias("record_type"), F.lit("1996-03-01").alias("trans_dt"),
    )
    monkeypatch.setattr(td, "src_shipments", lambda spark, d: pad_to(rows, SRC_SHIPMENTS))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        got = TABLE_QUERIES[query](spark, "")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    per_file = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == got.select("shipment_id").distinct().count() == 20_000
    assert len(per_file) > 3 and max(per_file) < 10_000


def test_folders_of_partitions_are_listed_by_few_tasks(spark, tmp_dir):
    spark.range(0, 60, numPartitions=1).select("id", F.col("id").cast("string").alias("day")).write.partitionBy("day").parquet(tmp_dir + "/t")
    sc = spark.sparkContext
    sc.setJobGroup("listing", "")
    try:
        got = spark.read.schema("id long, day string").parquet(tmp_dir + "/t").count()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert got == 60 and max(s.numTasks for s in stages if s) <= 48


def test_rows_of_small_partitions_are_not_hashed_whole(spark, db, monkeypatch):
    from cargomart.operators import sinks, versions

    dealt = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "repartition", lambda self, n, *by, real=kind.repartition: dealt.append(by) or real(self, n, *by))
    df = spark.range(6).select("id", F.when(F.col("id") < 4, "a").otherwise("b").alias("day"))
    sinks.ensure_table(spark, f"{db}.t", df.schema, ["day"])
    for rows_a_file, salted in ((2_000_000, 1), (2, 2)):
        monkeypatch.setattr(versions, "FILE_ROWS", rows_a_file)
        staged = versions.stage_partitions(df, f"{db}.t", [{"day": "a"}, {"day": "b"}], {"day=a": 4, "day=b": 2})
        assert staged.counts == {"day=a": 4, "day=b": 2} and len(dealt.pop()) == salted


def _order_tables(spark, d):
    orders = spark.range(1, 401, numPartitions=4)
    tables = {
        "customer": spark.range(1, 21).selectExpr("id AS c_custkey", "CAST(id % 5 AS INT) AS c_nationkey", "'BUILDING' AS c_mktsegment"),
        # Orders that come twice, and one without a key.
        "orders": orders.selectExpr("IF(id = 7, NULL, IF(id < 5, 1L, id)) AS o_orderkey", "id % 20 + 1 AS o_custkey", "'F' AS o_orderstatus",
                                    "TIMESTAMP_NTZ'1994-01-01 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority"),
        "lineitem": orders.selectExpr("id", "explode(sequence(1, 5)) AS l_linenumber").selectExpr(
            "IF(id = 9, NULL, id) AS l_orderkey", "id * 7 AS l_partkey", "id % 9 AS l_suppkey", "l_linenumber", "DOUBLE(l_linenumber) AS l_quantity",
            "DOUBLE(id) + 0.25 AS l_extendedprice", "DOUBLE(0.01) AS l_discount", "DOUBLE(0.02) AS l_tax", "'N' AS l_returnflag", "'F' AS l_linestatus",
            "IF(id = 11, NULL, TIMESTAMP_NTZ'1994-01-01 00:00:00' + MAKE_INTERVAL(CAST(id % 3 AS INT))) AS l_shipdate"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{d}/{name}.parquet")
    return str(d)


def test_landing_files_are_written_in_slices_that_leave_no_shuffle(spark, tmp_path, monkeypatch):
    """Compressed files, no shuffle files that outlive their slice, and every row as often as it comes."""
    from cargomart.plans import table_queries

    monkeypatch.setattr(table_queries, "SLICE_BYTES", 5000, raising=False)
    d = _order_tables(spark, tmp_path)
    left, write = [], table_queries.write_delimited
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {x for x in (files.apply(i).getName() for i in range(files.size())) if x.startswith("shuffle_")}

    def watched(*args, **options):
        before = shuffles()
        write(*args, **options)
        for _ in range(50):  # they go within moments
            if not shuffles() - before:
                break
            time.sleep(0.1)
        left.append(shuffles() - before)

    monkeypatch.setattr(table_queries, "write_delimited", watched)
    got = table_queries.q_landing_round_trip(spark, d)
    assert len(left) > 1 and not any(left)
    assert all(f.endswith(".csv.gz") for f in got.inputFiles())
    blank = [F.when(F.col(c) != "", F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in got.dtypes]
    rows = lambda df: sorted(map(repr, df.collect()))
    whole = td.src_shipments(spark, d).select(*blank)
    assert rows(got) == rows(whole) and len(rows(got)) > 1900


def test_slices_of_shipments_hold_every_row_once(spark, tmp_path):
    d = _order_tables(spark, tmp_path)
    rows = lambda df: sorted(map(repr, df.collect()))
    parts = [rows(td.src_shipments(spark, d, part=(k, 3))) for k in range(3)]
    assert all(parts) and sorted(sum(parts, [])) == rows(td.src_shipments(spark, d))
