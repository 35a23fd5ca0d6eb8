"""Dimensions too large to broadcast, and joins of bucketed tables: same rows, and the plans they are for."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from cargomart.operators.buckets import bucket_count, write_bucketed
from cargomart.operators.joins import DimSpec, enrich_latest, orphan_rows, orphan_rows_by_keys, star_join
from tests.test_plans import plan


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """Facts of which a third has one key and some have none, and a dimension with repeated keys."""
    folder = str(tmp_path_factory.mktemp("large-dims"))
    k = F.col("id") % 500
    fact = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), k.cast("string"))).alias("f_key"),
        F.col("id").alias("n"), F.lit("x").alias("d_key"),
    )
    dim = spark.range(900).select(F.concat(F.lit("k"), (F.col("id") % 450).cast("string")).alias("d_key"), (F.col("id") % 7).alias("kind"))
    fact.unionByName(fact.where("n < 40")).write.parquet(f"{folder}/fact")
    dim.write.parquet(f"{folder}/dim")
    return spark.read.parquet(f"{folder}/fact"), spark.read.parquet(f"{folder}/dim")


@pytest.mark.parametrize("max_rows", [0, 2_000_000])
def test_orphans_by_keys_are_the_orphans(sides, max_rows):
    fact, dim = sides
    got = sorted(map(tuple, orphan_rows_by_keys(fact, dim, "f_key", "d_key", max_rows=max_rows).collect()), key=str)
    there = {r[0] for r in dim.select("d_key").collect()}
    assert got == sorted((tuple(r) for r in fact.collect() if r[0] not in there), key=str)
    assert got == sorted(map(tuple, orphan_rows(fact, dim, "f_key", "d_key").collect()), key=str)
    assert orphan_rows_by_keys(fact.limit(0), dim, "f_key", "d_key").count() == 0
    assert orphan_rows_by_keys(fact, dim.limit(0), "f_key", "d_key").count() == fact.count()


def test_facts_are_not_shuffled_to_find_orphans(sides):
    fact, dim = sides
    found = plan(orphan_rows_by_keys(fact, dim, "f_key", "d_key"))
    assert "BroadcastHashJoin" in found and "LeftSemi" in found and "Exchange hashpartitioning" not in found


def test_facts_are_filtered_before_the_shuffle_to_a_large_dimension(spark, sides):
    fact, dim = sides
    at = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(at)
    spark.conf.set(at, "0")  # the facts here are small
    try:
        joined = star_join(fact.drop("d_key"), [DimSpec(dim.where("kind = 3"), "f_key", "d_key", ["kind"])], max_rows=0)
        found = plan(joined)
        rows = joined.count()
    finally:
        spark.conf.set(at, before)
    assert re.search(r"Exchange hashpartitioning\(f_key[^\n]*\n[^\n]*Filter [^\n]*might_contain", found)
    assert rows == fact.join(dim.where("kind = 3"), fact["f_key"] == dim["d_key"]).count()


def test_bucketed_tables_join_without_a_shuffle(spark, sides):
    fact, _ = sides
    events = fact.select(F.col("f_key").alias("e_key"), F.col("n").alias("ts"), (F.col("n") * 7 % 11).alias("kind"))
    args = ([("f_key", "e_key")], ["ts"], {"kind": "last_kind"}, ["kind"])
    db = f"b_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    left, right = write_bucketed(fact, f"{db}.fact", ["f_key"], 4), write_bucketed(events, f"{db}.events", ["e_key"], 4)
    joined = enrich_latest(left, right, *args)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert "Exchange" in plan(enrich_latest(fact, events, *args))
    key = lambda r: str(tuple(r))
    assert sorted(joined.collect(), key=key) == sorted(enrich_latest(fact, events, *args).collect(), key=key)
    assert write_bucketed(fact.limit(0), f"{db}.none", ["f_key"], 4).count() == 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_bucket_counts_follow_the_largest_side(sides):
    fact, dim = sides
    assert bucket_count(fact, dim) == 1 == bucket_count(fact.limit(0))
    few, many = bucket_count(fact, dim, bucket_bytes=40_000), bucket_count(fact, dim, bucket_bytes=10_000)
    assert many == 4 * few and few & (few - 1) == 0
