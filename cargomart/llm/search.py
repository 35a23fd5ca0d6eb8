"""Exact top-k search over binary codes by incremental multi-index hashing.

A code's bits are cut into segments, and each segment's value is an index
entry.  Round by round, queries look up the values at the next distance from
their own segments.  After all m segments have been searched to radius r, every
code at most m * (r + 1) - 1 bits away has been seen, as one of its segments is
at most r bits away; a query is done once its k-th verified distance lies
within that.

Codes that stand often are one index entry with their number and their k + 1
smallest ids, so neither a common vector nor ties make long lists.  As a query
leaves out the rows of its own id, ids are distinct and have their numbers.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bits of a segment at most, and how much shorter than the number of codes it
#: is, so that few values are looked up in vain.
SEGMENT_BITS, SPARE_BITS = 24, 3
#: Groups that copies of one code are dealt to before their smallest ids are taken.
SALTS = 64


def codes(vectors: DataFrame, column: str = "embedding", bits: int = 64) -> DataFrame:
    """vec_id and ``code``: bit i is set where number i is 0 or more.  Vectors
    that are null or shorter than ``bits``, or hold nulls or NaN among them,
    have no code and are left out, as are null ids; of longer ones the first
    ``bits`` numbers count."""
    v = F.slice(F.col(column), 1, bits)
    usable = F.col("vec_id").isNotNull() & (F.size(v) == bits) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))
    code = F.aggregate(v, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1) + F.when(x >= 0, 1).otherwise(0).cast("long"))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), code.alias("code"))


def _segments(bits: int, rows: int) -> list[tuple[int, int]]:
    """(first bit, bits) of segments of a little less than log2(rows) bits."""
    each = max(4, min(SEGMENT_BITS, rows.bit_length() - SPARE_BITS))
    n = -(-bits // each)
    edges = [round(bits * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _flips(width: int, radius: int) -> list[int]:
    """Values of ``width`` bits of which ``radius`` are set."""
    return [sum(1 << b for b in c) for c in combinations(range(width), radius)]


def _value(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))


def _smallest(counted: DataFrame, k: int) -> DataFrame:
    """(code, n, ids): each distinct code, its number of rows and its k smallest
    distinct ids in order, with their numbers; of (code, vec_id, c)."""
    salted = counted.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    nth = F.row_number().over(Window.partitionBy("code", "_salt").orderBy("vec_id"))
    some = salted.withColumn("_n", nth).where(F.col("_n") <= k)
    # At most k * SALTS rows of a code are left.
    ids = some.groupBy("code").agg(F.slice(F.array_sort(F.collect_list(F.struct("vec_id", "c"))), 1, k).alias("ids"))
    return counted.groupBy("code").agg(F.sum("c").alias("n")).join(ids, "code")


def top_k(coded: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64) -> DataFrame:
    """query_id, rank, vec_id, distance: for each query (vec_id, code) its k
    nearest other vectors by Hamming distance, ties by vec_id; fewer if there
    are fewer.  Rows of one vec_id are vectors of their own, but none of them
    is an answer to a query of that id.  An empty table or no queries give an
    empty result.

    Each round writes its verified candidates to the shared folder."""
    counted = written(coded.groupBy("code", "vec_id").agg(F.count(F.lit(1)).alias("c")), "ids")
    index = written(_smallest(counted, k + 1), "codes")
    rows = index.count()
    asked = written(queries.select(F.col("vec_id").alias("query_id"), F.col("code").alias("q")).distinct(), "queries")
    distance = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))).cast("int")
    parts = _segments(bits, rows)
    entries = index.select(
        "code", F.explode(F.array(*[F.struct(F.lit(i).alias("_s"), _value(F.col("code"), *p).alias("_v")) for i, p in enumerate(parts)])).alias("e")
    ).select("code", "e._s", "e._v")

    # How many rows of a query's own id there are at each distance: mostly one
    # at 0.  Queries of one code that agree in it are looked at once.
    mine = asked.join(counted.withColumnRenamed("vec_id", "query_id"), "query_id").groupBy("query_id", "q", distance("q", "code").alias("at"))
    mine = mine.agg(F.sum("c").alias("c")).groupBy("query_id", "q").agg(F.array_sort(F.collect_list(F.struct("at", "c"))).alias("own"))
    none = F.lit([]).cast("array<struct<at:int,c:bigint>>")
    needs = written(asked.join(mine, ["query_id", "q"], "left").select("q", F.coalesce("own", none).alias("own")).distinct(), "needs")

    def kth(found: DataFrame) -> DataFrame:
        """(query, the distance at which it has k others; null: it hasn't)."""
        per = found.groupBy("q", "distance").agg(F.sum("n").alias("n")).join(needs, "q")
        own = F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + F.when(x["at"] == F.col("distance"), x["c"]).otherwise(0))
        upto = F.sum(F.col("n") - own).over(Window.partitionBy("q", "own").orderBy("distance"))
        reached = per.withColumn("_upto", upto).groupBy("q", "own").agg(F.min(F.when(F.col("_upto") >= k, F.col("distance"))).alias("b"))
        # A code's queries go on until the last of them has k.
        return reached.groupBy("q").agg(F.when(F.count("b") == F.count(F.lit(1)), F.max("b")).alias("bound"))

    open_ = asked.select("q", F.lit(bits).alias("bound")).distinct()
    found = None
    for radius in range(max(w for _, w in parts) + 1):
        looked = F.array(*[
            F.struct(F.lit(i).alias("_i"), _value(F.col("q"), *p).alias("_own"), F.lit(_flips(p[1], radius)).cast("array<long>").alias("_flips"))
            for i, p in enumerate(parts) if radius <= p[1]
        ])
        probes = open_.select("q", "bound", F.inline(looked)).select("q", "bound", "_i", "_own", F.explode("_flips").alias("_flip"))
        probes = probes.withColumn("_w", F.col("_own").bitwiseXOR(F.col("_flip")))
        near = probes.join(
            entries, (F.col("_i") == F.col("_s")) & (F.col("_w") == F.col("_v")) & (distance("q", "code") <= F.col("bound"))
        ).select("q", "code", distance("q", "code").alias("distance"))
        found = written((near if found is None else found.unionByName(near)).distinct(), "found")
        covered = len(parts) * (radius + 1) - 1
        weighed = found.join(index.select("code", "n"), "code")
        open_ = written(
            open_.join(kth(weighed).withColumnRenamed("bound", "_b"), "q", "left")
            .select("q", F.least("bound", "_b").alias("bound"))
            .where(F.col("bound") > covered),
            "open",
        )
        if open_.isEmpty():
            break
    listed = found.join(index.select("code", "ids"), "code").select("q", "distance", F.explode("ids").alias("_id"))
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        asked.join(listed.select("q", "distance", "_id.*"), "q")
        .where("vec_id <> query_id")
        .withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.least("c", F.lit(k).cast("long")))))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "distance")
    )


ORACLE = """
with c as (
  select vec_id, list_transform(embedding[1:64], lambda x: x >= 0) as b from embeddings
  where vec_id is not null and len(embedding) >= 64
), d as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.b, c.b), lambda z: case when z[1] <> z[2] then 1 else 0 end))::int as distance
  from c q join c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), r as (
  select *, row_number() over (partition by query_id order by distance, vec_id)::int as rank from d
)
select query_id, rank, vec_id, distance from r where rank <= 10
"""
