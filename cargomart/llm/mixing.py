"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled queue, and after its last document
the queue starts over.  A document's virtual finish time is the number of its
source's tokens up to and including it, divided by the source's target.  All
queues are served in order of finish time until the token budget is used up,
so at any moment every source has got its share.

DataFrame functions only.  No order is made by one task: a source's queue is
summed in buckets of the shuffle key first, and the end of the budget is found
by narrowing a histogram of finish times; only documents that finish within
the last narrow step are sorted one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargomart.operators.joins import bounded_broadcast

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a bucket of a queue, or the last step of the histogram, holds about.
GROUP_ROWS = 10_000
#: Steps of one narrowing of the histogram.
STEPS = 1_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size to the same with ``weight`` and ``target``: sources
    by code point (null last) weigh as ``weights`` repeat and share ``share`` of
    all sizes; none gets more than ``cap`` times its size, and what one can't
    take the others share by weight.  One row a source goes through one task."""
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("_nth", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_nth") - 1) % len(weights) + 1))
        .withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    # Sources that are full soonest first.  If those before a source are full
    # and the others share the rest by weight, this is what a weight of 1 gets;
    # the level is right where the source itself isn't above its cap.
    soonest = Window.orderBy(F.col("_cap") / F.col("weight"), "_nth")
    before, onward = (soonest.rowsBetween(Window.unboundedPreceding, -1), soonest.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        ranked.withColumn("_level", level)
        .withColumn("_fits", F.when(F.col("_level") <= F.col("_cap") / F.col("weight"), F.col("_level")))
        .withColumn("_level", F.max("_fits").over(everything))
        .select(
            "source", "source_size", "weight",
            F.when(F.col("_level").isNull(), F.col("_cap"))
            .otherwise(F.least(F.col("_cap"), F.col("_level") * F.col("weight")))
            .alias("target"),
        )
    )


def _queue(docs: DataFrame, goals: DataFrame, rows: int) -> DataFrame:
    """Adds source_size, target and ``_sum``: words of the source's queue up to
    and including the document."""
    buckets = rows // GROUP_ROWS + 1
    at = F.conv(F.substring("_key", 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    docs = docs.withColumn("_bucket", F.floor(at * buckets).cast("int"))
    sums = docs.groupBy("source", "_bucket").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
    docs = docs.withColumn("_sum", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    goals = bounded_broadcast(goals.withColumnRenamed("source", "_g").drop("weight"))
    return (
        docs.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_sum", F.col("_sum") + F.col("_before"))
        .join(goals, F.col("source").eqNullSafe(F.col("_g")))
        .drop("_s", "_b", "_g", "_before", "_bucket")
    )


def _ends(queue: DataFrame, rounds: int) -> DataFrame:
    """A row for each time that a document may be taken, with its finish time."""
    return queue.select(
        "source", "_key", "doc_id", "size", F.explode(F.array(*[F.lit(k) for k in range(rounds)])).alias("_round"), "_sum", "source_size", "target"
    ).withColumn("_finish", (F.col("_sum") + F.col("_round") * F.col("source_size")).cast("double") / F.col("target"))


def _cut(ends: DataFrame, budget: float) -> tuple[float, float, int]:
    """(lo, hi, words that finish before lo): the budget ends in [lo, hi), which
    holds at most GROUP_ROWS rows or can't be narrowed further."""
    lo, hi, below = 0.0, None, 0
    top = ends.agg(F.max("_finish")).first()[0]
    if top is None:
        return 0.0, 0.0, 0
    hi = top * (1 + 1e-9) + 1e-300
    while True:
        width = (hi - lo) / STEPS
        step = F.least(F.floor((F.col("_finish") - F.lit(lo)) / F.lit(width)), F.lit(STEPS - 1)).cast("int")
        inside = ends.where((F.col("_finish") >= F.lit(lo)) & (F.col("_finish") < F.lit(hi)))
        rows = sorted(
            tuple(r)
            for r in inside.groupBy(step.alias("step"))
            .agg(F.sum("size"), F.count(F.lit(1)), F.min("_finish"), F.max("_finish"))
            .collect()
        )
        for _, words, n, first, last in rows:
            if below + words > budget:
                break
            below += words
        else:
            return hi, hi, below
        # The step's own first and last times are its bounds, whatever rounding
        # did to the step's edges.
        following = last + max(abs(last), 1e-300) * 2**-52
        if n <= GROUP_ROWS or first == last:
            return first, following, below
        lo, hi = first, following


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2, seed: str = "mix") -> DataFrame:
    """doc_id, text, source to doc_id, source, size (words; null text: 0),
    source_size, target (of the source) and ``taken``: words that the mix takes
    of the document, its size times 0 to ``cap``.

    Documents of no words take none.  A null source is a source of its own; a
    null doc_id counts as an empty one in the shuffle.  Rows of one doc_id and
    size are alike.  An empty table gives an empty result.  Same rows and seed,
    same result, however they are partitioned."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    slim = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), name)).alias("_key"),
        ),
        "mix",
    )
    per = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    per = written(per, "mix-sources")
    rows, total = per.agg(F.sum("_rows"), F.sum("source_size")).first()
    queue = written(_queue(slim, targets(per.drop("_rows"), weights, share, float(cap)), rows or 0), "mix-queue")
    ends = _ends(queue.where("size > 0"), cap)
    budget = min(share, cap) * (total or 0)
    lo, hi, below = _cut(ends, budget)
    last = ends.where((F.col("_finish") >= F.lit(lo)) & (F.col("_finish") < F.lit(hi)))
    order = Window.orderBy("_finish", F.asc_nulls_last("source"), "_key", "doc_id", "size", "_round")
    last = (
        last.withColumn("_used", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(below))
        .where(F.col("_used") <= F.lit(budget))
        .groupBy(F.col("_key").alias("_k"), F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_sum").alias("_u"))
        .agg(F.count(F.lit(1)).alias("_more"))
    )
    sure = sum(
        ((F.col("_sum") + k * F.col("source_size")).cast("double") / F.col("target") < F.lit(lo)).cast("long") for k in range(cap)
    )
    return (
        queue.join(
            bounded_broadcast(last),
            (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s"))
            & (F.col("size") == F.col("_z")) & (F.col("_sum") == F.col("_u")),
            "left",
        )
        .withColumn("_times", F.when(F.col("size") > 0, sure + F.coalesce("_more", F.lit(0))).otherwise(0))
        .select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("_times")).alias("taken"))
    )


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents that the mix takes, as often as it takes them.  Rows of one
    doc_id are told apart by their number of words."""
    names = docs.columns
    times = mixed.where("taken > 0").select(
        F.col("doc_id").alias("_d"), F.col("size").alias("_z"), (F.col("taken") / F.col("size")).cast("int").alias("_times")
    )
    nth = lambda doc_id, size, *more: F.row_number().over(Window.partitionBy(doc_id, size).orderBy(*more))
    times = times.withColumn("_m", nth("_d", "_z", F.desc("_times")))
    rows = docs.withColumn("_size", word_count(F.col("text")))
    rows = rows.withColumn("_n", nth("doc_id", "_size", F.asc_nulls_last("source"), "text"))
    return (
        rows.join(times, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_size") == F.col("_z")) & (F.col("_n") == F.col("_m")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*[f"`{c}`" for c in names])
    )


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix:' || coalesce(doc_id::varchar, '')) as k
  from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight,
         row_number() over (order by source nulls last) as nth
  from s
), c as (
  select *, (2 * source_size)::double as cap, (select sum(source_size)::double from s) * 1.5 as budget from w
), l as (
  select *, (budget - coalesce(sum(cap) over (order by cap / weight, nth rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by cap / weight, nth rows between current row and unbounded following) as level
  from c
), t as (
  select source, source_size, budget,
         case when lim is null then cap else least(cap, lim * weight) end as target
  from (select *, (select max(level) from l where level <= cap / weight) as lim from l)
), q as (
  select d.*, t.source_size, t.target, t.budget,
         sum(size) over (partition by d.source order by k, doc_id, size rows between unbounded preceding and current row) as cum
  from d join t on d.source is not distinct from t.source
), e as (
  select *, (cum + r * source_size)::double / target as finish
  from q, (values (0), (1)) x(r) where size > 0
), u as (
  select *, sum(size) over (order by finish, source nulls last, k, doc_id, size, r rows between unbounded preceding and current row) as used
  from e
), n as (
  select doc_id, source, size, cum, count(*) as times from u where used <= budget group by all
)
select q.doc_id, q.source, q.size, q.source_size, q.target, (q.size * coalesce(n.times, 0))::bigint as taken
from q left join n on q.doc_id is not distinct from n.doc_id and q.source is not distinct from n.source and q.size = n.size and q.cum = n.cum
"""
