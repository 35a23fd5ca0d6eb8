"""Near-duplicate documents by b-bit MinHash.

1. *Sign.*  Each document's set of word shingles gives minima under 128 hash
   functions.  Runs of minima are the keys of bands; of every minimum only the
   low bits are kept, packed into four integers.  Documents of one set (equal
   128-bit checksum) are one node from here on.
2. *Candidates.*  Nodes that share a band's key are in one bucket.  A bucket's
   nodes aren't all paired.  First each is held against few centres of the
   bucket: two that hashing picks, and the one that is most alike to those.
3. *Estimate and confirm.*  Equal low bits, counted and corrected for chance
   collisions, estimate a pair's similarity; what may reach the threshold is
   confirmed on the full sets.  Confirmed links make components.
4. *The rest.*  In buckets that still hold several components, every node that
   isn't in the bucket's largest one is held against all nodes of the others.
   A pair is only made if its estimate and exact bounds allow a link: a
   shingle that stands in no other set can't be shared, and sets differ in at
   least as many shingles as their parity sketches (for each of 1024 places,
   whether an odd number of shingles falls there) differ in places.  So links between
   components are found, however many copies a bucket holds, and pairs within
   a component never are.

Steps 2 and 4 together hold every two nodes that share a bucket either against
each other or find them in one component already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tune, written
from .components import components
from .vec import mix, shingles, words

#: Hash functions, low bits kept of each minimum, and bands: a pair of 0.85 is
#: missed by all bands with a chance below one in two million, one of 0.8 with
#: one in twenty thousand.
HASHES, BITS = 128, 2
BANDS, ROWS = 25, 5
#: A pair is held against the full sets if its estimate is at most so many
#: standard errors below the threshold.
ERRORS = 6
#: Places of a parity sketch.
PLACES = 1024
#: Bits of a minimum below the highest, which are near 0 in a minimum.
_SHIFT = np.uint64(20)

_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SIGNED = "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, sig array<long>"


def minima(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of minima for each text that has shingles."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((HASHES, len(starts)), np.uint64)
    if len(starts):
        for k, f in enumerate(_FACTORS):
            np.minimum.reduceat(h * f, starts, out=out[k])
    return out.T


def pack(found: np.ndarray) -> np.ndarray:
    """The low bits of each row's minima in 64-bit integers."""
    low = (found >> _SHIFT) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    places = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
    return (low.reshape(len(low), -1, per) << places).sum(axis=2, dtype=np.uint64)


def _band_keys(found: np.ndarray) -> np.ndarray:
    key = np.zeros((len(found), BANDS), np.uint64)
    for b in range(BANDS):
        for r in range(ROWS):
            key[:, b] = mix(key[:, b] + found[:, b * ROWS + r], b + 1)
    return key


def sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    h, bounds = shingles(words(texts), n)
    return [np.unique(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _checksum(found: np.ndarray, salt: int) -> int:
    return int(mix(found, salt).sum(dtype=np.uint64).view(np.int64)) if len(found) else 0


def sign(docs: DataFrame, n: int, row: str | None = None) -> DataFrame:
    """doc_id, text to number of shingles, checksum of the set, band keys and
    packed bits (null text: empty; both arrays null for an empty set), and the
    text column ``row`` as it is."""
    tune(docs.sparkSession)
    carried = F.col(row) if row else F.lit(None)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, texts in text_slices(batch):
                own = sets(texts, n)
                size = np.array([len(s) for s in own])
                full = np.flatnonzero(size)
                found = minima(np.concatenate(own), np.concatenate([[0], np.cumsum(size)]))
                arrays = []
                for rows in (_band_keys(found), pack(found)):
                    col = [None] * len(texts)
                    for i, row in zip(full, rows.view(np.int64)):
                        col[i] = row
                    arrays.append(pa.array(col, pa.list_(pa.int64())))
                cols = [pa.array(ids[at : at + len(texts)], pa.int64()), pa.array(size.astype(np.int64))]
                cols += [pa.array([_checksum(s, k) for s in own], pa.int64()) for k in (1, 2)]
                cols += [*arrays, batch.column("row").slice(at, len(texts))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_shingles", "h1", "h2", "bands", "sig", "row"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", carried.cast("string").alias("row"))
    return texts.mapInArrow(run, f"{_SIGNED}, row string")


def _mismatches(a: str, b: str) -> Column:
    """Of two packed signatures, the places whose bits differ."""
    ones = sum(1 << (BITS * k) for k in range(64 // BITS))
    total = F.lit(0)
    for i in range(HASHES * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        total = total + F.bit_count(folded.bitwiseAND(F.lit(ones)))
    return total


def estimate(a: str, b: str) -> Column:
    """Similarity of the sets behind two packed signatures: the share of equal
    places, corrected for those that are equal by chance."""
    chance = 2.0**-BITS
    return (1 - _mismatches(a, b) / F.lit(float(HASHES)) - F.lit(chance)) / F.lit(1 - chance)


def least_estimate(percent: int) -> float:
    t, chance = percent / 100, 2.0**-BITS
    equal = t + (1 - t) * chance
    return t - ERRORS * float(np.sqrt(equal * (1 - equal) / HASHES)) / (1 - chance)


def _confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Of pairs (u, v) of nodes, those whose sets are alike enough."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(full.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
        .join(full.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
        .select("u", "v", "a", "b")
        .mapInArrow(run, "u long, v long")
    )


def parity(found: np.ndarray) -> np.ndarray:
    """Parity sketch of a set in 64-bit integers."""
    odd = np.bincount((found % np.uint64(PLACES)).astype(np.int64), minlength=PLACES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _odd_places(a: str, b: str) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(PLACES // 64)), F.lit(0))


def _full_sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, shingles, odd), the set and its parity sketch, of nodes (node, doc_id, h1, h2), from one document each."""
    names = ("node", "h1", "h2", "text")

    def run(batches):
        for batch in batches:
            node, h1, h2 = (batch.column(c).to_pylist() for c in names[:3])
            for at, texts in text_slices(batch):
                keep = []
                for i, s in enumerate(sets(texts, n), at):
                    # Rows of one doc_id may have different texts.
                    if (_checksum(s, 1), _checksum(s, 2)) == (h1[i], h2[i]):
                        keep.append((node[i], s.tobytes(), parity(s).view(np.int64)))
                kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
                cols = [pa.array(c, t) for c, t in zip(list(zip(*keep)) or [[], [], []], kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "shingles", "odd"])

    texts = docs.select(F.col("doc_id").cast("long").alias("_d"), "text")
    found = nodes.join(texts, F.col("doc_id").eqNullSafe(F.col("_d"))).select(*names).mapInArrow(run, "node long, shingles binary, odd array<long>")
    return found.dropDuplicates(["node"])


def _unshared(full: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, unshared): how many shingles stand in no other of the nodes' sets."""

    def run(batches):
        for batch in batches:
            own = [np.frombuffer(s, np.int64) for s in batch.column("shingles").to_pylist()]
            node = np.repeat(batch.column("node").to_numpy(), [len(s) for s in own])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), pa.array(node)], names=["shingle", "node"])

    each = full.select("node", "shingles").join(nodes, "node", "left_semi").mapInArrow(run, "shingle long, node long")
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    return alone.groupBy("node").agg(F.count(F.lit(1)).alias("unshared"))


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 85, row: str | None = None) -> DataFrame:
    """doc_id, text to doc_id, n_shingles, component_id (smallest doc_id that
    links reach), kept (doc_id is component_id).

    Words are what lies between ASCII white space, A-Z lower-cased; a document's
    set has its distinct runs of ``n`` words, or all its words as one run if it
    has fewer.  Links hold between sets of similarity ``percent`` or more.
    Documents without words (null text too) are linked with nothing.  Rows of
    one doc_id are documents of their own; if rows of one doc_id and text
    repeat, each is kept or none.  A null doc_id is never a component's
    smallest unless all are null, and never kept.  An empty table gives an
    empty result.

    With the name of a text column as ``row``, that column comes back with each
    row's verdict, and ``root``, a number of the row's component that doesn't
    depend on doc_ids (null without words)."""
    signed = written(sign(docs, n, row).withColumn("rid", F.monotonically_increasing_id()), "signed")
    classes = written(
        signed.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("least")), "classes"
    )
    nodes = signed.drop("row").join(classes.select(F.col("node").alias("rid")), "rid", "left_semi").withColumnRenamed("rid", "node")
    nodes = written(nodes, "nodes")

    keyed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("node", F.xxhash64("node")).alias("c1"), F.max_by("node", F.xxhash64("node")).alias("c2")
    )
    members = written(keyed.join(buckets.where("n > 1").drop("n"), "key"), "members")
    inside = members.select("node").distinct()
    full = written(_full_sets(docs, nodes.join(inside, "node", "left_semi").select("node", "doc_id", "h1", "h2"), n), "sets")

    def with_sig(pairs: DataFrame, column: str, name: str) -> DataFrame:
        return pairs.join(nodes.select(F.col("node").alias(column), F.col("sig").alias(name)), column)

    least = least_estimate(percent)
    star = members.select(F.col("node").alias("u"), F.explode(F.array("c1", "c2")).alias("v")).distinct()
    star = with_sig(with_sig(star, "u", "a"), "v", "b").select("u", "v", estimate("a", "b").alias("e"))
    star = written(star, "star")
    # The node most alike to the centres that hashing picked is a better one.
    central = star.groupBy(F.col("u").alias("node")).agg(F.avg("e").alias("e"))
    centre = members.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("e", "node")).alias("v"))
    second = members.join(centre, "key").select(F.col("node").alias("u"), "v").distinct().join(star, ["u", "v"], "left_anti")
    second = with_sig(with_sig(second, "u", "a"), "v", "b").where(estimate("a", "b") >= least).select("u", "v")
    pairs = star.where(F.col("e") >= least).select("u", "v").unionByName(second).where("u <> v")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = written(_confirmed(pairs, full, percent), "confirmed")

    rooted = written(
        members.select("key", "node").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
    )
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    open_ = written(rooted.join(open_.drop("roots"), "key"), "open")
    there = open_.select("node").distinct()
    about = (
        nodes.join(there, "node", "left_semi")
        .join(_unshared(full, there), "node", "left")
        .join(full.select("node", "odd"), "node")
        .select("node", F.col("n_shingles").alias("size"), (F.col("n_shingles") - F.coalesce("unshared", F.lit(0))).alias("shared"), "sig", "odd")
        # A node whose unshared shingles alone keep it below has no link.
        .where(100 * F.col("shared") >= percent * F.col("size"))
    )
    sides = written(open_.join(about, "node"), "sides")
    left = sides.where("root <> main")
    left = left.select("key", *[F.col(c).alias(f"l_{c}") for c in ("node", "root", "main", "size", "shared", "sig", "odd")])
    right = sides.select("key", *[F.col(c).alias(f"r_{c}") for c in ("node", "root", "size", "shared", "sig", "odd")])
    both = F.least("l_shared", "r_shared")
    rest = (
        left.join(
            right.withColumnRenamed("key", "_k"),
            (F.col("key") == F.col("_k"))
            & (F.col("l_root") != F.col("r_root"))
            & ((F.col("r_root") == F.col("l_main")) | (F.col("l_node") < F.col("r_node")))
            & (100 * both >= percent * (F.col("l_size") + F.col("r_size") - both))
            & (estimate("l_sig", "r_sig") >= least)
            & ((100 + percent) * _odd_places("l_odd", "r_odd") <= (100 - percent) * (F.col("l_size") + F.col("r_size"))),
        )
        .select(F.col("l_node").alias("u"), F.col("r_node").alias("v"))
        .distinct()
    )
    links = links.unionByName(written(_confirmed(rest, full, percent), "confirmed"))
    roots = components(links)

    grouped = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(smallest, "root").select("h1", "h2", "component_id", "root")
    some = signed.where("n_shingles > 0").join(named, ["h1", "h2"])
    none = signed.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn("root", F.lit(None).cast("long"))
    names = ("doc_id", "n_shingles", "component_id", *(("row", "root") if row else ()))
    return some.select(*names).unionByName(none.select(*names)).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
