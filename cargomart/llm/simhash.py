"""SimHash fingerprints, and all fingerprints within a Hamming radius.

Each distinct term of a text (runs of two words, and single words) has a
64-bit hash; its bits vote for or against the fingerprint's bits with the
term's weight.  Near fingerprints are found in permuted block tables: the 64
bits are cut into blocks, each table puts another choice of blocks in front,
and two fingerprints that differ in no more bits than blocks are left out
agree on the front of at least one table.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices, tune, written
from .vec import shingles, words

#: Weight of a term of n words that stands k times: WEIGHTS[n] * (1 + log2 k).
WEIGHTS = {1: 1, 2: 4}
RADIUS = 3
BLOCKS = 6


def _votes(terms: np.ndarray, weight: int) -> np.ndarray:
    found, times = np.unique(terms, return_counts=True)
    # Whole numbers in doubles: sums are exact in any order.
    w = np.floor(16 * weight * (1 + np.log2(times)))
    bits = np.unpackbits(found.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return 2 * (w @ bits) - w.sum()


def fingerprints(texts: list[str]) -> np.ndarray:
    """64-bit fingerprints; 0 for a text without words."""
    w = words(texts)
    pairs, bounds = shingles(w, 2)
    out = np.zeros(len(texts), np.uint64)
    for i in range(len(texts)):
        if len(single := w.of(i)):
            votes = _votes(single, WEIGHTS[1]) + _votes(pairs[bounds[i] : bounds[i + 1]], WEIGHTS[2])
            out[i] = np.packbits(votes > 0).view(">u8")[0]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1 - np.bitwise_count(a ^ b) / 64


def edit(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of the next one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_OUT = (
    "part int, role string, doc_id long, n_chars long, edited_sha256 string, fingerprint long, "
    "edited_fingerprint long, near_edited double, near_next double, text string"
)
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_ARROW = pa.schema(list(zip(_NAMES, (
    pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()
))))


def _rows(part: int, doc_ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    edited = [edit(t, f) for t, f in zip(texts, following)]
    n = len(texts)
    own, cut, nxt = np.split(fingerprints(texts + edited + following), 3)
    sha = [hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited]
    cols = (
        [part] * n, ["doc"] * n, doc_ids, [len(t) for t in texts], sha, own.view(np.int64), cut.view(np.int64),
        likeness(own, cut), likeness(own, nxt), [None] * n,
    )
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _edge(part: int, role: str, doc_id, text: str) -> pa.RecordBatch:
    row = dict.fromkeys(_NAMES) | {"part": part, "role": role, "doc_id": doc_id, "text": text}
    return pa.RecordBatch.from_pylist([row], schema=_ARROW)


def _along(batches):
    """Rows come in ascending order, so that the next document in descending
    order is the one before.  A partition's first document waits for the one at
    the end of the partition before."""
    part, last = TaskContext.get().partitionId(), None
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for at, texts in text_slices(batch):
            here = ids[at : at + len(texts)]
            if last is None:
                yield _edge(part, "first", here[0], texts[0])
                rows = _rows(part, here[1:], texts[1:], texts[:-1])
            else:
                rows = _rows(part, here, texts, [last[1], *texts[:-1]])
            if rows.num_rows:
                yield rows
            last = (here[-1], texts[-1])
    if last is not None:
        yield _edge(part, "last", *last)


def _meet(batches):
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "following")]
        yield _rows(0, cols[1], cols[2], cols[3])


def along(docs: DataFrame) -> DataFrame:
    """Of each document (doc_id, text; null: empty): n_chars, fingerprint, and
    the same of its text edited with the next document's, in descending order
    of doc_id (null last; rows of one doc_id by text; after the last, the
    first; a single document is next to itself).  An empty table gives an empty
    result.  One range shuffle of the texts; a task handles a few at a time."""
    tune(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    found = written(ordered.sortWithinPartitions("doc_id", "text").mapInArrow(_along, _OUT), "simhash")
    first, last = (found.where(F.col("role") == r).select("part", "doc_id", "text") for r in ("first", "last"))
    # Partitions, not documents: which one each partition's first looks back to.
    ends = last.select("part")
    order = Window.orderBy("part")
    back = ends.select("part", F.lag("part").over(order).alias("_b"), F.max("part").over(order.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)).alias("_m")).select("part", F.coalesce("_b", "_m").alias("back"))
    pairs = (
        first.join(back, "part")
        .join(last.select(F.col("part").alias("back"), F.col("text").alias("following")), "back")
        .select("part", "doc_id", "text", "following")
    )
    done = found.where(F.col("role") == "doc").unionByName(pairs.mapInArrow(_meet, _OUT))
    return done.drop("part", "role", "text")


def tables(fingerprint: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """Array of (table, front): the fingerprint's bits of each choice of
    ``blocks - radius`` blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    out = []
    for k, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in kept)
        mask -= (1 << 64) if mask >> 63 else 0
        out.append(F.struct(F.lit(k).alias("table"), fingerprint.bitwiseAND(F.lit(mask)).alias("front")))
    return F.array(*out)


def within(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs (query, fingerprint, distance) of distinct fingerprints at most
    ``radius`` bits apart, itself included.  Both frames have a column
    ``fingerprint`` (long).  Copies count once, so a large group of them is one
    row; ``radius`` below ``blocks``."""
    both = []
    for df, name in ((queries, "query"), (prints, "fingerprint")):
        one = df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct()
        both.append(one.select(name, F.inline(tables(F.col(name), radius, blocks))))
    apart = F.bit_count(F.col("query").bitwiseXOR(F.col("fingerprint")))
    q, p = both
    p = p.withColumnsRenamed({"table": "_t", "front": "_f"})
    return (
        q.join(p, (F.col("table") == F.col("_t")) & (F.col("front") == F.col("_f")) & (apart <= radius))
        .select("query", "fingerprint", apart.cast("int").alias("distance"))
        .distinct()
    )


def shown(fingerprint: Column) -> Column:
    """16 hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
