"""Ranked lexical search: one automaton of all items' terms reads the documents.

Every byte that is no part of a term becomes a space, and every term of an item
stands in an Aho-Corasick automaton between two spaces.  A scan of a text then
ends in an output state exactly where a whole term ends (two terms may share
the space between them), so term frequencies come straight from the text and no
index of the documents is kept.  An output is a term's number; its postings say
which items hold it and how often.

The texts are scanned twice: for the number of documents with each term (and
the corpus's totals), and for the scores.  A task keeps the best ``k`` documents
of each item only.  Items go through in blocks of bounded size, so what is
broadcast doesn't grow with them.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices, tune, written

#: Fixed value: a term, A-Z already lower-cased ([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+).
TERM = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (item, term) pairs of one block of items: what is broadcast at once.
BLOCK_PAIRS = 200_000
#: Cells of the table (documents x items), and parts of scores, that a task holds at once.
CELLS = 1 << 20
#: First the best of so many groups of documents, then the best of all.
GROUPS = 32

_SPREAD = bytearray(b" " * 256)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _SPREAD[_b] = _b
for _b in range(0x41, 0x5B):
    _SPREAD[_b] = _b + 32
_SPREAD = bytes(_SPREAD)

_second = itemgetter(1)


def spread(text: str) -> bytes:
    """A text's terms, lower-cased, between spaces (UTF-8)."""
    return b" " + text.encode("utf-8", "replace").translate(_SPREAD) + b" "


def n_terms_of(data: bytes) -> int:
    """Number of terms, repeats included, of a spread text."""
    inside = np.frombuffer(data, np.uint8) != 0x20
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


class Block:
    """Terms of a block of items, and for each term its items: ``item[at]`` and
    ``times[at]`` for ``at`` in ``starts[term]:starts[term + 1]``."""

    def __init__(self, pairs: pa.Table):
        terms = pairs.column("term").combine_chunks().dictionary_encode()
        items = pairs.column("item").combine_chunks().dictionary_encode()
        self.terms = [t.encode() for t in terms.dictionary.to_pylist()]
        self.items = np.array(items.dictionary.to_pylist(), np.int64)
        term = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(term, kind="stable")
        self.item = items.indices.to_numpy(zero_copy_only=False).astype(np.int64)[order]
        self.times = pairs.column("times").to_numpy().astype(np.int64)[order]
        self.starts = np.searchsorted(term[order], np.arange(len(self.terms) + 1))


_BUILT: dict[int, object] = {}


def _automaton(shared):
    """The worker's automaton of a broadcast block; the last one is kept."""
    if shared.value is not _BUILT.get("block"):
        import ahocorasick

        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(shared.value.terms):
            # One character a byte: the automaton then needs no wide letters.
            made.add_word(f" {term.decode('latin-1')} ", i)
        made.make_automaton()
        _BUILT.update(block=shared.value, made=made)
    return _BUILT["made"]


def _found(made, data: bytes) -> Counter:
    """How often each term of the block stands in a spread text."""
    return Counter(map(_second, made.iter(data.decode("latin-1"))))


def _frequencies(docs: DataFrame, shared) -> tuple[np.ndarray, int, int]:
    """Documents with each term of the block, documents with any term at all,
    and all their terms."""

    def count(batches):
        made, df = _automaton(shared), np.zeros(len(shared.value.terms), np.int64)
        with_terms = total = 0
        for batch in batches:
            for _, texts in text_slices(batch):
                for text in texts:
                    data = spread(text)
                    n = n_terms_of(data)
                    with_terms, total = with_terms + (n > 0), total + n
                    found = _found(made, data)
                    df[np.fromiter(found, np.int64, len(found))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *at.tolist()], pa.int64()), pa.array([total, with_terms, *df[at].tolist()], pa.int64())],
            names=["term", "n"],
        )

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = dict(zip(sums.column("term").to_pylist(), sums.column("n").to_pylist()))
    df = np.zeros(len(shared.value.terms), np.int64)
    for term, k in n.items():
        if term >= 0:
            df[term] = k
    return df, n.get(-1, 0), n.get(-2, 0)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The best ``k`` documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]  # item, score, doc_id, doc_id is null

    def add(self, scores: np.ndarray, doc_ids: np.ndarray, unknown: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        new = (item, scores[doc, item], doc_ids[doc], unknown[doc])
        item, score, doc_id, null = (np.concatenate(x) for x in zip(self.held, new))
        order = np.lexsort((doc_id, null, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - first[item[order]]
        order = order[rank < self.k]
        self.held = [x[order] for x in (item, score, doc_id, null)]
        full = np.flatnonzero(np.bincount(self.held[0], minlength=len(self.least)) == self.k)
        ends = np.searchsorted(self.held[0], full, side="right") - 1
        self.least[full] = self.held[1][ends]


def _ranked(docs: DataFrame, shared, df: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best documents of each of the block's items, ``k`` a task."""
    weights = np.array([weight(int(x), n_docs) for x in df], np.int64)

    def scan(batches):
        block, made = shared.value, _automaton(shared)
        best, spans = _Best(len(block.items), k), np.diff(block.starts)
        rows = max(1, CELLS // max(1, len(block.items)))

        def fill(ids, parts):
            doc, term, tf, m = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in parts)
            part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            each = spans[term]
            pair = np.repeat(np.arange(len(term)), each)
            at = block.starts[term][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
            cell = doc[pair] * len(block.items) + block.item[at]
            value = part[pair] * block.times[at]
            # Two halves, so that sums in doubles are exact.
            size = len(ids) * len(block.items)
            low = np.bincount(cell, (value & 0x3FFFFFF).astype(float), size).astype(np.int64)
            high = np.bincount(cell, (value >> 26).astype(float), size).astype(np.int64)
            best.add(
                ((high << 26) + low).reshape(len(ids), len(block.items)),
                np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids]),
            )

        ids, parts, wide = [], ([], [], [], []), 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, texts in text_slices(batch):
                for i, text in enumerate(texts):
                    data = spread(text)
                    n = n_terms_of(data)
                    found = _found(made, data)
                    if not found:
                        continue
                    m = 100 - 25 + (25 * n * n_docs) // n_terms
                    term, tf = (np.fromiter(x, np.int64, len(found)) for x in (found.keys(), found.values()))
                    for held, x in zip(parts, (np.full(len(term), len(ids)), term, tf, np.full(len(term), m))):
                        held.append(x)
                    ids.append(doc_ids[first + i])
                    wide += int(spans[term].sum())
                    if len(ids) == rows or wide >= CELLS:
                        fill(ids, parts)
                        ids, parts, wide = [], ([], [], [], []), 0
        if ids:
            fill(ids, parts)
        item, score, doc_id, null = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.items[item]), pa.array(doc_id, mask=null), pa.array(score)], names=["item", "doc_id", "score"]
        )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "item long, doc_id long, score long")


def _best(found: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = 20, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """For each item of ``items`` (item_id, text) its ``k`` documents with the
    highest scores above 0: item_id, rank (from 1), doc_id, score; ties by
    ascending doc_id, null last.

    Null and empty texts have no terms.  Rows of one item_id (null too) are one
    item, their terms taken together; rows of ``docs`` with one doc_id are
    documents of their own.  Other columns are not looked at; items without
    terms or matches, and empty tables, give no rows."""
    spark = tune(docs.sparkSession)
    lower = F.translate(F.col("text"), UPPER, LOWER)
    pairs = written(
        items.select(F.col("item_id").alias("_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
        .groupBy("_id", "term").agg(F.count(F.lit(1)).alias("times")),
        "lexical-pairs",
    )
    blocks = -(-pairs.count() // block_pairs)
    kind = items.schema["item_id"].dataType
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for b in range(blocks):
        # Item numbers are the items' places in order of item_id, null first.
        own = pairs.where(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == b)
        ids = own.select("_id").distinct().orderBy("_id").toArrow().column("_id")
        numbers = spark.createDataFrame(pa.table({"_id": ids, "item": pa.array(range(len(ids)), pa.int64())}))
        names = F.broadcast(numbers.select(F.col("_id").cast(kind).alias("_id"), "item"))
        table = own.join(names, own["_id"].eqNullSafe(names["_id"])).select("item", "term", "times").toArrow()
        if not table.num_rows:
            continue
        shared = spark.sparkContext.broadcast(Block(table.sort_by([("item", "ascending"), ("term", "ascending")])))
        df, n_docs, n_terms = _frequencies(docs, shared)
        if not df.any():
            continue
        found = written(_ranked(docs, shared, df, n_docs, n_terms, k), "lexical-found")
        few = _best(found.withColumn("_group", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS))), k, "item", "_group").drop("_group")
        out = out.unionByName(_best(few, k, "item").join(names, "item").select(F.col("_id").alias("item_id"), "rank", "doc_id", "score"))
    return out


#: What ``rank`` returns for the tables ``documents`` and ``benchmark``.
ORACLE = r"""
with terms as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') as ts
  from documents
), corpus as (
  select count(*)::bigint as n_docs, sum(len(ts))::bigint as n_terms from terms where len(ts) > 0
), tf as (
  select row, term, count(*)::bigint as tf from (select row, unnest(ts) as term from terms) group by all
), df as (
  select term, count(*)::bigint as df from tf group by all
), wanted as (
  select item_id, term, count(*)::bigint as times from (
    select item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
    from benchmark) group by all
), scores as (
  select item_id, row, any_value(doc_id) as doc_id,
         sum(times * floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint
             * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(ts) * n_docs) // n_terms))))::bigint as score
  from wanted join df using (term) join tf using (term) join terms using (row), corpus
  group by item_id, row
), ranked as (
  select item_id, doc_id, score,
         row_number() over (partition by item_id order by score desc, doc_id asc nulls last)::int as rank
  from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""
