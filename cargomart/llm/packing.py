"""Best-fit packing of token pieces into fixed-length sequences.

Pieces of one length are alike, so the packing problem is the histogram of
lengths.  A *configuration* is a multiset of lengths that fits one sequence;
the configuration linear program (as few sequences as possible, every piece
covered) is solved by multiplicative weights: lengths that are covered too
little gain weight, and the best configurations for the weights are priced by a
knapsack dynamic program over the sequence's places.  They enter in whole
numbers, round by round; the few pieces that no configuration covers in the end
are placed by best fit.  All of this works on counts by length (at most
``capacity`` of them), whatever the number of pieces.

Spark cuts the pieces, counts lengths, ranks the pieces of a length (in salted
groups, with offsets from the groups' counts) and looks a piece's place up by
(length, rank) in the plan's table of intervals.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices, tune, written
from .tokens import encoder

#: Step of the multiplicative weights, how much dearer a token of a long piece
#: is at first, and a token that stays empty (more than any piece's: 1 + 2 * CONVEX).
STEP, CONVEX, WASTE = 1.0, 10.0, 30.0
#: Pieces of one length that a knapsack may take; lengths within this share of
#: the capacity count as near, and so many tokens of a sequence may stay empty.
MANY, NEAR = 2, 32
#: Rows of a salted group that is ranked by one task.
GROUP_ROWS = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first."""
    first = (n - 1) % capacity + 1
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keeps_space: bool = True,
           with_ids: bool = False) -> DataFrame:
    """A row for each piece of each document (null text: empty, its end id
    alone).  ``with_ids`` keeps the ids, as little-endian 32-bit integers."""
    tune(docs.sparkSession)

    def run(batches):
        enc = encoder(tokenizer, keeps_space)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for at, texts in text_slices(batch):
                out = []
                for doc_id, ids in zip(doc_ids[at : at + len(texts)], enc.encode(texts, end_id)):
                    data = memoryview(ids.astype("<u4")).cast("B")
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        part = data[4 * s : 4 * (s + n)]
                        out.append((doc_id, k, s, n, zlib.crc32(part), bytes(part) if with_ids else None))
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
    return found if with_ids else found.drop("ids")


def _knapsack(lengths: list[int], most: list[int], price: list[float], capacity: int) -> tuple[np.ndarray, list[tuple]]:
    """For every room up to the capacity the most valuable filling that leaves
    nothing empty (-1: none), with at most ``most`` pieces of each length; and
    the choices made, for ``_fillings``."""
    best = np.full(capacity + 1, -1.0)
    best[0] = 0
    rows = []
    for i, (x, left, worth) in enumerate(zip(lengths, most, price)):
        k = 1
        while left > 0:
            k = min(k, left)
            step = x * k
            got = best[:-step] + worth * k
            got[best[:-step] < 0] = -1
            better = got > best[step:]
            np.copyto(best[step:], got, where=better)
            rows.append((i, k, step, better))
            left, k = left - k, 2 * k
    return best, rows


def _fillings(rows: list[tuple], rooms: list[int]) -> list[Counter]:
    """Index and number of the pieces that the knapsack's table puts into each room."""
    at, out = np.array(rooms, dtype=int), [Counter() for _ in rooms]
    for i, k, step, better in reversed(rows):
        fits = at >= step
        take = fits & better[np.where(fits, at - step, 0)]
        for j in np.flatnonzero(take).tolist():
            out[j][i] += k
        at = at - step * take
    return out


def _rounded(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Counter, int]], dict[int, int]]:
    """Configurations of the linear program and how many sequences each makes,
    and the pieces that none of them covers.

    A round prices configurations by one knapsack table: the best filling of
    the room beside each long piece (more than half a sequence; no two stand
    together), or of a whole sequence when no long piece is left.  A length's
    price grows faster than the length, so that the short ones are kept for the
    small rooms, and is multiplied up while the lengths around it are covered
    less than the whole, and down while they are covered more.  A configuration
    enters at the greatest whole number that the uncovered counts allow: the
    solution is rounded as it is made, and what is left is priced anew."""
    lengths = np.array(sorted(counts), dtype=int)
    n = np.array([counts[x] for x in lengths.tolist()], dtype=np.int64)
    rest, made = n.copy(), []
    short = np.flatnonzero(lengths <= capacity // 2)
    long = np.flatnonzero(lengths > capacity // 2)[::-1].tolist()
    near = capacity // NEAR
    low, high = np.searchsorted(lengths, lengths - near), np.searchsorted(lengths, lengths + near, side="right")
    around = lambda x: (sums := np.concatenate([[0], np.cumsum(x)]))[high] - sums[low]
    of_all, total = around(n), float((n * lengths).sum())
    slack = np.arange(near + 1)
    while rest.any():
        lag = around(rest) / of_all - float((rest * lengths).sum()) / total
        price = lengths * (1 + CONVEX * lengths / capacity) * np.exp(STEP * lag)
        own = short[rest[short] > 0]
        most = np.minimum(np.minimum(MANY, rest[own]), capacity // lengths[own]).tolist()
        best, rows = _knapsack(lengths[own].tolist(), most, price[own].tolist(), capacity)
        # A room may stay a little empty, at more than any piece's price for the tokens.
        value = np.where(best >= 0, best, -np.inf)
        less = np.full((near + 1, capacity + 1), -np.inf)
        for w in slack.tolist():
            less[w, w:] = value[: capacity + 1 - w] - WASTE * w
        empty, found = less.argmax(axis=0), less.max(axis=0) > -np.inf
        leads = [x for x in long if rest[x] > 0 and found[capacity - lengths[x]]]
        rooms = [capacity - int(lengths[x]) for x in leads]
        if not leads and len(own) and found[capacity]:
            leads, rooms = [None], [capacity]
        used = False
        for lead, filling in zip(leads, _fillings(rows, [r - int(empty[r]) for r in rooms])):
            need = Counter({int(own[i]): k for i, k in filling.items()})
            if lead is not None:
                need[lead] += 1
            times = min(int(rest[i]) // k for i, k in need.items())
            if times:
                for i, k in need.items():
                    rest[i] -= times * k
                made.append((Counter({int(lengths[i]): k for i, k in need.items()}), times))
                used = True
        if not used:
            break
    return made, {int(x): int(k) for x, k in zip(lengths, rest) if k}


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing on counted pieces: each, longest first, goes to the
    fullest sequence that has room for it.  Sequences that are alike are one."""
    rooms: dict[int, list[tuple[Counter, int]]] = {}

    def put(config: Counter, room: int, x: int, each: int, times: int) -> None:
        rooms.setdefault(room - each * x, []).append((config + Counter({x: each}), times))

    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            room = min((r for r in rooms if r >= x), default=None)
            if room is None:
                each = min(capacity // x, left)
                put(Counter(), capacity, x, each, left // each)
                left %= each
                continue
            config, there = rooms[room].pop()
            each = min(room // x, left)
            times = min(there, left // each)
            if times < there:
                rooms[room].append((config, there - times))
            if not rooms[room]:
                del rooms[room]
            put(config, room, x, each, times)
            left -= times * each
    return [x for group in rooms.values() for x in group]


@dataclass
class Plan:
    """Sequences of one full piece, of the linear program's rounded
    configurations, and of what best fit did with the rest; no plan of these
    counts has fewer sequences than ``bound``."""

    full: list[tuple[Counter, int]]
    rounded: list[tuple[Counter, int]]
    rest: list[tuple[Counter, int]]
    bound: int

    def all(self) -> list[tuple[Counter, int]]:
        return [*self.full, *self.rounded, *self.rest]


def solve(counts: dict[int, int], capacity: int) -> Plan:
    """``counts``: pieces by length, every length within the capacity."""
    left = {x: k for x, k in counts.items() if k > 0}
    whole = left.pop(capacity, 0)
    full = [(Counter({capacity: 1}), whole)] if whole else []
    # Prices by length, and prices of one for each long piece, are feasible in
    # the dual program; their sums bound every solution.
    bound = max(-(-sum(x * k for x, k in left.items()) // capacity), sum(k for x, k in left.items() if x > capacity // 2))
    made, rest = _rounded(left, capacity) if left else ([], {})
    plan = Plan(full, made, best_fit(rest, capacity), whole + bound)
    plain = best_fit(left, capacity)
    if sum(t for _, t in plain) < sum(t for _, t in [*plan.rounded, *plan.rest]):
        plan.rounded, plan.rest = [], plain
    return plan


def plan(counts: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """(configuration, number of sequences) that hold exactly the counted pieces."""
    return solve(counts, capacity).all()


def _intervals(made: list[tuple[Counter, int]]) -> tuple[np.ndarray, ...]:
    """For the pieces of each length by rank: (length << 40 | first rank, first
    sequence, place in it), sorted."""
    rows, seen, seq = [], Counter(), 0
    for config, times in made:
        place = 0
        for x, k in sorted(config.items(), reverse=True):
            for _ in range(k):
                rows.append(((x << 40) | seen[x], seq, place))
                seen[x] += times
                place += x
        seq += times
    rows.sort()
    keys, seqs, places = zip(*rows) if rows else ((), (), ())
    return np.array(keys, "i8"), np.array(seqs, "i8"), np.array(places, "i8")


def place(cut_pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``.  ``cut_pieces`` is read three times:
    give a written table.  Sequences have no gaps but at their end; ids run
    from 0.  Same input, same result."""
    counts = {r["length"]: r["count"] for r in cut_pieces.groupBy("length").count().collect()}
    total = sum(counts.values())
    keys, seqs, places = _intervals(plan(counts, capacity))
    names = cut_pieces.columns
    salted = cut_pieces.withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(1, -(-total // GROUP_ROWS))))
    )
    before = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before",
        F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)),
    )
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(own).cast("long") - 1)
        .join(before.drop("_n"), ["length", "_salt"])
        .withColumn("_rank", F.col("_rank") + F.coalesce("_before", F.lit(0)))
        .select(*names, "_rank")
    )

    def run(batches):
        for batch in batches:
            x, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (x << 40) | rank, side="right") - 1
            cols = [batch.column(c) for c in names]
            cols += [pa.array(seqs[at] + rank - (keys[at] & ((1 << 40) - 1))), pa.array(places[at])]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in cut_pieces.dtypes)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, keeps_space: bool = True,
         with_ids: bool = False) -> DataFrame:
    """Documents (doc_id, text) to placed pieces.  A null or empty text is one
    piece, its end id.  Rows with the same doc_id are documents of their own.
    An empty table gives an empty result."""
    return place(written(pieces(docs, tokenizer, end_id, capacity, keeps_space, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from placed pieces with ids: sequence_id,
    length, ids (little-endian 32-bit integers), doc_ids in order."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    got = placed.groupBy("sequence_id").agg(rows.alias("_p"))
    return got.select(
        "sequence_id",
        F.aggregate("_p", F.lit(0).cast("long"), lambda a, p: a + p["length"]).alias("length"),
        F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"),
    )
