"""Phrase collocation mining by direct-address tiling.

The frequent words of a language are numbered by falling frequency.  A pair of
numbers (i, j) is a cell of a square table that is cut into tiles of SIDE x SIDE
cells.  A tile that many pairs of a chunk fall into is counted densely, with
``numpy.bincount`` over its cell addresses; the few pairs of any other tile are
kept as sorted coordinates with counts.  Frequent pairs are then ranked and
numbered like words, and two numbers at neighbouring places are a pair again:
pairs of pairs are phrases of three words, pairs of those phrases of four.

A phrase reaches the minimum only if both its halves (all but the last word,
all but the first) do, so each level counts pairs of frequent phrases alone.
The most frequent phrases of a level (HEAD at most, each of NAME_BYTES at most)
are broadcast with their numbers.  Frequent phrases beyond them are found
through a broadcast bit table of fixed size: what it lets through is numbered
within the task and counted in full, so counts are exact at any size, and a
false hit only costs work.  Such numbers are pairs of numbers in arrays, not
texts, and are forgotten with the counts handed on when there are too many.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import tune, written

#: Cells of a tile's side, and how many pairs of a chunk make its tile a dense one.
SIDE = 256
DENSE = SIDE * SIDE // 16
#: Dense tiles that a task holds at most (half a MB each).
MAX_DENSE = 64
#: Numbered phrases of a level that are broadcast, and their longest names: 16 MB at most.
HEAD = 1 << 18
NAME_BYTES = 64
#: Places of the bit table for the others (16 MB); a power of two.
PLACES = 1 << 27
#: A task's sparse counts, or word counts, before they are handed on, so many rows at once;
#: half as many numbers of its own.
HELD, ROWS = 1_000_000, 250_000
#: Groups of a language's phrases that are ranked apart at first.
GROUPS = 64
#: Bytes of text that are split into words at once; longer texts go on in the next chunk.
CHUNK = 1 << 20

#: What ends a piece, what parts its words.  A byte that UTF-8
#: never holds stands for the end of a piece.
END = b"\xff"
_MAP = bytearray(range(256))
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _MAP[_c] = 0xFF
for _c in range(0x41, 0x5B):
    _MAP[_c] = _c + 32
_MAP[0x09] = 0x20
_MAP = bytes(_MAP)
_CUT = re.compile(b"[ \xff]")
#: The second number of a pair.
LOW = 0xFFFFFFFF

COUNTS = "lang string, phrase string, f long"


def _tokens(data: bytes) -> list[bytes]:
    return data.replace(END, b" \xff ").split()


def _chunks(texts: list[bytes]):
    """(tokens, whether they go on the chunk before) of one language's texts;
    END stands between pieces, and between texts."""
    short, size = [], 0
    for text in texts:
        if len(text) > CHUNK:
            data, at = text.translate(_MAP), 0
            while at < len(data):
                cut = _CUT.search(data, at + CHUNK)
                stop = cut.start() if cut else len(data)
                yield _tokens(data[at:stop]), at > 0
                at = stop
            continue
        short.append(text)
        size += len(text)
        if size > CHUNK:
            yield _tokens(END.join(short).translate(_MAP)), False
            short, size = [], 0
    if short:
        yield _tokens(END.join(short).translate(_MAP)), False


def _by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        out.setdefault(lang, []).append(text)
    return out


def _rows(lang: str, names, counts) -> pa.RecordBatch:
    names = names if isinstance(names, pa.Array) else pa.array(names, pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.repeat(lang, len(names)), names.cast(pa.string()), pa.array(counts, pa.int64())],
        names=["lang", "phrase", "f"],
    )


def _words(batches):
    """Counts of words by language, summed over what a task holds at once."""
    held: dict[str, Counter] = {}

    def flush():
        for lang, counts in held.items():
            counts.pop(END, None)
            yield _rows(lang, list(counts), list(counts.values()))
        held.clear()

    for batch in batches:
        for lang, texts in _by_lang(batch).items():
            for tokens, _ in _chunks(texts):
                held.setdefault(lang, Counter()).update(tokens)
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
    yield from flush()


class Tiles:
    """Counts of pairs of numbers: dense tiles, and sorted coordinates for the rest."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_sparse = 0

    def add(self, a: np.ndarray, b: np.ndarray, room: int | None = None) -> None:
        """``room``: dense tiles that may be held, MAX_DENSE if not given."""
        room = MAX_DENSE if room is None else room
        tile = (a // SIDE) << 32 | (b // SIDE)
        found, where, size = np.unique(tile, return_inverse=True, return_counts=True)
        # Most pairs first, while there is room for dense tiles.
        for k in np.argsort(-size, kind="stable"):
            if size[k] < DENSE:
                break
            if len(self.dense) < room:
                self.dense.setdefault(int(found[k]), np.zeros(SIDE * SIDE, np.int64))
        dense = np.array([int(t) in self.dense for t in found], bool)[where] if self.dense else np.zeros(len(a), bool)
        if dense.any():
            cell = (a[dense] % SIDE) * SIDE + b[dense] % SIDE
            of = where[dense]
            order = np.argsort(of, kind="stable")
            cell, of = cell[order], of[order]
            turns = np.flatnonzero(np.diff(of)) + 1
            for k, cells in zip(of[np.concatenate([[0], turns])], np.split(cell, turns)):
                self.dense[int(found[k])] += np.bincount(cells, minlength=SIDE * SIDE)
        if not dense.all():
            codes, n = np.unique(a[~dense] << 32 | b[~dense], return_counts=True)
            self.sparse.append((codes, n))
            self.n_sparse += len(codes)
            if len(self.sparse) > 16:
                self.merge()

    def merge(self) -> None:
        if len(self.sparse) < 2:
            return
        codes = np.concatenate([c for c, _ in self.sparse])
        counts = np.concatenate([n for _, n in self.sparse])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        self.sparse = [(codes[first], np.add.reduceat(counts, first))]
        self.n_sparse = len(first)

    def parts(self):
        """Pairs and their counts, a part at a time; nothing is held afterwards."""
        self.merge()
        sparse, dense = self.sparse, self.dense
        self.__init__()
        while sparse:
            codes, n = sparse.pop()
            for at in range(0, len(n), ROWS):
                part = codes[at : at + ROWS]
                yield part >> 32, part & LOW, n[at : at + ROWS]
        while dense:
            tile, counts = dense.popitem()
            at = np.flatnonzero(counts)
            yield (tile >> 32) * SIDE + at // SIDE, (tile & LOW) * SIDE + at % SIDE, counts[at]

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs and their counts; nothing is held afterwards."""
        parts = list(self.parts())
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3


def _place(name: bytes, start: int) -> int:
    """A phrase's place in the bit table, word by word."""
    for word in name.split(b" "):
        start = (start * 31 + zlib.crc32(word)) & (PLACES - 1)
    return start


def _found(codes: np.ndarray, numbers: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Numbers of pairs by sorted pairs, -1 for others; the last pair is none."""
    where = np.searchsorted(codes, wanted)
    return np.where(codes[where] == wanted, numbers[where], -1)


_NONE = np.array([np.iinfo(np.int64).max]), np.array([-1])


class _Level:
    """Numbers of one language's frequent phrases of one length in a worker:
    those that all tasks know alike, then those of its own, which ``reset``
    forgets.  ``before``: the level of phrases one word shorter, for all but words."""

    def __init__(self, lang: str, names, bits: np.ndarray | None, before: _Level | None):
        self.names = names if isinstance(names, pa.Array) else pa.array(names, pa.binary())
        self.head, self.bits, self.before = len(self.names), bits, before
        self.start = zlib.crc32(lang.encode()) & (PLACES - 1)
        #: Own numbers: words, or pairs of numbers; all pairs met so far, sorted, and what they are.
        self.words: list[bytes] = []
        self.own, self.met = np.zeros(0, np.int64), _NONE
        #: Places in the bit table and last words' checksums, of all numbers and of own ones.
        self.hashes = None
        self.own_hashes = [np.zeros(0, np.uint32)] * 2
        texts = self.names.to_pylist()
        if before is None:
            self.ends, self.ids = self.names, dict(zip(texts, range(self.head)))
            return
        self.ends = pa.array([x.rsplit(b" ", 1)[-1] for x in texts], pa.binary())
        halves = [x.rsplit(b" ", 1)[0] for x in texts], [x.split(b" ", 1)[1] for x in texts]
        a, b = (
            pc.fill_null(pc.index_in(pa.array(x, pa.binary()), value_set=before.names), -1).to_numpy().astype(np.int64) for x in halves
        )
        codes, there = a << 32 | b, (a >= 0) & (b >= 0)
        order = np.flatnonzero(there)[np.argsort(codes[there])]
        self.codes, self.numbers_of = np.append(codes[order], _NONE[0]), np.append(order, -1)
        # By name: phrases a half of which isn't among those that all tasks know.
        self.odd = {texts[i]: i for i in np.flatnonzero(~there).tolist()}
        self.odd_places = np.unique(np.array([_place(x, self.start) for x in self.odd], np.int64))

    def extra(self) -> int:
        """Own numbers, and pairs met."""
        return len(self.words) + len(self.met[0]) - 1

    def reset(self) -> None:
        """Forgets all own numbers."""
        for word in self.words:
            del self.ids[word]
        self.words, self.own, self.met = [], np.zeros(0, np.int64), _NONE
        if self.hashes is not None:
            self.hashes = [x[: self.head].copy() for x in self.hashes]
        self.own_hashes = [np.zeros(0, np.uint32)] * 2

    def _marked(self, places: np.ndarray) -> np.ndarray:
        """Whether the bit table lets them through."""
        if self.bits is None:
            return np.zeros(len(places), bool)
        return (self.bits[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def _odd_ones(self, places: np.ndarray) -> np.ndarray:
        return np.isin(places, self.odd_places) if self.odd else np.zeros(len(places), bool)

    def _hash(self, places, crcs) -> None:
        self.own_hashes = [np.append(x, np.asarray(y, np.uint32)) for x, y in zip(self.own_hashes, (places, crcs))]

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        """Of words, -1 for others."""
        out = np.fromiter(map(self.ids.get, tokens, repeat(-1)), np.int64, len(tokens))
        if self.bits is not None:
            missed = np.flatnonzero(out < 0)
            crcs = np.fromiter((zlib.crc32(tokens[i]) for i in missed.tolist()), np.int64, len(missed))
            places = (self.start * 31 + crcs) & (PLACES - 1)
            new = []
            for k in np.flatnonzero(self._marked(places)).tolist():
                word = tokens[missed[k]]
                if word == END:
                    continue
                if word not in self.ids:
                    self.ids[word] = self.head + len(self.words)
                    self.words.append(word)
                    new.append(k)
                out[missed[k]] = self.ids[word]
            self._hash(places[new], crcs[new])
        return out

    def pairs(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where this number and the next are both frequent."""
        at = np.flatnonzero((own[:-1] >= 0) & (own[1:] >= 0))
        return at, own[at], own[at + 1]

    def _texts(self, numbers: np.ndarray, known: pa.Array, others) -> pa.Array:
        """``known`` of numbers that all tasks know, ``others`` of the own ones, counted from 0."""
        mine = numbers >= self.head
        if not mine.any():
            return known.take(pa.array(numbers))
        first = known.take(pa.array(numbers[~mine]))
        both = pa.concat_arrays([first, others(numbers[mine] - self.head)])
        where = np.empty(len(numbers), np.int64)
        where[~mine], where[mine] = np.arange(len(first)), np.arange(len(first), len(numbers))
        return both.take(pa.array(where))

    def _own_words(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.words[i] for i in at.tolist()], pa.binary())

    def texts(self, numbers: np.ndarray) -> pa.Array:
        """The phrases of numbers."""
        if self.before is None:
            return self._texts(numbers, self.names, self._own_words)
        return self._texts(numbers, self.names, lambda at: self.before.joined(self.own[at] >> 32, self.own[at] & LOW))

    def lasts(self, numbers: np.ndarray) -> pa.Array:
        """Their last words."""
        if self.before is None:
            return self.texts(numbers)
        return self._texts(numbers, self.ends, lambda at: self.before.lasts(self.own[at] & LOW))

    def joined(self, a: np.ndarray, b: np.ndarray) -> pa.Array:
        """The phrases of numbers at neighbouring places."""
        return pc.binary_join_element_wise(self.texts(a), self.lasts(b), b" ")

    def _hashed(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the bit table of the phrases of two numbers, and their last words' checksums."""
        if self.hashes is None:
            self.hashes = [np.array([_place(x, self.start) for x in self.names.to_pylist()], np.uint32),
                           np.array([zlib.crc32(x) for x in self.ends.to_pylist()], np.uint32)]
        done = len(self.hashes[0]) - self.head
        if done < len(self.own_hashes[0]):
            self.hashes = [np.append(x, y[done:]) for x, y in zip(self.hashes, self.own_hashes)]
        crcs = self.hashes[1][b].astype(np.int64)
        return (self.hashes[0][a].astype(np.int64) * 31 + crcs) & (PLACES - 1), crcs

    def _meet(self, codes: np.ndarray, places: np.ndarray, crcs: np.ndarray) -> None:
        """Numbers pairs that were not met before."""
        numbers = np.full(len(codes), -1, np.int64)
        odd = np.flatnonzero(self._odd_ones(places))
        if len(odd):
            names = self.before.joined(codes[odd] >> 32, codes[odd] & LOW).to_pylist()
            numbers[odd] = [self.odd.get(x, -1) for x in names]
        new = np.flatnonzero((numbers < 0) & self._marked(places))
        numbers[new] = np.arange(len(new)) + self.head + len(self.own)
        self.own = np.append(self.own, codes[new])
        self._hash(places[new], crcs[new])
        all_codes, all_numbers = np.append(codes, self.met[0]), np.append(numbers, self.met[1])
        order = np.argsort(all_codes, kind="stable")
        self.met = all_codes[order], all_numbers[order]

    def next(self, own: np.ndarray, after: _Level) -> np.ndarray:
        """Numbers in the level after this one, by place."""
        at, a, b = self.pairs(own)
        codes = a << 32 | b
        got = _found(after.codes, after.numbers_of, codes)
        rest = np.flatnonzero(got < 0)
        if len(rest) and (after.bits is not None or after.odd):
            places, crcs = self._hashed(a[rest], b[rest])
            maybe = np.flatnonzero(after._marked(places) | after._odd_ones(places))
            rest, (found, first) = rest[maybe], np.unique(codes[rest[maybe]], return_index=True)
            new = after.met[0][np.searchsorted(after.met[0], found)] != found
            if new.any():
                after._meet(found[new], places[maybe][first[new]], crcs[maybe][first[new]])
            got[rest] = _found(*after.met, codes[rest])
        out = np.full(max(0, len(own) - 1), -1, np.int64)
        out[at] = got
        return out


_KEPT: dict[str, object] = {}


def _levels(shared, name: str) -> dict[str, list[_Level]]:
    """The worker's levels by language for what was broadcast under a name;
    those of another name go before its value comes."""
    if _KEPT.get("name") != name:
        _KEPT.clear()
        _KEPT.update({"name": name, "levels": {}})
    return _KEPT["levels"]


def _pairs(shared):
    """Counts of phrases one word longer than those of the last shared level."""
    name = uuid.uuid4().hex

    def run(batches):
        levels = _levels(shared, name)
        tiles: dict[str, Tiles] = {}

        def flush():
            for lang, t in tiles.items():
                for a, b, n in t.parts():
                    yield _rows(lang, levels[lang][-1].joined(a, b), n)
            tiles.clear()

        def full():
            if sum(t.n_sparse for t in tiles.values()) <= HELD:
                return False
            for t in tiles.values():
                t.merge()
            return sum(t.n_sparse for t in tiles.values()) > HELD // 2

        for batch in batches:
            for lang, texts in _by_lang(batch).items():
                if lang not in levels:
                    levels[lang] = []
                    for names, bits in shared.value:
                        levels[lang].append(_Level(lang, names.get(lang, []), bits, levels[lang][-1] if levels[lang] else None))
                own, before = levels[lang], []
                for tokens, goes_on in _chunks(texts):
                    if goes_on:
                        tokens = before + tokens
                    # As many words as a phrase of the last level has: a phrase
                    # that is counted here ends in this chunk.
                    before = tokens[-len(own) :]
                    words = own[0].numbers(tokens)
                    for level, after in zip(own, own[1:]):
                        words = level.next(words, after)
                    _, a, b = own[-1].pairs(words)
                    if len(a):
                        dense = sum(len(t.dense) for x, t in tiles.items() if x != lang)
                        tiles.setdefault(lang, Tiles()).add(a, b, MAX_DENSE - dense)
                    many = sum(x.extra() for all_of in levels.values() for x in all_of) > HELD // 2
                    if many or full():
                        yield from flush()
                    if many:
                        for x in (x for all_of in levels.values() for x in all_of):
                            x.reset()
        yield from flush()

    return run


def _head(counts: DataFrame, head: int) -> tuple[dict[str, pa.Array], np.ndarray | None]:
    """The most frequent phrases of each language in order of their numbers,
    ``head`` at most in all, and the bit table of the others (None: no others)."""
    short = F.octet_length("phrase") <= NAME_BYTES
    # Steps of a tenth: a phrase's step says how frequent it is.
    steps = counts.withColumn("_step", F.when(short, F.floor(F.log("f") * 10)).otherwise(-1))
    sizes = {r["_step"]: r["n"] for r in steps.groupBy("_step").agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total = max(sizes, default=0) + 1, 0
    for step in sorted((s for s in sizes if s >= 0), reverse=True):
        if total + sizes[step] > head:
            break
        least, total = step, total + sizes[step]
    table = steps.where(F.col("_step") >= least).select("lang", "phrase", "f").toArrow()
    names: dict[str, list] = {}
    for lang, phrase, f in zip(*(table.column(c).to_pylist() for c in ("lang", "phrase", "f"))):
        names.setdefault(lang, []).append((-f, phrase.encode()))
    ranked = {lang: pa.array([name for _, name in sorted(x)], pa.binary()) for lang, x in names.items()}
    if total == sum(sizes.values()):
        return ranked, None
    cut = lambda x: x.bitwiseAND(F.lit(PLACES - 1))
    place = F.aggregate(F.split("phrase", " "), cut(F.crc32("lang")), lambda at, w: cut(at * 31 + F.crc32(w)))
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    rest = (
        steps.where(F.col("_step") < least).select(place.alias("_place"))
        .groupBy(F.shiftright("_place", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    )
    bits = np.zeros(PLACES // 64, np.uint64)
    bits[rest.column("at").to_numpy()] = rest.column("bits").to_numpy().view(np.uint64)
    return ranked, bits


def _part(first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice("_words", first, n), " ")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate: lang, phrase, a, l, r, score."""
    cuts = candidates.withColumn("_words", F.split("phrase", " ")).select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("_words") - 1)).alias("k"), "_words"
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _part(1, F.col("k")).alias("_left"),
        _part(F.col("k") + 1, F.size("_words") - F.col("k")).alias("_right"),
    )
    for side, n in (("_left", "l"), ("_right", "r")):
        known = counts.select(F.col("lang"), F.col("phrase").alias(side), F.col("f").alias(n))
        cuts = cuts.join(known, ["lang", side])
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r)")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "a").agg(least.alias("_m")).select("lang", "phrase", "a", "_m.l", "_m.r", "_m.score")


def _covered(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that a longer one contains and nearly replaces."""
    words = candidates.select("lang", F.split("phrase", " ").alias("_words"), F.col("a").alias("_f"))
    length = F.col("_n")
    inner = (
        words.withColumn("_n", F.explode(F.sequence(F.lit(2), F.greatest(F.size("_words") - 1, F.lit(2)))))
        .where(length < F.size("_words"))
        .withColumn("_at", F.explode(F.sequence(F.lit(1), F.size("_words") - length + 1)))
        .select("lang", _part(F.col("_at"), length).alias("phrase"), "_f")
        .groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    )
    enough = F.expr(f"cast(_f as decimal(20, 0)) * 100 >= cast(a as decimal(20, 0)) * {percent}")
    return candidates.join(inner, ["lang", "phrase"]).where(enough).select("lang", "phrase")


def collocations(docs: DataFrame, longest: int = 4, min_count: int = 30, percent: int = 80, top: int = 2000,
                 head: int = HEAD) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: lang, rank,
    phrase, a, l, r, n, score.  Null lang: ``und``.  Null and empty texts hold
    no words; rows that repeat count as often as they occur; only lang and text
    are looked at; an empty table gives no rows."""
    spark = tune(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    ).where(F.length("text") > 0)

    def summed(counts: DataFrame, name: str) -> DataFrame:
        return written(counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f")), name)

    words = summed(texts.mapInArrow(_words, COUNTS), "collocations-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = [words.where(F.col("f") >= min_count)]
    levels = []
    for n in range(2, longest + 1):
        levels.append(_head(frequent[-1], head))
        shared = spark.sparkContext.broadcast(levels)
        counts = texts.mapInArrow(_pairs(shared), COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        frequent.append(written(counts.where(F.col("f") >= min_count), f"collocations-{n}"))
    counts = frequent[0]
    for more in frequent[1:]:
        counts = counts.unionByName(more)
    candidates = frequent[1]
    for more in frequent[2:]:
        candidates = candidates.unionByName(more)
    candidates = candidates.withColumnRenamed("f", "a")
    kept = _scored(candidates, counts).join(_covered(candidates, percent), ["lang", "phrase"], "left_anti")
    # First the best of so many groups of a language's phrases, then the best of all.
    best = kept.withColumn("_group", F.pmod(F.xxhash64("phrase"), F.lit(GROUPS)))
    for group in (("lang", "_group"), ("lang",)):
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: What ``collocations`` returns for the table ``documents``.
ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces
), grams as (
  select lang, k, array_to_string(ws[i : i + k - 1], ' ') as phrase from (
    select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from words, (select unnest([1, 2, 3, 4]) as k) where len(ws) >= k)
), f as (
  select lang, k, phrase, count(*)::bigint as f from grams group by all
), totals as (
  select lang, sum(f)::bigint as n from f where k = 1 group by lang
), candidates as (
  select lang, k as len, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1 and f >= 30
), cuts as (
  select c.lang, c.phrase, c.a, c.cut, l.f as l, r.f as r, (2000000::hugeint * c.a) // (l.f::hugeint + r.f) as score
  from (select *, unnest(range(1, len)) as cut from candidates) c
  join f l on l.lang = c.lang and l.k = c.cut and l.phrase = array_to_string(c.ws[1 : c.cut], ' ')
  join f r on r.lang = c.lang and r.k = c.len - c.cut and r.phrase = array_to_string(c.ws[c.cut + 1 : c.len], ' ')
), lowest as (
  select lang, phrase, a, l, r, score from cuts
  qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), inner_parts as (
  select lang, array_to_string(ws[i : i + m - 1], ' ') as phrase, max(a) as longer from (
    select lang, ws, a, m, unnest(range(1, len - m + 2)) as i from candidates, (select unnest([2, 3]) as m) where m < len)
  group by lang, array_to_string(ws[i : i + m - 1], ' ')
), kept as (
  select x.* from lowest x left join inner_parts p using (lang, phrase)
  where p.longer is null or 100::hugeint * p.longer < 80::hugeint * x.a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank from kept
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""
