"""Document quality by a linear-chain conditional random field over lines.

A document is a chain of lines, each good or bad.  A line is seen through its
own features and those of the lines before and after it; pairs of neighbouring
labels have weights of their own.  Only documents are labelled: every line of a
sampled document starts with its document's label, and lines of bad documents
that the fitted chain holds for surely good are relabelled before the next fit.

A document's quality is the mean of its lines' marginals (forward-backward),
weighted by their length, read through a logistic curve that is fitted on the
sampled documents' own means.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tune, written
from .vec import NOT_SPACE, mix, words

#: Labelled documents of each label used for fitting at most (by hash of
#: doc_id), and consecutive lines of each, from a place that its hash picks.
MAX_GOOD, MAX_BAD, TRAIN_LINES = 3_000, 1_500, 64
#: Fits, and from which marginal on a line of a bad document counts as good.
FITS, SURELY_GOOD = 2, 0.98
#: Rounds, step and decay of a fit (Adam).
ROUNDS, STEP, DECAY = 200, 0.1, 1e-4
#: From this score on a document counts as good.
THRESHOLD = 0.5
#: Cells (documents x lines) of a table that is gone through at once.
CELLS = 1 << 18

_UPPER, _LETTER, _DIGIT, _STOP, _MARK, _BAR = (np.zeros(256, bool) for _ in range(6))
_UPPER[range(0x41, 0x5B)] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT[range(0x30, 0x3A)] = True
_STOP[[ord(c) for c in ".,;:?'\"()-"]] = True
_MARK[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{}~"]] = True
_BAR[[ord("|"), 0x09, ord("{"), ord("}")]] = True
#: Above which a share counts as more than little, and as much.
_LITTLE, _MUCH = 0.03, 0.25


def _sums(values: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(line, weights=values, minlength=n)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of numbers from 0 to 1 for each line, its length in bytes, and
    where each text's lines start (and, last, end).  An empty text is one line."""
    w = words(texts, NOT_SPACE)
    raw = np.frombuffer(b"\n".join(t.encode("utf-8", "replace") for t in texts) + b"\n", np.uint8)
    ends = np.flatnonzero(raw == 0x0A)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, size = len(ends), ends - starts
    bounds = np.concatenate([np.searchsorted(starts, w.texts), [n]])
    of_text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    line_of_byte = np.repeat(np.arange(n), size + 1)
    long = np.maximum(size, 1)
    share = lambda kind: _sums(kind[raw], line_of_byte, n) / long
    letters = np.maximum(_sums(_LETTER[raw], line_of_byte, n), 1)

    line = np.searchsorted(starts, w.first, side="right") - 1
    count = _sums(np.ones(len(line)), line, n)
    many = np.maximum(count, 1)
    width = (w.end - w.first).astype(float)
    last = raw[w.end - 1] if len(w.end) else raw[:0]
    # A word, and how often it has stood in its line, and in its text, before.
    new, seen = np.zeros(len(line)), np.zeros(len(line))
    new[np.unique(mix(w.hash ^ mix(line.astype(np.uint64))), return_index=True)[1]] = 1
    seen[np.unique(mix(w.hash ^ mix(of_text[line].astype(np.uint64), 1)), return_index=True)[1]] = 1
    # Lines by their words, to find those that a text repeats.
    whole = np.zeros(n, np.uint64)
    np.add.at(whole, line, w.hash * (np.arange(len(line), dtype=np.uint64) - np.searchsorted(line, line).astype(np.uint64) + np.uint64(1)))
    _, same, times = np.unique(mix(whole ^ mix(of_text.astype(np.uint64), 2)), return_inverse=True, return_counts=True)

    shares = np.stack([
        _sums(_UPPER[raw], line_of_byte, n) / letters, share(_LETTER), share(_DIGIT), share(_STOP), share(_MARK), share(_BAR),
        _sums(~(_LETTER | _DIGIT | _STOP)[last], line, n) / many, _sums(_MARK[last], line, n) / many,
        1 - _sums(new, line, n) / many, 1 - _sums(seen, line, n) / many,
        _sums(width <= 2, line, n) / many, _sums(width >= 15, line, n) / many,
    ], axis=1)
    plain = np.stack([
        np.minimum(_sums(width, line, n) / many / 20, 1), np.minimum(np.log1p(count) / 8, 1), np.minimum(np.log1p(size) / 12, 1),
        count == 0, count <= 3, times[same] > 1, _STOP[raw[np.maximum(ends - 1, 0)]] & (size > 0), _UPPER[raw[starts]],
    ], axis=1).astype(float)
    shares = np.clip(shares, 0, 1)
    return np.hstack([shares, np.sqrt(shares), shares > _LITTLE, shares > _MUCH, plain]).astype(np.float32), size + 1, bounds


def in_context(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features with those of the lines before and after it in its
    text, and whether there are such lines."""
    first, last = np.zeros(len(x), bool), np.zeros(len(x), bool)
    there = bounds[:-1] < bounds[1:]
    first[bounds[:-1][there]] = last[bounds[1:][there] - 1] = True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0, 0
    return np.hstack([x, before, after, np.stack([first, last, np.ones(len(x))], axis=1).astype(np.float32)])


@dataclass
class Chain:
    """Weights of features for a good line against a bad one, of pairs of labels
    (bad, good), and the curve from a document's mean to its score."""

    emit: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def marginals(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """How likely each line is good, given its whole chain."""
        score = in_context(x, bounds) @ self.emit.astype(np.float32)
        out = np.zeros(len(x))
        size = np.diff(bounds)
        # Chains of about one length together; a long chain is a table of its own.
        order = np.argsort(size, kind="stable")[np.count_nonzero(size == 0) :]
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and size[order[stop]] <= max(8, 2 * size[order[at]]) and size[order[stop]] * (stop - at + 1) <= CELLS:
                stop += 1
            own = order[at:stop]
            table, there, where = _table(score.astype(float), bounds, own)
            p, _, _ = forward_backward(table, there, self.move)
            out[where[there]] = p[there]
            at = stop
        return out

    def score(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * mean + self.shift, -50, 50)))


def _table(score: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains as rows of a table, padded: scores, which cells are real, and the
    line of each."""
    size = bounds[own + 1] - bounds[own]
    steps = np.arange(size.max())
    there = steps < size[:, None]
    where = np.where(there, bounds[own][:, None] + steps, 0)
    return np.where(there, score[where], 0.0), there, where


def forward_backward(score: np.ndarray, there: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains in rows (``score``: log odds of good by its features alone): the
    marginals of good, each chain's log partition sum, and the expected number of
    each pair of neighbouring labels over all chains."""
    n, t = score.shape
    emit = np.stack([np.zeros_like(score), score], axis=2)
    forth, back = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    forth[:, 0] = emit[:, 0]
    for k in range(1, t):
        go = np.logaddexp(forth[:, k - 1, 0, None] + move[0], forth[:, k - 1, 1, None] + move[1]) + emit[:, k]
        forth[:, k] = np.where(there[:, k, None], go, forth[:, k - 1])
    for k in range(t - 2, -1, -1):
        on = emit[:, k + 1] + back[:, k + 1]
        go = np.logaddexp(on[:, 0, None] + move[:, 0], on[:, 1, None] + move[:, 1])
        back[:, k] = np.where(there[:, k + 1, None], go, 0.0)
    z = np.logaddexp(forth[:, -1, 0], forth[:, -1, 1])
    p = np.exp(forth[:, :, 1] + back[:, :, 1] - z[:, None])
    pairs = np.zeros((2, 2))
    if t > 1:
        both = forth[:, :-1, :, None] + move + (emit + back)[:, 1:, None, :] - z[:, None, None, None]
        pairs = np.where(there[:, 1:, None, None], np.exp(np.minimum(both, 0)), 0.0).sum(axis=(0, 1))
    return p, z, pairs


def fit(x: np.ndarray, bounds: np.ndarray, good: np.ndarray, importance: np.ndarray) -> Chain:
    """Greatest likelihood of the lines' labels, by chain weighted with
    ``importance``; no chance is involved."""
    x = np.ascontiguousarray(in_context(x, bounds))
    own = np.arange(len(bounds) - 1)
    share = importance / importance.sum()
    line_share = np.repeat(share, np.diff(bounds))
    # By weight class, so that expected pairs need one table each.
    classes = [own[importance == v] for v in np.unique(importance)]
    emit, move = np.zeros(x.shape[1]), np.zeros((2, 2))
    m = [np.zeros_like(emit), np.zeros_like(move)]
    v = [np.zeros_like(emit), np.zeros_like(move)]
    y = good.astype(float)
    real = []
    for c in classes:
        table, there, where = _table(y, bounds, c)
        a, b, both = table[:, :-1].astype(int), table[:, 1:].astype(int), there[:, 1:]
        real.append((there, where, np.bincount((a * 2 + b)[both], minlength=4).reshape(2, 2)))
    for step in range(1, ROUNDS + 1):
        score = (x @ emit.astype(np.float32)).astype(float)
        off, pair_off = np.zeros(len(x)), np.zeros((2, 2))
        for c, (there, where, pairs) in zip(classes, real):
            p, _, expected = forward_backward(np.where(there, score[where], 0.0), there, move)
            off[where[there]] = p[there] - y[where[there]]
            pair_off += (expected - pairs) * share[c[0]]
        grads = [x.T @ (off * line_share).astype(np.float32) + DECAY * emit, pair_off + DECAY * move]
        params = []
        for i, (value, g) in enumerate(zip((emit, move), grads)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            params.append(value - STEP * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8))
        emit, move = params
    return Chain(emit, move)


def _curve(mean: np.ndarray, good: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Logistic regression of a document's label on its mean (Newton, with a
    pull towards the curve that is one half at a mean of one half)."""
    prior = np.array([8.0, -4.0])
    a = prior.copy()
    d = np.stack([mean, np.ones_like(mean)], axis=1)
    share = importance / importance.sum() * len(mean)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(d @ a, -50, 50)))
        g = d.T @ ((p - good) * share) + 0.1 * (a - prior)
        h = (d * (p * (1 - p) * share)[:, None]).T @ d + 0.1 * np.eye(2)
        a = a - np.linalg.solve(h, g)
    return float(a[0]), float(a[1])


def means(p: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each document's mean marginal, weighted by the lines' lengths."""
    of_text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n = len(bounds) - 1
    return np.bincount(of_text, weights=p * size, minlength=n) / np.bincount(of_text, weights=size, minlength=n)


def train(docs: DataFrame, labels: DataFrame, max_good: int = MAX_GOOD, max_bad: int = MAX_BAD) -> Chain:
    """Fits on labelled documents whose crc32 of doc_id as text leaves no 1 when
    divided by 3: at most ``max_good`` and ``max_bad`` of them, with TRAIN_LINES
    lines each at most, both labels counting alike.  Labels other than 0 and 1
    are no labels; a doc_id with both is bad.  The sample's features come to the
    driver, bounded by these numbers.  Without documents of both labels nothing
    is learned and every score is one half."""
    tune(docs.sparkSession)
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("good"))
        .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    )
    nothing = Chain(np.zeros(3 * 56 + 3), np.zeros((2, 2)), 0.0, 0.0)
    pick = lambda y, n: known.where(F.col("good") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = pick(1, max_good).unionByName(pick(0, max_bad))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")

    def run(batches):
        for batch in batches:
            doc_ids, label = batch.column("doc_id").to_pylist(), batch.column("good").to_pylist()
            for at, texts in text_slices(batch):
                x, size, bounds = features(texts)
                rows = []
                for i in range(len(texts)):
                    a, b = int(bounds[i]), int(bounds[i + 1])
                    if b - a > TRAIN_LINES:
                        a += doc_ids[at + i] * 0x9E3779B1 % (b - a - TRAIN_LINES + 1)
                        b = a + TRAIN_LINES
                    rows.append((doc_ids[at + i], label[at + i], x[a:b].tobytes(), size[a:b].astype("<i8").tobytes()))
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "good", "x", "size"])

    table = sample.select("doc_id", "good", "text").mapInArrow(run, "doc_id long, good int, x binary, size binary")
    got = written(table, "quality-sample").orderBy("doc_id", "good", "x").toArrow()
    good = np.array(got.column("good").to_pylist(), dtype=float)
    if not 0 < good.sum() < len(good):
        return nothing
    sizes = [np.frombuffer(b, "<i8") for b in got.column("size").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sizes])])
    size = np.concatenate(sizes)
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(len(size), -1)
    importance = np.where(good == 1, 1 / good.sum(), 1 / (len(good) - good.sum()))
    given = np.repeat(good, np.diff(bounds))
    y = given
    for k in range(FITS):
        chain = fit(x, bounds, y, importance)
        p = chain.marginals(x, bounds)
        y = np.where((given == 0) & (p >= SURELY_GOOD), 1.0, given)
    chain.slope, chain.shift = _curve(means(p, size, bounds), good, importance)
    return chain


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """Adds ``score`` and ``lines``, each line's marginal in order (null and empty
    texts: one empty line); columns of these names are replaced.  No row is
    dropped or merged; an empty table gives no rows."""
    tune(docs.sparkSession)
    docs = docs.drop("score", "lines")
    names = docs.columns

    def run(batches):
        for batch in batches:
            scores, lines = [], []
            for _, texts in text_slices(batch):
                x, size, bounds = features(texts)
                p = chain.marginals(x, bounds)
                scores += chain.score(means(p, size, bounds)).tolist()
                lines += np.split(p, bounds[1:-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(lines, pa.list_(pa.float64()))], names=[*names, "score", "lines"]
            )

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{kinds}, score double, lines array<double>")
