"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a logistic score from its
words, and the document's is their noisy-or: it is toxic unless no sentence
is.  Only documents are labelled; the gradient of their likelihood puts the
blame on the sentences that explain the labels, and afterwards a sentence's
own score locates the offence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, tune, written
from .vec import ALNUM, Words, words

#: Labelled documents of each label used for fitting at most (by hash of doc_id).
MAX_TOXIC, MAX_CLEAN = 2_000, 4_000
#: A word's features: itself, and its first bytes, so many; stems that take
#: many endings are learned by these.
PREFIXES = (3, 4, 5, 6)
#: A feature stands in so many documents at least, and its shares of toxic and
#: clean documents differ by so many standard errors.
MIN_DOCS, MIN_Z = 5, 2.5
#: Rounds and step of the fit, and the weights' decay.
ROUNDS = 250
STEP = 0.2
DECAY = 3e-5
#: From this score on a document, or a sentence, counts as toxic.
THRESHOLD = 0.5

#: Bytes that end a sentence.
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word its sentence, numbered over all texts from 0 without
    gaps, and for each sentence its text."""
    stops = np.concatenate([[0], np.cumsum(_STOPS[w.data])])[w.first]
    text = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    new = np.ones(len(stops), bool)
    new[1:] = (stops[1:] != stops[:-1]) | (text[1:] != text[:-1])
    return np.cumsum(new) - 1, text[new]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def features(texts: list[str]) -> tuple[Words, np.ndarray]:
    """Words, and a row of feature hashes for the words and for each prefix."""
    w = words(texts, ALNUM, PREFIXES)
    return w, np.vstack([w.hash[None], w.prefix]) if len(w.hash) else np.zeros((1 + len(PREFIXES), 0), np.uint64)


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash in the vocabulary, or -1."""
        if not len(self.vocabulary):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def logits(self, hashes: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        z = np.full(n, self.bias)
        for row in hashes:
            at = self.known(row)
            z += np.bincount(sentence[at >= 0], weights=self.weights[at[at >= 0]], minlength=n)
        return z


def fit(labels: np.ndarray, importance: np.ndarray, sentences_of: np.ndarray, x: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """Weights of ``n`` features and the bias.  ``labels`` and ``importance`` by
    document, ``sentences_of`` its number of sentences; feature ``x[i]`` stands
    in sentence ``s[i]``, sentences numbered over all documents.  Full-batch
    steps scaled by weight and slowly shortened; no chance is involved."""
    bag = np.repeat(np.arange(len(labels)), sentences_of)
    total = len(bag)
    importance = importance / importance.sum()
    w, g2, b2 = np.zeros(n), np.full(n, 1e-10), 1e-10
    bias = float(np.log((importance @ labels) / max(1.0, float(sentences_of.mean()))))
    for k in range(ROUNDS):
        step = STEP / (1 + k / 50)
        z = bias + np.bincount(s, weights=w[x], minlength=total)
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        sums = np.bincount(bag, weights=_softplus(z), minlength=len(labels))
        # Of -log likelihood by each sentence's logit.
        blame = np.where(labels == 1, -np.exp(-sums) / np.maximum(-np.expm1(-sums), 1e-12), 1.0)
        d = p * (blame * importance)[bag]
        g = np.bincount(x, weights=d[s], minlength=n) + DECAY * w
        g2 = 0.95 * g2 + 0.05 * g * g
        w -= step * g / (np.sqrt(g2) + 1e-6)
        db = float(d.sum())
        b2 = 0.95 * b2 + 0.05 * db * db
        bias -= step * db / (np.sqrt(b2) + 1e-6)
    return w, bias


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Fits on labelled documents whose crc32 of doc_id as text isn't divisible
    by 5: at most ``max_toxic`` and ``max_clean`` of them, weighted so that both
    labels count as often as they occur.  Labels other than 0 and 1 are no
    labels; a doc_id with both is toxic.  The sample's ids are broadcast and
    its known features come to the driver, both bounded by the sample.  Without
    documents of both labels nothing is learned and every score is about 0."""
    tune(docs.sparkSession)
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    )
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)
    there = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(there) < 2:
        return nothing
    pick = lambda y, n: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = pick(1, max_toxic).unionByName(pick(0, max_clean))
    # One row a document; few enough for a few tasks.
    sample = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "text"),
        "toxicity-sample",
    )

    def count(batches):
        for batch in batches:
            label = np.array(batch.column("toxic").to_pylist())
            for at, texts in text_slices(batch):
                w, hashes = features(texts)
                bounds = w.bounds
                each = [np.unique(hashes[:, bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
                y = np.repeat(label[at : at + len(texts)], [len(u) for u in each])
                found, where = np.unique(np.concatenate(each), return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.view(np.int64)),
                        pa.array(np.bincount(where, weights=y, minlength=len(found)).astype(np.int64)),
                        pa.array(np.bincount(where, minlength=len(found)).astype(np.int64)),
                    ],
                    names=["hash", "toxic", "docs"],
                )

    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return nothing
    share = lambda n, of: n / F.lit(float(size[of]))
    rate = F.col("docs") / F.lit(float(size[0] + size[1]))
    z = (share(F.col("toxic"), 1) - share(F.col("docs") - F.col("toxic"), 0)) / F.sqrt(
        rate * (1 - rate) * F.lit(1 / size[0] + 1 / size[1]) + F.lit(1e-12)
    )
    table = (
        sample.select("toxic", "text").mapInArrow(count, "hash long, toxic long, docs long")
        .groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))
        .where((F.col("docs") >= MIN_DOCS) & (F.abs(z) >= MIN_Z))
        .select("hash").toArrow()
    )
    vocabulary = np.sort(table.column("hash").to_numpy().view(np.uint64))
    model = Model(vocabulary, np.zeros(len(vocabulary)), -50.0)

    def place(batches):
        for batch in batches:
            label = batch.column("toxic").to_pylist()
            for at, texts in text_slices(batch):
                w, hashes = features(texts)
                sentence, text = sentences(w)
                index = model.known(hashes)
                rows = []
                for i in range(len(texts)):
                    own = slice(w.bounds[i], w.bounds[i + 1])
                    first = sentence[own][0] if own.stop > own.start else 0
                    x = index[:, own]
                    # A feature counts once in a sentence.
                    pairs = np.unique(np.where(x >= 0, x + ((sentence[own] - first).astype(np.int64) << 32)[None], -1))
                    rows.append((label[at + i], int((text == i).sum()), pairs[pairs >= 0].tobytes()))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(cols, names=["toxic", "sentences", "pairs"])

    got = sample.select("doc_id", "toxic", "text").mapInArrow(place, "toxic int, sentences int, pairs binary").toArrow()
    y = np.array(got.column("toxic").to_pylist(), dtype=float)
    sentences_of = np.array(got.column("sentences").to_pylist())
    held = got.column("pairs").cast(pa.large_binary()).combine_chunks()
    del got
    # The driver holds the sample's features once, and what the fit works on.
    bounds = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1] // 8
    pairs = np.frombuffer(held.buffers()[2] or b"", np.int64)[bounds[0] : bounds[-1]]
    s = pairs >> 32
    s += np.repeat(np.concatenate([[0], np.cumsum(sentences_of)])[:-1], np.diff(bounds))
    x = pairs & 0xFFFFFFFF
    del pairs, held
    pa.default_memory_pool().release_unused()
    importance = np.where(y == 1, there[1] / size[1], there[0] / size[0])
    model.weights, model.bias = fit(y, importance, sentences_of, x, s, len(vocabulary))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` (0 for a text without words; null text: empty) and
    ``offending``, the sentences whose own score reaches the threshold, as
    (start, end, score) in code points from their first word to their last;
    columns of these names are replaced.  No row is dropped or merged."""
    tune(docs.sparkSession)
    docs = docs.drop("score", "offending")
    names = docs.columns

    def run(batches):
        for batch in batches:
            doc_scores, places = [], []
            for _, texts in text_slices(batch):
                w, hashes = features(texts)
                sentence, text = sentences(w)
                z = model.logits(hashes, sentence, len(text))
                doc_scores += (-np.expm1(-np.bincount(text, weights=_softplus(z), minlength=len(texts)))).tolist()
                found = [[] for _ in texts]
                p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
                for k in np.flatnonzero(p >= THRESHOLD):
                    a, b = np.searchsorted(sentence, [k, k + 1])
                    t = w.texts[text[k]]
                    lead = lambda at: int(((w.data[t:at] & 0xC0) != 0x80).sum())  # noqa: B023, E731
                    found[text[k]].append({"start": lead(w.first[a]), "end": lead(w.end[b - 1]), "score": float(p[k])})
                places += found
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(doc_scores, pa.float64()), pa.array(places, kind)], names=[*names, "score", "offending"]
            )

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(run, f"{kinds}, score double, offending array<struct<start: long, end: long, score: double>>")
