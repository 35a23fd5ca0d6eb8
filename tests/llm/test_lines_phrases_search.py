"""Operators 11 to 13 against brute force and their SQL on small tables."""

import itertools
import random
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cargomart.llm import collocations, lexical, quality

SF = "/root/testdata/sf0.01"


def in_duckdb(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow() if hasattr(df, "toArrow") else df)
    return sorted(con.execute(sql).fetchall(), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ op11


def plain_marginals(score, move):
    """Every labelling of a chain, one by one."""
    ways = list(itertools.product((0, 1), repeat=len(score)))
    weight = np.array([
        np.exp(sum(s * y for s, y in zip(score, way)) + sum(move[a, b] for a, b in zip(way, way[1:]))) for way in ways
    ])
    good = np.array(ways).T @ weight / weight.sum()
    pairs = np.zeros((2, 2))
    for way, w in zip(ways, weight):
        for a, b in zip(way, way[1:]):
            pairs[a, b] += w / weight.sum()
    return good, np.log(weight.sum()), pairs


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(5)
    move = rng.normal(size=(2, 2))
    sizes = [1, 2, 7, 3]
    score, there = np.zeros((4, 7)), np.arange(7) < np.array(sizes)[:, None]
    score[there] = rng.normal(size=there.sum()) * 2
    p, z, pairs = quality.forward_backward(score, there, move)
    expected = np.zeros((2, 2))
    for i, n in enumerate(sizes):
        good, log_z, both = plain_marginals(score[i, :n], move)
        assert np.allclose(p[i, :n], good) and np.isclose(z[i], log_z)
        expected += both
    assert np.allclose(pairs, expected)


def test_the_fit_goes_uphill_and_uses_the_neighbours(monkeypatch):
    monkeypatch.setattr(quality, "DECAY", 0.0)
    rng = np.random.default_rng(1)
    x = rng.random((60, 3)).astype(np.float32)
    bounds = np.array([0, 10, 11, 40, 60])
    y = (x[:, 0] > 0.5).astype(float)
    chain = quality.fit(x, bounds, y, np.ones(4))
    p = chain.marginals(x, bounds)
    # In a log-linear model at its optimum expected features equal observed ones.
    assert np.abs(quality.in_context(x, bounds).T @ (p - y)).max() < 1.5
    assert ((p > 0.5) == (y == 1)).mean() > 0.95


def test_context_stays_within_a_text():
    x = np.arange(1, 6, dtype=np.float32)[:, None]
    got = quality.in_context(x, np.array([0, 2, 2, 5]))
    assert got[:, 1].tolist() == [0, 1, 0, 3, 4] and got[:, 2].tolist() == [2, 0, 4, 5, 0]
    assert got[:, 3].tolist() == [1, 0, 1, 0, 0] and got[:, 4].tolist() == [0, 1, 0, 0, 1]


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["", "a b a\n\nA!! b??\r", "x" * 50_000, "\n", "a b a\na b a", "é " * 3000 + "\nend."]
    whole, size, bounds = quality.features(texts)
    assert np.diff(bounds).tolist() == [1, 3, 1, 2, 2, 2] and ((whole >= 0) & (whole <= 1)).all()
    for i, text in enumerate(texts):
        x, s, _ = quality.features([text])
        assert np.allclose(x, whole[bounds[i] : bounds[i + 1]]) and (s == size[bounds[i] : bounds[i + 1]]).all()
        assert s.sum() == len(text.encode()) + 1


def test_a_document_is_the_length_weighted_mean_of_its_lines(docs):
    chain = quality.Chain(np.linspace(-1, 1, 171), np.array([[0.5, -0.2], [0.1, 0.3]]), 6.0, -3.0)
    got = quality.score(docs, chain)
    assert got.columns == [*[c for c in docs.columns if c != "score"], "score", "lines"]
    found = got.collect()
    assert len(found) == docs.count()
    for r in found:
        lines = (r["text"] or "").split("\n")
        assert len(r["lines"]) == len(lines)
        size = [len(x.encode()) + 1 for x in lines]
        mean = sum(p * s for p, s in zip(r["lines"], size)) / sum(size)
        assert np.isclose(r["score"], 1 / (1 + np.exp(3 - 6 * mean)))


def test_quality_without_labels_or_documents(spark, docs, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    chain = quality.train(docs, none)
    assert {r["score"] for r in quality.score(docs, chain).collect()} == {0.5}
    assert quality.score(no_docs, chain).count() == 0
    assert quality.train(no_docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")).slope == 0


def test_quality_on_held_out_documents_and_lines(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = quality.train(d, labels)
    held = quality.score(d.join(labels, "doc_id"), chain).where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    right = held.select(((F.col("score") >= 0.5).cast("int") == F.col("quality")).alias("ok")).agg(F.avg(F.col("ok").cast("int")), F.count("*")).first()
    assert right[1] > 80 and right[0] > 0.97
    good = "Eand as nttionble. Eraning of a and thersh erorst esor inblend eson with iningly ha."
    mixed = "\n".join([good] * 1 + ["Stlysh and the enonin, was thening of ered. Thand a nonre it anor."] + ["BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!"] * 8)
    lines = quality.score(spark.createDataFrame([(mixed,)], "text string"), chain).first()["lines"]
    assert lines[0] > 0.5 and lines[-1] < 0.5


# ------------------------------------------------------------------ op12


def some_texts(seed, n=700):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "New", "york", "city", "hall", "é", "ÉTÉ", "a-b", "x" * 80, "\x1c", "日本", "in", "\u00a0z", "New York city hall"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", "\n", "!", ",", "\r\n", "; "]
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, [9, 2, 8, 7, 7, 6, 5, 3, 1, 4, 3, 1, 2, 6, 2, 2], k=rng.randint(0, 60))
        out.append((i, rng.choice([None, "und", "en", "fr", "en", "fr"]), "".join(w + rng.choice(gaps) for w in words)))
    return out + [(1, "en", None), (1, "en", None), (2, None, ""), (3, "xx", "lone words here")]


@pytest.mark.parametrize("head", [1 << 18, 6, 0])
def test_collocations_equal_the_sql(spark, head):
    d = spark.createDataFrame(some_texts(head), "doc_id long, lang string, text string").withColumn("phrase", F.lit("?")).withColumn("f", F.lit(1))
    got = rows(collocations.collocations(d.repartition(3), head=head).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    assert got == in_duckdb(collocations.ORACLE, documents=d)
    assert {r[0] for r in got} == {"en", "fr", "und"} and any(len(r[2].split(" ")) == 4 for r in got)


def test_no_documents_have_no_collocations(no_docs):
    assert collocations.collocations(no_docs).collect() == []


@pytest.mark.parametrize("bits", [None, np.full(collocations.PLACES // 64, ~np.uint64(0))])
def test_chunks_of_long_texts_lose_and_repeat_no_phrase(monkeypatch, bits):
    monkeypatch.setattr(collocations, "CHUNK", 40)
    monkeypatch.setattr(collocations, "HELD", 50)
    texts = [t or "" for _, _, t in some_texts(7, 60)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([t.encode() for t in texts])], names=["lang", "text"])
    want = {}
    for (lang, _, phrase, f) in in_duckdb(
        collocations.ORACLE.split("), totals as")[0] + ") select lang, k, phrase, f from f",
        documents=pa.table({"lang": ["en"] * len(texts), "text": texts}),
    ):
        want[phrase.encode()] = f

    def counted(found):
        out = {}
        for b in found:
            for phrase, f in zip(b.column("phrase").to_pylist(), b.column("f").to_pylist()):
                out[phrase.encode()] = out.get(phrase.encode(), 0) + f
        return out

    words = counted(collocations._words([batch]))
    assert words == {k: v for k, v in want.items() if b" " not in k}
    levels, known = [], words
    for n in (2, 3, 4):
        # With the bit table half of the names are left to it.
        names = [w for w in sorted(known, key=lambda w: -known[w]) if bits is None or len(w) % 2]
        levels.append(({"en": names}, bits))
        known = counted(collocations._pairs(type("Shared", (), {"value": list(levels)}))([batch]))
        assert known == {k: v for k, v in want.items() if len(k.split(b" ")) == n}


def test_a_task_keeps_few_numbers_of_its_own(monkeypatch):
    """Many phrases that the bit table alone lets through: what a worker holds
    doesn't grow with its rows, and each phrase is counted."""
    monkeypatch.setattr(collocations, "HELD", 4000)
    monkeypatch.setattr(collocations, "CHUNK", 10_000)
    levels = [({}, np.full(collocations.PLACES // 64, ~np.uint64(0)))] * 2

    def texts(n):
        for k in range(n):
            text = " ".join(f"w{k}x{i}" for i in range(4000)).encode()
            yield pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["lang", "text"])

    peaks = []
    for n in (4, 40):
        tracemalloc.start()
        found = sum(b.num_rows for b in collocations._pairs(type("Shared", (), {"value": list(levels)}))(texts(n)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found == n * 3998
    assert peaks[1] < 1.5 * peaks[0]


def test_tiles_count_as_a_dictionary_does(monkeypatch):
    monkeypatch.setattr(collocations, "DENSE", 4)
    monkeypatch.setattr(collocations, "MAX_DENSE", 3)
    rng = np.random.default_rng(2)
    tiles, want = collocations.Tiles(), {}
    for _ in range(40):
        a, b = (np.floor(rng.pareto(0.6, 300)).astype(np.int64) % 3000 for _ in range(2))
        tiles.add(a, b)
        for pair in zip(a.tolist(), b.tolist()):
            want[pair] = want.get(pair, 0) + 1
    assert len(tiles.dense) == 3 and tiles.n_sparse
    a, b, n = tiles.take()
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == want and len(n) == len(want)
    assert len(tiles.take()[0]) == 0


def test_scores_of_huge_counts_are_exact(spark):
    big = 9_000_000_000_000_000_001
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 2)], "lang string, phrase string, f long")
    pair = counts.where("phrase = 'a b'").withColumnRenamed("f", "a")
    r = collocations._scored(pair, counts).first()
    assert r["score"] == 2_000_000 * (big - 2) // (2 * big - 1)


# ------------------------------------------------------------------ op13

DOCS = [
    (1, "Alpha beta, beta GAMMA."), (2, "alpha-beta gamma delta"), (2, "alphabeta gamma"), (3, None), (4, ""), (5, " .,; "),
    (None, "alpha beta"), (6, "été ÉTÉ alpha 日本 123"), (7, "alpha " * 5000), (8, "Alpha beta, beta GAMMA."), (9, "é"),
]
ITEMS = [(1, "alpha alpha beta"), (2, "ÉTÉ 日本"), (3, "nothing of it"), (4, None), (5, ""), (6, "gamma! alpha"), (6, "delta"), (None, "beta")]


@pytest.mark.parametrize("block_pairs", [200_000, 3])
def test_ranks_equal_the_sql(spark, block_pairs):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "日本", "x1"]
    more = [(100 + i % 150, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for i in range(300)]
    asked = [(20 + i, "-".join(rng.choices(vocabulary, k=rng.randint(1, 9)))) for i in range(15)]
    d = spark.createDataFrame(DOCS + more, "doc_id long, text string").withColumn("item", F.lit("?")).withColumn("score", F.lit(1))
    items = spark.createDataFrame(ITEMS + asked, "item_id long, text string").withColumn("term", F.lit("?"))
    got = rows(lexical.rank(d.repartition(4), items, block_pairs=block_pairs).select("item_id", "rank", "doc_id", "score"))
    want = in_duckdb(lexical.ORACLE, documents=d, benchmark=items)
    # Rows of one doc_id may have equal scores; their ranks may change places.
    assert got == want and len(got) > 200


def test_items_of_text_ids_and_empty_tables(spark, no_docs):
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame([("q", "delta"), ("r", "beta")], "item_id string, text string")
    got = rows(lexical.rank(d, items, k=2))
    assert [r[:3] for r in got] == [("q", 1, 2), ("r", 1, 1), ("r", 2, 8)]
    assert lexical.rank(no_docs, items).collect() == [] and lexical.rank(d, items.limit(0)).collect() == []


def test_the_best_are_kept_over_many_tables():
    rng = np.random.default_rng(3)
    best, seen = lexical._Best(4, 5), []
    for k in range(30):
        scores = rng.integers(0, 12, (7, 4))
        ids, null = rng.integers(0, 50, 7), rng.random(7) < 0.2
        best.add(scores, ids, null)
        seen += [(i, -scores[d, i], null[d], ids[d]) for d in range(7) for i in range(4) if scores[d, i] > 0]
    item, score, doc_id, null = best.held
    for i in range(4):
        want = [(-s, n, d if not n else 0) for j, s, n, d in sorted(seen) if j == i][:5]
        assert [(s, n, d if not n else 0) for j, s, n, d in zip(item, score, null, doc_id) if j == i] == want
