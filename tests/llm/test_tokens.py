"""Operators 1 and 5 against the tokenizers library, one text at a time."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cargomart.llm import bitplane, packing
from cargomart.llm.common import scratch
from cargomart.llm.tokens import ChunkEncoder

from .conftest import TEXTS

FILES = {"word_bpe_49k.json": False, "byte_bpe_50k.json": True}


def tokenizer(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", FILES)
def test_chunks_give_the_ids_of_whole_texts(name):
    rng = random.Random(3)
    parts = ["a", "é", "B", "  ", " ", "\n", "\t", " \n ", " ", "　", "'s", "12", "!", "\x1c", "\x85", "<|endoftext|>", "́",
             "日本", "İ", "ß", "\U0001F600", "\x00", "Word", "'", "É", ".", "a,"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)]
    enc, whole = ChunkEncoder(public_tokenizers.path(name), FILES[name]), tokenizer(name)
    for text, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_full_memory_changes_no_ids(monkeypatch):
    monkeypatch.setattr("cargomart.llm.tokens.GENERATION", 5)
    enc, whole = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), True), tokenizer("byte_bpe_50k.json")
    for k in range(30):
        text = " ".join(f"word{k % 7}-{j}" for j in range(k))
        assert enc.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_are_undone(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    planes = bitplane.shuffle_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    if n:
        assert (bitplane.join_planes(planes, n) == ids).all()


def test_a_damaged_block_is_refused():
    w = bitplane._Writer(0, 8, False, 3)
    (row,) = list(w.add(1, np.arange(8, dtype="<u4")))
    assert bitplane.read_block(row).tolist() == list(range(8))
    with pytest.raises(ValueError, match="checksum"):
        bitplane.read_block(row | {"crc32": row["crc32"] ^ 1})


@pytest.mark.parametrize("bits, block", [(False, 64), (True, 1 << 16)])
def test_files_give_back_every_document(spark, docs, bits, block):
    whole, name = tokenizer("word_bpe_49k.json"), "word_bpe_49k.json"
    path = scratch(spark, "test-planes")
    bitplane.write_corpus(docs, path, public_tokenizers.path(name), 1, block_ids=block, bits=bits)
    got = [tuple(r) for r in bitplane.read_documents(spark, path, block).orderBy("start").collect()]
    start, want = 0, []
    for doc_id, text, _ in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    sizes = [r["n_ids"] for r in spark.read.parquet(path).orderBy("shard", "block").collect()]
    assert max(sizes) <= block and sum(sizes) == start


def test_no_documents_give_no_files_rows(spark, no_docs):
    path = scratch(spark, "test-planes")
    bitplane.write_corpus(no_docs, path, public_tokenizers.path("word_bpe_49k.json"), 1)
    assert bitplane.read_documents(spark, path).count() == 0


def test_packing_places_every_piece_once(docs):
    whole = tokenizer("byte_bpe_50k.json")
    placed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, 256, with_ids=True)
    rows = placed.collect()
    want = []
    for doc_id, text, _ in TEXTS:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = [ids[s : s + n] for s, n in packing.cut(len(ids), 256)]
        assert sum(pieces, []) == ids and all(len(p) == 256 for p in pieces[1:])
        want += [(str(doc_id), k, crc(p)) for k, p in enumerate(pieces)]
    assert sorted((str(r["doc_id"]), r["piece"], r["ids_crc32"]) for r in rows) == sorted(want)
    by = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by.get(r["sequence_id"], 0) and len(r["ids"]) == 4 * r["length"]
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by.values()) <= 256
    made = packing.sequences(placed).agg(F.sum("length"), F.max("length")).first()
    assert tuple(made) == (sum(by.values()), max(by.values()))


def test_no_documents_pack_to_nothing(no_docs):
    assert packing.pack(no_docs, public_tokenizers.path("byte_bpe_50k.json"), 2).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_what_was_counted_in_few_sequences(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(128, rng.lognormal(3.3, 1, 3000).astype(int) + 1)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    made = packing.plan(counts, 128)
    held = {}
    for config, times in made:
        assert sum(x * k for x, k in config.items()) <= 128 and times > 0
        for x, k in config.items():
            held[x] = held.get(x, 0) + k * times
    assert held == counts
    bound = max(-(-int(lengths.sum()) // 128), int((lengths > 64).sum()))
    assert sum(t for _, t in made) <= bound * 1.01 + 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_plans_come_from_configurations_and_beat_best_fit(spark, sf):
    d = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    cut = packing.pieces(d, public_tokenizers.path("byte_bpe_50k.json"), 2, 1024)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    began = time.process_time()
    made = packing.solve(counts, 1024)
    assert time.process_time() - began < 5
    of = lambda configs: sum(t for _, t in configs)
    assert of(made.all()) <= of(packing.best_fit(counts, 1024))
    assert made.bound <= of(made.all()) <= max(made.bound + 1, made.bound * 1.005)
    assert of(made.rounded) > 0.89 * (of(made.rounded) + of(made.rest))
    held = {}
    for config, times in made.all():
        for x, k in config.items():
            held[x] = held.get(x, 0) + k * times
    assert held == counts


def test_best_fit_is_that_of_piece_by_piece():
    rng = np.random.default_rng(9)
    for _ in range(50):
        pieces = sorted(rng.integers(1, 41, rng.integers(1, 200)).tolist(), reverse=True)
        rooms = []
        for x in pieces:
            fits = [r for r in rooms if r >= x]
            rooms.remove(min(fits)) if fits else None
            rooms.append((min(fits) if fits else 40) - x)
        counts = {x: pieces.count(x) for x in set(pieces)}
        got = packing.best_fit(counts, 40)
        assert sorted(40 - sum(x * k for x, k in c.items()) for c, t in got for _ in range(t)) == sorted(rooms)


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 1024])
def test_plans_of_any_counts_hold_them(capacity):
    rng = np.random.default_rng(capacity)
    for top in (1, capacity // 3, capacity // 2, capacity - 1, capacity):
        for n in (1, 3, 400):
            x = rng.integers(1, max(2, top + 1), n)
            counts = {int(a): int(k) * int(rng.integers(1, 500)) for a, k in zip(*np.unique(np.minimum(x, capacity), return_counts=True))}
            made, held = packing.solve(counts, capacity), {}
            for config, times in made.all():
                assert times > 0 and sum(a * k for a, k in config.items()) <= capacity
                for a, k in config.items():
                    held[a] = held.get(a, 0) + k * times
            assert held == counts and sum(t for _, t in made.all()) >= made.bound


def test_plans_of_few_or_alike_pieces():
    assert packing.plan({}, 8) == []
    assert sum(t for _, t in packing.plan({8: 3}, 8)) == 3
    assert sum(t for _, t in packing.plan({1: 17}, 8)) == 3
    assert sum(t for _, t in packing.plan({5: 2, 3: 2}, 8)) == 2
