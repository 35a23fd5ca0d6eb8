"""Token ids as shuffled planes: fixed-size blocks of ids are transposed into
byte or bit planes, each plane is compressed with zstandard, and every block
carries its entry of the chunk index.

The format is a folder of Parquet files, one row a block:

=============  ==========================================================
shard, block   place: shards ascend by doc_id, blocks within a shard
n_ids          ids in the block (all but a shard's last are full)
sizes          compressed bytes of each plane, most significant first
planes         the compressed planes one after another
crc32          of the block's ids as little-endian 32-bit integers
carry          ids at the front that end the document begun before
docs           documents that begin here: (doc_id, at, n_tokens, ord),
               ord counting the shard's documents
=============  ==========================================================

Index columns can be read without touching a plane.  Spark's own committer
writes the files, so a task that is run again leaves no half-written shard.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_slices, tune, written
from .tokens import encoder

BLOCK_IDS = 1 << 16
LEVEL = 3

BLOCKS = (
    "shard int, block long, n_ids int, sizes array<int>, planes binary, crc32 long, carry int, "
    "docs array<struct<doc_id: long, at: int, n_tokens: long, ord: long>>"
)
_DOC = pa.struct([("doc_id", pa.int64()), ("at", pa.int32()), ("n_tokens", pa.int64()), ("ord", pa.int64())])
_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int64()), ("n_ids", pa.int32()), ("sizes", pa.list_(pa.int32())),
    ("planes", pa.binary()), ("crc32", pa.int64()), ("carry", pa.int32()), ("docs", pa.list_(pa.field("item", _DOC))),
])


def shuffle_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Planes of 32-bit ids, most significant first: 4 of bytes or 32 of bits
    (packed, the last byte padded with zeros)."""
    rows = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits:
        return [p.tobytes() for p in np.packbits(np.unpackbits(rows, axis=1).T, axis=1)]
    return [p.tobytes() for p in np.ascontiguousarray(rows.T)]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """Inverse of ``shuffle_planes``."""
    rows = np.array([np.frombuffer(p, np.uint8) for p in planes])
    if len(planes) == 32:
        rows = np.packbits(np.unpackbits(rows, axis=1)[:, :n].T, axis=1).T
    return np.ascontiguousarray(rows.T).view(">u4").reshape(-1)[:n].astype("<u4")


class _Writer:
    """Cuts a shard's stream of documents into block rows."""

    def __init__(self, shard: int, block_ids: int, bits: bool, level: int):
        self.shard, self.block_ids, self.bits = shard, block_ids, bits
        self.zip = zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.n = self.block = self.ord = self.carry = 0
        self.docs: tuple[list, list, list] = ([], [], [])  # doc_id, at, n_tokens

    def add(self, doc_id, ids: np.ndarray):
        for held, x in zip(self.docs, (doc_id, self.n, len(ids))):
            held.append(x)
        while self.n + len(ids) >= self.block_ids:
            k = self.block_ids - self.n
            self.held.append(ids[:k])
            ids = ids[k:]
            yield self.flush()
            self.carry = min(len(ids), self.block_ids)
        if len(ids):
            self.held.append(ids)
            self.n += len(ids)

    def flush(self) -> dict:
        ids = np.concatenate(self.held).astype("<u4")
        planes = [self.zip.compress(p) for p in shuffle_planes(ids, self.bits)]
        doc_id, at, n_tokens = self.docs
        docs = (doc_id, at, n_tokens, range(self.ord, self.ord + len(at)))
        row = {
            "shard": self.shard, "block": self.block, "n_ids": len(ids), "sizes": [len(p) for p in planes],
            "planes": b"".join(planes), "crc32": zlib.crc32(ids), "carry": self.carry,
            "docs": pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(docs, _DOC)], fields=list(_DOC)),
        }
        self.ord += len(at)
        self.held, self.docs, self.n, self.carry = [], ([], [], []), 0, 0
        self.block += 1
        return row


def _batch(row: dict) -> pa.RecordBatch:
    docs = row["docs"]
    cols = [pa.array([row[f.name]], f.type) for f in _ARROW if f.name != "docs"]
    return pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)], schema=_ARROW)


def write_corpus(docs: DataFrame, path: str, tokenizer: str, end_id: int, keeps_space: bool = False,
                 block_ids: int = BLOCK_IDS, bits: bool = False, level: int = LEVEL) -> None:
    """Encodes whole texts (null: empty), ends each with ``end_id`` and writes
    them to ``path`` in ascending doc_id order (null first; rows of one doc_id
    by their text).  A range shuffle of the texts orders them; a shard is one
    of its partitions.  An empty table gives no rows; other columns are not
    looked at."""
    tune(docs.sparkSession)

    def run(batches):
        enc, w = encoder(tokenizer, keeps_space), _Writer(TaskContext.get().partitionId(), block_ids, bits, level)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for at, texts in text_slices(batch):
                for doc_id, ids in zip(doc_ids[at : at + len(texts)], enc.encode(texts, end_id)):
                    yield from map(_batch, w.add(doc_id, ids))
        if w.n:
            yield _batch(w.flush())

    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, BLOCKS)
        .write.option("compression", "none")
        .parquet(path)
    )


def read_block(row: dict) -> np.ndarray:
    """Ids of a block; raises if they aren't those that were written."""
    unzip, planes, at = zstandard.ZstdDecompressor(), [], 0
    for size in row["sizes"]:
        planes.append(unzip.decompress(row["planes"][at : at + size]))
        at += size
    ids = join_planes(planes, row["n_ids"])
    if zlib.crc32(ids.tobytes()) != row["crc32"]:
        raise ValueError(f"shard {row['shard']}, block {row['block']}: ids don't match their checksum")
    return ids


_PARTS = "shard int, ord long, doc_id long, at long, n_tokens long, block long, crc32 long, ids binary"
_PARTS_ARROW = pa.schema([
    ("shard", pa.int32()), ("ord", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
    ("n_tokens", pa.int64()), ("block", pa.int64()), ("crc32", pa.int64()), ("ids", pa.binary()),
])


def _parts(batches):
    """Of each document in each block: its whole checksum, or the ids it has
    there if it goes on in another block."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {f.name: batch.column(f.name)[k].as_py() for f in _ARROW if f.name != "docs"}
            docs = batch.column("docs")[k].values
            doc_id, at, n, order = (docs.field(f.name).to_pylist() for f in _DOC)
            if row["carry"]:
                for held, x in zip((doc_id, at, n, order), (None, 0, row["carry"], None)):
                    held.insert(0, x)
            data = memoryview(read_block(row)).cast("B")
            last = row["n_ids"]
            crcs, ids = [], []
            for first, size, begins in zip(at, n, order):
                whole = begins is not None and first + size <= last
                part = data[4 * first : 4 * min(first + size, last)]
                crcs.append(zlib.crc32(part) if whole else None)
                ids.append(None if whole else bytes(part))
            base = batch.column("block_ids")[k].as_py() * row["block"]
            cols = ([row["shard"]] * len(at), order, doc_id, [base + x for x in at], n, [row["block"]] * len(at), crcs, ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PARTS_ARROW)], schema=_PARTS_ARROW)


def _fold(batches):
    """Checksums of documents from their parts, which come in order of shard and block."""
    names = [f.name for f in _PARTS_ARROW]
    now: dict | None = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["ord"] is not None:
                if now:
                    out.append(now)
                now = dict(row, crc32=0)
            now["crc32"] = zlib.crc32(row["ids"], now["crc32"])
        now_out = [dict(r, ids=None) for r in out]
        if now_out:
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in now_out], schema=_PARTS_ARROW)
    if now:
        yield pa.RecordBatch.from_pylist([{k: dict(now, ids=None)[k] for k in names}], schema=_PARTS_ARROW)


def read_documents(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    every document, from the planes; no rows for no documents.  Only documents that cross a block's end
    are shuffled, with the ids of their parts; a task folds them block by block."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")  # blocks are large
    blocks = spark.read.schema(BLOCKS).parquet(path)
    base = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n")).select(
        "shard",
        F.coalesce(
            # One row a shard, however many ids it has.
            F.sum("_n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_base"),
    )
    # Written, so that each block is read and decompressed once.
    parts = written(blocks.withColumn("block_ids", F.lit(block_ids)).mapInArrow(_parts, _PARTS), "parts")
    tune(spark)
    whole = parts.where("ids is null")
    # A shard's documents that cross blocks follow each other: block by block,
    # the part that a block's front ends comes before the one its back begins.
    crossing = (
        parts.where("ids is not null")
        .repartition("shard")
        .sortWithinPartitions("shard", "block", "at")
        .mapInArrow(_fold, _PARTS)
    )
    return (
        whole.unionByName(crossing)
        .join(F.broadcast(base), "shard")  # one row a shard, so one a partition of the writer
        .select("doc_id", (F.col("_base") + F.col("at")).alias("start"), "n_tokens", F.col("crc32").alias("ids_crc32"))
    )
