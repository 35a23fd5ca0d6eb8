"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import bitplane, collocations, html_extract, lexical, licenses, minhash, mixing, packing, pii, quality, search, simhash, toxicity
from .common import scratch, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bit_plane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "planes")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    bitplane.write_corpus(_table(spark, sf_dir, "documents"), path, tokenizer, end_id=1)
    return bitplane.read_documents(spark, path)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), n=3, percent=85)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the likenesses, ``n_within``: for each document whose id is
    divisible by 100, how many distinct other fingerprints of the whole table
    are at most 3 bits away (null for the others)."""
    found = written(simhash.along(_table(spark, sf_dir, "documents")), "fingerprints")
    pairs = simhash.within(found, found.where("doc_id % 100 = 0"))
    near = pairs.groupBy(F.col("query").alias("fingerprint")).agg((F.count(F.lit(1)) - 1).alias("n_within"))
    return found.join(near, "fingerprint", "left").select(
        "doc_id", "n_chars", "edited_sha256", simhash.shown(F.col("fingerprint")).alias("fingerprint"),
        simhash.shown(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.when(F.col("doc_id") % 100 == 0, F.col("n_within")).alias("n_within"),
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer, end_id=2, capacity=1024)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all vectors to every vector whose id is divisible by 100."""
    coded = written(search.codes(_table(spark, sf_dir, "embeddings")), "codes")
    return search.top_k(coded, coded.where("vec_id % 100 = 0"), k=10)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("offending").alias("n_offending"),
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; learned from labelled documents that are not held out."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chain = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, chain).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
        F.size(F.filter("lines", lambda p: p < quality.THRESHOLD)).alias("n_bad_lines"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for every benchmark item."""
    return lexical.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


QUERIES = {
    f.__name__: f
    for f in (op1_bit_plane_tokens, op2_minhash_near_dedup, op3_personal_data, op4_simhash, op5_best_fit_packing, op6_license_scan, op7_top_k_search, op8_mix_sources, op9_html_extraction, op10_toxicity,
              op11_quality, op12_collocations, op13_lexical_search)
}
ORACLE = {
    "op7_top_k_search": search.ORACLE, "op8_mix_sources": mixing.ORACLE, "op12_collocations": collocations.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}
