"""The corpus pipeline: toxicity, near-duplicates, personal data, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet to the shared folder and reads them again as the
next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargomart.llm import minhash, mixing, packing, pii, toxicity
from cargomart.llm.common import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier calls toxic; it learns from the
    labelled ones among ``docs``.  Null and empty texts aren't toxic, rows that
    repeat stay, and an empty table stays empty."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.withColumn("_doc", F.struct(*[f"`{c}`" for c in docs.columns])).select("_doc", "text"), model)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose five-word shingles are linked at
    a similarity of 0.8: the one with the smallest doc_id (null last), of several
    texts with that id the one whose key is smallest, and of rows that repeat it
    one.  Documents without words (null text too) all stay, as they are linked
    with nothing; an empty table stays empty."""
    key = F.md5(F.concat_ws("\0", F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.concat(F.lit("="), F.col("text"))))
    keyed = docs.withColumn("_key", key)
    found = written(minhash.near_duplicates(keyed, n=5, percent=80, row="_key").select("doc_id", "row", "root"), "verdicts")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row"))
    chosen = found.where("root is not null").groupBy("root").agg(least.alias("_m")).select(F.col("_m.row").alias("_key"))
    wordless = found.where("root is null").select(F.col("row").alias("_key")).distinct()
    kept = written(chosen.unionByName(wordless), "kept")
    rows = keyed.join(kept, "_key", "left_semi")
    copies = found.where("root is not null").groupBy(F.col("row").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = written(copies.select("_key").join(chosen, "_key", "left_semi"), "repeated")
    if repeated.isEmpty():
        return rows.drop("_key")
    once = rows.join(repeated, "_key", "left_semi").dropDuplicates(["_key"])
    return rows.join(repeated, "_key", "left_anti").unionByName(once).drop("_key")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in angle brackets; every row stays,
    null texts stay null."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them; those with
    no words (null text too) have size 0.  An empty table stays empty."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, placed in sequences of 1024; a null or
    empty text is its end id alone, and an empty table has no pieces."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the minima and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
