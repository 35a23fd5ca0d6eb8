"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cargomart.session import checkpoint_dir

#: Rows of an Arrow batch handed to Python at once; texts are handled in
#: slices of SLICE_CHARS, so a batch of very long texts stays bounded too.
ARROW_ROWS = 512
SLICE_CHARS = 500_000


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Sends the package to the executors once an application, so that their
    Python workers can import it wherever the driver runs."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "cargomart-code"), "zip", root, "cargomart"))
        _SHIPPED.add(sc.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Ships the code and sets small Arrow batches: texts are long, and a
    worker's memory holds the batch in hand."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and go on
    from the files, which outlive any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batch: pa.RecordBatch, column: str = "text"):
    """(first row, list of texts; null: empty) in slices of about SLICE_CHARS."""
    texts = batch.column(column).to_pylist()
    at, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        size += len(held[-1])
        if size >= SLICE_CHARS:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held
