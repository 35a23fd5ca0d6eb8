"""Session helpers: the checkpoint folder comes from the session; lineage cuts
are written under it and read back unchanged."""

from pyspark.sql import functions as F

from cargomart.session import RUNTIME_CONF, checkpoint_dir, configure, materialize


def test_checkpoint_dir_reads_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    path = checkpoint_dir(spark)
    assert path and (configured is None or path == configured)
    assert checkpoint_dir(spark) == path  # stable, never replaced


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    out = materialize(df)
    files = out.inputFiles()
    base = checkpoint_dir(spark).replace("file:", "").rstrip("/")
    assert files and all(base in f for f in files)
    assert out.exceptAll(df).count() == 0 and df.exceptAll(out).count() == 0


def test_configure_sets_runtime_options(spark):
    configure(spark)
    for k, v in RUNTIME_CONF.items():
        assert spark.conf.get(k).lower() == v.lower()
