"""Session helpers: table access, durable cut points and sizing."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CUTS: dict[str, list[str]] = {}  # tables made, by application


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; a file and a folder of files read alike."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; only where it is unset (tests, one machine) a local one is made."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(named)
        return named
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        local = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, local, True)
        sc.setCheckpointDir(local)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a compressed table in the shared checkpoint folder and cut its lineage.

    The table survives the loss of executors, so what is read from it later is always the same rows,
    and a reader takes only the columns it needs. ``release`` deletes the tables when results are written."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _CUTS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Deletes the tables that ``cut`` made in this application; results that still read them must be written before."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = _CUTS.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)
    return len(paths)


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public vocabulary file; ``CORPUSLOOM_TOKENIZERS`` overrides the folder."""
    return os.path.join(os.environ.get("CORPUSLOOM_TOKENIZERS", "/opt/tokenizers"), name)
