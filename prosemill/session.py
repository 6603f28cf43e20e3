"""Session settings, checkpoints and scratch space."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str, partitions: int, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    b = (
        SparkSession.builder.master(master)
        .appName("prosemill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    Taken from `spark.checkpoint.dir` (or a directory already set on the
    context).  Only a local session without either gets a temporary folder; on a
    cluster that would not be shared, so it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="prosemill-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again; the files go with the session.

    Later stages read the columns they use, and Spark knows the size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table from `cut_lineage` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if not folder.rsplit("/", 1)[-1].startswith("stored-"):
            raise ValueError(f"not a stored table: {folder}")
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    Its cleaner does so when the driver's JVM has collected what refers to them, which in a loop of
    jobs with few objects may be after half an hour.
    """
    gc.collect()
    spark._jvm.System.gc()


def frozen(df: DataFrame) -> DataFrame:
    """`df` checkpointed with its partitions and their order, for what numbers rows by place."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
