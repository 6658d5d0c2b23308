"""Session helpers: a local session for tests/bench and the checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "vela") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VELA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:      # for the Python workers, wherever the session is started from
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (a zip through ``addPyFile``), once per context.

    Not needed where the repository is on the executors' PYTHONPATH."""
    import shutil
    sc = spark.sparkContext
    if getattr(sc, "_vela_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="vela-zip-"), "vela")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "vela"))
    sc._vela_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when it is unset *and* the master is local (tests, bench) do we make
    our own folder; on a cluster an unset folder is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="vela-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


class Steps:
    """Tables of an iteration, written to and read again from the shared checkpoint folder.

    A checkpointed frame keeps the size estimate of its plan, and a join multiplies
    its sides' estimates: a loop that joins a table with something made of itself
    squares the estimate each round, until planning handles numbers of millions of
    digits.  A written table starts from its file size.  Only the last ``keep``
    tables stay.
    """

    def __init__(self, spark: SparkSession, keep: int = 4):
        import uuid
        self.spark, self.keep, self.paths = spark, keep, []
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/steps-{uuid.uuid4().hex}"

    def cut(self, df):
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        self.paths.append(path)
        if len(self.paths) > self.keep:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[-1 - self.keep])
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        return self.spark.read.schema(df.schema).parquet(path)
