"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", name: str = "accountwise", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the cluster's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        # no call-site capture per column expression: plans are built several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there one machine is the cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="accountwise-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint: survives lost executors, unlike a local one."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written_again(df, label: str = "step"):
    """The rows written below the shared folder and read back, for loops.

    A checkpoint keeps the constraints that Spark infers from its plan; in a loop they multiply with each round, until the
    driver's time and memory go to them. A table that is read knows none.
    """
    path, spark = run_dir(df.sparkSession, label), df.sparkSession
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input files for each partition of a step that ``dealt_by_size`` deals.
PART_BYTES = 4 << 20


def dealt_by_size(df, *keys):
    """The rows dealt by their keys into partitions whose number follows the files they come from, not a setting.

    Without it a task of the step grows with the input, as the number of shuffle partitions is fixed. Rows that come
    from no files are dealt by the setting.
    """
    spark, total = df.sparkSession, 0
    files = df.inputFiles()
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    if not files:
        return df.repartition(*keys)
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-total // PART_BYTES)), *keys)


#: Rows that a task of a learner holds at most, on average, and rows below which another task does not pay.
MOST_ROWS, FEWEST_ROWS = 500_000, 2_000


def tasks_for(rows: int, spark: SparkSession) -> int:
    """Tasks for work with a fixed cost in each: as many as cores, more only for ``MOST_ROWS``, fewer for few rows."""
    return max(1, -(-rows // MOST_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // FEWEST_ROWS)))


def dealt_for_rounds(df, key: str):
    """The rows for a learner that meets them in every round, dealt by their key, in its order, and stored.

    Each task of a round sends the statistics of all open nodes, however few rows it has, and draws its rows by their places:
    neither the bytes sent nor the fitted trees may follow the shuffle setting.
    """
    return cut_lineage(df.repartition(tasks_for(df.count(), df.sparkSession), key).sortWithinPartitions(key).drop(key))
