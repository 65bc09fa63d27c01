"""Session settings and the shared folder for written intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app="fraudlake", master=None, shuffle_partitions=None):
    """A session with adaptive execution and skew handling on; the cluster's own
    settings (master, memory, shuffle partitions) stay unless given here."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


_local_root = None


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local-mode session without
    that setting gets a temporary folder of its own."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="fraudlake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_local_root)
    return _local_root


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the shared one."""
    return f"{shared_root(spark)}/fraudlake-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back: the lineage ends
    there and a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the folders of frames that ``materialize`` returned. Only for frames that no later
    action reads, not even through a frame derived from them."""
    for df in frames:
        remove(df.sparkSession, df.written_to)


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
