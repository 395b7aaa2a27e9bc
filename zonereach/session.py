"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on; all of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also split a hot key where the next grouping is on the join key; one more shuffle of partial sums is cheaper.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join may use a side that lies by some of its keys already (pairs by unit and block of targets).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Batches that go to Python: some thousand documents fill tens of megabytes, on both sides.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Fewer where rows are long.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    # The same for the scans: a batch of 4096 texts is a few very large arrays on the heap.
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def without_old_shuffles(spark: SparkSession) -> SparkSession:
    """Shuffle files go when the job that wrote them has ended, so a chain of jobs holds those of one job at a time.

    Passes that follow read tables of the shared folder. A DataFrame that runs twice is shuffled again for it.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("zonereach")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture costs three extra driver calls per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Plans name the whole path of a table.
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none (a test) gets a folder of its own; any other session must name one, because
    a folder on the driver's disk is out of the executors' reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="zonereach-ckpt-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """Parquet tables under the shared folder; a written table cuts the lineage and survives lost executors.

    ``drop`` removes a table nothing reads any more. Tables a returned DataFrame still reads go when the driver ends.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/zonereach-{what}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        atexit.register(remove, spark, self.root)

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._zonereach_path = path
        return out

    def placed(self, df: DataFrame, name: str, buckets: int, by: Sequence[str]) -> DataFrame:
        """The same, bucketed by columns: joins and groups on these and others find the rows where they lie."""
        path, table = self.path(name), f"zonereach_{uuid.uuid4().hex}"
        df.write.format("parquet").option("path", path).bucketBy(buckets, *by).saveAsTable(table)
        out = self.spark.table(table)
        out._zonereach_path, out._zonereach_name = path, table
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if hasattr(t, "_zonereach_name"):
                self.spark.sql(f"drop table if exists {t._zonereach_name}")
            remove(self.spark, t._zonereach_path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    return Scratch(df.sparkSession, "cut").table(df, "rows")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; after the session has ended there is nothing to ask any more."""
    if spark.sparkContext._jsc is not None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
