"""Session settings and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Web pages are large rows, so Arrow batches are kept short in rows and in bytes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A landed table. `spark.sql.files.maxPartitionBytes` decides how many tasks parse it."""
    return spark.read.parquet(path)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="postmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that `scratch_path` named. Spark has no writer for that, so the file system is asked."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a table to the shared folder and read it back, so that its rows no longer change."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
