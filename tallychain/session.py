"""Session settings the jobs are written for."""

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work: it picks broadcast joins from measured
# shuffle sizes, splits skewed join partitions and merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sides up to this measured size are broadcast at run time; larger ones are shuffled.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Unlike the default type this one keeps min/max statistics, so scans can skip by time.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def local_session(cpus="*", shuffle_partitions=8, **extra) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallychain")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Test data is small: keep all cores busy instead of merging its partitions.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master (tests) gets a machine-local one where the session names none: on a
    cluster each executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tallychain-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_work_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"tallychain-{name}-{uuid.uuid4().hex}")


def filesystem(spark: SparkSession, path: str):
    """The file system that holds a path, and the path in its form."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str):
    """A small text in a file: written aside first, so that whoever sees the file sees all of it."""
    fs, aside = filesystem(spark, path + ".new")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(aside, filesystem(spark, path)[1])


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def copy_folder(spark: SparkSession, source: str, target: str) -> bool:
    """A small folder once more; False if it is not there."""
    fs, old = filesystem(spark, source)
    if not fs.exists(old):
        return False
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, old, fs, filesystem(spark, target)[1], False, spark._jsc.hadoopConfiguration())


def partition_names(spark: SparkSession, path: str) -> list:
    """Names of the partition folders of a table; none where it has no folder."""
    fs, root = filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root) if "=" in s.getPath().getName()] if fs.exists(root) else []


def drop_folder(spark: SparkSession, path: str):
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def written(df, name: str):
    """The rows of ``df`` as a table in the shared folder.

    This cuts the lineage, survives the loss of any executor, and gives later joins the
    true size of the rows.  The folder is returned as well, for callers that know when
    they are done with it.
    """
    folder = new_work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def release_shuffles(spark: SparkSession):
    """Shuffle files of steps that have ended go now, not when the driver happens to collect garbage.

    Spark's cleaner removes them once the driver has collected the step's objects, so a chain of steps
    needs the disk of its largest one rather than of all.  Spark's listeners hold the last step until another
    one ends, so an empty one follows; otherwise its files would stay through the next step.
    """
    spark.range(1).collect()
    time.sleep(0.2)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
