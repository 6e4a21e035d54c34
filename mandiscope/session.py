"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and descriptions can be long; small batches bound the memory of a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_spark(app: str = "mandiscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out before costly work, if the caller asked for it with the setting ``mandiscope.partitions``.

    Large input comes in as many tasks as it has splits and needs none of this; it helps where one small file holds all.
    """
    partitions = df.sparkSession.conf.get("mandiscope.partitions", None)
    return df.repartition(int(partitions)) if partitions else df


def many_tasks(spark: SparkSession) -> int:
    """A number of tasks that keeps all cores busy with rows that are much work for their bytes."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, which the session names in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets one temporary folder per application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _FOLDERS:
            _FOLDERS[application] = tempfile.mkdtemp(prefix="mandiscope-")
        folder = _FOLDERS[application]
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint that outlives executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder: computed once, and kept when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if path.getParent().getName() != "tables":
            raise ValueError(f"{path} is no table of the shared folder")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
