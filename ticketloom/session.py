"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied only by ``build_session``; a session handed in by a cluster keeps its own.
SPARK_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lets a date window on one large table thin out the other join side before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10g",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SPARK_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's ``spark.checkpoint.dir``.

    Every executor must see the folder, so the warehouse's is used only where the setting
    is absent and the session runs on one machine anyway.
    """
    base = _setting(spark, "spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{_setting(spark, 'spark.sql.warehouse.dir') or 'spark-warehouse'}/intermediate"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_finished(spark: SparkSession) -> None:
    """Spark drops the shuffle files of a finished step when the driver happens to collect
    its garbage; that is asked for here, or they would lie on the executors' disks for
    the whole job."""
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once as a columnar table in the shared folder and read from there."""
    path = shared_path(df.sparkSession, name)
    drop_finished(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    drop_finished(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more from the shared folder."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)
