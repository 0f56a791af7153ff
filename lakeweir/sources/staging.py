"""Intermediate results in storage that every executor can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data, else one in the warehouse."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate").rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once under the shared folder and read it back.

    Later steps then cost a columnar read of what they need instead of another
    evaluation of the source, losing executors loses nothing, and the file
    size lets Spark decide on broadcasts.
    """
    path = f"{shared_dir(df.sparkSession)}/lakeweir-stage/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, name: str) -> None:
    """Free the folder that ``stage`` made under a name, once nothing reads it."""
    path = f"{shared_dir(spark)}/lakeweir-stage/{name}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame and cut its plan, for long or iterative jobs."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
