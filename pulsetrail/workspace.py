"""Tables a job writes for itself in the shared folder named by ``spark.checkpoint.dir``, or else in the warehouse.

Writing a table cuts the lineage: what is read back does not have to be computed again when an
executor is lost, and every later step sees the very same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """Folder of this application below the shared checkpoint folder, or else below the warehouse."""
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{root.rstrip('/')}/pulsetrail-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that no one has used yet."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None, dictionary: bool = True) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back.

    Looking values up in a dictionary is most of the work for many short texts, which ``compression`` makes as small.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    options = {} if dictionary else {"parquet.enable.dictionary": "false"}
    df.write.options(**options).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, system = _resolve(spark, path)
    return system.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    folder, system = _resolve(spark, path)
    system.delete(folder, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to one that is not there yet; its parent is made."""
    folder, system = _resolve(spark, target)
    system.mkdirs(folder.getParent())
    if not system.rename(_resolve(spark, source)[0], folder):
        raise RuntimeError(f"{source} can not be renamed to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file as a whole, without a Spark job."""
    file, system = _resolve(spark, path)
    out = system.create(file, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Contents of a small file."""
    file, system = _resolve(spark, path)
    stream = system.open(file)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged; results that still read it become invalid."""
    folder, system = _resolve(spark, work_folder(spark))
    system.delete(folder, True)


def _resolve(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())
