"""Written tables in the shared checkpoint folder (short lineage, safe against lost executors)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names.  Where it is unset, a local master gets a private
    folder; on a cluster this is an error, as executors would not share it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cadence-llm-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None, dictionary: bool = True) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark, path = df.sparkSession, fresh(df.sparkSession, name)
    df.write.option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
