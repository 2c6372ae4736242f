"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Columns that an operator needs for itself start with this, so that a caller's columns can't clash.
OWN = "__ff_"


def own(name: str) -> str:
    return OWN + name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Where none is named, a local master gets a temporary one; on a cluster that would be a folder of the driver's machine
    only, so it's an error there.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = f"file://{tempfile.mkdtemp(prefix='folioforge-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    It cuts the lineage: a lost executor costs the tasks that it ran, not the stages before the table.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/folioforge-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a table that `materialize` gave, once everything made from it is a table too."""
    spark = df.sparkSession
    place = scratch_dir(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not folder.rsplit("/", 1)[1].startswith("folioforge-"):
            raise ValueError(f"{folder} isn't a table in {place}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
