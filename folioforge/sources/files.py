"""File sources and sinks: JSON lines, gzipped dumps, fallbacks, resumable loads."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the cluster names; one of our own only where a local master names none."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = f"file://{tempfile.mkdtemp(prefix='folioforge-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return f"{place.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table at a path that `scratch` gave, once what is made from it is a table too."""
    place = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    if not path.startswith(f"{place}/"):
        raise ValueError(f"{path} isn't a table in {place}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines under a schema; blank lines are skipped, gzip is read by its suffix, a broken line is an error."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.select(*schema.names) if isinstance(schema, T.StructType) else rows  # folder names come last otherwise


def write_jsonl(df: DataFrame, path: str, by: Sequence[str] = (), compressed: bool = True) -> None:
    """JSON lines, in a folder for each value of `by`; the commit protocol leaves no half files."""
    out = df.write.option("compression", "gzip" if compressed else "none").option("ignoreNullFields", "false")
    (out.partitionBy(*by) if by else out).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def load_cards(spark: SparkSession, book: str, schema: T.StructType | str) -> DataFrame | None:
    """A book's cards from the first of upload.json, cards.jsonl and cards.jsonl.gz that is there."""
    for name in ("upload.json", "cards.jsonl", "cards.jsonl.gz"):
        if exists(spark, f"{book}/{name}"):
            return spark.read.schema(schema).option("multiLine", name == "upload.json").json(f"{book}/{name}")
    return None


def manifest(df: DataFrame, by: str) -> DataFrame:
    """(by, rows, digest) of a dump: the digest doesn't depend on the order of rows."""
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.sum(F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(2147483647))).alias("digest"))


def page_range(spec: str, n: int) -> list[int]:
    """`40-1200,1300` -> sorted distinct indexes from 0, clipped to n pages; an empty spec is all."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        low, _, high = part.partition("-")
        out |= set(range(int(low) - 1, int(high or low)))
    return sorted(i for i in out if 0 <= i < n) if spec.strip() else list(range(n))


def remaining(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed load still has to do."""
    return items.join(done.select(key).distinct(), key, "left_anti")
