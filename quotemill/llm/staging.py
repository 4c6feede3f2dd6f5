"""Tables in the folder all executors share, and helpers for batches of documents."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A temporary folder is made only where none is named and driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("name a shared folder in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quotemill-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


#: Whether Spark deletes the shuffle files of a query as soon as it has ended. Else they stay until the
#: driver happens to collect its garbage, and the files of all stages so far are on disk together.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries planned within delete their shuffle files when they have ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` evaluated once into a Parquet table that cuts its lineage and outlives executors. The
    shuffle files behind it go with the write."""
    path = f"{shared_folder(df.sparkSession)}/quotemill-llm/{name}-{uuid.uuid4().hex}"
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def deal(key: Sequence[str], parts: int):
    """A hash of the ``key`` columns, from 0 to ``parts - 1``."""
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
