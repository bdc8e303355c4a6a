"""What the training-data operators share: reading tables, text keys, durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, wherever Spark can read it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are. Texts that are all ASCII take the faster way."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's spark.checkpoint.dir. Only where that is unset and the session is local
    (tests), a temporary folder is made; on a cluster an unset folder is an error, as a
    machine-local folder would lose results.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quarrylight-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once, store it in the shared folder, and cut its lineage there.

    Spark removes the files when the frame is no longer referenced, if the session sets
    spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Send at most so many texts to a Python worker at once, in the jobs that run inside."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


class Shelf:
    """Tables stored as Parquet in the shared folder while an operator works; gone when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark).rstrip('/')}/shelf-{uuid.uuid4().hex}"

    def __enter__(self) -> Shelf:
        return self

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __exit__(self, *_) -> None:
        self.drop()


def require(df: DataFrame, *names: str) -> None:
    """Raise ValueError if a column that an operator reads is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")

