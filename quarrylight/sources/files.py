"""Files at the edges: CSV in and out, page tables, manifests, stage tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import sql_text


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any file system that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """A CSV file with a header, all columns as text; the words for missing values are null.

    multi_line: fields may hold line breaks, and a file is one task; without, large files are split.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*[sql_text(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A stage's table, or None if it has not been written. If replacing it was cut short, the table as it was before."""
    for at in (path, f"{path}.old"):
        if exists(spark, at):
            return spark.read.parquet(at)
    return None


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write a stage's table, by the commit protocol, and read it back. A table may replace its own source.

    The old table is moved aside and removed last, so that at every moment one whole table is there.
    """
    spark, fs_path = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path
    df.write.mode("overwrite").parquet(f"{path}.new")
    system = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(fs_path(path)):
        system.delete(fs_path(f"{path}.old"), True)
        system.rename(fs_path(path), fs_path(f"{path}.old"))
    system.rename(fs_path(f"{path}.new"), fs_path(path))
    system.delete(fs_path(f"{path}.old"), True)
    return spark.read.parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A folder of <company_id>.html files as (company_id, html)."""
    files = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return files.select(F.regexp_extract("file", r"([^/]+)\.html?$", 1).alias("company_id"), F.col("value").alias("html"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header, also for an empty table."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """One small CSV file (a final sample of a few hundred rows), replaced in one step."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    half = target.with_name(f".{target.name}.new")
    try:
        df.toPandas().to_csv(half, index=False, encoding="utf-8-sig" if bom else "utf-8", lineterminator="\n")
        half.replace(target)
    finally:
        half.unlink(missing_ok=True)


def write_manifest(summary: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(summary, indent=2, default=str) + "\n", encoding="utf-8")
