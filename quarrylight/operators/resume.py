"""Resumable stages: what is left to do, and merging old and new results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pending(wanted: DataFrame, done: DataFrame | None, key: str | list[str]) -> DataFrame:
    """Rows of wanted whose key is not done."""
    keys = [key] if isinstance(key, str) else key
    return wanted if done is None else wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def requested(done: DataFrame, wanted: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of done whose key is wanted."""
    keys = [key] if isinstance(key, str) else key
    return done.join(wanted.select(*keys).distinct(), keys, "left_semi")


def merge_last(old: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """Union by name; of rows with equal keys the new one stays."""
    keys = [key] if isinstance(key, str) else key
    both = old.withColumn("__age", F.lit(0)).unionByName(new.withColumn("__age", F.lit(1)), allowMissingColumns=True)
    return last(both, keys, F.desc("__age")).drop("__age")


def merge_checked(left: DataFrame, right: DataFrame, key: str, kind: str = "one_to_one") -> DataFrame:
    """Left join by key. ValueError if right repeats a key, or left does and kind is not many_to_one."""
    for side, df in (("right", right), *([] if kind == "many_to_one" else [("left", left)])):
        if not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            raise ValueError(f"{key} repeats on the {side}")
    return left.join(right, key, "left")


def last(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")
