"""Sharding by sampled splitters.

Records are ordered by (hash of the text, hash of the id), so equal texts lie side by side. A sample
drawn in proportion to record size gives quantile boundaries between many small key ranges; the exact
bytes of every range are then counted, overfull ranges (a hot text, a few long records) are sampled
again and subdivided by the id's hash, and the ranges are packed onto the shards, largest first.
Everything the driver holds - samples, boundaries, range sizes - is bounded by the number of ranges,
which is a parameter and does not grow with the table.

Slots are numbered inside ranges and shifted by the range's place in its shard, so that no task ever
holds a whole shard.

Defined cases: a null text counts 16 bytes and the checksum of the empty text; a null id is hashed as
null; rows that repeat id and text stay in one range; an empty table gives an empty result; columns of
any other name pass through untouched.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import require, settle

LAW = "bytes"
OVERHEAD = 16
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 16
LOWEST = np.iinfo(np.int64).min


def _range_udf(bounds: list[tuple[int, int]]):
    """Number of boundaries (key, tie) at or below each record."""
    keys, ties = (np.array([b[i] for b in bounds], np.int64) for i in (0, 1))

    @F.pandas_udf(T.IntegerType())
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        out = low.copy()
        for start in np.unique(low[low < high]):  # boundaries that cut through one key
            rows = (low == start) & (low < high)
            stop = high[rows][0]
            out[rows] = start + np.searchsorted(ties[start:stop], t[rows], "right")
        return pd.Series(out.astype(np.int32))

    return place


def _sample(rows: DataFrame, rate: float, salt: int) -> list:
    """Each record with probability min(1, rate * size), by a hash, so that reruns draw the same."""
    u = F.pmod(F.xxhash64("tie", "key", F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)
    return rows.filter(u < F.col("size") * rate).select("key", "tie", F.greatest(F.col("size").cast("double"), F.lit(1 / rate)).alias("w")).collect()


def _cut(sample: list, step: float, between_keys: bool) -> list[tuple[int, int]]:
    """Boundaries after every `step` bytes of the sampled order; between_keys: never inside one key."""
    bounds, mass, due = [], 0.0, step
    for key, tie, w in sorted(sample):
        if mass >= due:
            bounds.append((key, LOWEST if between_keys else tie))
            due = mass + step
        mass += w
    return bounds


def _keyed(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    require(df, id_col, text_col)
    text = F.col(text_col)
    return df.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.xxhash64(F.col(id_col), F.lit(17)).alias("tie"),
        *more,
    )


def _ranges(rows: DataFrame, n_ranges: int) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """Boundaries, and the exact bytes and records of every range."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [], {}
    step = max(1.0, total / n_ranges)
    bounds, stats, salt = _cut(_sample(rows, SAMPLES_PER_RANGE / step, 1), step, True), {}, 1
    while True:
        salt += 1
        ranged = rows.withColumn("range", _range_udf(bounds)("key", "tie"))
        found = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
        stats = {r["range"]: (r["bytes"], r["n"]) for r in found}
        overfull = [r for r, (size, n) in stats.items() if size > 2 * step and n > 1]
        if not overfull:
            break
        again = _sample(ranged.filter(F.col("range").isin(overfull)), SAMPLES_PER_RANGE / step, salt)
        more = {*_cut(again, step, False)} - {*bounds}
        if not more:  # what is left are single long records, or rows that repeat id and text
            break
        bounds = sorted({*bounds, *more})
    return bounds, stats


def _places(spark: SparkSession, stats: dict[int, tuple[int, int]], n_shards: int) -> DataFrame:
    """Pack the ranges onto shards, largest first onto the lightest; each range's first slot."""
    heap, of = [(0, s) for s in range(n_shards)], {}
    for r, (size, _) in sorted(stats.items(), key=lambda x: (-x[1][0], x[0])):
        load, shard = heapq.heappop(heap)
        of[r] = shard
        heapq.heappush(heap, (load + size, shard))
    offset, plan = [0] * n_shards, []
    for r in sorted(stats):
        plan.append((r, of[r], offset[of[r]]))
        offset[of[r]] += stats[r][1]
    return spark.createDataFrame(plan, "range int, shard int, first long")


def _numbered(rows: DataFrame, n_shards: int, ranges_per_shard: int, full: DataFrame | None = None) -> DataFrame:
    """Rows (or full, which has the same keys and more) with shard and slot."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    bounds, stats = _ranges(rows, n_shards * ranges_per_shard)
    ranged = (rows if full is None else full).withColumn("range", _range_udf(bounds)("key", "tie"))
    inside = Window.partitionBy("range").orderBy("key", "tie", "id", "size")
    places = _places(rows.sparkSession, stats, n_shards)  # a few rows for each of n_shards * ranges_per_shard
    return ranged.withColumn("n", F.row_number().over(inside)).join(F.broadcast(places), "range").withColumn("slot", F.col("first") + F.col("n") - 1)


def assign(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """id, size, text_crc32, law, shard and slot of every record, one row per row of df."""
    rows = settle(_keyed(df, id_col, text_col))
    return _numbered(rows, n_shards, ranges_per_shard).select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot")


def shard_records(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """The records themselves with shard and slot, in slot order inside their ranges.

    Columns of df that are called shard or slot are replaced.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = settle(_keyed(df, id_col, text_col))
    full = _keyed(df, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    return _numbered(rows, n_shards, ranges_per_shard, full).select("row.*", "shard", "slot")


def write_shards(df: DataFrame, path: str, n_shards: int, **columns: str) -> None:
    """Write the records as one folder of Parquet files for each shard."""
    shard_records(df, n_shards, **columns).write.partitionBy("shard").parquet(path)
