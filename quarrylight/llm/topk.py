"""Exact top-k search by distributed histogram selection.

Queries are taken in blocks of bounded size against all rows. Every partition scores its rows against a
block and keeps, for each query, counts of its best score bins; the counts are added up globally, the bin
that holds the k-th best score is cut into finer bins, and so on until that bin is one score wide. Then
only rows at or above the k-th score are read out; among ties at the k-th score each partition gives its
k smallest ids, and the last rows are chosen by (score, id).

A partition need not report bins below its own k-th best score: the global k-th score is never lower. So
a pass sends at most k bins for each query and partition, however many rows score alike.

Defined cases: vectors that are null, empty, or hold a null or a non-finite component take no part;
vectors are compared with those of equal length only; rows that repeat an id are candidates each, but not
for queries of that id; a component beyond 64 bits counts as the nearest 64-bit integer, and a score beyond
2^61 as 2^61 with its sign; a query id that repeats is searched once (with its smallest vector); null ids
take no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import require, settle

SCALE = 1024
BINS = 256
BLOCK = 512
ROWS = 2048
MOST_SCORE = 1 << 61


def quantised(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and the integer components floor(1024 * x) of vectors that take part."""
    require(df, id_col, vector_col)
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return df.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False))).select(F.col(id_col).alias("id"), whole.alias("v"))


class _Block:
    """Queries of one length, and for each the scores, low to below high, among which its k-th best is."""

    def __init__(self, ids: list[int], vectors: list[list[int]], k: int, most: int):
        self.ids, self.k = np.array(ids, np.int64), k
        self.vectors = np.array(vectors, np.int64)
        self.weight = max(sum(abs(x) for x in v) for v in vectors)
        reach = min(self.weight * most, MOST_SCORE) + 1  # no score is beyond this
        self.width = max(1, -(-(2 * reach + 1) // BINS))
        self.low = np.full(len(ids), -reach, np.int64)
        self.high = self.low + self.width * BINS
        self.above = np.zeros(len(ids), np.int64)  # rows at or above high

    def scores(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores [query, row]) of the candidates; own rows score below everything."""
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                part = pdf.iloc[at : at + ROWS]
                part = part[part["v"].map(len) == self.vectors.shape[1]]
                if len(part):
                    ids = part["id"].to_numpy(np.int64)
                    found = self._products(np.stack(part["v"].to_numpy()))
                    yield ids, np.where(self.ids[:, None] == ids[None, :], np.iinfo(np.int64).min, found)

    def _products(self, rows: np.ndarray) -> np.ndarray:
        """Exact inner products, in the fastest numbers that hold them."""
        reach = self.weight * max(abs(int(rows.min())), abs(int(rows.max())))
        if reach < 1 << 52:
            return (self.vectors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
        if reach < MOST_SCORE:
            return self.vectors @ rows.T
        return np.clip(self.vectors.astype(object) @ rows.astype(object).T, -MOST_SCORE, MOST_SCORE).astype(np.int64)

    def histogram(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """query number, bin and count of the partition's best bins inside the current range."""
        counts = np.zeros((len(self.ids), BINS), np.int64)
        for _, found in self.scores(batches):
            bins = (found - self.low[:, None]) // self.width
            q, c = np.nonzero((found >= self.low[:, None]) & (found < self.high[:, None]))  # bins may reach past high
            counts += np.bincount(q * BINS + bins[q, c], minlength=counts.size).reshape(counts.shape)
        better = np.cumsum(counts[:, ::-1], 1)[:, ::-1] - counts  # rows in higher bins
        q, b = np.nonzero((counts > 0) & (better < self.k))
        yield pd.DataFrame({"q": q, "bin": b, "n": counts[q, b]})

    def refine(self, found: list) -> None:
        """Move to the bin that holds the k-th best score, or to the lowest score if there are fewer rows."""
        counts = np.zeros((len(self.ids), BINS), np.int64)
        for q, b, n in found:
            counts[q, b] = n
        upper = self.above[:, None] + np.cumsum(counts[:, ::-1], 1)[:, ::-1]
        at = np.where(upper[:, :1] >= self.k, (upper >= self.k).sum(1, keepdims=True) - 1, 0)
        self.above = np.take_along_axis(upper - counts, at, 1)[:, 0]
        self.low = self.low + at[:, 0] * self.width
        self.high = np.minimum(self.high, self.low + self.width)

    def rows(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows at or above the k-th score; of equal scores the partition's k smallest ids."""
        kept = [np.empty((0, 2), np.int64) for _ in self.ids]
        for ids, found in self.scores(batches):
            for q in np.flatnonzero((found >= self.low[:, None]).any(1)):
                at = np.flatnonzero(found[q] >= self.low[q])
                rows = np.concatenate([kept[q], np.stack([ids[at], found[q, at]], 1)])
                kept[q] = rows[np.lexsort((rows[:, 0], -rows[:, 1]))[: self.k]]
        out = [pd.DataFrame({"query_id": i, "vec_id": r[:, 0], "score": r[:, 1]}) for i, r in zip(self.ids, kept, strict=True) if len(r)]
        if out:
            yield pd.concat(out)


def _search(rows: DataFrame, block: _Block) -> DataFrame:
    while True:
        counts = rows.mapInPandas(block.histogram, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        block.refine([(r["q"], r["bin"], r["n"]) for r in counts.collect()])  # at most BLOCK * BINS small rows
        if block.width == 1:
            break
        block.width = max(1, -(-block.width // BINS))
    return rows.mapInPandas(block.rows, "query_id long, vec_id long, score long")


def search(df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """The k best rows of df for every query (of the same columns): query_id, rank, vec_id, score."""
    spark, rows = df.sparkSession, settle(quantised(df, id_col, vector_col))
    asked = quantised(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    ends = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    most = max(abs(x or 0) for x in ends)
    parts, waiting = [], {}

    def run(length: int) -> None:
        found = _search(rows, _Block(*zip(*waiting.pop(length), strict=True), k, most))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        parts.append(settle(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)))

    for row in asked.toLocalIterator():
        waiting.setdefault(len(row["v"]), []).append((row["id"], list(row["v"])))
        if len(waiting[len(row["v"])]) == block:
            run(len(row["v"]))
    for length in list(waiting):
        run(length)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.select("query_id", "rank", "vec_id", "score")
