"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a hash of the document id. A source's target is met by whole passes
over its blocks, a random run of further blocks, and documents of one last block. The resulting exact
block quotas are split among output shards by a binary tree whose nodes draw the left child's quota
vector from a multivariate hypergeometric distribution; each shard then takes the next blocks of every
source's permutation, so that shards are disjoint, and shuffles its documents locally.

The driver holds sizes of sources, of at most MAX_BLOCKS blocks and of the cells of one block a source.

Defined cases: a null text has size 0; null is a source of its own, last in order; a source of size 0
has target 0; documents of size 0 count as taken 0 times; rows that repeat id and source are taken alike
inside the last cell; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require, settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
MAX_BLOCKS = 4096
DOCUMENTS_PER_BLOCK = 64
CELL = 512
SHARDS = 16


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Words to take of each source: shares by weight, capped at `most` times the source, excess reshared."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, active = dict.fromkeys(names, 0.0), float(sum(sizes.values())), list(names)
    while active:
        whole = sum(weight[s] for s in active)
        full = [s for s in active if left * weight[s] / whole > most * sizes[s]]
        if not full:
            for s in active:
                out[s] = left * weight[s] / whole
            break
        for s in full:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in full)
        active = [s for s in active if s not in set(full)]
    return out


def split_quotas(counts: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Block quotas, [shard, source], whose columns add up to counts."""
    counts = np.asarray(counts, np.int64)
    out = np.zeros((n_shards, len(counts)), np.int64)

    def node(quota: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[low] = quota
            return
        middle = (low + high) // 2
        take = int(round(int(quota.sum()) * (middle - low) / (high - low)))
        draw = np.random.default_rng([seed, low, high])
        left = draw.multivariate_hypergeometric(quota, take, method="marginals") if take else np.zeros_like(quota)
        node(left, low, middle)
        node(quota - left, middle, high)

    if len(counts):
        node(counts, 0, n_shards)
    return out


@dataclass(frozen=True)
class Plan:
    """The mixture as small tables; none grows with the documents.

    sources: source, source_no, source_size, target, blocks. draws: source_no, block, shards (one entry
    for each time that the block is drawn). ends: source_no, end_block, cells, end_cell; cells below
    end_cell of that block are drawn once more. chosen: source_no, h, size of documents of the end cell
    that are drawn once more.
    """

    sources: DataFrame
    draws: DataFrame
    ends: DataFrame
    chosen: DataFrame
    n_shards: int
    seed: int

    def apply(self, rows: DataFrame) -> DataFrame:
        """Rows (source, h, size, ...) with source_size, target and shards, an entry for each repeat."""
        rows = rows.withColumnRenamed("source", "of").join(F.broadcast(self.sources), F.col("of").eqNullSafe(F.col("source")), "left")
        rows = rows.withColumn("block", F.pmod("h", "blocks")).join(F.broadcast(self.draws), ["source_no", "block"], "left")
        rows = rows.join(F.broadcast(self.ends), "source_no", "left").join(F.broadcast(self.chosen), ["source_no", "h", "size"], "left")
        more = (F.col("block") == F.col("end_block")) & ((_cell(self.seed) < F.col("end_cell")) | ((_cell(self.seed) == F.col("end_cell")) & F.coalesce("more", F.lit(False))))
        extra = F.when(more, F.array(F.pmod("h", F.lit(self.n_shards)).cast("int"))).otherwise(F.array().cast("array<int>"))
        return rows.withColumn("shards", F.concat(F.coalesce("shards", F.array().cast("array<int>")), extra))


def _cell(seed: int) -> Column:
    """The cell, inside its block, of a document."""
    return F.pmod(F.xxhash64("h", F.lit(seed + 1)), "cells")


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one source's end cell, in hash order, take what still fits, and one more if that ends nearer."""
    pdf = pdf.sort_values(["h", "size"], kind="stable").reset_index(drop=True)
    words, left, took = (pdf["size"] * pdf["n"]).tolist(), pdf["rest"].iloc[0], []
    for w in words:
        took.append(bool(0 < w <= left))
        left -= w * took[-1]
    over = [(w, i) for i, w in enumerate(words) if w and not took[i]]
    if over and min(over)[0] - left < left:
        took[min(over)[1]] = True
    return pdf.assign(more=took)[["source_no", "h", "size", "more"]]


def plan(rows: DataFrame, n_shards: int = SHARDS, seed: int = 7) -> Plan:
    """Draw the mixture for settled rows (source, h, size)."""
    spark = rows.sparkSession
    stats = {r["source"]: r for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()}
    want, total = targets({s: r["size"] for s, r in stats.items()}), sum(r["n"] for r in stats.values())
    blocks = [max(1, min(stats[s]["n"] // DOCUMENTS_PER_BLOCK, MAX_BLOCKS * stats[s]["n"] // total)) for s in want]
    sources = spark.createDataFrame([(i, s, stats[s]["size"], t, blocks[i]) for i, (s, t) in enumerate(want.items())], "source_no int, source string, source_size long, target double, blocks long")
    rows = rows.withColumnRenamed("source", "of").join(F.broadcast(sources), F.col("of").eqNullSafe(F.col("source"))).withColumn("block", F.pmod("h", "blocks"))
    of_block = {(r["source_no"], r["block"]): r for r in rows.groupBy("source_no", "block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()}

    order, ends = [], []  # of every source, its blocks as drawn; where its last run ends
    for i, (s, target) in enumerate(want.items()):
        size = stats[s]["size"]
        passes = int(target // size) if size else 0
        shuffled = [np.random.default_rng([seed, i, k]).permutation(blocks[i]).tolist() for k in range(passes + 1)]
        drawn, need = [b for x in shuffled[:passes] for b in x], target - passes * size
        for block in shuffled[passes]:
            here = of_block.get((i, block))
            if here and here["size"] > need:
                ends.append((i, block, max(1, here["n"] // CELL), need))
                break
            drawn.append(block)
            need -= here["size"] if here else 0
        order.append(drawn)

    quotas, at, shards = split_quotas([len(x) for x in order], n_shards, seed), [0] * len(order), {}
    for shard, quota in enumerate(quotas.tolist()):
        for i, k in enumerate(quota):
            for block in order[i][at[i] : at[i] + k]:
                shards.setdefault((i, block), []).append(shard)
            at[i] += k
    draws = spark.createDataFrame([(*k, v) for k, v in shards.items()], "source_no int, block long, shards array<int>")

    cut = spark.createDataFrame(ends, "source_no int, block long, cells long, rest double")
    last = rows.select("source_no", "block", "h", "size").join(F.broadcast(cut), ["source_no", "block"]).withColumn("cell", _cell(seed))
    in_cell, closing = {}, []
    for r in last.groupBy("source_no", "cell").agg(F.sum("size").alias("size")).collect():
        in_cell.setdefault(r["source_no"], {})[r["cell"]] = r["size"]
    for i, block, cells, need in ends:
        for cell, size in sorted(in_cell[i].items()):
            if size > need:
                closing.append((i, block, cells, cell, need))
                break
            need -= size
    closing = spark.createDataFrame(closing, "source_no int, end_block long, cells long, end_cell long, rest double")
    rest = last.drop("rest", "cells").join(F.broadcast(closing), "source_no").filter("cell = end_cell").groupBy("source_no", "h", "size", "rest").agg(F.count(F.lit(1)).alias("n"))
    chosen = settle(rest.groupBy("source_no").applyInPandas(_fill, "source_no int, h long, size long, more boolean"))  # about CELL rows a source
    return Plan(sources, draws, closing.drop("rest"), chosen.filter("more"), n_shards, seed)


def _keyed(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, *more: Column) -> DataFrame:
    require(df, id_col, text_col, source_col)
    return df.select(F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *more)


def mix_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", n_shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """id, size, source_size, target and taken of every row: taken is size times the row's repeats.

    shards: the output shards of the repeats, comma-joined, as the splitting tree has dealt the row's block.
    """
    rows = settle(_keyed(df, id_col, text_col, source_col, seed, F.col(id_col).alias("id")))
    out = plan(rows, n_shards, seed).apply(rows)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"), F.array_join(F.array_sort("shards"), ",").alias("shards"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", n_shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """The mixture itself: rows of df repeated as drawn, dealt to their shards and shuffled inside them.

    Rows of size 0 are never needed for a target and do not appear.
    """
    small = settle(_keyed(df, id_col, text_col, source_col, seed))
    drawn = plan(small, n_shards, seed)
    full = _keyed(df, id_col, text_col, source_col, seed, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    dealt = drawn.apply(full.filter("size > 0")).select("row", "h", F.posexplode("shards").alias("draw", "shard"))
    spread = F.pmod(F.xxhash64("h", "draw"), F.lit(64))  # parts of a shard, so that no task holds a whole one
    dealt = dealt.withColumn("part", spread).repartition("shard", "part")
    return dealt.sortWithinPartitions("shard", "part", F.xxhash64("h", "draw", F.lit(seed))).select("row.*")
