"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its word shingles. Two collections of SIDE half-keys, each made of WIDTH minhashes,
are computed once; table (i, j) is keyed by the pair of half-key i of the first collection and half-key j of
the second, so 2 * SIDE * WIDTH minhashes serve SIDE * SIDE tables of 2 * WIDTH hashes. Half-keys travel packed
by the thousand; those that only one document has are dropped before any table is formed.

Documents with equal sets are one node. Links are confirmed on the full shingle sets, recomputed from the
texts. Two quick rounds compare a node with a few leaders of its buckets, which joins most of a large group.
Then nodes of different components that still share a bucket meet in blocks of bounded size, by sizes and
parity sketches. A sketch holds, for each cell of a hash, whether an odd number of the set's shingles fall into
it; two sketches differ in no more cells than the sets differ in shingles, and hardly ever in many more than
sets at the threshold are expected to (LIMITS; a link is ruled out with probability below 1e-9). Of the partners
that are left, each node of a smaller component hands on its likeliest ones; what the full sets confirm joins
components; buckets that had more pairs meet again and hand on MORE_PARTNERS times as many, until no bucket has an
untested pair of different components. So no bucket is capped, and pairs inside a component are not listed.
Only the comparison of sketches grows with the square of the nodes in a bucket that are not joined.

With SIDE = 12 and WIDTH = 3 a pair at similarity 0.8 shares no table with probability below 4e-4 (at 0.85:
3e-5), and shares 38 of the 144 tables on average; two documents at 0.2 share one with probability 0.9 percent,
so that buckets grow little faster than the documents.

Defined cases: null texts and texts without words have no shingles and link with nothing; fewer words than a
shingle are one shingle; null ids take part and are never the smallest of a component that has another;
rows that repeat are reported each; an empty table gives an empty result; columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Shelf, require, settle, small_batches
from .components import connected
from .textsets import chunks, mix, packed, shingle_sets, unpacked

SIDE, WIDTH = 12, 3
SLICE, AT_ONCE = 256, 256
SHINGLE = 5
THRESHOLD = (80, 100)
QUICK_ROUNDS, QUICK_LEADERS = 2, 6
CELLS, FOLDED = 16, 4  # 64-bit words of a sketch, and of its folded form that is compared first
BLOCK_NODES, SMALL_BUCKET = 4096, 64
FIRST_PARTNERS, MORE_PARTNERS = 2, 32
MOST_HELD = 1 << 17
BUCKET_ROWS, DEALT_ROWS, MOST_ROWS = 1 << 16, 1 << 18, 1 << 20
PARCELS = 64  # packed parcels in one batch to a Python worker
BROADCAST_NODES = 200_000
_rng = np.random.default_rng(20240607)
_MULTIPLIERS = _rng.integers(1, 1 << 63, 2 * SIDE * WIDTH, np.uint64) | np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, 2 * SIDE * WIDTH, np.uint64)
_SALTS = _rng.integers(0, 1 << 63, 3, np.uint64)
_CELL_SALT = _rng.integers(0, 1 << 63, 1, np.uint64)


def _limits(cells: int) -> np.ndarray:
    """For each number of shingles in which sets differ, the most cells in which sketches do: six deviations over the mean."""
    d = np.arange(1 << 14)
    share = (1 - (1 - 2 / cells) ** d) / 2
    return np.minimum(d, np.ceil(cells * share + 6 * np.sqrt(cells * share * (1 - share)) + 1)).astype(np.int64)


LIMITS, FOLDED_LIMITS = _limits(64 * CELLS), _limits(64 * FOLDED)


def _half_keys(found: np.ndarray) -> np.ndarray:
    """SIDE half-keys of the first collection, then of the second."""
    least = np.full(len(_OFFSETS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), AT_ONCE):
        np.minimum(least, (found[at : at + AT_ONCE, None] * _MULTIPLIERS + _OFFSETS).min(0), out=least)
    least = least.reshape(2 * SIDE, WIDTH)
    key = np.arange(2 * SIDE, dtype=np.uint64)
    for j in range(WIDTH):
        key = mix(key * np.uint64(0x2545F4914F6CDD1D) + least[:, j])
    return key


def _parity(found: np.ndarray) -> bytes:
    """Whether each cell has an odd number of the set's shingles, as bits."""
    cells = (mix(found ^ _CELL_SALT) % np.uint64(64 * CELLS)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=64 * CELLS) & 1).astype(np.uint8)).tobytes()


def _sketch(shingle: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            counts, nodes, keys, parities, texts = [], [], [], [], batch.column(1).to_pylist()
            for _, run in chunks(texts):
                for found in shingle_sets(run, shingle):
                    counts.append(len(found))
                    if not len(found):
                        nodes.append(None)
                        keys.append([])
                        parities.append(None)
                        continue
                    # Sums over the set under independent mixings, so that equal sets have equal nodes.
                    sums = np.array([mix(found ^ s).sum(dtype=np.uint64) for s in _SALTS], np.uint64)
                    nodes.append(int(mix(mix(sums[:1]) + np.uint64(len(found)) + mix(sums[1:2] ^ sums[2:3])).view(np.int64)[0]))
                    keys.append(_half_keys(found).view(np.int64))
                    parities.append(_parity(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(parities, pa.binary())],
                names=["id", "text_key", "n", "node", "keys", "parity"],
            )

    return sketch


HALF = {"half": "i8", "node": "i8", "n": "i8", "i": "u1"}


def _deal(buckets: int):
    """bucket, data: the half-keys of nodes, packed."""

    def dealt(held: list) -> pa.RecordBatch:
        col = [np.concatenate(c) for c in zip(*held, strict=True)]
        bucket = (col[0].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        rows = [order[at:to] for at, to in zip(edges, [*edges[1:], len(order)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[[r[0] for r in rows]]), pa.array([packed(*(c[r] for c in col)) for r in rows], pa.binary())], names=["bucket", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            node, n = (np.repeat(batch.column(c).to_numpy(), 2 * SIDE) for c in (0, 1))
            held.append((batch.column(2).flatten().to_numpy(), node, n, np.tile(np.arange(2 * SIDE, dtype=np.uint8), batch.num_rows)))
            size += len(node)
            if size >= DEALT_ROWS:
                yield dealt(held)
                held, size = [], 0
        if size:
            yield dealt(held)

    return deal


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """i, half, node, n of half-keys that several nodes have; rows come by bucket.

    Of a bucket with more rows than MOST_ROWS one row for each half-key is held from piece to piece.
    """

    def emit(held: list) -> tuple[pa.RecordBatch, list]:
        half, node, n, i, done = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((~done, node, half))
        half, node, n, i, done = (c[order] for c in (half, node, n, i, done))
        once = np.concatenate([[True], (half[1:] != half[:-1]) | (node[1:] != node[:-1])])
        half, node, n, i, done = (c[once] for c in (half, node, n, i, done))
        firsts = np.flatnonzero(np.concatenate([[True], half[1:] != half[:-1]]))
        shared = (np.diff(np.append(firsts, len(half))) > 1) | np.logical_or.reduceat(done, firsts)
        out = np.repeat(shared, np.diff(np.append(firsts, len(half)))) & ~done
        rest = (half[firsts], node[firsts], n[firsts], i[firsts], shared)
        return pa.RecordBatch.from_arrays([pa.array(i[out].astype(np.int32)), pa.array(half[out]), pa.array(node[out]), pa.array(n[out])], names=["i", "half", "node", "n"]), [rest]

    bucket, held, size = None, [], 0
    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if number != bucket and held:
                yield emit(held)[0]
                held, size = [], 0
            elif size > MOST_ROWS:
                found, held = emit(held)
                yield found
                size = 0
            bucket, cols = number, unpacked(data, *HALF.values())
            held.append((*cols, np.zeros(len(cols[0]), bool)))
            size += len(cols[0])
    if held:
        yield emit(held)[0]


def _confirm(shingle: int, threshold: tuple[int, int]):
    """Pairs whose full sets are similar enough."""
    share, whole = threshold

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                sets = {}
                texts = list(dict.fromkeys([*part["text_a"], *part["text_b"]]))
                for first, run in chunks(texts):
                    for i, found in enumerate(shingle_sets(run, shingle)):
                        sets[texts[first + i]] = found
                good = []
                for a, b in zip(part["text_a"], part["text_b"], strict=True):
                    x, y = sets[a], sets[b]
                    both = len(np.intersect1d(x, y, assume_unique=True)) if whole * min(len(x), len(y)) >= share * max(len(x), len(y)) else 0
                    good.append(whole * both >= share * (len(x) + len(y) - both) and both > 0)
                yield part[good][["a", "b"]]

    return confirm


def _texts(df: DataFrame, text_col: str, keys: DataFrame) -> DataFrame:
    """node, text for nodes (node, text_key); small key tables go to the scan, larger ones meet it in a shuffle."""
    texts = df.select(F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_NODES else keys
    return texts.join(keys, "text_key").groupBy("node").agg(F.first("text").alias("text"))


def _round(shelf: Shelf, df: DataFrame, text_col: str, buckets: DataFrame, labels: DataFrame | None, nodes: DataFrame, tested: DataFrame | None, number: int, most: int | None, shingle: int, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compare nodes of buckets (key, node, n) with two leaders of their bucket that are of other components.

    Leaders are the first and last node by a hash that differs from round to round. most: compare a node with
    so many leaders only, for rounds that others follow. Returns (pairs tested, links, buckets that held more
    than one component); the buckets are read from the shelf.
    """
    share, whole = threshold
    if labels is None:
        labelled = buckets.withColumn("label", F.col("node"))
    else:
        labelled = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    order = labelled.withColumn("p", F.xxhash64("node", "key", F.lit(number)))
    heads = order.groupBy("key").agg(
        F.min_by("node", "p").alias("first"), F.min_by("label", "p").alias("first_label"), F.min_by("n", "p").alias("first_n"),
        F.max_by("node", "p").alias("last"), F.max_by("label", "p").alias("last_label"), F.max_by("n", "p").alias("last_n"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    ).filter("low <> high").drop("low", "high")
    met = shelf.put(f"round-{number}", labelled.join(heads, "key"))
    leaders = [F.struct(*[F.col(f"{end}{c}").alias(f"head{c}") for c in ("", "_label", "_n")]) for end in ("first", "last")]
    pairs = met.select("node", "label", "n", F.explode(F.array(*leaders)).alias("h"))
    pairs = pairs.filter((F.col("label") != F.col("h.head_label")) & (whole * F.least("n", "h.head_n") >= share * F.greatest("n", "h.head_n")))
    pairs = pairs.select(F.least("node", "h.head").alias("a"), F.greatest("node", "h.head").alias("b"), "node").distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    if most is not None:
        some = Window.partitionBy("node").orderBy(F.xxhash64("a", "b", F.lit(number)))  # at most two leaders for each table
        pairs = pairs.withColumn("k", F.row_number().over(some)).filter(F.col("k") <= most)
    pairs = settle(pairs.select("a", "b").distinct())
    return pairs, _links(df, text_col, pairs, nodes, shingle, threshold), met.select("key", "node", "n")


def _runs(group: np.ndarray, label: np.ndarray) -> Iterator[tuple]:
    """(rows or one row, later rows) that together give every pair of rows of one group with different labels.

    Groups lie in one piece each, and labels of a group too. In large groups no two rows of the most frequent
    label are met.
    """
    edges = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]])
    sizes = np.diff(edges)
    end = np.repeat(edges[1:], sizes)
    rows = np.flatnonzero(np.repeat(sizes <= SMALL_BUCKET, sizes))
    for d in range(1, SMALL_BUCKET):
        rows = rows[rows + d < end[rows]]
        if not len(rows):
            break
        yield rows, rows + d
    for at in np.flatnonzero(sizes > SMALL_BUCKET):
        low, high = edges[at], edges[at + 1]
        turns = np.concatenate([[low], np.flatnonzero(label[low + 1 : high] != label[low : high - 1]) + low + 1, [high]])
        k = np.diff(turns).argmax()
        first, last = turns[k], turns[k + 1]
        for r in range(low, first):
            yield r, slice(r + 1, high)
        for r in range(last, high):
            yield r, slice(first, last)
            yield r, slice(r + 1, high)


def _near(threshold: tuple[int, int], keep: int):
    """key, a, b, more: pairs of one bucket and different components that sizes and sketches do not rule out.

    A node of the component that has fewer nodes here hands on its `keep` likeliest partners; more: there are others.
    """
    share, whole = threshold
    group = ["key", "low", "high"]

    def likeliest(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows (asking, other, apart, more) the first `keep` of each asking node."""
        found = found[:, np.lexsort((found[1], found[2], found[0]))]
        new = np.flatnonzero(np.diff(found[0], prepend=-1))
        count = np.diff(np.append(new, found.shape[1]))
        found[3] |= np.repeat(count > keep, count)
        return found[:, np.arange(found.shape[1]) - np.repeat(new, count) < keep]

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        key, low, high, side, node, label, n = (pdf[c].to_numpy() for c in (*group, "side", "node", "label", "n"))
        turn = lambda *cs: np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in cs])]).cumsum()
        of, within = turn(key, low, high), low == high
        part = turn(key, low, high, label) - 1  # components lie in one piece each
        members = np.bincount(part)[part]
        words = np.frombuffer(b"".join(pdf["parity"]), np.uint64).reshape(-1, CELLS)
        folded = np.ascontiguousarray(np.bitwise_xor.reduce(words.reshape(-1, CELLS // FOLDED, FOLDED), 1).T)
        room = n * (whole - share)
        out, held, most = [np.empty((4, 0), np.int64)], 0, MOST_HELD
        for a, b in _runs(of, label):
            apart = np.bitwise_count(folded[0][a] ^ folded[0][b]).astype(np.uint16)
            for f in folded[1:]:
                apart += np.bitwise_count(f[a] ^ f[b])
            differ = np.minimum((room[a] + room[b]) // (whole + share), len(LIMITS) - 1)  # shingles, at the threshold
            near = np.flatnonzero((apart <= FOLDED_LIMITS[differ]) & (label[a] != label[b]) & (within[a] | (side[a] != side[b])))
            if len(near):
                x, y = (np.full(len(near), a), near + b.start) if isinstance(b, slice) else (a[near], b[near])
                apart = np.bitwise_count(words[x] ^ words[y]).sum(1, dtype=np.int64)
                good = (apart <= LIMITS[differ[near]]) & (whole * np.minimum(n[x], n[y]) >= share * np.maximum(n[x], n[y]))
                x, y, apart = x[good], y[good], apart[good]
                turned = (members[x] > members[y]) | ((members[x] == members[y]) & (label[x] < label[y]))
                out.append(np.stack([np.where(turned, y, x), np.where(turned, x, y), apart, np.zeros_like(apart)]))
                held += len(x)
                if held > most:  # memory stays bounded, however many pairs are near
                    out = [likeliest(np.concatenate(out, 1))]
                    held = out[0].shape[1]
                    most = max(MOST_HELD, 2 * held)
        x, y, _, more = likeliest(np.concatenate(out, 1))
        return pd.DataFrame({"key": key[x], "a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y]), "more": more.astype(bool)})

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = (pdf[group] == pdf[group].iloc[-1]).all(axis=1).to_numpy() if len(pdf) else np.zeros(0, bool)
            rest = pdf[last].reset_index(drop=True)
            if not last.all():
                yield pairs(pdf[~last])
        if rest is not None and len(rest):
            yield pairs(rest)

    return near


def _candidates(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, threshold: tuple[int, int], keep: int, keys: DataFrame | None) -> DataFrame:
    """key, a, b, more for pairs of different components that share a bucket (one of keys, if given): the likeliest of each node."""
    labelled = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    several = several if keys is None else several.join(keys, "key", "left_semi")
    blocks = F.ceil(F.col("c") / BLOCK_NODES).cast("long")
    rows = labelled.join(several.select("key", blocks.alias("blocks")), "key").withColumn("side", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node", "label", "n")
    rows = rows.join(nodes.select("node", "parity"), "node").select("key", "low", "high", "side", "node", "label", "n", "parity")
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "label")
    return rows.mapInPandas(_near(threshold, keep), "key long, a long, b long, more boolean")


def _links(df: DataFrame, text_col: str, pairs: DataFrame, nodes: DataFrame, shingle: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that the full sets confirm."""
    wanted = settle(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "text_key"), "node"))
    texts = _texts(df, text_col, wanted)
    both = pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")
    with small_batches(df.sparkSession):
        return settle(both.mapInPandas(_confirm(shingle, threshold), "a long, b long"))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """id, text_key, n_shingles, component_id and kept of every row."""
    require(df, id_col, text_col)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))
    kind = df.schema[id_col].dataType.simpleString()
    with small_batches(df.sparkSession):
        rows = settle(rows.mapInArrow(_sketch(shingle), f"id {kind}, text_key long, n long, node long, keys array<long>, parity binary"))
    nodes = settle(rows.filter("n > 0").groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("parity").alias("parity")))
    dealt = rows.filter("n > 0").select("node", "n", "keys").mapInArrow(_deal(2 * SIDE * rows.count() // BUCKET_ROWS + 1), "bucket int, data binary")
    halves = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared, "i int, half long, node long, n long")
    with small_batches(df.sparkSession, PARCELS):  # a batch of the usual number of rows would hold all parcels of a task
        halves = settle(halves.distinct())
    first, second = halves.filter(F.col("i") < SIDE), halves.filter(F.col("i") >= SIDE)
    buckets = first.select("node", "n", F.col("half").alias("x")).join(second.select("node", F.col("half").alias("y")), "node").select(F.xxhash64("x", "y").alias("key"), "node", "n")
    tested = links = labels = None
    with Shelf(df.sparkSession) as shelf:
        for number in range(QUICK_ROUNDS):
            more, new, buckets = _round(shelf, df, text_col, buckets, labels, nodes, tested, number, QUICK_LEADERS, shingle, threshold)
            if number:
                shelf.drop(f"round-{number - 1}")
            links = new if links is None else settle(links.unionAll(new))
            labels = settle(connected(links))
            tested = more if tested is None else settle(tested.unionAll(more))
        keep, number, full = FIRST_PARTNERS, QUICK_ROUNDS, None
        while True:
            found = shelf.put(f"near-{number}", _candidates(buckets, labels, nodes, threshold, keep, full))
            pairs = settle(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"))
            if not pairs.isEmpty():
                links = settle(links.unionAll(_links(df, text_col, pairs, nodes, shingle, threshold)))
                labels = settle(connected(links))
                tested = settle(tested.unionAll(pairs))
            full = settle(found.filter("more").select("key").distinct())
            if full.isEmpty():
                break
            keep, number = keep * MORE_PARTNERS, number + 1
    out = rows.select("id", "text_key", "n", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = out.groupBy("label").agg(F.min("id").alias("least"))
    out = out.join(least, "label", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Rows of df, one for each component; documents without words stay. Of rows that repeat id and text one stays."""
    kept = groups(df, id_col, text_col, shingle, threshold).filter("kept").select(F.col(id_col).alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_key"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key")), "left_semi")
    same = Window.partitionBy("id", "text_key").orderBy(F.lit(0))
    return rows.withColumn("copy", F.row_number().over(same)).filter("copy = 1").select("row.*")
