"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, counted over all lines in a table of fixed size
(words that share a cell share a count: any one order gives an exact join). Two sets at Jaccard 0.8 or more
share a word among the first words of both. Each such prefix word meets its like under the length filter (the
shorter has at least 0.8 of the longer), the positional filter (what is left after the first common word is
enough) and a parity filter: 128 bits hold for each cell of a hash whether an odd number of the set's words
fall into it, and those of two sets differ in no more bits than the sets differ in words, so no pair is lost.
Pairs that pass are verified on the lines themselves.

Lines with equal sets are one node. A line is removed if its set occurred earlier, or if a node that occurred
earlier is similar to it; earlier means by document id, then by line number. A node needs one similar earlier
node only, so each meeting hands on a node's few likeliest partners first, and more of them only for nodes that
those have not removed, until none is left: large groups of similar lines cost a comparison or two each, and no
pair that could remove another line is missed. Of a word with more than BLOCK rows, all nodes are first compared
with the earliest; what is left meets in blocks of bounded size.

What a word's rows carry is ids, sizes and the parities, packed by the thousand. Texts move only for lines in
pairs: few pairs are looked up where their lines are, many by a scan with a bitmap of fixed size (lines that it
lets through in vain are dropped by a join).

Defined cases: null texts have no lines; lines without words are never removed; null ids come last; rows
that repeat an id are one document with the lines of all; very long texts are taken in pieces of MOST_LINES
lines, a very long line whole; an empty table gives an empty result; other columns pass through `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shelf, require, settle, small_batches
from .textsets import chunks, hashed_words, mix, packed, unpacked

SHARE, WHOLE = 80, 100
CELLS, PAGE = 1 << 24, 1 << 14
BLOCK = 4096
FIRST_PARTNERS, MORE_PARTNERS = 1, 256
MOST_LINES, PAIRS = 1 << 14, 256
MEETING_ROWS, BUCKET_ROWS, DEALT_ROWS, COUNTED_WORDS = 1 << 16, 1 << 16, 1 << 18, 1 << 20
MAP_BITS = 1 << 26
BROADCAST_ROWS = 300_000
_SALTS = np.random.default_rng(20240608).integers(0, 1 << 63, 3, np.uint64)
LINES = "text_key long, line int, node long, n int, ord long, parity long, parity_2 long, skip int, cold int, words array<long>"


def _cells(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(40)).astype(np.int64) & (CELLS - 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page, data: counts of words by cell, for the cells of each page that has any."""

    def counted(held: list) -> pa.RecordBatch:
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        pages = cells // PAGE
        edges = np.flatnonzero(np.diff(pages, prepend=-1))
        parcels = [packed((cells[at:to] % PAGE).astype(np.uint16), counts[at:to].astype(np.uint32)) for at, to in zip(edges, [*edges[1:], len(cells)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(pages[edges].astype(np.int32)), pa.array(parcels, pa.binary())], names=["page", "data"])

    held, size = [], 0
    for batch in batches:
        for _, run in chunks(batch.column(0).to_pylist()):
            held.append(_cells(hashed_words(run)[0]).astype(np.int32))
            size += len(held[-1])
            if size > COUNTED_WORDS:
                yield counted(held)
                held, size = [], 0
    if size:
        yield counted(held)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page, bytes: of all counts of a page the rounded 8 * log2, at most 255, a byte for each cell. Rows come by page."""
    page, total = None, np.zeros(PAGE, np.int64)

    def done() -> pa.RecordBatch:
        rare = np.minimum(255, np.round(8 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([rare.tobytes()])], names=["page", "bytes"])

    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if number != page:
                if page is not None:
                    yield done()
                page, total = number, np.zeros(PAGE, np.int64)
            cells, counts = unpacked(data, "u2", "u4")
            total[cells] += counts
    if page is not None:
        yield done()


def _gathered(pages: DataFrame, size: int) -> np.ndarray:
    """`size` bytes from page, bytes: PAGE bytes each."""
    out = np.zeros(size, np.uint8)
    for row in pages.toLocalIterator():
        out[row["page"] * PAGE : (row["page"] + 1) * PAGE] = np.frombuffer(row["bytes"], np.uint8)
    return out


def rarity(df: DataFrame, text_col: str) -> np.ndarray:
    """For each cell the rounded 8 * log2 of its count, at most 255; 0 for a count of 1."""
    counts = df.select(F.col(text_col)).mapInArrow(_count, "page int, data binary").repartition("page").sortWithinPartitions("page")
    with small_batches(df.sparkSession):
        return _gathered(counts.mapInArrow(_add, "page int, bytes binary"), CELLS)


def _line_sets(lines: list[bytes], order: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of all lines, by line and rarity: words, line of each, rarity of each; nodes and sizes of lines."""
    words, of = hashed_words(lines)
    rare = np.zeros(len(words), np.uint8) if order is None else order[_cells(words)]
    key = (of.astype(np.uint64) << np.uint64(50)) | (rare.astype(np.uint64) << np.uint64(42)) | (words & np.uint64((1 << 42) - 1))
    at = np.argsort(key)
    words, of, rare = words[at], of[at], rare[at]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (of[1:] != of[:-1])
    words, of, rare = words[new], of[new], rare[new]
    edges = np.searchsorted(of, np.arange(len(lines) + 1))
    nodes = np.zeros(len(lines), np.uint64)
    for s in _SALTS[:2] if len(words) else ():
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words ^ s), dtype=np.uint64)])
        nodes = mix(nodes + sums[edges[1:]] - sums[edges[:-1]])
    return words, of, rare, nodes, np.diff(edges)


def _orders(ids: pa.Array) -> np.ndarray:
    """Numbers in the order of ids, not always strictly; nulls last."""
    last = np.iinfo(np.int64).max
    if pa.types.is_integer(ids.type):
        return ids.cast(pa.int64()).fill_null(last).to_numpy(zero_copy_only=False)
    if pa.types.is_string(ids.type):
        return np.array([last if i is None else int.from_bytes(i.encode()[:7].ljust(7, b"\0"), "big") for i in ids.to_pylist()], np.int64)
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), last, 0).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list, list[bytes]]]:
    """(batch, (row, line number) of each line, lines) for pieces of bounded size."""
    for batch in batches:
        numbers, texts = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            if text is not None:
                own = text.split("\n")
                texts += own
                numbers += [(i, k) for k in range(len(own))]
        for first, run in chunks(texts):
            for at in range(0, len(run), MOST_LINES):
                part = run[at : at + MOST_LINES]
                yield batch, numbers[first + at : first + at + len(part)], part


def _lines(order):
    """One row for each line with words: where it is, its node, and once for each node the prefix words."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch, numbers, run in _pieces(batches):
            yield _rows(batch, numbers, run, order.value, seen)
            if len(seen) > 1_000_000:  # only spares repeats
                seen.clear()

    return lines


def _rows(batch: pa.RecordBatch, numbers: list, run: list[bytes], rare_of: np.ndarray, seen: dict[int, int]) -> pa.RecordBatch:
    words, of, rare, nodes, n = _line_sets(run, rare_of)
    starts = np.cumsum(n) - n
    place = np.arange(len(words)) - starts[of]
    size = n[of]
    prefix = (place < size - (SHARE * size + WHOLE - 1) // WHOLE + 1) & (rare > 0) & (size * (WHOLE - SHARE) >= SHARE)  # smaller sets equal or differ
    has, signed = np.flatnonzero(n), nodes.view(np.int64)
    ids, keys = (batch.column(c).take(pa.array([numbers[i][0] for i in has], pa.int64())) for c in (0, 2))
    orders, fresh = _orders(ids), np.zeros(len(run), bool)
    for i, node, order in zip(has.tolist(), signed[has].tolist(), orders.tolist(), strict=True):
        if seen.get(node, order + 1) > order:  # once more if an earlier line has it
            seen[node] = order
            fresh[i] = True
    prefix &= fresh[of]
    counts = np.bincount(of[prefix], minlength=len(run))[has]
    cold = np.bincount(of[prefix & (rare < 8 * np.log2(BLOCK))], minlength=len(run))[has]
    skip = np.bincount(of[(rare == 0)], minlength=len(run))[has]  # words that occur once come first
    bit = mix(words ^ _SALTS[2]) >> np.uint64(57)
    odd = [np.bitwise_xor.reduceat(np.where(bit >> np.uint64(6) == k, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)), starts[has]) if len(has) else np.zeros(0, np.uint64) for k in (0, 1)]
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    ints = lambda x: pa.array(np.asarray(x).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            ids, keys, pa.array([numbers[i][1] for i in has], pa.int32()), pa.array(signed[has]), ints(n[has]), pa.array(orders), *(pa.array(x.view(np.int64)) for x in odd), ints(skip), ints(cold),
            pa.ListArray.from_arrays(offsets, pa.array(words[prefix].view(np.int64))),
        ],
        names=["id", *(c.split()[0] for c in LINES.split(", "))],
    )


KINDS = {"word": "i8", "n": "i4", "node": "i8", "place": "i4", "ord": "i8", "parity": "i8", "parity_2": "i8"}
ROW = tuple(KINDS)


def _deal(buckets: int, wide):
    """bucket, data: the rows of words, packed; words that the bitmap `wide` has go to bucket -1."""

    def dealt(held: list) -> Iterator[pa.RecordBatch]:
        col = [np.concatenate(c) for c in zip(*held, strict=True)]
        word = col[0].view(np.uint64)
        bucket = (word % np.uint64(buckets)).astype(np.int32)
        if wide is not None:
            bucket[_has(wide.value, word)] = -1
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-2))
        numbers, parcels = [], []
        for at, to in zip(edges, [*edges[1:], len(order)], strict=True):
            rows = order[at:to]
            numbers.append(bucket[rows[0]])
            parcels.append(packed(*(c[rows] for c in col)))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parcels, pa.binary())], names=["bucket", "data"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            node, n, order, skip, *odd = (batch.column(c).to_numpy() for c in ("node", "n", "ord", "skip", "parity", "parity_2"))
            counts = batch.column("words").value_lengths().to_numpy()
            of = np.repeat(np.arange(len(node)), counts)
            place = (skip[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
            held.append((batch.column("words").flatten().to_numpy(), n[of], node[of], place, order[of], *(x[of] for x in odd)))
            size += len(of)
            if size >= DEALT_ROWS:
                yield from dealt(held)
                held, size = [], 0
        if size:
            yield from dealt(held)

    return deal


def _pairs(col: dict[str, np.ndarray], group: tuple[str, ...], keep: int) -> pa.RecordBatch:
    """FOUND of rows by group, then size, node and order: for each node b its likeliest earlier nodes a, at most `keep`.

    Where the columns are given, only rows that are `base` serve as a and only `open` ones as b.
    """
    turn = lambda names: np.logical_or.reduce([col[c][1:] != col[c][:-1] for c in names])
    roles = tuple(c for c in ("base", "open") if c in col)
    once = np.concatenate([[True], turn((*group, "n", "node", *roles))])  # a node may come from several tasks; the earliest row counts
    col = {c: x[once] for c, x in col.items()}
    edges = np.concatenate([[0], np.flatnonzero(turn(group)) + 1, [len(col["word"])]])
    end = np.repeat(edges[1:], np.diff(edges))
    n, node, place, order = col["n"].astype(np.int64), col["node"], col["place"], col["ord"]
    odd = [col[c].view(np.uint64) for c in ("parity", "parity_2")]
    found, r, d = [np.zeros((3, 0), np.int64)], np.arange(len(n)), 1
    while True:
        r = r[r + d < end[r]]
        r = r[SHARE * n[r + d] <= WHOLE * n[r]]
        if not len(r):
            break
        y = r + d
        both = n[r] + n[y]
        need = -(-SHARE * both // (SHARE + WHOLE))
        good = np.flatnonzero((place[r] <= n[r] - need) & (place[y] <= n[y] - need) & (node[r] != node[y]))
        x, y = r[good], y[good]
        apart = sum(np.bitwise_count(p[x] ^ p[y]) for p in odd)
        near = apart <= (both - 2 * need)[good]
        x, y, apart = x[near], y[near], apart[near]
        for a, b in ((x, y), (y, x)):
            fit = order[a] <= order[b]
            if roles:
                fit &= col["base"][a] & col["open"][b]
            found.append(np.stack([b[fit], a[fit], apart[fit]]))
        d += 1
    b, a, apart = np.concatenate(found, 1)
    at = np.lexsort((node[a], order[a], apart, b))
    b, a = b[at], a[at]
    new = np.flatnonzero(np.diff(b, prepend=-1))
    count = np.diff(np.append(new, len(b)))
    kept = np.arange(len(b)) - np.repeat(new, count) < keep
    more = np.repeat(count > keep, count)[kept]
    return pa.RecordBatch.from_arrays([pa.array(node[a[kept]]), pa.array(node[b[kept]]), pa.array(col["word"][b[kept]]), pa.array(more)], names=["a", "b", "word", "more"])


def _meet_packed(keep: int):
    """FOUND of packed rows, by bucket."""

    def met(held: list) -> Iterator[pa.RecordBatch]:
        col = dict(zip(ROW, (np.concatenate(c) for c in zip(*held, strict=True)), strict=True))
        order = np.lexsort((col["ord"], col["node"], col["n"], col["word"]))
        col = {c: x[order] for c, x in col.items()}
        starts = np.flatnonzero(np.diff(col["word"], prepend=col["word"][0] - 1))
        cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(order), MEETING_ROWS)).clip(max=len(starts) - 1))]
        for at, to in zip(cuts, [*cuts[1:], len(order)], strict=True):
            yield _pairs({c: x[at:to] for c, x in col.items()}, ("word",), keep)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != bucket and held:
                    yield from met(held)
                    held = []
                bucket = number
                held.append(unpacked(data, *KINDS.values()))
        if held:
            yield from met(held)

    return meet


def _meet_rows(keep: int):
    """FOUND of rows by word and block, then size."""
    group = ("word", "low", "high")

    def pairs(t: pa.Table) -> pa.RecordBatch:
        return _pairs({c: t[c].to_numpy() for c in t.column_names}, group, keep)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= MEETING_ROWS:
                t = pa.Table.from_batches(held)
                last = np.logical_and.reduce([t[c].to_numpy() == t[c][-1].as_py() for c in group])
                cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
                if cut:
                    yield pairs(t.slice(0, cut))
                held, size = t.slice(cut).to_batches(), 0  # a group is not much larger than this
        if sum(b.num_rows for b in held):
            yield pairs(pa.Table.from_batches(held))

    return meet


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(1).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in unpacked(data, *KINDS.values())], names=list(ROW))


FOUND = "a long, b long, word long, more boolean"
ROWS = "word long, n int, node long, place int, ord long, parity long, parity_2 long"


def _fits(a: str, b: str):
    """The filters that pairs pass, in SQL; a and b are structs."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    both = x("n") + y("n")
    need = F.ceil(SHARE * both / float(SHARE + WHOLE) - 1e-9)
    near = sum(F.bit_count(x(c).bitwiseXOR(y(c))) for c in ("parity", "parity_2")) <= both - 2 * need
    return (SHARE * F.greatest(x("n"), y("n")) <= WHOLE * F.least(x("n"), y("n"))) & (x("place") <= x("n") - need) & (y("place") <= y("n") - need) & near


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _asked(rows: DataFrame, asks: DataFrame, keep: int) -> DataFrame:
    """FOUND for asks (word, node) of words that have at most BLOCK rows."""
    of = rows.join(_few(settle(asks.select("word").distinct())), "word", "left_semi").join(_few(asks.withColumn("asks", F.lit(True))), ["word", "node"], "left")
    one = F.lit(0)
    met = of.select(*ROW, F.lit(True).alias("base"), F.coalesce("asks", F.lit(False)).alias("open"), one.alias("low"), one.alias("high"))
    return met.repartition("word").sortWithinPartitions("word", "n", "node", "ord").mapInArrow(_meet_rows(keep), FOUND)


def _asked_blocks(rows: DataFrame, asks: DataFrame, keep: int) -> DataFrame:
    """The same for words of any number of rows, in blocks: every block of rows meets every block of asking ones."""
    of = settle(rows.join(asks.select("word").distinct(), "word", "left_semi").groupBy("word", "n", "node", "place", "parity", "parity_2").agg(F.min("ord").alias("ord")))
    parts = lambda c: F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(c)
    of = of.join(_few(settle(of.groupBy("word").agg(parts("lows")).join(asks.groupBy("word").agg(parts("highs")), "word"))), "word")
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    roles = lambda base: (F.lit(base).alias("base"), F.lit(not base).alias("open"))
    base = of.select(*ROW, *roles(True), own("lows").alias("low"), every("highs").alias("high"))
    open_ = of.join(asks, ["word", "node"], "left_semi").select(*ROW, *roles(False), own("highs").alias("high"), every("lows").alias("low"))
    met = base.unionByName(open_).repartition("word", "low", "high").sortWithinPartitions("word", "low", "high", "n", "node", "base", "ord")
    return met.mapInArrow(_meet_rows(keep), FOUND)


def _bitmap(values: DataFrame) -> np.ndarray:
    """MAP_BITS bits, set for the one column's hashes by their first bits."""
    size = 8 * PAGE
    bit = F.shiftrightunsigned(F.col(values.columns[0]), 64 - (MAP_BITS.bit_length() - 1))
    pages = values.select(F.floor(bit / size).cast("int").alias("page"), (bit % size).cast("int").alias("bit")).distinct()

    def pack(group: pa.Table) -> pa.Table:
        bits = np.zeros(size, np.uint8)
        bits[group["bit"].to_numpy()] = 1
        return pa.table({"page": group["page"][:1], "bytes": pa.array([np.packbits(bits).tobytes()])})

    return _gathered(pages.groupBy("page").applyInArrow(pack, "page int, bytes binary"), MAP_BITS // 8)


def _has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether a bitmap has these 64-bit values, or others with the same first bits."""
    at = (values >> np.uint64(64 - (MAP_BITS.bit_length() - 1))).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _look_up(bitmap):
    """node, id, text_key, line, text of lines that the bitmap lets through."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch, numbers, run in _pieces(batches):
            nodes, n = _line_sets(run, None)[3:]
            hits = np.flatnonzero((n > 0) & _has(bits, nodes))
            ids, keys = (batch.column(c).take(pa.array([numbers[i][0] for i in hits], pa.int64())) for c in (0, 2))
            texts = pa.array([run[i].decode("utf-8", "surrogatepass") for i in hits], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)[hits]), ids, keys, pa.array([numbers[i][1] for i in hits], pa.int32()), texts], names=["node", "id", "text_key", "line", "text"])

    return look_up


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node: the later one of pairs whose lines are similar enough."""
    for whole in batches:
        for batch in (whole.slice(at, PAIRS) for at in range(0, whole.num_rows, PAIRS)):
            later, x, y = (batch.column(i).to_pylist() for i in range(3))
            sets = {t: _word_set(t) for t in {*x, *y}}
            good = {later[i] for i in range(len(x)) if WHOLE * (c := len(sets[x[i]] & sets[y[i]])) >= SHARE * (len(sets[x[i]]) + len(sets[y[i]]) - c)}
            yield pa.RecordBatch.from_arrays([pa.array(list(good), pa.int64())], names=["node"])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACES = bytes.maketrans(b"\x0b\x0c\r\t\n", b"     ")


def _word_set(line: str) -> set[bytes]:
    return set(line.encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACES).split(b" ")) - {b""}


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("text_key"))


def _gone(df: DataFrame, id_col: str, text_col: str, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """node: the later one of each pair (a, b) that the first lines of both confirm."""
    wanted = settle(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    docs = _texts(df, id_col, text_col)
    place = (F.col("id").isNull().alias("last"), F.col("id"), F.col("line"), F.col("text_key"))  # rows that share an id are told apart by their texts
    if wanted.count() <= BROADCAST_ROWS:
        at = settle(lines.join(F.broadcast(wanted), "node", "left_semi").groupBy("node").agg(F.min(F.struct(*place)).alias("at")))
        of = at.groupBy(F.col("at.id").alias("of"), F.col("at.text_key").alias("key")).agg(F.collect_list(F.struct(F.col("at.line").alias("line"), "node", "at")).alias("w"))  # at most BROADCAST_ROWS lines
        found = docs.filter(F.col("text").isNotNull()).join(F.broadcast(of), F.col("id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key")))
        found = found.select(F.split("text", "\n").alias("l"), F.explode("w").alias("w")).select("w.node", "w.at", F.get("l", F.col("w.line")).alias("text"))
        first = settle(found.groupBy("node").agg(F.first("at").alias("at"), F.first("text").alias("text")))  # rows may repeat
    else:
        bitmap = df.sparkSession.sparkContext.broadcast(_bitmap(wanted))
        kind = df.schema[id_col].dataType.simpleString()
        found = docs.mapInArrow(_look_up(bitmap), f"node long, id {kind}, text_key long, line int, text string")
        first = found.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct(*place, F.col("text"))).alias("at"))
        with small_batches(df.sparkSession):
            first = settle(first.select("node", F.struct("at.last", "at.id", "at.line", "at.text_key").alias("at"), "at.text"))
    both = pairs.join(first.toDF("a", "at_a", "x"), "a").join(first.toDF("b", "at_b", "y"), "b")
    both = both.select(F.when(F.col("at_a") < F.col("at_b"), F.col("b")).otherwise(F.col("a")).alias("later"), "x", "y")
    return both.mapInArrow(_similar, "node long").distinct()


def _near(df: DataFrame, shelf: Shelf, id_col: str, text_col: str, lines: DataFrame) -> DataFrame:
    """node of every node that an earlier one is similar to."""
    lines = lines.select("id", "line", "text_key", "node", "n", "ord", "parity", "parity_2", "skip", "cold", "words")
    prefixes = lines.filter(F.size("words") > 0)
    often = prefixes.filter(F.size("words") > F.col("cold")).select(F.explode(F.slice("words", F.col("cold") + 1, F.size("words"))).alias("word"))
    counts = often.groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    many = settle(counts.filter(F.col("c") > BLOCK).select("word"))
    wide = None if many.isEmpty() else df.sparkSession.sparkContext.broadcast(_bitmap(many))
    buckets = max(1, (prefixes.agg(F.sum(F.size("words"))).first()[0] or 0) // BUCKET_ROWS)
    dealt = prefixes.select("node", "n", "ord", "parity", "parity_2", "skip", "words").mapInArrow(_deal(buckets, wide), "bucket int, data binary")
    wide_rows = None
    if wide is not None:
        dealt = shelf.put("dealt", dealt)
        wide_rows = dealt.filter("bucket < 0").mapInArrow(_unpack, ROWS)
        dealt = dealt.filter("bucket >= 0")
    found = shelf.put("found-0", dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet_packed(FIRST_PARTNERS), FOUND))
    pairs, asks = found.select("a", "b").distinct(), found.filter("more").select("word", F.col("b").alias("node")).distinct()
    wide_asks = None
    if wide is not None:
        row = F.struct("node", "n", "place", "parity", "parity_2")
        heads = wide_rows.groupBy("word").agg(F.min_by(row, F.struct("ord", "node")).alias("h"))
        led = wide_rows.select("word", row.alias("r")).join(heads, "word").filter(F.col("r.node") != F.col("h.node")).filter(_fits("h", "r"))
        pairs = pairs.unionAll(led.select(F.col("h.node").alias("a"), F.col("r.node").alias("b"))).distinct()
        wide_asks = wide_rows.select("word", "node").distinct()
    pairs = settle(pairs)
    gone = settle(_gone(df, id_col, text_col, lines, pairs))
    rows = prefixes.select("node", "n", "ord", "parity", "parity_2", "skip", F.posexplode("words").alias("pos", "word")).withColumn("place", F.col("skip") + F.col("pos")).select(*ROW)
    tested, keep, number = pairs, MORE_PARTNERS, 0
    while True:
        asks, number = settle(asks.join(gone, "node", "left_anti")), number + 1
        more = [] if asks.isEmpty() else [_asked(rows, asks, keep).withColumn("wide", F.lit(False))]
        if wide_asks is not None:
            wide_asks = settle(wide_asks.join(gone, "node", "left_anti"))
            more += [] if wide_asks.isEmpty() else [_asked_blocks(wide_rows, wide_asks, keep).withColumn("wide", F.lit(True))]
        if not more:
            return gone
        found = shelf.put(f"found-{number}", more[0] if len(more) == 1 else more[0].unionAll(more[1]))
        shelf.drop(f"found-{number - 1}")
        pairs = settle(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"))
        gone = settle(gone.unionAll(_gone(df, id_col, text_col, lines, pairs)).distinct())
        asks = found.filter("more and not wide").select("word", F.col("b").alias("node")).distinct()
        if wide_asks is not None:
            wide_asks = found.filter("more and wide").select("word", F.col("b").alias("node")).distinct()
        tested, keep = settle(tested.unionAll(pairs)), keep * MORE_PARTNERS


def removed_lines(df: DataFrame, shelf: Shelf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, line, same, near of every line that is removed: its set is an earlier line's, or its node is similar to one."""
    require(df, id_col, text_col)
    kind = df.schema[id_col].dataType.simpleString()
    order = df.sparkSession.sparkContext.broadcast(rarity(df, text_col))  # CELLS bytes, whatever the table
    with small_batches(df.sparkSession):
        lines = shelf.put("lines", _texts(df, id_col, text_col).mapInArrow(_lines(order), f"id {kind}, {LINES}"))
    gone = _near(df, shelf, id_col, text_col, lines)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("line"), F.col("text_key")))
    repeated = lines.groupBy("node").agg(first.alias("at"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("node", "at")
    flags = repeated.join(gone.withColumn("near", F.lit(True)), "node", "full")
    out = lines.select("id", "line", "text_key", "node").join(flags, "node")
    later = F.col("at").isNotNull() & ~(F.col("id").eqNullSafe(F.col("at.id")) & (F.col("line") == F.col("at.line")))
    return out.select("id", "line", F.coalesce(later, F.lit(False)).alias("same"), F.coalesce("near", F.lit(False)).alias("near")).filter("same or near")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_lines, n_same (their set occurred earlier), n_near (similar to an earlier one), removed (numbers)."""
    with Shelf(df.sparkSession) as shelf:
        found = removed_lines(df, shelf, id_col, text_col)
        per = found.groupBy("id").agg(F.count(F.when(F.col("same"), 1)).alias("n_same"), F.count(F.when(~F.col("same"), 1)).alias("n_near"), F.array_sort(F.collect_list("line")).alias("removed"))
        per = settle(per.withColumnRenamed("id", "of"))
    counts = df.select(F.col(id_col).alias("id"), F.coalesce(F.regexp_count(F.col(text_col), F.lit("\n")) + 1, F.lit(0)).cast("long").alias("n_lines")).groupBy("id").agg(F.sum("n_lines").alias("n_lines"))
    out = counts.join(per, F.col("id").eqNullSafe(F.col("of")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("id").alias(id_col), "n_lines", zero("n_same"), zero("n_near"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of df whose texts have lost the removed lines; ids are taken to be unique."""
    gone = settle(report(df, id_col, text_col).filter("removed <> ''").select(F.col(id_col).alias("of"), F.split("removed", ",").cast("array<int>").alias("removed")))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(gone, F.col("id").eqNullSafe(F.col("of")), "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    return rows.select(F.col("row").withField(text_col, F.when(F.col("removed").isNull(), F.col("text")).otherwise(left)).alias("row")).select("row.*")
