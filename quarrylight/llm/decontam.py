"""Benchmark decontamination with a broadcast hash set of normalised test n-grams.

Native DataFrame expressions only. Words are runs of ASCII digits and letters and of non-ASCII characters,
A-Z lower-cased. Every window of 13 words of a benchmark item (a shorter item is one window) is hashed;
the distinct windows are the broadcast side of a hash join against the word windows of all documents, which
are generated inside the scan's stage and never shuffled. A hash match counts only if the words are equal.

Each document also sends one row at position 0 through the join, which matches a marker in the windows
table, so that documents without hits are reported from the same single scan.

The windows are counted first. Beyond BROADCAST_BYTES they are no broadcast side: then the documents' windows go
to them as (document, position, hash) only, the words of the few that meet are read again for the comparison of
words, and documents without hits come from a left join.

Defined cases: a null or empty text has no words and is not contaminated; items without words have no
windows; a null item id gives hits but is not listed; rows that repeat id and text are reported each; an
empty benchmark leaves all documents clean; other columns pass through `decontaminate`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, require, settle

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WINDOW = 13
BROADCAST_BYTES = 64 << 20
BROADCAST_HITS = 100_000
MARKER = 0


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows: h, gram, len, items (sorted ids as strings)."""
    require(benchmark, id_col, text_col)
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    items = items.select("item", "w", size.alias("len"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
    grams = items.select("item", "len", F.slice("w", F.col("at"), F.col("len")).alias("gram"))
    return grams.groupBy(F.xxhash64("gram").alias("h"), F.array_join("gram", " ").alias("gram"), "len").agg(F.array_sort(F.collect_set("item")).alias("items"))


def scan(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each document: id, text_key, n_words, spans (at, len of hit windows), items, n_hit."""
    require(df, id_col, text_col)
    grams = settle(item_windows(benchmark, item_col, item_text_col, window))
    size = grams.agg(F.sum(F.octet_length("gram") + 64 + 24 * F.size("items"))).first()[0] or 0
    lengths = sorted(r[0] for r in grams.select("len").distinct().collect()) or [window]  # at most `window` numbers
    text = F.col(text_col)
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), words(text).alias("w"))
    if size > BROADCAST_BYTES:
        return _scan_shuffled(rows, grams.withColumnRenamed("len", "span"), lengths)
    marker = grams.sparkSession.range(1).select(F.lit(MARKER).cast("long").alias("h"), F.lit("").alias("gram"), F.lit(0).alias("len"), F.array().cast("array<string>").alias("items"))
    grams = F.broadcast(grams.unionByName(marker).withColumnRenamed("len", "span"))
    if len(lengths) == 1:
        rows = rows.withColumn("len", F.lit(lengths[0]))
    else:
        rows = rows.select("*", F.explode(F.lit(lengths)).alias("len"))
    rows = rows.select("id", "text_key", "w", "len", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - F.col("len") + 1, F.lit(0)))).alias("at"))
    rows = rows.filter((F.col("at") > 0) | (F.col("len") == lengths[0]))
    gram = F.slice("w", F.greatest("at", F.lit(1)), F.col("len"))
    rows = rows.withColumn("key", F.when(F.col("at") == 0, F.lit(MARKER).cast("long")).otherwise(F.xxhash64(gram)))
    equal = F.when(F.col("at") == 0, F.col("span") == 0).otherwise((F.col("span") == F.col("len")) & (F.array_join(gram, " ") == F.col("gram")))
    hits = rows.join(grams, (rows["key"] == grams["h"]) & equal).select("id", "text_key", "n_words", "at", "span", "items")
    hit = F.col("at") > 0
    found = hits.groupBy("id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count(F.when(~hit, 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(hit, F.struct(F.col("at"), F.col("span").alias("len"))))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items")))))).alias("items"),
    )
    found = found.select("id", "text_key", "n_words", "spans", "items", covered(F.col("spans")).alias("n_hit"), F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return found.drop("copy")


def covered(spans: Column) -> Column:
    """Number of words in sorted spans."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["at"] + s["len"] - F.greatest(s["at"], a["end"]), F.lit(0))).alias("n"), F.greatest(a["end"], s["at"] + s["len"]).alias("end")),
        lambda a: a["n"].cast("long"),
    )


def _scan_shuffled(rows: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """The same as scan for windows that are too many to broadcast: h, gram, span, items."""
    wide = rows.filter(F.size("w") > 0).select("id", "text_key", "w", F.explode(F.lit(lengths)).alias("len"))
    wide = wide.filter(F.size("w") >= F.col("len"))
    hashes = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda at: F.struct(at.cast("int").alias("at"), F.xxhash64(F.slice("w", at, F.col("len"))).alias("h")))
    windows = wide.select("id", "text_key", "len", F.explode(hashes).alias("x")).select("id", "text_key", "len", "x.at", "x.h")
    grams = grams.withColumnRenamed("h", "gram_h")
    met = windows.join(grams.select("gram_h", "span").distinct(), (F.col("h") == F.col("gram_h")) & (F.col("len") == F.col("span")), "left_semi")
    spots = settle(met.groupBy("id", "text_key").agg(F.collect_set(F.struct("at", "len", "h")).alias("x")).withColumnsRenamed({"id": "of", "text_key": "of_text"}))  # no more than a text has windows
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_text"))
    read = rows.join(spots, same).dropDuplicates(["id", "text_key"]).select("id", "text_key", "w", F.explode("x").alias("x"))
    read = read.select("id", "text_key", "x.at", "x.len", "x.h", F.array_join(F.slice("w", F.col("x.at"), F.col("x.len")), " ").alias("said"))
    hits = read.join(grams, (F.col("h") == F.col("gram_h")) & (F.col("said") == F.col("gram"))).select("id", "text_key", "at", "len", "items")
    found = hits.groupBy("id", "text_key").agg(F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    found = found.withColumnsRenamed({"id": "of", "text_key": "of_text"})
    out = rows.select("id", "text_key", F.size("w").cast("long").alias("n_words")).join(found, same, "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<at:int,len:int>>"))
    return out.select("id", "text_key", "n_words", spans.alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), covered(spans).alias("n_hit"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256 and contaminated for every document."""
    found = scan(df, benchmark, id_col, text_col)
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words that spans cover, and without the separators before those words."""
    pieces = F.regexp_extract_all(text, F.lit(f"{SEPARATOR_ANY_CASE}*{WORD_ANY_CASE}"), F.lit(0))
    kept = F.filter(pieces, lambda x, i: ~F.exists(spans, lambda s: (i + 1 >= s["at"]) & (i + 1 < s["at"] + s["len"])))
    return F.concat(F.array_join(kept, ""), F.regexp_extract(text, f"{SEPARATOR_ANY_CASE}*$", 0))


def decontaminate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of df without contaminated documents; hit spans of the others are cut from the text."""
    found = settle(scan(df, benchmark, id_col, text_col).filter("n_hit > 0").dropDuplicates(["id", "text_key"]))
    hits = found.select(F.col("id").alias("hit_id"), "text_key", contaminated(F.col("n_hit"), F.col("n_words")).alias("reject"), "spans")
    if found.count() <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.xxhash64(F.col(text_col)).alias("key"))
    rows = rows.join(hits, (F.col("key") == F.col("text_key")) & F.col("row").getField(id_col).eqNullSafe(F.col("hit_id")), "left").filter(F.coalesce(~F.col("reject"), F.lit(True)))
    text = F.col("row").getField(text_col)
    cut = F.when(F.col("spans").isNull(), text).otherwise(without_spans(text, F.col("spans")))
    return rows.select(F.col("row").withField(text_col, cut).alias("row")).select("row.*")
