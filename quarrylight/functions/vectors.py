"""Similarity of vectors as Column expressions; sums are taken in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def best_theme(items: DataFrame, themes: DataFrame, vector: str = "vector", name: str = "theme", rank: str = "theme_no") -> DataFrame:
    """Items with matched_theme and similarity_score: the most similar theme, the first at a tie.

    themes is a bank of fixed size (a few dozen rows): it is folded into one array and sent to all items,
    so that items are neither multiplied nor shuffled.
    """
    bank = themes.agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("no"), F.col(name).alias("name"), F.col(vector).alias("v")))).alias("bank"))
    scored = F.transform("bank", lambda t: F.struct(cosine(F.col(vector), t["v"]).alias("score"), (-t["no"]).alias("no"), t["name"].alias("name")))
    rows = items.join(F.broadcast(bank), F.lit(True)).withColumn("best", F.array_max(scored))  # one row
    return rows.withColumns({"matched_theme": F.col("best.name"), "similarity_score": F.col("best.score")}).drop("best", "bank")


def best_score(vector: Column, bank: list[list[float]]) -> Column:
    """Highest cosine against a literal bank of a few vectors."""
    return F.array_max(F.array(*[cosine(vector, F.lit(v)) for v in bank]))


def best_margin(chunks: Column, positive: list[list[float]], negative: list[list[float]]) -> Column:
    """Of a text's chunk vectors the one with the largest positive minus negative: its three scores."""
    scored = F.transform(chunks, lambda v, i: F.struct((best_score(v, positive) - best_score(v, negative)).alias("margin"), (-i).alias("at"), best_score(v, positive).alias("positive"), best_score(v, negative).alias("negative")))
    return F.array_max(scored)
