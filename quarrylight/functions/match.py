"""Agreement of company name and domain, on token arrays with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import catalogue as C


def _partly(company: Column, domain: Column, exact: Column) -> Column:
    """Tokens of four letters or more that contain a domain token or are contained in one."""
    return F.array_distinct(F.filter(company, lambda t: (F.length(t) >= 4) & ~F.array_contains(exact, t) & F.exists(domain, lambda d: F.contains(d, t) | F.contains(t, d))))


def _initials(company: Column) -> Column:
    return F.array_join(F.transform(company, lambda t: F.substring(t, 1, 1)), "")


def _first_hit(company: Column, domain: Column, whole: int, start: int, least: int) -> Column:
    """Score of the first domain token that equals the initials or starts with them."""
    short = _initials(company)
    scores = F.transform(domain, lambda d: F.when(d == short, F.lit(whole)).when((F.length(short) >= least) & d.startswith(short), F.lit(start)).otherwise(F.lit(0)))
    return F.when(F.size(company) < 2, F.lit(0)).otherwise(F.coalesce(F.get(F.filter(scores, lambda s: s > 0), F.lit(0)), F.lit(0)))


def match_score(company: Column, domain: Column) -> Column:
    """Struct of the three scores, their capped sum and the sorted matched tokens."""
    exact = F.array_intersect(company, domain)
    partly = _partly(company, domain, exact)
    none = (F.size(exact) == 0) & (F.size(partly) == 0)
    exact_score, part_score = F.least(F.size(exact) * 80, F.lit(100)), F.least(F.size(partly) * 35, F.lit(100))
    short_score = F.when(none, _first_hit(company, domain, 60, 40, 3)).otherwise(F.lit(0))
    matched = F.array_union(F.array_union(exact, partly), F.when(short_score > 0, company).otherwise(F.array().cast("array<string>")))
    return F.struct(
        exact_score.alias("exact_score"),
        part_score.alias("substring_score"),
        short_score.alias("abbreviation_score"),
        F.least(exact_score + part_score + short_score, F.lit(100)).alias("domain_match_score"),
        F.array_sort(matched).alias("matched_tokens"),
    )


def match_score_tiered(company: Column, domain: Column) -> Column:
    """The notebook's scores: the first of exact, substring and abbreviation that hits decides."""
    exact = F.array_intersect(company, domain)
    partly = _partly(company, domain, exact)
    empty = (F.size(company) == 0) | (F.size(domain) == 0)
    full = F.when(~empty & (F.size(exact) > 0), F.lit(100)).otherwise(F.lit(0))
    sub = F.when(empty | (full > 0) | (F.size(partly) == 0), F.lit(0)).when(F.size(partly) == F.size(company), F.lit(100)).otherwise(F.lit(80))
    short = F.when(empty | (full > 0) | (sub > 0), F.lit(0)).otherwise(_first_hit(company, domain, 90, 70, 1))
    final = F.greatest(full, sub, short)
    return F.struct(full.alias("full_match_score"), sub.alias("substring_match_score"), short.alias("abbreviation_score"), final.alias("final_score"), status(final, F.lit("")).alias("domain_match_status"))


def status(score: Column, country: Column) -> Column:
    """keep, review or remove; a domain of another country is always reviewed."""
    return F.when(country == "country_mismatch", F.lit("review")).when(score >= C.KEEP_SCORE, F.lit("keep")).when(score >= C.REVIEW_SCORE, F.lit("review")).otherwise(F.lit("remove"))
