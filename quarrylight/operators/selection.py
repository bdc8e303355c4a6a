"""From crawled pages to one page for each company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import catalogue as C
from ..functions import text, urls
from ..schemas import require_columns

REQUIRED = ("company_id", "url", "crawl_error", "page_text", "candidate_section_text", "section_positive_score", "section_negative_score", "section_semantic_margin", "heading_similarity_score", "contains_primary_value_section", "discovery_score", "depth")
RENAMED = {"url": "internal_url", "fetch_url": "candidate_fetch_url", "status_code": "candidate_status_code", "page_text": "candidate_text_full", "candidate_section_text": "candidate_text", "crawl_error": "candidate_error"}


def _scores() -> tuple[Column, Column, Column, Column]:
    return tuple(text.no_nan(F.col(c)) for c in ("heading_similarity_score", "section_positive_score", "section_negative_score", "section_semantic_margin"))


def _all(*limits: tuple[Column, float]) -> Column:
    out = F.lit(True)
    for column, least in limits:
        out = out & (column >= least)
    return F.coalesce(out, F.lit(False))


def valid_page() -> Column:
    """No error, text and section, all scores, and a section that is close enough."""
    h, p, n, m = _scores()
    filled = lambda c: text.strip_ws(F.coalesce(c, F.lit(""))) != ""
    return (F.coalesce("crawl_error", F.lit("")) == "") & filled("page_text") & filled("candidate_section_text") & n.isNotNull() & _all((p, C.MIN_CONTENT), (m, C.MIN_MARGIN))


def semantic_rule() -> Column:
    h, p, _, m = _scores()
    return _all((h, 0.70), (p, 0.40), (m, 0.05)) | _all((h, 0.50), (p, 0.42), (m, 0.12)) | _all((h, 0.38), (p, 0.50), (m, 0.25))


def value_signal(primary: Column, evidence: Column) -> Column:
    h, p, _, m = _scores()
    return (primary & _all((h, 0.40), (p, 0.40), (m, 0.05))) | (evidence & _all((h, 0.38), (p, 0.40), (m, 0.05))) | (~primary & _all((h, 0.70), (p, 0.46), (m, 0.12)))


def _graded(pages: DataFrame) -> DataFrame:
    """All pages with __valid, and evidence, both rules and the final score where that is true."""
    require_columns(pages, REQUIRED)
    h, p, n, m = _scores()
    out = pages.withColumn("__valid", ~urls.is_excluded_url(F.coalesce("url", F.lit(""))) & valid_page())
    out = out.withColumn("contains_primary_value_section", F.coalesce("contains_primary_value_section", F.lit(False)))
    out = out.withColumns({"value_path_bonus": urls.value_path_bonus(F.col("url")), "e": F.when(F.col("__valid"), text.value_evidence(F.col("candidate_section_text")))})
    out = out.select("*", "e.value_section_matches", "e.named_value_matches", F.col("e.contains_value_signal").alias("contains_explicit_value_evidence")).drop("e")
    primary, evidence = F.col("contains_primary_value_section"), F.col("contains_explicit_value_evidence")
    out = out.withColumns({"passes_semantic_rule": semantic_rule(), "contains_value_signal": value_signal(primary, evidence)})
    out = out.withColumns({"primary_value_heading_bonus": F.when(primary, 0.20).otherwise(0.0), "mission_only_penalty": F.when(~primary & ~evidence, 0.06).otherwise(0.0)})
    total = m + F.col("value_path_bonus") + F.col("primary_value_heading_bonus") + 0.20 * text.no_nan(F.col("discovery_score")) + 0.20 * h + 0.10 * p - 0.10 * n - F.col("mission_only_penalty")
    return out.withColumn("final_selection_score", total)


def gate(pages: DataFrame) -> DataFrame:
    """Valid pages with evidence, both rules and the final score."""
    return _graded(pages).filter("__valid").drop("__valid")


def select(pages: DataFrame) -> DataFrame:
    """The best page of each company among those with a value signal."""
    order = Window.partitionBy("company_id").orderBy(F.desc_nulls_last("final_selection_score"), F.desc_nulls_last("section_semantic_margin"), F.desc_nulls_last("section_positive_score"), F.asc_nulls_last("depth"), "url")
    best = gate(pages).filter("contains_value_signal").withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")
    return best.withColumnsRenamed({k: v for k, v in RENAMED.items() if k in best.columns}).withColumn("quality_status", F.lit("accepted"))


def best_rejected(pages: DataFrame) -> DataFrame:
    """Each company's best section by review score, where even that has no value signal."""
    h, p, _, m = _scores()
    out = pages.filter(text.strip_ws(F.coalesce("candidate_section_text", F.lit(""))) != "")
    out = out.withColumns({"passes_rule_1": _all((h, 0.50), (p, 0.44), (m, 0.08)), "passes_rule_2": _all((h, 0.42), (p, 0.48), (m, 0.12)), "contains_value_signal": _all((p, 0.46), (m, 0.10)), "review_score": m + 0.15 * h + 0.10 * p})
    order = Window.partitionBy("company_id").orderBy(F.desc("contains_value_signal"), F.desc_nulls_last("review_score"), "url")
    return out.withColumn("__n", F.row_number().over(order)).filter("__n = 1 and not contains_value_signal").drop("__n")


def funnel(pages: DataFrame) -> DataFrame:
    """Pages crawled, without error, valid, with a value signal; companies accepted. Pages are read once."""
    tests = {"crawled": F.lit(True), "without_error": F.coalesce("crawl_error", F.lit("")) == "", "valid": F.col("__valid"), "with_signal": F.col("__valid") & F.col("contains_value_signal")}
    company = F.col("company_id").isNotNull() & tests["with_signal"]
    marks = _graded(pages).select("company_id", *[F.coalesce(t, F.lit(False)).cast("long").alias(c) for c, t in tests.items()], F.coalesce(company, F.lit(False)).cast("long").alias("companies_accepted"))
    each = marks.groupBy("company_id").agg(*[F.sum(c).alias(c) for c in tests], F.max("companies_accepted").alias("companies_accepted"))
    return each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*tests, "companies_accepted")])


def top_children(links: DataFrame, parent: list[str], score: str, position: str, k: int = C.MAX_CHILDREN) -> DataFrame:
    """The k best links of each page, earlier ones first at a tie."""
    order = Window.partitionBy(*parent).orderBy(F.desc(score), position)
    return links.filter(F.col(score) >= C.MIN_LINK).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def readable_pages(pages: DataFrame) -> DataFrame:
    """Pages that were found (any status but 404, also none) and have text."""
    return pages.filter(~F.col("status_code").eqNullSafe(404) & F.col("page_text").isNotNull())
