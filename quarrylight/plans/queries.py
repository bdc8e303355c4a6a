"""Queries over the benchmark tables, one for each group of operators, with SQL for those that SQL can express.

The tables hold no companies, so companies, sites and scores are derived from customers, pages and vectors by
expressions that Spark and other SQL engines read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalogue as C
from ..functions import match, text, urls, vectors
from ..operators import companies, resume, selection, semantic, translation, web
from ..sources.providers import HashEmbedder, MarkingTranslator, Response, StopwordDetector


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(on: str, values: list[str]) -> str:
    return f"CASE {on} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_COUNTRY = _case("c_nationkey % 12", [*C.COUNTRIES, "india", "spain"])
_TLD = _case("c_nationkey % 12", [*C.COUNTRY_SUFFIX.values(), "in", "es"])
_OTHER_TLD = _case("c_custkey % 3", ["com", "de", "jp"])
_SEGMENT = "lower(c_mktsegment)"
#: Derived companies, in expressions of common SQL.
RAW = {
    "company_id": "c_custkey",
    "name": "concat(c_mktsegment, CASE c_custkey % 4 WHEN 0 THEN ' Works' WHEN 1 THEN ' Trading Ltd' WHEN 2 THEN ' International Partners Corp' ELSE ' Müller GmbH' END, ' ', CAST(c_custkey % 97 AS STRING))",
    "website": f"CASE c_custkey % 8 WHEN 0 THEN concat('https://www.', {_SEGMENT}, '-works.', {_TLD}, '/en?x=1') WHEN 1 THEN concat({_SEGMENT}, 'trading', CAST(c_custkey % 41 AS STRING), '.com.', {_TLD}) "
    f"WHEN 2 THEN concat('http://', lower(substr(c_mktsegment, 1, 1)), 'ip.com') WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN 'info@mail.com' WHEN 5 THEN concat('https://facebook.com/', {_SEGMENT}) "
    f"WHEN 6 THEN concat('  HTTPS://Shared', CAST(c_custkey % 5 AS STRING), '.example.', {_TLD}, '/brochure') ELSE concat({_SEGMENT}, CAST(c_custkey % 97 AS STRING), '.', {_OTHER_TLD}) END",
    "country": f"CASE WHEN c_custkey % 50 = 0 THEN CAST(NULL AS STRING) ELSE concat(' ', {_COUNTRY}) END",
    "industry": _case("c_custkey % 7", ["Construction", " automotive ", "machinery", "banking", "unknown trade", "government relations", "retail"]),
    "size": _case("c_custkey % 9", ["1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000", "5001-10000", "10001+", "many"]),
}
_RAW_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in RAW.items()) + " FROM customer"

_PARTS = urls.PARTS


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _collapse(x: str) -> str:
    return _strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def _norm(x: str) -> str:
    return f"CASE WHEN {_strip(x)} = '' THEN NULL WHEN starts_with({_strip(x)}, 'http://') OR starts_with({_strip(x)}, 'https://') THEN {_strip(x)} ELSE concat('https://', {_strip(x)}) END"


def _host(u: str) -> str:
    return rf"regexp_replace(lower(trim(regexp_extract({u}, '{_PARTS}', 4))), '^www\.', '')"


def _path(u: str) -> str:
    return f"CASE WHEN regexp_extract({u}, '{_PARTS}', 5) = '' THEN '/' ELSE regexp_extract({u}, '{_PARTS}', 5) END"


def _any(patterns) -> str:
    return "|".join(f"(?:{p})" for p in patterns).replace("'", "''")


_FILES = "|".join(re.escape(e) for e in C.FILE_EXTENSIONS)
_BLOCKED = "|".join(re.escape(h) for h in C.BLOCKED_HOSTS)


def _usable(x: str, domain: str) -> str:
    return rf"coalesce({_strip(x)} <> '' AND NOT contains({x}, '@') AND contains({x}, '.') AND NOT regexp_matches(lower({_strip(x)}), '(?:{_FILES})$') AND {domain} IS NOT NULL AND NOT regexp_matches({domain}, '(?:^|\.)(?:{_BLOCKED})$'), false)"


_BUCKET = "CASE size " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.SIZE_BUCKETS.items()) + " ELSE 'too_small' END"
_SECTOR = "CASE industry " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.INDUSTRY_SECTOR.items()) + " ELSE 'Other' END"
_CLEAN_CTE = f"""raw AS ({_RAW_SQL}),
    c1 AS (SELECT company_id, {", ".join(f"lower({_strip(c)}) AS {c}" for c in ("name", "website", "country", "industry", "size"))} FROM raw
           WHERE name IS NOT NULL AND website IS NOT NULL AND country IS NOT NULL AND industry IS NOT NULL AND size IS NOT NULL),
    c2 AS (SELECT *, {_norm("website")} AS website_url FROM c1 WHERE country IN ({_q(C.COUNTRIES)})),
    c3 AS (SELECT *, nullif({_host("website_url")}, '') AS domain FROM c2),
    cleaned AS (SELECT company_id, name, country, industry, size, {_BUCKET} AS size_bucket, {_SECTOR} AS High_Level_Sector, website_url, domain
                FROM c3 WHERE {_usable("website", "domain")} AND {_BUCKET} <> 'too_small')"""


def _labels(d: str) -> str:
    return rf"string_split(regexp_replace(lower(trim({d})), '[:/?#].*$', ''), '.')"


def _suffix(d: str) -> str:
    lab = _labels(d)
    two = f"concat({lab}[-2], '.', {lab}[-1])"
    return f"CASE WHEN len({lab}) < 2 OR regexp_matches({lab}[-1], '^\\d+$') THEN '' WHEN len({lab}) > 2 AND {two} IN ({_q(C.TWO_PART_SUFFIXES)}) THEN {two} ELSE {lab}[-1] END"


def _label(d: str) -> str:
    lab = _labels(d)
    return f"coalesce({lab}[len({lab}) - CASE WHEN ({_suffix(d)}) = '' THEN 0 ELSE len(string_split({_suffix(d)}, '.')) END], '')"


_OWN = "CASE country " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.COUNTRY_SUFFIX.items()) + " END"


def _country(d: str) -> str:
    last = f"regexp_extract({_suffix(d)}, '([^.]*)$', 1)"
    return f"CASE WHEN country IS NULL OR {d} IS NULL OR ({_suffix(d)}) = '' THEN 'unknown' WHEN {last} = {_OWN} THEN 'country_match' WHEN {last} IN ({_q(C.COUNTRY_SUFFIX.values())}) THEN 'country_mismatch' ELSE 'global_domain' END"


def _fold(x: str) -> str:
    return rf"regexp_replace(strip_accents(lower(trim({x}))), '[^\x00-\x7F]', '', 'g')"


def _company_tokens(x: str) -> str:
    return f"list_filter(string_split(regexp_replace({_fold(x)}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: length(t) > 1 AND t NOT IN ({_q(C.LEGAL_WORDS)}))"


def _domain_tokens(d: str) -> str:
    return f"list_filter(string_split_regex({_fold(_label(d))}, '[-._]+'), lambda t: length(t) > 1)"


def _qualified(source: str) -> str:
    """CTEs scored and qualified over a CTE with company_id, name, country and domain."""
    return f"""t1 AS (SELECT *, {_company_tokens("name")} AS ct, {_domain_tokens("domain")} AS dt FROM {source}),
    t2 AS (SELECT *, list_intersect(ct, dt) AS ex FROM t1),
    t3 AS (SELECT *, list_distinct(list_filter(ct, lambda t: length(t) >= 4 AND NOT list_contains(ex, t) AND len(list_filter(dt, lambda d: contains(d, t) OR contains(t, d))) > 0)) AS pa,
                  array_to_string(list_transform(ct, lambda t: t[1:1]), '') AS ini FROM t2),
    t4 AS (SELECT *, least(len(ex) * 80, 100) AS exact_score, least(len(pa) * 35, 100) AS substring_score,
                  CASE WHEN len(ex) = 0 AND len(pa) = 0 AND len(ct) >= 2 THEN coalesce(list_filter(list_transform(dt, lambda d: CASE WHEN d = ini THEN 60 WHEN length(ini) >= 3 AND starts_with(d, ini) THEN 40 ELSE 0 END), lambda s: s > 0)[1], 0) ELSE 0 END AS abbreviation_score FROM t3),
    scored AS (SELECT *, least(exact_score + substring_score + abbreviation_score, 100) AS domain_match_score, {_country("domain")} AS country_domain_status,
                  array_to_string(list_sort(list_distinct(list_concat(list_concat(ex, pa), CASE WHEN abbreviation_score > 0 THEN ct ELSE [] END))), ' ') AS matched FROM t4),
    shared AS (SELECT domain, count(DISTINCT company_id) AS companies_using_domain, count(DISTINCT country) AS countries_using_domain FROM scored GROUP BY 1),
    qualified AS (SELECT s.*, companies_using_domain, countries_using_domain,
                  CASE WHEN companies_using_domain > 1 THEN 'review' WHEN country_domain_status = 'country_mismatch' THEN 'review' WHEN domain_match_score >= 80 THEN 'keep' WHEN domain_match_score >= 50 THEN 'review' ELSE 'remove' END AS qualification_status
                  FROM scored s JOIN shared USING (domain))"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in RAW.items()])


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned companies, with their id."""
    # The id rides along in the name, which cleaning only strips and lower-cases.
    packed = raw(spark, sf_dir).withColumn("name", F.concat_ws("\x1f", F.col("company_id").cast("string"), "name"))
    out = companies.clean(packed)
    return out.withColumns({"company_id": F.substring_index("name", "\x1f", 1).cast("long"), "name": F.substring_index("name", "\x1f", -1)})


def clean_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.clean(raw(spark, sf_dir))


def prepare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.prepare_summary(raw(spark, sf_dir))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages")


def site_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _pages(spark, sf_dir).select("page_id", urls.normalise_url(u).alias("normal"), urls.domain_of(u).alias("domain"), urls.clean_internal_url(u).alias("internal"), urls.url_path(u).alias("path"), urls.normalised_path(u).alias("normal_path"), urls.robots_url(u).alias("robots"), urls.same_site(u, F.lit("http://example.com")).alias("below_example"))


def site_format_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("company_id", urls.website_usable(F.col("website")).alias("usable"))


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("company_id", F.to_json(urls.url_variants(F.col("website"))).alias("variants"))


def url_variants_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("company_id", F.to_json(urls.url_variants_plain(F.col("website"))).alias("variants"))


def country_domain_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("company_id", urls.country_status(F.col("country"), F.col("domain")).alias("status"), urls.public_suffix(F.col("domain")).alias("suffix"), urls.registered_label(F.col("domain")).alias("label"))


#: Paths given to pages in turn, so that the patterns have something to find.
_TAILS = ["", "/contact", "/our-values", "/News/", "/about-co/val-home.html", "/team.php", "/x/brochure.PDF", "/index_page/vis-abt", "/nos-valeurs/", "/people/profile"]
_PAGE_URL = f"concat(regexp_extract(url, '^[^?#]*', 0), {_case('page_id % 10', _TAILS)})"


def _tailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).selectExpr("page_id", f"{_PAGE_URL} AS url")


def excluded_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tailed(spark, sf_dir).select("page_id", urls.is_excluded_url(F.col("url")).alias("excluded"), urls.is_unwanted_page(F.col("url")).alias("unwanted"))


def path_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = urls.url_path(F.col("url"))
    anchor = F.when(F.col("page_id") % 3 == 0, F.lit(" Read  more")).otherwise(F.concat(F.lit("Page "), F.col("page_id").cast("string")))
    return _tailed(spark, sf_dir).select("page_id", text.path_features(path).alias("words"), text.feature_text(anchor, path).alias("feature"))


def value_path_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tailed(spark, sf_dir).select("page_id", urls.value_path_bonus(F.col("url")).alias("bonus"))


def company_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("company_id", F.array_join(text.company_tokens(text.ascii_fold(F.col("name"))), " ").alias("tokens"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.score(cleaned(spark, sf_dir))


def match_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = companies.qualify(cleaned(spark, sf_dir))
    return out.select("company_id", "name", "domain", "exact_score", "substring_score", "abbreviation_score", "domain_match_score", F.array_join("matched_tokens", " ").alias("matched"), "country_domain_status", "companies_using_domain", "qualification_status")


def match_score_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scored(spark, sf_dir).withColumn("t", match.match_score_tiered(F.col("company_tokens"), F.col("domain_tokens")))
    return out.select("company_id", "t.*")


def domain_sharing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.sharing(cleaned(spark, sf_dir), "company_id").select("company_id", "domain", "companies_using_domain", "countries_using_domain")


def qualification_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.status_counts(companies.qualify(cleaned(spark, sf_dir)))


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = companies.with_ids(companies.sample(cleaned(spark, sf_dir), key="company_id").withColumnRenamed("company_id", "source_id"), key="source_id")
    return sampled.select("company_id", "source_id", "country", "size_bucket", "High_Level_Sector")


def round_robin_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.round_robin(cleaned(spark, sf_dir), key="company_id").select("company_id", "country", "size_bucket", "High_Level_Sector")


def quota_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.government_summary(cleaned(spark, sf_dir))


def count_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.count_tables(cleaned(spark, sf_dir))


def pool_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.pool_counts(cleaned(spark, sf_dir)).select("company_id", "company_count_for_country_in_pool", "total_countries_in_pool")


def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.seed_rows(cleaned(spark, sf_dir), key="company_id").select("company_id", "country", "size_bucket")


def prefer_country_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.prefer_country_domain(cleaned(spark, sf_dir).select("name", "country", "domain")).select("name", "country", "domain", "country_website_status")


_READY = {
    "company_id": "page_id",
    "final_url": "CASE WHEN page_id % 11 = 0 THEN CAST(NULL AS STRING) ELSE url END",
    "is_website_reachable": "CASE WHEN page_id % 7 = 0 THEN CAST(NULL AS BOOLEAN) ELSE page_id % 5 <> 0 END",
    "content_type": _case("page_id % 4", ["text/html; charset=utf-8", "TEXT/HTML", "application/pdf", "application/xhtml+xml"]),
    "qualification_status": _case("page_id % 3", ["keep", "keep", "review"]),
}


def scrape_ready_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _pages(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in _READY.items()])
    return companies.scrape_ready(df).select("company_id", "final_url", "scraping_ready")


#: Company columns over the customer table: ids repeat and addresses are missing.
_CRAWL_INPUT = {"company_id": "CAST(c_custkey % 400 AS STRING)", "name": "c_name", "country": "CAST(c_nationkey AS STRING)", "size_bucket": "c_mktsegment", "domain": "concat('d', CAST(c_custkey AS STRING))", "final_url": "CASE WHEN c_custkey % 7 > 0 THEN concat('http://d', CAST(c_custkey AS STRING)) END"}


def reachable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _pages(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in _READY.items()])
    reached, missed = companies.reachable_split(df)
    return reached.withColumn("side", F.lit("reachable")).unionAll(missed.withColumn("side", F.lit("unreachable"))).select("company_id", "side")


def crawl_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in _CRAWL_INPUT.items()])
    return companies.crawl_input(rows, run_size=100)


def checked_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    return resume.merge_checked(orders, _table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name"), "key", "many_to_one")


def readable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").selectExpr("page_id", "CASE page_id % 4 WHEN 0 THEN 404 WHEN 1 THEN 200 END AS status_code", "CASE WHEN page_id % 3 > 0 THEN html END AS page_text")
    return selection.readable_pages(pages).select("page_id", "status_code")


def resume_anti_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    done = events.filter("user_id % 3 = 0").withColumn("state", F.lit("old"))
    new = resume.pending(events, done.filter("user_id % 2 = 0"), "user_id").withColumn("state", F.lit("new"))
    return resume.merge_last(resume.requested(done, events, "user_id"), new, "user_id").select("user_id", "n", "state")


def crawl_cache_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select(urls.domain_of(F.col("url")).alias("company_id"), urls.clean_internal_url(F.col("url")).alias("url"), "page_id")
    old = pages.groupBy("company_id", "url").agg(F.min("page_id").alias("page_id")).withColumn("source", F.lit("cache"))
    new = pages.filter("page_id % 2 = 0").groupBy("company_id", "url").agg(F.max("page_id").alias("page_id")).withColumn("source", F.lit("crawl"))
    return resume.merge_last(old, new, ["company_id", "url"]).select("company_id", "url", "page_id", "source")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = semantic.page_links(_pages(spark, sf_dir), "url", "url", exclude=False)
    return found.select("page_id", "raw_link", "internal_url", "anchor_text")


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.page_links(_pages(spark, sf_dir), "url", "url").select("page_id", "position", "internal_url", "url_path", "anchor_text")


def rescored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as crawled with other scores; every seventh had an error."""
    pages = semantic.page_texts(_pages(spark, sf_dir)).select("page_id", "page_text", F.expr("CASE WHEN page_id % 7 = 0 THEN 'http_error_404' ELSE '' END").alias("crawl_error"), *[F.lit(0.0).alias(c) for c in ("content_positive_score", "content_negative_score", "semantic_margin")])
    return semantic.rescore(pages, HashEmbedder()).drop("page_text")


def robots_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _pages(spark, sf_dir).select(F.col("page_id").alias("company_id"), urls.domain_of(F.col("url")).alias("domain"), F.col("url").alias("final_url"))
    return web.check_robots(sites, fixture="User-agent: *\nDisallow: /private").drop("final_url")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.page_texts(_pages(spark, sf_dir)).select("page_id", "page_text")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("page_id") % 4 == 0, F.regexp_replace("html", "<h1>[^<]*</h1>", "<h2>Our core values</h2>")).otherwise(F.col("html"))
    pages = _pages(spark, sf_dir).withColumn("html", named)
    return semantic.page_sections(pages, HashEmbedder()).drop("html", "url")


_DOC_TEXT = "concat(text, CASE doc_id % 5 WHEN 0 THEN ' Our values: integrity, respect, accountability and excellence guide every decision.' WHEN 1 THEN ' Trust and safety.' WHEN 2 THEN ' Mission, vision  and Values' ELSE '' END)"


def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", text.chunks(F.col("text")).alias("c"))
    return docs.select("doc_id", F.size("c").cast("long").alias("n"), F.md5(F.get("c", F.size("c") - 1).cast("binary")).alias("last"), F.md5(F.array_join("c", "\x1f").cast("binary")).alias("all_chunks"))


def value_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_DOC_TEXT} AS text")
    return docs.select("doc_id", text.value_evidence(F.col("text")).alias("e")).select("doc_id", "e.*")


_HEADS = ["Our Values", "What we  believe", "Contact", "Company DNA", "Our DNA and more", "values and behaviours"]


def primary_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").selectExpr("doc_id", f"concat({_case('doc_id % 6', _HEADS)}, ' ', text) AS heading")
    return docs.select("doc_id", text.primary_heading(F.col("heading")).alias("primary_heading"))


def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("clean"))


def text_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", text.text_metrics(F.col("text")).alias("m"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select("doc_id", "m.characters", "m.letters", "m.passes", "quality")


def _themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").filter("vec_id < 12").select(F.col("vec_id").alias("theme_no"), F.concat(F.lit("theme "), F.col("vec_id").cast("string")).alias("theme"), F.col("embedding").alias("vector"))


def theme_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return vectors.best_theme(items, _themes(spark, sf_dir)).select("vec_id", "matched_theme", F.round("similarity_score", 6).alias("similarity_score"))


def _banks(spark: SparkSession, sf_dir: str) -> tuple[list, list]:
    rows = _table(spark, sf_dir, "embeddings").filter("vec_id < 12").orderBy("vec_id").select("embedding").collect()  # two banks of six themes
    return [list(r[0]) for r in rows[:6]], [list(r[0]) for r in rows[6:]]


def theme_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with equal vec_id div 4 are the chunks of one text."""
    good, bad = _banks(spark, sf_dir)
    chunked = _table(spark, sf_dir, "embeddings").withColumn("text_id", F.floor(F.col("vec_id") / 4)).groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("c"))
    best = vectors.best_margin(F.col("c.embedding"), good, bad)
    return chunked.select("text_id", best.alias("b")).select("text_id", *[F.round(f"b.{c}", 6).alias(c) for c in ("positive", "negative", "margin")])


#: Derived crawl scores, in expressions of common SQL; components are about -0.5 to 0.5.
_X = {n: f"round(least(1.0, 0.3 + abs(CAST(v{i} AS DOUBLE)) * 3), 4)" for i, n in enumerate(("heading_similarity_score", "section_positive_score", "discovery_score"), 1)}
_PAGE_SCORES = {
    "company_id": "CAST(vec_id % 40 AS STRING)",
    "url": f"concat('https://x.example.com/', CAST(vec_id AS STRING), {_case('vec_id % 10', _TAILS)})",
    "crawl_error": "CASE WHEN vec_id % 13 = 0 THEN 'http_error_404' WHEN vec_id % 2 = 0 THEN CAST(NULL AS STRING) ELSE '' END",
    "page_text": "CASE WHEN vec_id % 17 = 0 THEN '  ' ELSE 'text' END",
    "candidate_section_text": _case("vec_id % 4", ["Our values are integrity and trust", "We respect courage, safety and inclusion", "Our mission", "Who we are"]),
    **_X,
    "section_negative_score": "round(abs(CAST(v4 AS DOUBLE)) * 2, 4)",
    "section_semantic_margin": "round(abs(CAST(v5 AS DOUBLE)) * 2, 4)",
    "contains_primary_value_section": "CASE WHEN vec_id % 5 = 0 THEN CAST(NULL AS BOOLEAN) ELSE vec_id % 3 = 0 END",
    "depth": "CAST(vec_id % 4 AS INT)",
}


def _crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _table(spark, sf_dir, "embeddings").select("vec_id", *[F.get("embedding", F.lit(i)).alias(f"v{i}") for i in range(1, 6)])
    return v.selectExpr(*[f"{e} AS {n}" for n, e in _PAGE_SCORES.items()])


_CRAWL_CTE = f"""v AS (SELECT vec_id, {", ".join(f"embedding[{i + 1}] AS v{i}" for i in range(1, 6))} FROM embeddings),
    pages_ AS (SELECT {", ".join(f"{e} AS {n}" for n, e in _PAGE_SCORES.items())} FROM v)"""


def _norm_path(u: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({_path(u)}), '\.(html?|php|aspx?)$', ''), '/+$', '')"


def _is_excluded(u: str) -> str:
    files = "|".join(re.escape(e) for e in C.EXCLUDED_EXTENSIONS)
    return f"(regexp_matches({_norm_path(u)}, '(?:{files})$') OR regexp_matches({_norm_path(u)}, '{_any(C.EXCLUDED_PATHS)}'))"


def _hits(x: str, patterns) -> str:
    return " + ".join(f"CAST(regexp_matches({x}, '{p}') AS INT)" for p in patterns)


_LOWERED = f"lower({_collapse('candidate_section_text')})"
_GATED_CTE = (
    _CRAWL_CTE
    + f""",
    g1 AS (SELECT * REPLACE (coalesce(contains_primary_value_section, false) AS contains_primary_value_section), {_hits(_LOWERED, C.VALUE_SECTIONS)} AS value_section_matches, {_hits(_LOWERED, C.VALUE_WORDS)} AS named_value_matches,
                  CASE WHEN regexp_matches(lower({_path("url")}), '{_any(C.VALUE_PATHS)}') THEN 0.15 ELSE 0.0 END AS value_path_bonus,
                  heading_similarity_score AS h, section_positive_score AS p, section_negative_score AS n, section_semantic_margin AS m
           FROM pages_ WHERE NOT {_is_excluded("url")} AND coalesce(crawl_error, '') = '' AND trim(page_text) <> '' AND trim(candidate_section_text) <> ''
             AND section_negative_score IS NOT NULL AND section_positive_score >= 0.42 AND section_semantic_margin >= 0.06),
    g2 AS (SELECT *, value_section_matches >= 1 OR named_value_matches >= 3 AS evidence FROM g1),
    gated AS (SELECT *, (h >= 0.70 AND p >= 0.40 AND m >= 0.05) OR (h >= 0.50 AND p >= 0.42 AND m >= 0.12) OR (h >= 0.38 AND p >= 0.50 AND m >= 0.25) AS passes_semantic_rule,
                  (contains_primary_value_section AND h >= 0.40 AND p >= 0.40 AND m >= 0.05) OR (evidence AND h >= 0.38 AND p >= 0.40 AND m >= 0.05) OR (NOT contains_primary_value_section AND h >= 0.70 AND p >= 0.46 AND m >= 0.12) AS contains_value_signal,
                  CAST(m + value_path_bonus + CASE WHEN contains_primary_value_section THEN 0.20 ELSE 0.0 END + 0.20 * discovery_score + 0.20 * h + 0.10 * p - 0.10 * n - CASE WHEN NOT contains_primary_value_section AND NOT evidence THEN 0.06 ELSE 0.0 END AS DOUBLE) AS final_selection_score FROM g2)"""
)


def gate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = selection.gate(_crawled(spark, sf_dir))
    return out.select("url", "value_section_matches", "named_value_matches", "passes_semantic_rule", "contains_value_signal", F.round("final_selection_score", 6).alias("final_selection_score"))


def best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = selection.select(_crawled(spark, sf_dir))
    return out.select("company_id", "internal_url", F.round("final_selection_score", 6).alias("final_selection_score"), "quality_status")


def best_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = selection.best_rejected(_crawled(spark, sf_dir).withColumn("section_positive_score", F.col("section_positive_score") * 0.6))
    return out.select("company_id", "url", F.round("review_score", 6).alias("review_score"), "passes_rule_1", "passes_rule_2")


def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.funnel(_crawled(spark, sf_dir))


def top2_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 25).alias("parent"), F.col("vec_id").alias("child"), F.round(F.abs(F.get("embedding", F.lit(0)).cast("double")) * 4, 1).alias("score"))
    return selection.top_children(df, ["parent"], "score", "child").select("parent", "child", "score", F.col("rank").cast("long").alias("rank"))


def translation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents through a cache that knows those of even documents and failed on some."""
    docs = _table(spark, sf_dir, "documents").selectExpr("doc_id AS company_id", "text AS candidate_text", "CASE WHEN doc_id % 9 = 0 THEN 'http_error_500' ELSE '' END AS candidate_error", "'accepted' AS quality_status")
    keys = translation.eligible(docs).select("company_id", F.col("translation_key").alias("source_text"))
    cache = keys.groupBy("source_text").agg(F.min("company_id").alias("first")).filter("first % 2 = 0").select("source_text", F.lit("en").alias("detected_language"), F.lit(False).alias("translation_needed"), F.col("source_text").alias("translated_value_text"), F.lit("not_required").alias("translation_method"), F.lit("already_english").alias("translation_status"), F.lit("").alias("translation_error"))
    new = translation.pending_texts(docs, cache).select("source_text", F.lit("xx").alias("detected_language"), F.lit(True).alias("translation_needed"), F.concat(F.lit("English: "), "source_text").alias("translated_value_text"), F.lit("marked").alias("translation_method"), F.lit("translated").alias("translation_status"), F.lit("").alias("translation_error"))
    out = translation.enrich(docs, translation.merge_cache(cache, new))
    return out.select("id", "detect_language", "translation_status", F.md5(F.col("translated_value_text").cast("binary")).alias("translated"))


def translate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = _table(spark, sf_dir, "documents").filter(F.col("text").rlike(text.rx(r"\S")))  # a condition on source_text would collapse the text again
    texts = said.select(text.collapse_ws(F.col("text")).alias("source_text")).distinct()
    return translation.translate_texts(texts, StopwordDetector(), MarkingTranslator())


def translation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(text.translation_prompt(F.coalesce("text", F.lit("")), F.col("lang"), F.upper("lang")).cast("binary")).alias("prompt"))


def export_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.export_clean(F.col("text")).alias("clean"))


def _rules(host: str) -> str:
    return f"User-agent: *\nDisallow: /{'en' if 'blog.' in host else 'private'}\nAllow: /\n"


class _SiteFetcher:
    """Every host has robots rules by its name; every address is a small page."""

    def get(self, url: str) -> Response:
        host = url.split("/")[2]
        if url.endswith("/robots.txt"):
            return Response(url, 404 if host.startswith("m.") else 200, "text/plain", _rules(host))
        return Response(url, 503 if "/de/" in url else 200, "text/html", "<p>page</p>")


def robots_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _pages(spark, sf_dir).select(F.col("page_id").alias("company_id"), urls.domain_of(F.col("url")).alias("domain"), F.col("url").alias("final_url"))
    return web.check_robots(sites, _SiteFetcher()).drop("final_url")


def availability_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _pages(spark, sf_dir).select(F.col("page_id").alias("company_id"), F.col("url").alias("website_url"))
    return web.check_availability(sites, _SiteFetcher(), wait=lambda seconds: None)


def homepage_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _pages(spark, sf_dir).select(F.col("page_id").alias("company_id"), F.col("url").alias("final_url"))
    return web.fetch_homepages(sites, _SiteFetcher()).drop("homepage_html")


def crawl_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each host is a company whose home page links to all its pages."""
    pages = _pages(spark, sf_dir).select(urls.domain_of(F.col("url")).alias("company_id"), urls.clean_internal_url(F.col("url")).alias("url"), "html")
    home = pages.groupBy("company_id").agg(F.min("url").alias("homepage_fetch_url"))
    own = home.select("company_id", F.lit("").alias("robots_url"), "homepage_fetch_url")
    linked = F.concat(F.lit('<a href="'), F.col("url"), F.lit('/our-values">our core values</a>'), F.col("html"))
    return web.crawl_corpus(own, pages.withColumn("html", linked), HashEmbedder()).select("company_id", "url", "depth", "crawl_error", "links_discovered", "links_queued", "status_code")


_FUNCTIONS = (
    reachable_split, crawl_input, checked_merge, readable_pages,
    clean_companies, prepare_summary, site_url_parts, site_format_usable, url_variants, url_variants_plain, country_domain_status, excluded_urls, path_features, value_path_bonus,
    company_tokens, match_score, match_score_tiered, domain_sharing, qualification_counts, stratified_sample, round_robin_sample, quota_summary, count_tables,
    pool_counts, seed_rows, prefer_country_dedup, scrape_ready_filter, resume_anti_union, crawl_cache_dedup, page_links, crawl_links, page_text, rescored_pages, robots_fixture, sections, text_chunks,
    value_evidence, primary_heading, text_clean, text_quality_gate, theme_top1, theme_margin, gate_rules, best_per_group, best_rejected, funnel_counts, top2_children,
    translation_join, translate_documents, translation_prompts, export_cleanup, robots_eval, availability_probe, homepage_fetch, crawl_bfs,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_MD5 = "md5(concat('42|{salt}|', CAST(company_id AS VARCHAR)))"
_SAMPLE_CTE = f"""{_CLEAN_CTE},
    s1 AS (SELECT *, row_number() OVER (PARTITION BY country, size_bucket, High_Level_Sector ORDER BY {_MD5.format(salt="sector")}, company_id) AS sr FROM cleaned),
    s2 AS (SELECT *, row_number() OVER (PARTITION BY country, size_bucket ORDER BY sr > 5, {_MD5.format(salt="size")}, company_id) AS zr FROM s1),
    sampled AS (SELECT * FROM s2 WHERE zr <= 25)"""
_TAILED_CTE = f"tailed AS (SELECT page_id, {_PAGE_URL} AS url FROM pages)"


def _path_words(path: str) -> str:
    out = rf"regexp_replace(lower(trim({path})), '\.[a-zA-Z0-9]+$', '')"
    for word in C.PATH_NOISE:
        out = f"replace({out}, '{word}', ' ')"
    out = f"regexp_replace({out}, '[/_-]+', ' ', 'g')"
    for short, word in C.PATH_WORDS:
        out = rf"regexp_replace({out}, '\b{short}\b', '{word}', 'g')"
    return _collapse(out)


_WORDS = _path_words(_path("url"))
_CLEANED_TEXT = _collapse("text")
_DOT = "CAST(list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) AS DOUBLE)"
_COS = "{ab} / (sqrt({aa}) * sqrt({bb}))".format(ab=_DOT.format(a="{a}", b="{b}"), aa=_DOT.format(a="{a}", b="{a}"), bb=_DOT.format(a="{b}", b="{b}"))
_INTERNAL = r"regexp_replace(regexp_replace(trim({u}), '[?#].*$', ''), '/+$', '')"
_PLAIN = f"CASE WHEN {_suffix('domain')} = '' OR {_OWN} IS NULL THEN 'global_or_unknown' WHEN regexp_extract({_suffix('domain')}, '([^.]*)$', 1) = {_OWN} THEN 'country_match' WHEN length(regexp_extract({_suffix('domain')}, '([^.]*)$', 1)) = 2 THEN 'country_mismatch' ELSE 'global_or_unknown' END"
_BANK = "(SELECT list(struct_pack(no := vec_id, v := embedding) ORDER BY vec_id) FROM embeddings WHERE vec_id >= {low} AND vec_id < {high})"


def _best(bank: str) -> str:
    return f"list_max(list_transform({bank}, lambda t: {_COS.format(a='embedding', b='t.v')}))"


_VARIANTS_CTE = f"""u AS (SELECT *, {_norm("website")} AS u FROM raw),
    p AS (SELECT *, {_host("u")} AS h, regexp_extract(u, '{_PARTS}', 2) AS s, concat({_path("u")}, CASE WHEN regexp_extract(u, '{_PARTS}', 7) <> '' THEN concat('?', regexp_extract(u, '{_PARTS}', 7)) ELSE '' END) AS t FROM u),
    v AS (SELECT company_id, website, h, CASE WHEN s = 'https' THEN [concat(s, '://', h, t), concat(s, '://www.', h, t)] ELSE [concat(s, '://', h, t), concat(s, '://www.', h, t), concat('https://', h, t), concat('https://www.', h, t)] END AS v FROM p)"""
_LINKS_CTE = rf"""a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS raw_link, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS anchor_text, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)))) AS i FROM pages),
    n AS (SELECT page_id, raw_link, anchor_text, {_INTERNAL.format(u="concat(regexp_extract(url, '^https?://[^/?#]+', 0), raw_link)")} AS internal_url, i FROM a),
    r AS (SELECT *, row_number() OVER (PARTITION BY page_id, internal_url ORDER BY i) AS k FROM n),
    found AS (SELECT * FROM r WHERE k = 1)"""

ORACLES = {
    "clean_companies": f"WITH {_CLEAN_CTE} SELECT * EXCLUDE (company_id) FROM cleaned",
    "prepare_summary": f"WITH {_CLEAN_CTE} SELECT (SELECT count(*) FROM raw) AS input_rows, count(*) AS written_rows, count(*) FILTER (High_Level_Sector = 'Other') AS unmapped_rows FROM cleaned",
    "site_url_parts": f"""SELECT page_id, {_norm("url")} AS normal, nullif({_host(_norm("url"))}, '') AS domain, {_INTERNAL.format(u="url")} AS internal, {_path("url")} AS path,
        {_norm_path("url")} AS normal_path, concat(regexp_extract(url, '{_PARTS}', 2), '://', regexp_extract(url, '{_PARTS}', 4), '/robots.txt') AS robots, {_host("url")} = 'example.com' OR ends_with({_host("url")}, '.example.com') AS below_example FROM pages""",
    "site_format_usable": f"WITH raw AS ({_RAW_SQL}), d AS (SELECT *, nullif({_host(_norm('website'))}, '') AS domain FROM raw) SELECT company_id, {_usable('website', 'domain')} AS usable FROM d",
    "url_variants": f"""WITH raw AS ({_RAW_SQL}), {_VARIANTS_CTE}
        SELECT company_id, CASE WHEN coalesce(h, '') = '' THEN '[]' ELSE CAST(to_json(v) AS VARCHAR) END AS variants FROM v""",
    "url_variants_plain": f"""WITH raw AS ({_RAW_SQL}), u AS (SELECT company_id, {_norm("website")} AS u FROM raw),
        h AS (SELECT company_id, u, coalesce(lower({_strip(f"regexp_extract(u, '{_PARTS}', 4)")}), '') AS h, regexp_extract(u, '{_PARTS}', 2) AS s, regexp_extract(u, '{_PARTS}', 5) AS p FROM u)
        SELECT company_id, CASE WHEN h = '' THEN '[]' ELSE CAST(to_json([concat(s, '://', h, p), concat(s, '://', CASE WHEN starts_with(h, 'www.') THEN substr(h, 5) ELSE concat('www.', h) END, p)]) AS VARCHAR) END AS variants FROM h""",
    "country_domain_status": f"WITH {_CLEAN_CTE} SELECT company_id, {_country('domain')} AS status, {_suffix('domain')} AS suffix, {_label('domain')} AS label FROM cleaned",
    "excluded_urls": f"WITH {_TAILED_CTE} SELECT page_id, {_is_excluded('url')} AS excluded, regexp_matches({_path('url')}, '{urls.UNWANTED_PATH}') AS unwanted FROM tailed",
    "path_features": f"""WITH {_TAILED_CTE}, w AS (SELECT page_id, {_WORDS} AS words FROM tailed)
        SELECT page_id, words, CASE WHEN page_id % 3 = 0 THEN words WHEN words <> '' THEN concat('Page ', CAST(page_id AS VARCHAR), ' (', words, ')') ELSE concat('Page ', CAST(page_id AS VARCHAR)) END AS feature FROM w""",
    "value_path_bonus": f"WITH {_TAILED_CTE} SELECT page_id, CAST(CASE WHEN regexp_matches(lower({_path('url')}), '{_any(C.VALUE_PATHS)}') THEN 0.15 ELSE 0.0 END AS DOUBLE) AS bonus FROM tailed",
    "company_tokens": f"WITH raw AS ({_RAW_SQL}) SELECT company_id, array_to_string({_company_tokens('name')}, ' ') AS tokens FROM raw",
    "match_score": f"WITH {_CLEAN_CTE}, {_qualified('cleaned')} SELECT company_id, name, domain, exact_score, substring_score, abbreviation_score, domain_match_score, matched, country_domain_status, companies_using_domain, qualification_status FROM qualified",
    "match_score_tiered": f"""WITH {_CLEAN_CTE}, {_qualified("cleaned")},
        f AS (SELECT *, CASE WHEN len(ct) > 0 AND len(dt) > 0 AND len(ex) > 0 THEN 100 ELSE 0 END AS a FROM scored),
        g AS (SELECT *, CASE WHEN len(ct) = 0 OR len(dt) = 0 OR a > 0 OR len(pa) = 0 THEN 0 WHEN len(pa) = len(ct) THEN 100 ELSE 80 END AS b FROM f),
        h AS (SELECT *, CASE WHEN len(ct) < 2 OR len(dt) = 0 OR a > 0 OR b > 0 THEN 0 ELSE coalesce(list_filter(list_transform(dt, lambda d: CASE WHEN d = ini THEN 90 WHEN starts_with(d, ini) THEN 70 ELSE 0 END), lambda s: s > 0)[1], 0) END AS c FROM g)
        SELECT company_id, a AS full_match_score, b AS substring_match_score, c AS abbreviation_score, greatest(a, b, c) AS final_score,
               CASE WHEN greatest(a, b, c) >= 80 THEN 'keep' WHEN greatest(a, b, c) >= 50 THEN 'review' ELSE 'remove' END AS domain_match_status FROM h""",
    "domain_sharing": f"WITH {_CLEAN_CTE}, {_qualified('cleaned')} SELECT company_id, domain, companies_using_domain, countries_using_domain FROM qualified",
    "qualification_counts": f"WITH {_CLEAN_CTE}, {_qualified('cleaned')} SELECT count(*) AS checked, count(*) FILTER (qualification_status = 'keep') AS keep, count(*) FILTER (qualification_status = 'review') AS review, count(*) FILTER (qualification_status = 'remove') AS remove FROM qualified",
    "stratified_sample": f"WITH {_SAMPLE_CTE} SELECT format('C{{:04d}}', row_number() OVER (ORDER BY country, size_bucket, High_Level_Sector, company_id)) AS company_id, company_id AS source_id, country, size_bucket, High_Level_Sector FROM sampled",
    "quota_summary": f"WITH {_CLEAN_CTE} SELECT country, count(name) AS total_companies, count(*) FILTER (High_Level_Sector = '{C.GOVERNMENT_SECTOR}') AS government_companies, count(*) FILTER (High_Level_Sector = '{C.GOVERNMENT_SECTOR}') / count(name) AS government_ratio FROM cleaned GROUP BY 1",
    "count_tables": f"WITH {_CLEAN_CTE} " + " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS n FROM cleaned GROUP BY 2" for c in ("country", "size_bucket", "High_Level_Sector")),
    "pool_counts": f"WITH {_CLEAN_CTE} SELECT company_id, count(*) OVER (PARTITION BY country) AS company_count_for_country_in_pool, (SELECT count(DISTINCT country) FROM cleaned) AS total_countries_in_pool FROM cleaned",
    "seed_rows": f"WITH {_CLEAN_CTE} SELECT min(company_id) AS company_id, country, size_bucket FROM cleaned GROUP BY country, size_bucket",
    "prefer_country_dedup": f"""WITH {_CLEAN_CTE}, o AS (SELECT DISTINCT name, country, domain, {_PLAIN} AS country_website_status FROM cleaned),
        r AS (SELECT *, row_number() OVER (PARTITION BY name, country ORDER BY CASE country_website_status WHEN 'country_match' THEN 0 WHEN 'global_or_unknown' THEN 1 ELSE 2 END, domain) AS n FROM o)
        SELECT name, country, domain, country_website_status FROM r WHERE n = 1""",
    "scrape_ready_filter": f"WITH r AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _READY.items())} FROM pages) SELECT company_id, final_url, true AS scraping_ready FROM r WHERE final_url IS NOT NULL AND coalesce(is_website_reachable, false) AND regexp_matches(content_type, '(?i)text/html|application/xhtml\\+xml') AND qualification_status = 'keep'",
    "reachable_split": f"WITH r AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _READY.items())} FROM pages) SELECT company_id, CASE WHEN is_website_reachable THEN 'reachable' ELSE 'unreachable' END AS side FROM r WHERE is_website_reachable IS NOT NULL",
    "crawl_input": f"""WITH r AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _CRAWL_INPUT.items())} FROM customer),
        k AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY final_url, name, country, size_bucket, domain) AS n FROM r WHERE company_id IS NOT NULL AND final_url IS NOT NULL),
        s AS (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', company_id)), company_id) AS o FROM k WHERE n = 1)
        SELECT company_id, name, country, size_bucket, domain, final_url FROM s WHERE o <= 100""",
    "checked_merge": "SELECT o_orderkey, o_custkey AS key, c_name AS name FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    "readable_pages": "SELECT page_id, CAST(CASE page_id % 4 WHEN 0 THEN 404 WHEN 1 THEN 200 END AS INTEGER) AS status_code FROM pages WHERE page_id % 4 <> 0 AND page_id % 3 > 0 AND html IS NOT NULL",
    "resume_anti_union": "SELECT user_id, count(*) AS n, CASE WHEN user_id % 3 = 0 AND user_id % 2 = 0 THEN 'old' ELSE 'new' END AS state FROM events GROUP BY user_id",
    "crawl_cache_dedup": f"""WITH p AS (SELECT nullif({_host(_norm("url"))}, '') AS company_id, {_INTERNAL.format(u="url")} AS url, page_id FROM pages)
        SELECT company_id, url, coalesce(max(page_id) FILTER (page_id % 2 = 0), min(page_id)) AS page_id, CASE WHEN count(*) FILTER (page_id % 2 = 0) > 0 THEN 'crawl' ELSE 'cache' END AS source FROM p GROUP BY 1, 2""",
    "page_links": f"WITH {_LINKS_CTE} SELECT page_id, raw_link, internal_url, anchor_text FROM found",
    "crawl_links": f"""WITH {_LINKS_CTE} SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, internal_url, {_path("internal_url")} AS url_path, anchor_text
        FROM found WHERE NOT {_is_excluded("internal_url")}""",
    "robots_fixture": f"""SELECT page_id AS company_id, nullif({_host(_norm("url"))}, '') AS domain, concat(regexp_extract(url, '{_PARTS}', 2), '://', regexp_extract(url, '{_PARTS}', 4), '/robots.txt') AS robots_url,
        200 AS robots_status_code, false AS robots_allowed, 'Disallow rule present in robots.txt' AS robots_reason FROM pages""",
    "availability_probe": f"""WITH raw AS (SELECT page_id AS company_id, url AS website FROM pages), {_VARIANTS_CTE},
        a AS (SELECT company_id, website, CASE WHEN coalesce(h, '') = '' THEN [] ELSE v END AS v, coalesce(h, '') <> '' AND NOT contains(v[1], '/de/') AS good FROM v)
        SELECT company_id, website AS website_url, good AS is_website_reachable, CASE WHEN good THEN v[1] END AS final_url, CASE WHEN good THEN 200 WHEN len(v) > 0 THEN 503 END AS status_code, CASE WHEN len(v) > 0 THEN 'text/html' END AS content_type,
               CASE WHEN good THEN NULL WHEN len(v) > 0 THEN 'http_error:503' ELSE 'invalid' END AS failure_reason, CASE WHEN len(v) > 0 THEN concat('["', array_to_string(v, '", "'), '"]') ELSE '[]' END AS checked_url_variants,
               CAST(CASE WHEN good THEN 1 ELSE 3 * len(v) END AS INTEGER) AS http_attempts FROM a""",
    "text_chunks": f"""WITH c AS (SELECT doc_id, {_CLEANED_TEXT} AS c FROM documents), n AS (SELECT doc_id, c, CASE WHEN length(c) = 0 THEN 0 ELSE greatest(CAST(ceil((length(c) - 1500) / 1250.0) AS BIGINT), 0) + 1 END AS n FROM c)
        SELECT doc_id, n, CASE WHEN n > 0 THEN md5(trim(substr(c, (n - 1) * 1250 + 1, 1500))) END AS last,
               md5(CASE WHEN n > 0 THEN array_to_string(list_transform(range(0, n), lambda i: trim(substr(c, i * 1250 + 1, 1500))), chr(31)) ELSE c END) AS all_chunks FROM n""",
    "value_evidence": f"""WITH d AS (SELECT doc_id, lower({_CLEANED_TEXT}) AS t FROM (SELECT doc_id, {_DOC_TEXT} AS text FROM documents)), c AS (SELECT doc_id, {_hits("t", C.VALUE_SECTIONS)} AS value_section_matches, {_hits("t", C.VALUE_WORDS)} AS named_value_matches FROM d)
        SELECT *, value_section_matches >= 1 OR named_value_matches >= 3 AS contains_value_signal FROM c""",
    "primary_heading": f"WITH d AS (SELECT doc_id, concat({_case('doc_id % 6', _HEADS)}, ' ', text) AS text FROM documents) SELECT doc_id, regexp_matches(lower({_CLEANED_TEXT}), '{_any(C.PRIMARY_HEADINGS)}') AS primary_heading FROM d",
    "text_quality_gate": r"""WITH d AS (SELECT doc_id, length(text) AS characters, length(text) - length(regexp_replace(text, '\p{L}', '', 'g')) AS letters, length(text) - length(replace(text, chr(65533), '')) AS broken FROM documents)
        SELECT d.doc_id, characters, letters, characters >= 120 AND letters >= 80 AND letters / characters >= 0.30 AND broken / characters <= 0.002 AS passes, quality FROM d LEFT JOIN labels USING (doc_id)""",
    "theme_top1": f"""WITH s AS (SELECT e.vec_id, t.vec_id AS no, {_COS.format(a="e.embedding", b="t.embedding")} AS score FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < 12) t)
        SELECT vec_id, concat('theme ', CAST(arg_max(no, struct_pack(s := score, n := -no)) AS VARCHAR)) AS matched_theme, round(max(score), 6) AS similarity_score FROM s GROUP BY 1""",
    "theme_margin": f"""WITH s AS (SELECT vec_id, CAST(vec_id // 4 AS BIGINT) AS text_id, {_best(_BANK.format(low=0, high=6))} AS p, {_best(_BANK.format(low=6, high=12))} AS n FROM embeddings),
        b AS (SELECT text_id, arg_max(struct_pack(p := p, n := n, m := p - n), struct_pack(m := p - n, i := -vec_id)) AS b FROM s GROUP BY 1)
        SELECT text_id, round(b.p, 6) AS positive, round(b.n, 6) AS negative, round(b.m, 6) AS margin FROM b""",
    "gate_rules": f"WITH {_GATED_CTE} SELECT url, value_section_matches, named_value_matches, passes_semantic_rule, contains_value_signal, round(final_selection_score, 6) AS final_selection_score FROM gated",
    "best_per_group": f"""WITH {_GATED_CTE}, r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY final_selection_score DESC, m DESC, p DESC, depth, url) AS k FROM gated WHERE contains_value_signal)
        SELECT company_id, url AS internal_url, round(final_selection_score, 6) AS final_selection_score, 'accepted' AS quality_status FROM r WHERE k = 1""",
    "best_rejected": f"""WITH {_CRAWL_CTE}, s AS (SELECT company_id, url, heading_similarity_score AS h, section_positive_score * 0.6 AS p, section_semantic_margin AS m FROM pages_ WHERE trim(candidate_section_text) <> ''),
        t AS (SELECT *, p >= 0.46 AND m >= 0.10 AS signal, m + 0.15 * h + 0.10 * p AS score FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY signal DESC, score DESC, url) AS k FROM t)
        SELECT company_id, url, CAST(round(score, 6) AS DOUBLE) AS review_score, h >= 0.50 AND p >= 0.44 AND m >= 0.08 AS passes_rule_1, h >= 0.42 AND p >= 0.48 AND m >= 0.12 AS passes_rule_2 FROM r WHERE k = 1 AND NOT signal""",
    "funnel_counts": f"""WITH {_GATED_CTE} SELECT (SELECT count(*) FROM pages_) AS crawled, (SELECT count(*) FROM pages_ WHERE coalesce(crawl_error, '') = '') AS without_error, count(*) AS valid,
        count(*) FILTER (contains_value_signal) AS with_signal, count(DISTINCT company_id) FILTER (contains_value_signal) AS companies_accepted FROM gated""",
    "top2_children": """WITH s AS (SELECT vec_id % 25 AS parent, vec_id AS child, round(abs(CAST(embedding[1] AS DOUBLE)) * 4, 1) AS score FROM embeddings),
        r AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY score DESC, child) AS rank FROM s WHERE score >= 0.38) SELECT * FROM r WHERE rank <= 2""",
    "translation_join": f"""WITH k AS (SELECT doc_id AS id, {_CLEANED_TEXT} AS t FROM documents WHERE doc_id % 9 <> 0 AND trim(text) <> ''), f AS (SELECT t, min(id) AS first FROM k GROUP BY 1)
        SELECT id, CASE WHEN first % 2 = 0 THEN 'en' ELSE 'xx' END AS detect_language, CASE WHEN first % 2 = 0 THEN 'already_english' ELSE 'translated' END AS translation_status, md5(CASE WHEN first % 2 = 0 THEN t ELSE concat('English: ', t) END) AS translated FROM k JOIN f USING (t)""",
    "translation_prompts": "SELECT doc_id, md5(concat('Translate the following company values text from ', upper(lang), ' (', lang, ') into English.', chr(10), chr(10), 'Rules:', chr(10), '- Translate literally and completely.', chr(10), '- Do not summarise.', chr(10), '- Do not reorganise the content.', chr(10), '- Do not add headings unless they exist in the source.', chr(10), '- Do not explain the translation.', chr(10), '- Return only the translated text.', chr(10), chr(10), 'SOURCE TEXT:', chr(10), coalesce(text, ''))) AS prompt FROM documents",
    "robots_eval": f"""WITH p AS (SELECT page_id AS company_id, nullif({_host(_norm("url"))}, '') AS domain, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, {_path("url")} AS path FROM pages)
        SELECT company_id, domain, concat(site, '/robots.txt') AS robots_url, CASE WHEN starts_with(host, 'm.') THEN 404 ELSE 200 END AS robots_status_code,
               starts_with(host, 'm.') OR NOT (contains(host, 'blog.') AND starts_with(path, '/en')) AS robots_allowed,
               CASE WHEN starts_with(host, 'm.') THEN 'robots_status_404' WHEN contains(host, 'blog.') AND starts_with(path, '/en') THEN 'blocked' ELSE 'allowed' END AS robots_reason FROM p""",
    "homepage_fetch": f"""SELECT page_id AS company_id, url AS final_url, CASE WHEN contains(url, '/de/') THEN 503 ELSE 200 END AS homepage_status_code, 'text/html' AS homepage_content_type, {_INTERNAL.format(u="url")} AS homepage_fetch_url,
        NOT contains(url, '/de/') AS homepage_fetch_success, CASE WHEN contains(url, '/de/') THEN 'homepage_http_error_503' ELSE '' END AS homepage_error FROM pages""",
    "export_cleanup": r"SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(text, '[\r\n\t]+', ' ', 'g'), '\s{2,}', ' ', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM conversations",
}
