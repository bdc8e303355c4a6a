"""Columns of the stages (fixed values: files of other runs have the same), and the guard that checks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame

RAW = ("name", "website", "country", "industry", "size")
CLEANED = ("name", "country", "industry", "size", "size_bucket", "High_Level_Sector", "website_url", "domain")
AVAILABILITY = "is_website_reachable boolean, final_url string, status_code int, content_type string, failure_reason string, checked_url_variants string, http_attempts int"
ROBOTS = "robots_url string, robots_status_code int, robots_allowed boolean, robots_reason string"
HOMEPAGE = "homepage_status_code int, homepage_content_type string, homepage_fetch_url string, homepage_fetch_success boolean, homepage_error string, homepage_html string"
CRAWL = (
    "company_id string, name string, country string, domain string, size_bucket string, url string, fetch_url string, parent_url string, depth int, "
    "anchor_text string, feature_text string, discovery_score double, matched_theme string, status_code int, content_type string, page_text string, "
    "content_positive_score double, content_negative_score double, semantic_margin double, links_discovered int, links_queued int, crawl_error string, "
    "candidate_section_heading string, candidate_section_text string, section_positive_score double, section_negative_score double, "
    "section_semantic_margin double, candidate_section_count int, heading_similarity_score double, heading_matched_theme string, contains_primary_value_section boolean"
)
TRANSLATION = "source_text string, detected_language string, translation_needed boolean, translated_value_text string, translation_method string, translation_status string, translation_error string"
EXPORT = (
    "company_id", "name", "country", "size_bucket", "internal_url", "depth", "candidate_section_heading", "heading_matched_theme",
    "heading_similarity_score", "section_positive_score", "section_negative_score", "section_semantic_margin", "candidate_section_count",
    "candidate_text", "quality_status", "contains_value_signal", "detected_language", "translation_needed", "translated_value_text",
    "translation_method", "translation_status", "translation_error",
)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def require_columns(df: DataFrame, columns) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
