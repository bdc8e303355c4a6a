"""The stages from a raw company file to translated value statements, resumable, over any fetcher and models."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import companies, resume, selection, semantic, translation, web
from ..sources import files
from ..sources.providers import Embedder, Fetcher, LanguageDetector, Translator


@dataclass
class Run:
    """Where stages write, what they fetch and score with, and whether old results count.

    resume: keep finished rows and do the rest; force: start over.
    """

    spark: SparkSession
    folder: str
    fetcher: Fetcher
    embedder: Embedder
    detector: LanguageDetector
    translator: Translator
    resume: bool = False
    force: bool = False
    seed: int = 42
    workers: int = 5

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def load(self, name: str) -> DataFrame:
        found = files.read_table(self.spark, self.path(name))
        if found is None:
            raise FileNotFoundError(self.path(name))
        return found

    def save(self, name: str, df: DataFrame) -> DataFrame:
        return files.write_table(df, self.path(name))

    def merged(self, name: str, wanted: DataFrame, key: str | list[str], work, restrict: bool = True) -> DataFrame:
        """Do the work for rows that the stage's table lacks and merge; restrict: forget rows not wanted."""
        old = files.read_table(self.spark, self.path(name)) if self.resume and not self.force else None
        new = work(resume.pending(wanted, old, key).repartition(self.workers))
        if old is None:
            return self.save(name, new)
        kept = resume.requested(old, wanted, key) if restrict else old
        keys = [key] if isinstance(key, str) else key
        keys = keys if restrict else [*keys, "url"]
        return self.save(name, resume.merge_last(kept, new, keys))


def prepare(run: Run, raw_path: str) -> dict:
    raw = files.read_csv(run.spark, raw_path)
    run.save("companies", companies.clean(raw))
    return companies.prepare_summary(companies.column_names(raw)).first().asDict()


def qualify(run: Run) -> dict:
    checked = run.save("qualified", companies.qualify(run.load("companies")))
    sampled = companies.with_ids(companies.sample(checked.filter("qualification_status = 'keep'"), run.seed))
    count = run.save("sample", sampled).count()
    return companies.status_counts(checked).first().asDict() | {"sample": count}


def availability(run: Run) -> dict:
    # With the address in the key, a company whose address has changed is probed again.
    out = run.merged("availability", run.load("sample"), ["company_id", "website_url"], lambda df: web.check_availability(df, run.fetcher))
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("is_website_reachable"), 1)).alias("reachable")).first().asDict()


def build_scrape_ready(run: Run) -> dict:
    return {"rows": run.save("scrape_ready", companies.scrape_ready(run.load("availability"))).count()}


def robots(run: Run) -> dict:
    out = run.merged("robots", run.load("scrape_ready"), "company_id", lambda df: web.check_robots(df, run.fetcher))
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("robots_allowed"), 1)).alias("allowed")).first().asDict()


def homepages(run: Run) -> dict:
    allowed = run.load("robots").filter(F.coalesce("robots_allowed", F.lit(False)))
    out = run.merged("homepages", allowed, "company_id", lambda df: web.fetch_homepages(df, run.fetcher))
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("homepage_fetch_success"), 1)).alias("success")).first().asDict()


def links(run: Run) -> dict:
    pages = run.load("homepages").filter(F.coalesce("homepage_fetch_success", F.lit(False)))
    found = semantic.page_links(pages.select("company_id", "homepage_fetch_url", "final_url", "homepage_html"), "homepage_fetch_url", "homepage_fetch_url", "homepage_html", exclude=False)
    return {"rows": run.save("links", found).count()}


def crawl(run: Run) -> dict:
    ready = run.load("homepages").filter(F.col("homepage_fetch_url").isNotNull() & F.coalesce("robots_allowed", F.lit(False)) & (F.coalesce("homepage_error", F.lit("")) == ""))
    out = run.merged("crawl", ready, "company_id", lambda df: web.crawl(df, run.fetcher, run.embedder), restrict=False)
    return out.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("company_id").alias("companies")).first().asDict()


def select(run: Run) -> dict:
    return {"rows": run.save("selected", selection.select(run.load("crawl"))).count()}


def translate(run: Run, export: str | None = None) -> dict:
    chosen = run.load("selected")
    cache = None if run.force else files.read_table(run.spark, run.path("translations"))
    texts = translation.pending_texts(chosen, cache)
    healthy = getattr(run.translator, "healthy", None)
    if healthy is not None and not texts.isEmpty() and not healthy():
        raise RuntimeError(f"the translator {run.translator.name} does not answer")
    new = translation.translate_texts(texts, run.detector, run.translator, tasks=2)
    cache = run.save("translations", translation.merge_cache(cache, new))
    out = run.save("export", translation.enrich(chosen, cache))
    if export:
        files.export_csv(out, export)
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("translation_status") == "translated", 1)).alias("translated")).first().asDict()


STAGES = {
    "qualify-domains": qualify,
    "check-availability": availability,
    "build-scrape-ready": build_scrape_ready,
    "check-robots": robots,
    "fetch-homepages": homepages,
    "extract-links": links,
    "crawl-websites": crawl,
    "select-values": select,
    "translate-values": translate,
}


def run_all(run: Run, raw_path: str, with_translation: bool = False, manifest: str | None = None) -> dict:
    """All stages in order; returns, and optionally writes, the manifest."""
    began, done = time.monotonic(), {"prepare-companies": prepare(run, raw_path)}
    for name, stage in STAGES.items():
        if name != "translate-values" or with_translation:
            done[name] = stage(run)
    out = {"input": raw_path, "folder": run.folder, "seed": run.seed, "resume": run.resume, "force": run.force, "translate": with_translation, "stages": done, "stage_duration_seconds": round(time.monotonic() - began, 4)}
    if manifest:
        files.write_manifest(out, manifest)
    return out
