"""Translation of accepted texts through a cache of distinct texts."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rows import by_row
from ..functions.text import collapse_ws, export_clean, strip_ws
from ..schemas import EXPORT, TRANSLATION, names, require_columns
from ..sources.providers import LanguageDetector, Translator
from .resume import last, merge_last, pending

#: Beginnings of answers that comment on the translation. Fixed values.
COMMENTARY = ("here's a translation", "here is a translation", "translation:", "the translation is")
TRIES = 3


def eligible(candidates: DataFrame) -> DataFrame:
    """Accepted texts without error, with the key under which they are cached."""
    require_columns(candidates, ["candidate_text", "candidate_error", "quality_status"])
    text = F.coalesce("candidate_text", F.lit(""))
    keep = (F.coalesce("candidate_error", F.lit("")) == "") & (strip_ws(text) != "") & (F.col("quality_status") == "accepted")
    return candidates.filter(F.coalesce(keep, F.lit(False))).withColumn("translation_key", collapse_ws(text))


def translate_one(text: str, detector: LanguageDetector, translator: Translator, wait: Callable[[float], None] = time.sleep) -> tuple:
    """A cache row: English is kept, other texts are translated with retries."""
    try:
        code, language = detector.detect(text)
    except Exception as error:  # noqa: BLE001  any detector failure is a result
        return (text, "unknown", None, None, "not_started", "language_detection_failed", type(error).__name__)
    if code == "en":
        return (text, "en", False, text, "not_required", "already_english", "")
    why = ""
    for attempt in range(TRIES):
        try:
            out = translator.translate(text, code, language).strip()
            if not out:
                raise ValueError("empty translation")
            if out.lower().startswith(COMMENTARY):
                raise ValueError("commentary")
            return (text, code, True, out, translator.name, "translated", "")
        except Exception as error:  # noqa: BLE001
            why = type(error).__name__
            if attempt < TRIES - 1:
                wait(2**attempt)
    return (text, code, True, None, translator.name, "failed", why)


def translate_texts(texts: DataFrame, detector: LanguageDetector, translator: Translator, tasks: int | None = None) -> DataFrame:
    """Cache rows for a table of distinct texts (source_text); tasks bounds the calls at the same time."""

    @by_row(TRANSLATION)
    def run(text: str) -> tuple:
        return translate_one(text, detector, translator)

    rows = texts.repartition(tasks) if tasks else texts
    return rows.select(run("source_text").alias("row")).select("row.*")


def pending_texts(candidates: DataFrame, cache: DataFrame | None, retry_failed: bool = False) -> DataFrame:
    """Distinct keys that the cache lacks; retry_failed: also those that failed."""
    wanted = eligible(candidates).select(F.col("translation_key").alias("source_text")).distinct()
    if cache is not None and retry_failed:
        cache = cache.filter("translation_status <> 'failed'")
    return pending(wanted, cache, "source_text")


def merge_cache(cache: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if cache is None else merge_last(cache, new, "source_text")


def enrich(candidates: DataFrame, cache: DataFrame) -> DataFrame:
    """Eligible candidates with their cache row, the export's columns and names.

    The cache has one row for each text; where it does not, the first by status is taken.
    """
    rows = eligible(candidates)
    once = last(cache, ["source_text"], "translation_status", "translated_value_text")
    new = [c for c in names(TRANSLATION) if c != "source_text"]
    out = rows.drop(*new).join(once, rows["translation_key"] == once["source_text"], "left").drop("translation_key", "source_text")
    for column in EXPORT:
        if column not in out.columns:
            out = out.withColumn(column, F.lit(None).cast("string"))
    out = out.select(*EXPORT).withColumnsRenamed({"company_id": "id", "detected_language": "detect_language"})
    return out.select(*[export_clean(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes])
