import pytest
from pyspark.sql import functions as F

from quarrylight.functions import text, vectors
from quarrylight.operators import resume, selection, translation
from quarrylight.sources import providers
from quarrylight.sources.providers import MarkingTranslator, StopwordDetector


def _one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


def test_unicode_space_and_case(spark):
    assert _one(spark, "  A B \t", text.collapse_ws) == "A B"
    assert _one(spark, " Straße Œuvre İ ", text.ascii_fold) == "strae uvre i"
    assert _one(spark, None, text.ascii_fold) == ""


def test_spaces_that_unicode_knows(spark):
    odd = ["", " ", "\u00a0\u3000\x85", "\u2003a \t\u00a0\nb\u200b", "\x1c", "\u2028x\u1680", "\u180e", "\x00 a", None]
    both = F.struct(text.collapse_ws(F.col("t")).alias("now"), text.strip_ws(F.regexp_replace("t", text.rx(r"\s+"), " ")).alias("by_patterns"), F.col("t").rlike(text.rx(r"\S")).alias("says"))
    rows = spark.createDataFrame([(x,) for x in odd], "t string").select(both.alias("r")).select("r.*").collect()
    assert [r.now for r in rows] == [r.by_patterns for r in rows] and [r.says for r in rows] == [None if r.now is None else r.now != "" for r in rows]


def test_detector_does_not_split_its_words_for_each_word(monkeypatch):
    class Words(str):
        splits = 0

        def split(self, *_):
            Words.splits += 1
            return str.split(self)

    monkeypatch.setattr(providers, "STOPWORDS", {c: (n, Words(w)) for c, (n, w) in providers.STOPWORDS.items()})
    assert StopwordDetector().detect("le der Der la " * 50) == ("de", "German") and StopwordDetector().detect("le der") == ("de", "German")
    assert Words.splits == 0
    with pytest.raises(ValueError):
        StopwordDetector().detect("12 xyz")


def test_texts_are_translated_once_and_in_small_batches(spark):
    texts = spark.createDataFrame([("der die das",), ("the of and",), ("xyz",), (None,)], "source_text string")
    out = translation.translate_texts(texts, StopwordDetector(), MarkingTranslator())
    assert {tuple(r) for r in out.filter("translated_value_text IS NOT NULL").collect()} == {("der die das", "de", True, "[de] der die das", "marking", "translated", ""), ("the of and", "en", False, "the of and", "not_required", "already_english", "")}
    assert {(r.source_text, r.translation_error) for r in out.filter("translation_status = 'language_detection_failed'").collect()} == {("xyz", "ValueError"), (None, "AttributeError")}
    plan = out.filter("translation_status = 'translated'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "InPandas" not in plan


@pytest.mark.parametrize("n", [0, 1, 1499, 1500, 1501, 2750, 2751, 9000])
def test_chunks_follow_the_loop(spark, n):
    from quarrylight.operators.semantic import pieces

    value = " ".join(["word"] * 4000)[:n]
    assert _one(spark, value, text.chunks) == pieces(value)


def test_chunks_reject_bad_arguments():
    with pytest.raises(ValueError):
        text.chunks(F.lit("x"), 10, 10)


def test_evidence_and_headings(spark):
    e = _one(spark, "Integrity, respect, accountability and  excellence guide every decision.", text.value_evidence)
    assert (e.value_section_matches, e.named_value_matches, e.contains_value_signal) == (0, 4, True)
    assert _one(spark, "What  we\nBelieve", text.primary_heading) and not _one(spark, "valuesour", text.primary_heading)


def test_features(spark):
    row = spark.createDataFrame([("Read more", "/about-co/val.html"), ("Values", "/our_values/"), (" ", "/")], "a string, p string").select(text.feature_text(F.col("a"), F.col("p"))).collect()
    assert [r[0] for r in row] == ["about company values", "Values (our values)", ""]


def test_clean_text(spark):
    assert _one(spark, "See&nbsp;https://x.de/a now!!!! mail a.b@c.de ☃ ﬁn", text.clean_text) == "See now! mail fin"


def test_best_theme_takes_the_first_at_a_tie(spark):
    themes = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "b", [1.0, 0.0]), (2, "c", [0.0, 1.0])], "theme_no int, theme string, vector array<float>")
    items = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 3.0])], "id int, vector array<float>")
    got = {r.id: (r.matched_theme, r.similarity_score) for r in vectors.best_theme(items, themes).collect()}
    assert got == {1: ("a", 1.0), 2: ("c", 1.0)}


PAGE = "company_id string, name string, country string, domain string, size_bucket string, url string, fetch_url string, crawl_error string, page_text string, candidate_section_text string, depth int, status_code int, section_positive_score double, section_negative_score double, section_semantic_margin double, heading_similarity_score double, discovery_score double, contains_primary_value_section boolean"


def _page(url, primary, company="C1", positive=0.6, margin=0.3, error="", depth=1, heading=0.8):
    return (company, "n", "france", "x.fr", "small", url, url, error, "text", "Our values: integrity, respect and trust", depth, 200, positive, 0.2, margin, heading, 0.5, primary)


def test_selection_prefers_primary_and_is_nan_safe(spark):
    rows = [_page("https://x.fr/mission", False), _page("https://x.fr/our-values", True), _page("https://x.fr/contact", True), _page("https://x.fr/z", True, "C2", positive=float("nan")), _page("https://x.fr/y", None, "C3", error="http_error_404"), _page("https://x.fr/w", None, "C4")]
    out = selection.select(spark.createDataFrame(rows, PAGE)).collect()
    assert {(r.company_id, r.internal_url) for r in out} == {("C1", "https://x.fr/our-values"), ("C4", "https://x.fr/w")}
    assert all(r.quality_status == "accepted" for r in out)
    empty = selection.select(spark.createDataFrame([], PAGE))
    assert empty.count() == 0 and "quality_status" in empty.columns
    with pytest.raises(ValueError, match="missing required columns"):
        selection.select(spark.createDataFrame([(1,)], "a int"))


def test_resume(spark):
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    old = spark.createDataFrame([(1, "a"), (9, "z")], "id int, v string")
    assert sorted(r.id for r in resume.pending(wanted, old, "id").collect()) == [2, 3]
    assert resume.pending(wanted, None, "id").count() == 3
    new = spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string")
    assert sorted((r.id, r.v) for r in resume.merge_last(resume.requested(old, wanted, "id"), new, "id").collect()) == [(1, "b"), (2, "c")]


class _Fails(MarkingTranslator):
    def translate(self, text, code, language):
        raise OSError("down")


class _Comments(MarkingTranslator):
    def translate(self, text, code, language):
        return "Here is a translation: x"


def test_translate_one():
    d = StopwordDetector()
    assert translation.translate_one("the cat and the dog", d, _Fails())[5] == "already_english"
    waits = []
    assert translation.translate_one("der Hund und die Katze", d, _Fails(), waits.append)[3:] == (None, "marking", "failed", "OSError") and waits == [1, 2]
    assert translation.translate_one("der Hund und die Katze", d, _Comments())[6] == "ValueError"
    assert translation.translate_one("der Hund", d, MarkingTranslator())[3] == "[de] der Hund"
    assert translation.translate_one("zzz", d, MarkingTranslator())[5] == "language_detection_failed"


def test_translation_flow(spark):
    c = spark.createDataFrame([(1, "der  Hund", "", "accepted"), (2, "der Hund", None, "accepted"), (3, "x", "err", "accepted"), (4, " ", "", "accepted"), (5, "the cat", "", "rejected")], "company_id int, candidate_text string, candidate_error string, quality_status string")
    texts = translation.pending_texts(c, None)
    assert [r.source_text for r in texts.collect()] == ["der Hund"]
    cache = translation.translate_texts(texts, StopwordDetector(), MarkingTranslator())
    out = translation.enrich(c, cache.unionAll(cache)).orderBy("id").collect()
    assert [(r.id, r.translated_value_text, r.candidate_text) for r in out] == [(1, "[de] der Hund", "der Hund"), (2, "[de] der Hund", "der Hund")]
    assert translation.pending_texts(c, cache).count() == 0
