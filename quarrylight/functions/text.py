"""Text functions as Column expressions; Arrow functions only where Unicode normal forms are needed."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import catalogue as C


def rx(pattern: str) -> str:
    """A pattern whose \\b, \\s and \\w follow Unicode."""
    return f"(?U){pattern}"


def any_of(col: Column, patterns: tuple[str, ...]) -> Column:
    """Whether one of the patterns occurs; one alternation, so that the text is read once."""
    return col.rlike(rx("|".join(f"(?:{p})" for p in patterns)))


def strip_ws(col: Column) -> Column:
    return F.regexp_replace(col, rx(r"^\s+|\s+$"), "")


def collapse_ws(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, rx(r"\s+"), " "))


def clean_text_value(col: Column) -> Column:
    """Stripped and lower-cased."""
    return F.lower(strip_ws(col))


def no_nan(col: Column) -> Column:
    """NaN as null: thresholds are never met by a missing score."""
    return F.when(~F.isnan(col), col)


def sql_text(col: Column) -> Column:
    """Null for the words that stand for a missing value in text files."""
    return F.when(~col.isin(*C.MISSING), col)


@F.pandas_udf(T.StringType())
def _fold(col: pd.Series) -> pd.Series:
    return col.fillna("").str.lower().str.strip().str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def ascii_fold(col: Column) -> Column:
    """Lower-cased, stripped, decomposed, ASCII only; null is empty."""
    return _fold(col)


def company_tokens(folded: Column) -> Column:
    """Words of a folded name but for legal forms and single letters."""
    words = F.split(F.regexp_replace(folded, r"[^a-z0-9]+", " "), " ")
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*C.LEGAL_WORDS))


def label_tokens(label: Column) -> Column:
    """Parts of a folded domain label that are longer than a letter."""
    return F.filter(F.split(label, r"[-._]+"), lambda w: F.length(w) > 1)


def chunks(text: Column, size: int = C.CHUNK, overlap: int = C.OVERLAP) -> Column:
    """Overlapping pieces of a collapsed text, the last of which reaches its end."""
    if overlap < 0 or size <= overlap:
        raise ValueError("chunk size must be greater than the overlap, which must not be negative")
    clean, step = collapse_ws(text), size - overlap
    last = F.greatest(F.ceil((F.length(clean) - size) / F.lit(float(step))), F.lit(0)).cast("int")
    # The text goes in as a one-element array, so that it is cleaned once and not for each piece.
    cut = F.flatten(F.transform(F.array(clean), lambda t: F.transform(F.sequence(F.lit(0), last), lambda i: strip_ws(F.substr(t, i * step + 1, F.lit(size))))))
    return F.when(F.length(clean) == 0, F.array().cast("array<string>")).otherwise(F.filter(cut, lambda c: c != ""))


def primary_heading(text: Column) -> Column:
    return any_of(F.lower(collapse_ws(text)), C.PRIMARY_HEADINGS)


def matches(text: Column, pattern: str) -> Column:
    """text.rlike for a pattern of words, \\b and gaps like .{0,40}; the pattern runs only where all its words occur."""
    test = text.rlike(rx(pattern))
    for words in re.split(r"\\b|\.\{\d+,\d+\}", pattern):
        if re.fullmatch(r"[\w ]+", words):
            test = F.contains(text, F.lit(words)) & test
    return test


def value_evidence(text: Column) -> Column:
    """Struct of value_section_matches, named_value_matches and contains_value_signal."""

    def hits(clean: Column, patterns: tuple[str, ...]) -> Column:
        return sum((matches(clean, p).cast("int") for p in patterns), F.lit(0))

    def signal(found: Column) -> Column:
        sections, words = found["value_section_matches"], found["named_value_matches"]
        return F.struct(sections.alias("value_section_matches"), words.alias("named_value_matches"), ((sections >= 1) | (words >= 3)).alias("contains_value_signal"))

    # As elements of arrays, so that neither the clean text nor the counts are computed once for each use.
    counts = F.transform(F.array(F.lower(collapse_ws(text))), lambda t: F.struct(hits(t, C.VALUE_SECTIONS).alias("value_section_matches"), hits(t, C.VALUE_WORDS).alias("named_value_matches")))
    return F.get(F.transform(counts, signal), 0)


def path_features(path: Column) -> Column:
    """A path as words: no extension, noise or separators; abbreviations written out."""
    out = F.regexp_replace(clean_text_value(F.coalesce(path, F.lit(""))), r"\.[a-zA-Z0-9]+$", "")
    for word in C.PATH_NOISE:
        out = F.replace(out, F.lit(word), F.lit(" "))
    out = F.regexp_replace(out, r"[/_-]+", " ")
    for short, word in C.PATH_WORDS:
        out = F.regexp_replace(out, rx(rf"\b{short}\b"), word)
    return collapse_ws(out)


def anchor_text(text: Column) -> Column:
    return F.substring(collapse_ws(text), 1, 300)


def feature_text(anchor: Column, path: Column) -> Column:
    """Anchor (unless it says nothing) and path words."""
    clean, words = anchor_text(anchor), path_features(path)
    says = ~F.lower(clean).isin(*C.ANCHOR_NOISE)
    return F.when(says & (words != ""), F.concat(clean, F.lit(" ("), words, F.lit(")"))).when(says, clean).otherwise(words)


def export_clean(col: Column) -> Column:
    """One line without runs of spaces."""
    return strip_ws(F.regexp_replace(F.regexp_replace(col, r"[\r\n\t]+", " "), rx(r"\s{2,}"), " "))


def translation_prompt(text: Column, code: Column, language: Column) -> Column:
    return F.format_string(C.TRANSLATION_PROMPT, language, code, text)


_URL = re.compile(r"(?:https?://|www\.)\S+", re.I)
_MAIL = re.compile(r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", re.I)
_PUNCTUATION = re.compile(r"([!?.,;:])\1{2,}")
_MARKS = {"︎", "️", "⃣"}
MAX_CLEAN = 12_000


def _clean_one(text: str) -> str:
    spelled = unicodedata.normalize("NFKC", html.unescape(text))

    def keep(c: str) -> str:
        kind = unicodedata.category(c)
        if c in _MARKS:
            return ""
        return " " if c.isspace() or c == "�" or kind[0] == "C" or kind in ("So", "Sk") else c

    plain = _MAIL.sub(" ", _URL.sub(" ", "".join(map(keep, spelled))))
    return " ".join(_PUNCTUATION.sub(r"\1", plain).split())[:MAX_CLEAN]


@F.pandas_udf(T.StringType())
def clean_text(col: pd.Series) -> pd.Series:
    """Text without markup entities, symbols, links, addresses and repeated punctuation."""
    return col.map(_clean_one, na_action="ignore")


def text_metrics(text: Column) -> Column:
    """Struct of characters, letters, letter_ratio, replacement_ratio and passes (the quality gate)."""
    n = F.length(text)
    letters = n - F.length(F.regexp_replace(text, r"\p{L}", ""))
    broken = n - F.length(F.replace(text, F.lit("�"), F.lit("")))
    ratio, lost = F.try_divide(letters, n), F.try_divide(broken, n)
    passes = F.coalesce((n >= 120) & (letters >= 80) & (ratio >= 0.30) & (lost <= 0.002), F.lit(False))
    return F.struct(n.alias("characters"), letters.alias("letters"), ratio.alias("letter_ratio"), lost.alias("replacement_ratio"), passes.alias("passes"))
