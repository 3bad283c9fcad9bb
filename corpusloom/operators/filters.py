"""Ordered quality filters with stable reject reasons, and the decision to keep a record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class FilterProfile:
    """Thresholds; the defaults are the general profile."""

    languages: tuple[str, ...] = ("kin_Latn", "rw")
    min_confidence: float = 0.80
    min_chars: int = 200
    max_chars: int = 100_000
    min_words: int = 30
    max_url_ratio: float = 0.20
    max_repeated_lines: float = 0.30
    min_alpha_ratio: float = 0.70
    max_ngram_2: float = 0.30
    max_ngram_3: float = 0.25
    max_ngram_4: float = 0.20
    max_non_latin: float = 0.10


#: Profiles of the other pipelines.
BOOKS = FilterProfile(min_confidence=0.70, max_chars=1_000_000, max_ngram_2=0.50, max_ngram_3=0.40, max_ngram_4=0.35)
INSTITUTIONS = FilterProfile(min_confidence=0.70, max_chars=500_000, max_ngram_2=0.50, max_ngram_3=0.40, max_ngram_4=0.35)
TARGETED = FilterProfile(min_confidence=0.85)

FilterBuilder = Callable[[Column, FilterProfile], Column]
_FILTERS: dict[str, FilterBuilder] = {}


def register_filter(name: str, rejects: FilterBuilder) -> None:
    """Add a filter after those there are: ``rejects(text, profile)`` is true where the text fails it."""
    _FILTERS[name] = rejects


register_filter("min_chars", lambda t, p: F.length(t) < p.min_chars)
register_filter("max_chars", lambda t, p: F.length(t) > p.max_chars)
register_filter("min_words", lambda t, p: T.word_count(t) < p.min_words)
register_filter("url_ratio", lambda t, p: T.url_ratio(t) > p.max_url_ratio)
register_filter("alpha_ratio", lambda t, p: T.alpha_ratio(t) < p.min_alpha_ratio)
register_filter("repetition", lambda t, p: T.repeated_line_ratio(t) > p.max_repeated_lines)


def _ngrams_repeat(t: Column, p: FilterProfile) -> Column:
    return _too_repetitive(T.ngram_repetitions(t), p)


def _too_repetitive(r: Column, p: FilterProfile) -> Column:
    return (r["rep_2"] > p.max_ngram_2) | (r["rep_3"] > p.max_ngram_3) | (r["rep_4"] > p.max_ngram_4)


register_filter("word_ngram_repetition", _ngrams_repeat)
register_filter("mixed_script", lambda t, p: T.non_latin_ratio(t) > p.max_non_latin)


def reject_reasons(text: Column, profile: FilterProfile = FilterProfile()) -> Column:
    """All failed filters of a text in their order, as ``reject.filter.<name>``; a null text fails ``min_chars`` and ``alpha_ratio``'s kin as an empty one does."""
    t = F.coalesce(text, F.lit(""))
    return F.array_compact(F.array(*(F.when(f(t, profile), f"reject.filter.{name}") for name, f in _FILTERS.items())))


def required_confidence(chars: Column) -> Column:
    """Shorter texts need a surer language label."""
    return F.when(chars < 300, 0.95).when(chars < 500, 0.90).when(chars < 1000, 0.85).otherwise(0.70)


def decide_keep(df: DataFrame, profile: FilterProfile = FilterProfile(), text_col: str = "text", lang_col: str = "lang", score_col: str = "lid_score") -> DataFrame:
    """Adds ``keep, reason, normalized_text``: too short, wrong language, language not sure enough, else the first failed filter, else ``keep``.

    Texts are normalized first and everything is judged by the normalized text, which kept rows carry on (others null).  The language comes from
    whatever identifier filled ``lang_col`` and ``score_col``.  Null text is too short; a null label is another language, a null score 0.  Columns
    of the three names are replaced.

    One Arrow pass normalizes all texts and counts n-grams only where length, language and the least confidence leave the row undecided.
    """
    right = F.coalesce(F.col(lang_col).isin(*profile.languages), F.lit(False))
    score = F.coalesce(F.col(score_col), F.lit(0.0))
    out = df.withColumn("_t", T.normalized_with_repetition(F.coalesce(F.col(text_col), F.lit("")), right & (score >= profile.min_confidence), F.lit(profile.min_chars)))
    t = F.col("_t.text")
    reason = F.when(F.length(t) < profile.min_chars, "reject.too_short").when(~right, "reject.lid.not_rw")
    reason = reason.when(score < F.greatest(F.lit(profile.min_confidence), required_confidence(F.length(t))), "reject.lid.low_confidence")
    for name, rejects in _FILTERS.items():
        failed = _too_repetitive(F.col("_t"), profile) if rejects is _ngrams_repeat else rejects(t, profile)
        reason = reason.when(failed, f"reject.filter.{name}")
    out = out.withColumn("reason", reason.otherwise("keep")).withColumn("keep", F.col("reason") == "keep")
    return out.withColumn("normalized_text", F.when(F.col("keep"), t)).drop("_t")


def index_language(languages: Column, url: Column, lang: str, excluded_part: str = ".ru/") -> Column:
    """The index row's first content language is ``lang`` and its URL hasn't the excluded part; every part of it reaches the scan."""
    return languages.isNotNull() & ((languages == lang) | F.startswith(languages, F.lit(lang + ","))) & ~F.contains(url, F.lit(excluded_part))


def instruction_reason(prompt: Column, response: Column, min_prompt: int = 10, min_response: int = 10, max_prompt: int = 4000, max_response: int = 8000) -> Column:
    """Why an example is invalid, empty if it isn't; minimal lengths count stripped texts, maximal ones don't."""
    p, r = T.strip(F.coalesce(prompt, F.lit(""))), T.strip(F.coalesce(response, F.lit("")))
    return (
        F.when(p == "", "reject.empty_prompt")
        .when(r == "", "reject.empty_response")
        .when((F.length(p) < min_prompt) | (F.length(r) < min_response), "reject.too_short")
        .when((F.length(prompt) > max_prompt) | (F.length(response) > max_response), "reject.too_long")
        .when(T.excessive_repeats(response), "reject.low_quality")
        .otherwise("")
    )


def instruction_language_reason(lang: Column, score: Column) -> Column:
    """Any label but the target's is rejected; an unsure target label is not."""
    return F.when(lang.isin("kin_Latn", "rw"), "").otherwise("reject.not_rw")


def pair_reason(rw: Column, en: Column, rw_lang: Column, rw_score: Column, en_lang: Column, en_score: Column, min_chars: int = 200, min_rw: float = 0.7, min_en: float = 0.7) -> Column:
    """First failed test of a pair of pages in two languages."""
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    return (
        F.when(none(rw) | none(en), "reject.extract_failed")
        .when((F.length(rw) < min_chars) | (F.length(en) < min_chars), "reject.too_short")
        .when(~F.coalesce(rw_lang.isin("kin_Latn", "rw"), F.lit(False)), "reject.lid.rw")
        .when(F.coalesce(rw_score, F.lit(0.0)) < min_rw, "reject.lid.rw_low")
        .when(~F.coalesce(en_lang.isin("eng_Latn", "en"), F.lit(False)), "reject.lid.en")
        .when(F.coalesce(en_score, F.lit(0.0)) < min_en, "reject.lid.en_low")
        .otherwise("ok")
    )


def garbled(lang: Column, score: Column) -> Column:
    """Text of a scan that needs recognition: no language, or hardly any confidence in another one."""
    return (lang == "zxx_Latn") | ((score < 0.3) & ~lang.isin("kin_Latn", "rw"))
