"""Text measures and clean-up as column expressions; only what Catalyst has no expression for is an Arrow UDF."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

#: Everything that counts as white space between words.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
#: Fixed value: characters per token of the rough estimate.
CHARS_PER_TOKEN = 2.55

#: Characters and rules that :func:`normalize_text` drops.
_ZERO_WIDTH = re.compile("[\u200b\u200c\u200d\ufeff]")
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
_RULES = re.compile(r"(\n[ \t]*[-=*_]{3,}[ \t]*){3,}")

_REPETITION = StructType().add("rep_2", DoubleType()).add("rep_3", DoubleType()).add("rep_4", DoubleType())


def _normalized(t: str) -> str:
    if not t.isascii():
        t = _ZERO_WIDTH.sub("", unicodedata.normalize("NFKC", t))
    t = _CONTROL.sub("", t)
    t = html.unescape(t) if "&" in t else t
    t = t.replace("\r\n", "\n").replace("\r", "\n")
    t = re.sub(r"([!?])\1+", r"\1", t)
    t = _RULES.sub("\n\n", t)
    t = re.sub(r"\n{3,}", "\n\n", t)
    return re.sub(r"[^\S\n]+", " ", t).strip()


@F.pandas_udf(StringType())
def normalize_text(s: pd.Series) -> pd.Series:
    """Canonical text: NFKC, no invisible or control characters, references resolved, line ends, repeated ``!?``, rules of signs, blank
    lines and spaces collapsed, edges stripped.  Null stays null."""
    return s.map(_normalized, na_action="ignore")


def collapse(text: Column) -> Column:
    """The part of :func:`normalize_text` that needs no Unicode tables, without leaving the JVM."""
    t = F.regexp_replace(text, "[\\x{200b}\\x{200c}\\x{200d}\\x{feff}]", "")
    t = F.regexp_replace(t, "[\\x{0}-\\x{8}\\x{b}\\x{c}\\x{e}-\\x{1f}\\x{7f}-\\x{9f}]", "")
    t = F.regexp_replace(t, "\r\n?", "\n")
    t = F.regexp_replace(t, r"([!?])\1+", "$1")
    t = F.regexp_replace(t, r"(\n[ \t]*[-=*_]{3,}[ \t]*){3,}", "\n\n")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, r"[\t\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000} ]+", " ")
    return strip(t)


def strip(text: Column) -> Column:
    """Without white space at the edges."""
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once; an expression that a lambda mentions would be computed again for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def url_ratio(text: Column) -> Column:
    """Share of characters in URLs; 0 for empty text."""
    found = F.regexp_extract_all(text, F.lit(r"(https?://\S+)"), F.lit(1))
    total = F.aggregate(found, F.lit(0), lambda a, u: a + F.length(u))
    return F.when(F.length(text) > 0, total / F.length(text)).otherwise(F.when(text.isNotNull(), F.lit(0.0)))


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}+", ""))


def alpha_ratio(text: Column) -> Column:
    """Share of letters; 0 for empty text."""
    return F.when(F.length(text) > 0, letter_count(text) / F.length(text)).otherwise(F.when(text.isNotNull(), F.lit(0.0)))


def non_latin_ratio(text: Column) -> Column:
    """Share of letters that aren't Latin; 0 without letters."""
    letters = F.regexp_replace(text, r"\P{L}+", "")
    other = F.length(F.regexp_replace(letters, r"\p{IsLatin}+", ""))
    return F.when(F.length(letters) > 0, other / F.length(letters)).otherwise(F.when(text.isNotNull(), F.lit(0.0)))


def _runs(items: Column) -> Column:
    """Over the sorted items: the longest run, the slots in runs of two or more, and the number of runs."""
    start = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("again"), F.lit(0).alias("kinds"))

    def step(a, x):
        run = F.when(a["prev"] == x, a["run"] + 1).otherwise(1)
        more = F.when(a["prev"] == x, F.when(a["run"] == 1, 2).otherwise(1)).otherwise(0)
        return F.struct(x.alias("prev"), run.alias("run"), F.greatest(a["best"], run).alias("best"), (a["again"] + more).alias("again"), (a["kinds"] + F.when(a["prev"] == x, 0).otherwise(1)).alias("kinds"))

    return F.aggregate(F.array_sort(items), start, step)


def lines(text: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def repeated_line_ratio(text: Column) -> Column:
    """Share of the commonest line; 0 for up to three lines."""
    return let(lines(text), lambda l: F.when(F.size(l) > 3, _runs(l)["best"] / F.size(l)).otherwise(F.when(l.isNotNull(), F.lit(0.0))))


def ngram_repetition(text: Column, n: int) -> Column:
    """Share of the word n-grams that occur more than once; 0 for fewer than ten words."""

    def of(w):
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(w, i, n)))
        return F.when(F.size(w) >= 10, _runs(grams)["again"] / (F.size(w) - (n - 1))).otherwise(F.when(w.isNotNull(), F.lit(0.0)))

    return let(words(text), of)


def _ngram_ratio(w: list[str], n: int) -> float:
    grams = Counter(zip(*(w[i:] for i in range(n))))
    return sum(c for c in grams.values() if c > 1) / (len(w) - n + 1)


@F.pandas_udf(_REPETITION)
def ngram_repetitions(s: pd.Series) -> pd.DataFrame:
    """:func:`ngram_repetition` for 2, 3 and 4 words in one pass.

    Sorting and folding arrays of strings in Catalyst's lambdas takes some thirty times as long as counting them here, so the filters use this one.
    """
    rows = []
    for t in s:
        w = t.split() if t is not None else []
        rows.append((None,) * 3 if t is None else (0.0,) * 3 if len(w) < 10 else tuple(_ngram_ratio(w, n) for n in (2, 3, 4)))
    return pd.DataFrame(rows, columns=["rep_2", "rep_3", "rep_4"], dtype=float)


@F.pandas_udf(StructType().add("text", StringType()).add("rep_2", DoubleType()).add("rep_3", DoubleType()).add("rep_4", DoubleType()))
def normalized_with_repetition(s: pd.Series, undecided: pd.Series, least: pd.Series) -> pd.DataFrame:
    """:func:`normalize_text`, and :func:`ngram_repetitions` of the result where the row is ``undecided`` and has ``least`` characters, else null.

    One trip to Python for both, and the costly half of it only for the rows that need it.
    """
    rows = []
    for t, open_, n in zip(s, undecided, least):
        t = None if t is None else _normalized(t)
        if t is None or not open_ or len(t) < n:
            rows.append((t, None, None, None))
            continue
        w = t.split()
        rows.append((t, 0.0, 0.0, 0.0) if len(w) < 10 else (t, *(_ngram_ratio(w, n) for n in (2, 3, 4))))
    return pd.DataFrame(rows, columns=["text", "rep_2", "rep_3", "rep_4"]).astype({c: float for c in ("rep_2", "rep_3", "rep_4")})


def excessive_repeats(text: Column, most: float = 0.5) -> Column:
    """Whether more than ``most`` of the lines of ten characters or more repeat another; needs three such lines."""
    long = F.filter(F.split(text, "\n"), lambda x: F.length(x) >= 10)
    return (F.size(long) >= 3) & (1 - F.size(F.array_distinct(long)) / F.size(long) > most)


def word_shingles(text: Column, k: int = 5) -> Column:
    """Distinct runs of k lower-case words; one shingle for a shorter text, none for an empty one."""

    def of(w):
        long = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.concat_ws(" ", F.slice(w, i, k)))
        return F.array_distinct(F.when(F.size(w) >= k, long).when(F.size(w) > 0, F.array(F.concat_ws(" ", w))).otherwise(F.array().cast("array<string>")))

    return let(words(F.lower(text)), of)


def token_estimate(text: Column) -> Column:
    """Rough tokens from characters."""
    return (F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("long")


def first_text(*fields: Column) -> Column:
    """The first field that isn't blank."""
    return F.coalesce(*(F.when(strip(f) != "", f) for f in fields))


def estimated_tokens_of(*fields: Column) -> Column:
    """Rough tokens of all text fields together."""
    total = sum((F.coalesce(F.length(f), F.lit(0)) for f in fields), F.lit(0))
    return (total / F.lit(CHARS_PER_TOKEN)).cast("long")


#: Whole or leading lines that extraction leaves of a site's frame.
FRAME_LINES = (
    r"Sign in to your account$", r"Log ?in$", r"Sign ?up$", r"Subscribe( now)?$", r"Share this", r"Cookie", r"Accept (all )?cookies", r"Privacy policy$",
    r"Terms (of|and) ", r"All rights reserved\.?$", r"Copyright ©", r"Powered by ",
)


def without_frame_lines(text: Column) -> Column:
    """Without the lines of :data:`FRAME_LINES`."""
    kept = F.filter(F.split(text, "\n"), lambda l: ~F.coalesce(strip(l).rlike("(?i)^(?:" + "|".join(FRAME_LINES) + ")"), F.lit(False)))
    return strip(F.array_join(kept, "\n"))
