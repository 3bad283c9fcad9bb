"""A language identifier of the core: word frequencies of a labelled reference.

Every word has points per language, a thousand times the logarithm of its smoothed frequency; a text's language has the most points.
Any other identifier can stand in its place: what the engine needs is a function of a text column that adds ``lang`` and ``score``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the code of text without words.
NO_LANGUAGE = "zxx_Latn"
_LETTERS = r"\p{L}+"


@dataclass(frozen=True)
class WordModel:
    languages: tuple[str, ...]
    points: dict[str, tuple[int, ...]]


def fit_words(reference: DataFrame, lang: str = "lang", text: str = "text") -> WordModel:
    """Count the words of a labelled reference (a table of fixed size; its vocabulary reaches the driver)."""
    rows = reference.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(F.regexp_extract_all(F.lower(text), F.lit(f"({_LETTERS})"))).alias("word"))
    counts = {(r.lang, r.word): r.n for r in rows.groupBy("lang", "word").agg(F.count("*").alias("n")).toLocalIterator()}
    languages = tuple(sorted({a for a, _ in counts}))
    words = {w for _, w in counts}
    total = {a: sum(n for (b, _), n in counts.items() if b == a) for a in languages}
    point = lambda a, w: round(1000 * math.log((counts.get((a, w), 0) + 1) / (total[a] + len(words))))
    return WordModel(languages, {w: tuple(point(a, w) for a in languages) for w in words})


def predict(df: DataFrame, model: WordModel, text_col: str = "text") -> DataFrame:
    """Adds ``lang, score, lang_2, score_2, gap``: the two likeliest languages, their confidence and its difference, in four digits.

    Words that the reference doesn't have say nothing; a text without any known word is ``zxx_Latn`` with score 1; null stays null.  The whole text counts.
    Confidence is the softmax of points over a thousand times the root of the number of known words.  Columns of the result's names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, lang_2 string, score_2 double, gap double")
    def top(s: pd.Series) -> pd.DataFrame:
        import regex

        m, find = shared.value, regex.compile(_LETTERS).findall
        out = []
        for t in s:
            known = [p for w in find(t.lower()) if (p := m.points.get(w))] if t is not None else []
            if not known:
                out.append((None,) * 5 if t is None else (NO_LANGUAGE, 1.0, None, 0.0, 1.0))
                continue
            sums = np.array(known, np.int64).sum(0)
            order = sorted(range(len(sums)), key=lambda i: (-sums[i], i))
            p = np.exp((sums - sums[order[0]]) / (1000 * math.sqrt(len(known))))
            p = p / p.sum()
            a, b = order[0], order[1] if len(order) > 1 else None
            one, two = round(float(p[a]), 4), round(float(p[b]), 4) if b is not None else 0.0
            out.append((m.languages[a], one, None if b is None else m.languages[b], two, round(one - two, 4)))
        return pd.DataFrame(out, columns=["lang", "score", "lang_2", "score_2", "gap"])

    rest = [c for c in df.columns if c not in ("lang", "score", "lang_2", "score_2", "gap")]
    return df.select(*rest, top(F.col(text_col)).alias("_l")).select(*rest, "_l.*")


def with_sections(df: DataFrame, model: WordModel, id_col: str, text_col: str, target: str = "kin_Latn", min_confidence: float = 0.80, min_whole: int = 500) -> DataFrame:
    """Adds ``lang, score, sections``: a text of at least ``min_whole`` characters that isn't surely in ``target`` is tried again by its sections in ``target``.

    ``sections`` is null where the whole text passes, is too short to try, or has too little in ``target``.  ``id_col`` must be unique.
    """
    from .sections import language_sections

    said = predict(df, model, text_col).drop("lang_2", "score_2", "gap")
    sure = (F.col("lang") == target) & (F.col("score") >= min_confidence)
    again = said.where(~F.coalesce(sure, F.lit(False)) & (F.length(text_col) >= min_whole))
    parts = language_sections(again, id_col, text_col, lambda b: predict(b, model, "block"), target, min_confidence=min_confidence)
    return said.drop("sections").join(parts.select(F.col(id_col), F.col("text").alias("sections")), id_col, "left")
