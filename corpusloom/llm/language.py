"""Language of documents and of the segments of mixed ones (problem 2).

Sparse multinomial logistic regression on tf-idf weighted character n-grams (inside words, with word ends marked), trained on a
labelled reference with follow-the-regularised-leader and elastic-net penalties, then calibrated with a temperature on held-out
reference texts.  The features of a text are the sum over its words, so a word is scored once per worker and a text costs one lookup
per word.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import lang_label
from .words import _INVISIBLE, hash_sample, pieces

#: Fixed value: the code of text without words.
NO_LANGUAGE = "zxx_Latn"
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\n")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
WORD_CACHE = 1_000_000


def words_of(text: str) -> list[str]:
    """Words in lower case and line ends."""
    t = text.lower()
    return _TOKEN.findall(t if t.isascii() else _INVISIBLE.sub("", t).replace("’", "'"))


def grams(word: str, most: int) -> list[str]:
    """Character n-grams of one word with its ends marked, n up to ``most``, and the whole word."""
    w = f"_{word}_"
    return [w[i : i + n] for n in range(1, most + 1) for i in range(len(w) - n + 1) if w[i : i + n] != "_"] + [w + "_"]


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


@dataclass
class LanguageModel:
    """Weights of the n-grams that the penalties left, their idf, and the calibration temperature."""

    languages: list[str]
    index: dict[str, int]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    most: int = 4

    def word(self, word: str) -> np.ndarray:
        """Summed scores per language, squared length and count (1) of one word's features."""
        at = np.array([i for g in grams(word, self.most) if (i := self.index.get(g)) is not None], np.int64)
        out = np.zeros(len(self.languages) + 2)
        if len(at):
            out[:-2] = self.idf[at] @ self.weights[at]
            at, n = np.unique(at, return_counts=True)
            out[-2] = ((n * self.idf[at]) ** 2).sum()
        out[-1] = 1
        return out

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """Calibrated probabilities from rows of summed word scores."""
        z = sums[:, :-2] / np.sqrt(np.maximum(sums[:, -2:-1], 1e-12)) + self.bias
        z = z / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def lines(self, texts: list, cache: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, line_no, sums)`` of all lines of ``texts`` that have a token; ``cache`` is the worker's memory of words."""
        ids, lens = [], []
        for t in texts:
            w = words_of(t) if t else ()
            ids.extend([cache[x] for x in w])
            lens.append(len(w))
        if not ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(self.languages) + 2))
        ids, lens = np.array(ids, np.int64), np.array(lens, np.int64)
        row = np.repeat(np.arange(len(texts)), lens)
        end = ids == 0
        before = np.cumsum(end) - end
        first = np.cumsum(np.r_[0, lens[:-1]])
        line = before - before[np.minimum(first, len(ids) - 1)][row]
        start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (line[1:] != line[:-1])])
        return row[start], line[start], np.add.reduceat(cache.table()[ids], start, axis=0)


class WordScores(dict):
    """Word -> place in a table of word scores; place 0 is the line end."""

    def __init__(self, model: LanguageModel):
        super().__init__({"\n": 0})
        self.model = model
        self.rows = [np.zeros(len(model.languages) + 2)]
        self.array = np.zeros((0, len(model.languages) + 2))

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.rows)
        self.rows.append(self.model.word(word))
        return n

    def table(self) -> np.ndarray:
        if len(self.array) < len(self.rows):
            self.array = np.vstack([self.array, *self.rows[len(self.array) :]])
        return self.array


def _ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_features: int, n_classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Follow-the-regularised-leader with per-coordinate steps; ``x`` holds (features, values) per example."""
    z, n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))

    def weights(i):
        zi, ni = z[i], n[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for e in order.permutation(len(x)):
            i, v = x[e]
            w = weights(i)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[e]] -= 1
            g = v[:, None] * p
            n_new = n[i] + g * g
            z[i] += g - (np.sqrt(n_new) - np.sqrt(n[i])) / alpha * w
            n[i] = n_new
    return weights(np.arange(n_features))


def fit(
    reference: DataFrame | list[tuple[str, str]], more: list[tuple[str, str]] = (), most: int = 4, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, held_out: int = 5
) -> LanguageModel:
    """Train on ``reference`` (``lang, text``; a small table of fixed size, read whole) and further labelled texts.

    Examples are the texts, their sentences, and both without accents; of ``more`` the sentences, every other one without accents.
    Every ``held_out``-th reference text calibrates the temperature only.
    """
    rows = reference if isinstance(reference, list) else [(r.lang, r.text) for r in reference.orderBy(*reference.columns).select("lang", "text").collect()]
    rows = [(a, t) for a, t in rows if a and t and a != NO_LANGUAGE]
    languages = sorted({a for a, _ in rows})
    if not languages:
        raise ValueError("the reference has no labelled text")
    seen: Counter = Counter()
    train, held = [], []
    per = Counter()
    for lang, text in rows:
        per[lang] += 1
        variants = {v for t in (text, *(s for s in _SENTENCE.split(text) if s.strip())) for v in (t, _plain(t))}
        (held if per[lang] % held_out == 0 and per[lang] > 1 else train).extend((lang, v) for v in sorted(variants))
    for n, (lang, text) in enumerate((a, s) for a, t in more if a in languages for s in _SENTENCE.split(t) if s.strip()):
        train.append((lang, _plain(text) if n % 2 else text))
    features = []
    for lang, text in train:
        c = Counter(g for w in words_of(text) if w != "\n" for g in grams(w, most))
        seen.update(c.keys())
        features.append(c)
    index = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n >= 2))}
    idf = np.zeros(len(index) + 1)
    idf[:-1] = [np.log((1 + len(train)) / (1 + seen[g])) + 1 for g in index]
    idf[-1] = 1.0  # the bias

    def row(c: Counter) -> tuple[np.ndarray, np.ndarray]:
        at = np.array([index[g] for g in c if g in index], np.int64)
        v = np.array([n for g, n in c.items() if g in index], float) * idf[at]
        return np.r_[at, len(index)], np.r_[v / max(np.linalg.norm(v), 1e-9), 1.0]

    y = np.array([languages.index(a) for a, _ in train])
    w = _ftrl([row(c) for c in features], y, len(index) + 1, len(languages), epochs, alpha, beta, l1, l2)
    kept = np.flatnonzero(np.abs(w[:-1]).sum(1) > 0)
    names = list(index)
    model = LanguageModel(languages, {names[i]: j for j, i in enumerate(kept)}, idf[kept], w[kept], w[-1], 1.0, most)
    if held:
        none = np.zeros(len(languages) + 2)
        sums = np.array([sum((model.word(x) for x in words_of(t) if x != "\n"), none) for _, t in held])
        truth = np.array([languages.index(a) for a, _ in held])

        sure = (len(truth) + 1) / (len(truth) + 2)  # smoothed targets, so that a faultless hold-out doesn't make the model certain
        target = np.full((len(truth), len(languages)), (1 - sure) / max(1, len(languages) - 1))
        target[np.arange(len(truth)), truth] = sure

        def loss(temperature: float) -> float:
            model.temperature = temperature
            return float(-(target * np.log(np.maximum(model.probabilities(sums), 1e-300))).sum(1).mean())

        model.temperature = min(np.geomspace(0.05, 5, 60), key=loss)
    return model


def fit_with_records(reference: DataFrame, records: DataFrame, most_records: int = 1500, least_confidence: float = 0.999) -> LanguageModel:
    """A model that also knows a bounded sample of labelled records.

    The sample is the ``most_records`` rows of ``records`` (``doc_id, lang, text``) with the least hash of their id; of those
    the ones train whose label a first model, fitted to the reference alone, confirms with ``least_confidence`` and finds unmixed.
    """
    first = fit(reference)
    sample = hash_sample(records.select("doc_id", lang_label(F.col("lang")).alias("label"), "text"), "doc_id", most_records).select("label", "text").collect()
    sample = [r for r in sample if r.label in first.languages and r.text]
    said = _verdicts(first, [r.text for r in sample], WordScores(first), 0.2, 2.0)
    more = [(r.label, r.text) for r, v in zip(sample, said) if v and v[0] == r.label and v[1] >= least_confidence and not v[2]]
    return fit(reference, more) if more else first


def _verdicts(model: LanguageModel, texts: list, cache: WordScores, min_share: float, sure: float) -> list:
    """Per text ``(lang, confidence, mixed, lines)``; null for a null or blank text.  ``lines`` is null unless the text is mixed."""
    row, line, sums = model.lines(texts, cache)
    k = len(model.languages)
    total = np.zeros((len(texts), k + 2))
    np.add.at(total, row, sums)
    whole = model.probabilities(total)
    top = whole.argmax(1)
    each = model.probabilities(sums)
    # a line leaves its document's language only where it is sure to
    best = each.argmax(1)
    own = each[np.arange(len(row)), top[row]] if len(row) else np.zeros(0)
    best = np.where(each[np.arange(len(row)), best] >= sure * np.maximum(own, 1e-12), best, top[row])
    held = np.zeros((len(texts), k))
    np.add.at(held, (row, best), sums[:, -1])
    mixed = (held >= min_share * np.maximum(total[:, -1:], 1)).sum(1) >= 2
    out = []
    for i, t in enumerate(texts):
        if not t or not t.strip():
            out.append(None)
        elif not total[i, -1]:
            out.append((NO_LANGUAGE, 1.0, False, None))
        elif not mixed[i]:
            out.append((model.languages[top[i]], float(whole[i, top[i]]), False, None))
        else:
            at = np.flatnonzero(row == i) if len(texts) < 50 else np.arange(np.searchsorted(row, i), np.searchsorted(row, i, "right"))
            said = {int(line[j]): (best[j], each[j, best[j]]) for j in at if sums[j, -1]}
            lines = []
            for n, s in enumerate(t.split("\n")):
                if s.strip():
                    lang, p = said.get(n, (None, 1.0))
                    lines.append((n, NO_LANGUAGE if lang is None else model.languages[lang], float(p)))
            main = held[i].argmax()
            out.append((model.languages[main], float(whole[i, main]), True, lines))
    return out


_RESULT = "lang string, confidence double, mixed boolean, lines array<struct<line_no: bigint, lang: string, confidence: double>>"
_LINES = pa.list_(pa.struct([("line_no", pa.int64()), ("lang", pa.string()), ("confidence", pa.float64())]))


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text", min_share: float = 0.2, sure: float = 1.5) -> DataFrame:
    """``keep`` columns and ``lang, confidence, mixed, lines``, one row per row of ``docs``.

    ``confidence`` is the calibrated probability.  A text is mixed if at least two languages each hold ``min_share`` of its words, counted
    by lines; ``lines`` then has ``(line_no, lang, confidence)`` of every non-blank line, numbered from 0 over ``split(text, '\\n')``.
    A line counts for another language than its document's if it is ``sure`` times as probable.  Text without words is ``zxx_Latn``
    with confidence 1; null and blank texts get nulls; texts are read whole.  ``keep`` must not be named like the result's columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = WordScores(m)
        for b in batches:
            found: list = []
            for part in pieces(b.column("_text").to_pylist()):
                if len(cache) > WORD_CACHE:
                    cache = WordScores(m)
                found.extend(_verdicts(m, part, cache, min_share, sure))
            rest = [c for c in b.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in rest),
                    pa.array([v and v[0] for v in found], pa.string()),
                    pa.array([v and v[1] for v in found], pa.float64()),
                    pa.array([v and v[2] for v in found], pa.bool_()),
                    pa.array([v and v[3] and [dict(zip(("line_no", "lang", "confidence"), x)) for x in v[3]] for v in found], _LINES),
                ],
                names=[*rest, "lang", "confidence", "mixed", "lines"],
            )

    cols = docs.select(*keep, F.col(text_col).alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields if f.name != "_text")
    return cols.mapInArrow(run, f"{ddl}, {_RESULT}")


def record_languages(records: DataFrame, model: LanguageModel) -> DataFrame:
    """Each record and each line of a mixed one with its language.

    ``records`` needs ``doc_id, text, lang, lid_score, fetched_at``.  Result: ``doc_id, line_no`` (-1 for the record), ``lang,
    confidence, lid_score, label_state, mixed``; ``label_state`` compares the record's label: ``ok``, ``missing`` (null, blank, und,
    unknown) or ``wrong``.  Null ids and null or blank texts have no rows; of several deliveries the latest counts.
    """
    rows = records.where(F.col("doc_id").isNotNull()).select("doc_id", "fetched_at", "lid_score", lang_label(F.col("lang")).alias("label"), "text")
    found = identify(rows, model, ["doc_id", "fetched_at", "lid_score", "label"]).where(F.col("lang").isNotNull())
    r = F.struct("fetched_at", "label", "lang", "mixed", "confidence", "lid_score", "lines")
    one = found.groupBy("doc_id").agg(F.max_by(r, F.struct("fetched_at", "label", "lang")).alias("r")).select("doc_id", "r.*")
    state = F.when(F.col("label").isNull(), "missing").when(F.col("label") == F.col("lang"), "ok").otherwise("wrong")
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("line_no"), "lang", "confidence"))
    each = one.withColumn("label_state", state).withColumn("x", F.explode(F.concat(whole, F.coalesce("lines", F.array()))))
    return each.select("doc_id", "x.line_no", "x.lang", "x.confidence", "lid_score", "label_state", "mixed")
