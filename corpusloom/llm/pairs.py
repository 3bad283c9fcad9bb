"""Defects of prompt and response pairs (problem 5).

A response is cut into clauses; a linear-chain conditional random field tags each as answer, refusal, echo, foreign, unfinished,
foreign and unfinished, or nothing (a placeholder).  The pair's defects follow from how much of the response each tag covers.  What the field sees of a clause comes
from three small models fitted with it to a bounded sample of the rows: words of refusals (responses to ``safety`` prompts), the
language of the clause against the wanted one, and whether a sentence may end where the clause ends (learned from sentences cut short).
The field itself is trained on responses of the sample composed into every defect, so its labels are known exactly.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import LanguageModel, WordScores, words_of
from .tokens import lang_label
from .words import _INVISIBLE, hash_sample, pieces

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished", "foreign_unfinished", "nothing")
A, R, E, G, U, GU, N = range(7)
N_FEATURES = 19

#: Most words remembered per worker; beyond it the memory starts anew.
WORD_CACHE = 1_000_000

#: Responses that stand for none.
PLACEHOLDERS = {"", "null", "none", "nil", "nan", "n/a", "na", "tbd", "todo", "undefined", "empty"}
#: How the prompts name a language that a translation is wanted in.
LANGUAGE_NAMES = {
    "kin_Latn": ("kinyarwanda", "ikinyarwanda", "rwandais"),
    "eng_Latn": ("english", "icyongereza", "cyongereza", "anglais", "kiingereza", "icongereza"),
    "fra_Latn": ("french", "igifaransa", "gifaransa", "français", "francais", "kifaransa"),
    "swh_Latn": ("swahili", "igiswayire", "giswayire", "kiswahili", "igiswahili", "giswahili"),
    "run_Latn": ("kirundi", "ikirundi"),
}
_NAMED = {n: lang for lang, names in LANGUAGE_NAMES.items() for n in names}
#: The verbs of the prompts that want a translation.
TRANSLATE = re.compile(r"\b(?:translate|traduisez|traduire|hindura|tafsiri|hindukiza)\b")

_TAG = re.compile(r"<[^<>]*>")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_BULLET = re.compile(r"^\s*(?:\d{1,3}[.)]|[-*•–])(?:\s+|$)")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'»”)]*[,;]?\s+")
_PROMPT_SENTENCE = re.compile(r"(?<=[.!?…:])\s+|\n")
_HANGING = re.compile(r"[,;:(\-–—/]\s*$")
_TAIL = re.compile(r"(?:\(\d+\)|,?\s*\d+\s*%)\s*$")
_CLOSED = re.compile(r"[.!?…][\"'»”)\]]*\s*$")
_HASH_BITS = 18


def plain(text: str | None) -> str:
    """Without markup, character references and invisible characters."""
    if not text:
        return ""
    t = html.unescape(text) if "&" in text else text
    t = _TAG.sub(" ", t) if "<" in t else t
    return _INVISIBLE.sub("", t).strip()


def is_placeholder(text: str) -> bool:
    return text.strip(" \t\n[](){}<>\"'.").lower() in PLACEHOLDERS


def is_empty(text: str) -> bool:
    """Nothing but blanks, signs or a placeholder; ``text`` is :func:`plain`."""
    return not _WORD.search(text) or is_placeholder(text)


@dataclass
class Clause:
    text: str
    words: list[str]
    bullet: bool
    quoted: bool


def clauses(text: str) -> list[Clause]:
    """Lines, list items and sentences of a response in order; whether each stands in a quotation."""
    out, quoted = [], False
    quotes = any(c in text for c in "«“»”")
    for line in text.split("\n"):
        if not line.strip():
            continue
        m = _BULLET.match(line)
        rest = line[m.end() :] if m else line
        for part in _SENTENCE.split(rest) if rest.strip() else [""]:
            part = part.strip()
            if part or m:
                out.append(Clause(part, _WORD.findall(part.lower()), bool(m), quotes and (quoted or part[:1] in ("«", "“"))))
            if quotes:
                opens, shuts = max(part.rfind("«"), part.rfind("“")), max(part.rfind("»"), part.rfind("”"))
                quoted = quoted if opens == shuts == -1 else opens > shuts
    return out


def _named(text: str) -> str | None:
    return next((_NAMED[w] for w in re.findall(r"[^\W\d_]+", text) if w in _NAMED), None)


def wanted_language(prompt: str, task: str | None, found: str) -> str:
    """The language a response must have: for a translation the one that its instruction names, else the prompt's own (``found``).

    The instruction is what stands before the first colon, else a sentence with a verb of translating, else (for ``translate``) the whole prompt.
    """
    low = prompt.lower()
    verb = TRANSLATE.search(low)
    if task != "translate" and (task is not None or not verb):
        return found
    head, colon, _ = low.partition(":")
    if colon and (lang := _named(head)) and (task == "translate" or TRANSLATE.search(head)):
        return lang
    for sentence in _PROMPT_SENTENCE.split(low) if verb else ():
        if TRANSLATE.search(sentence) and (lang := _named(sentence)):
            return lang
    return (_named(low) if task == "translate" else None) or found


def _trigrams(words: list[str]) -> list[tuple]:
    return list(zip(words, words[1:], words[2:])) if len(words) > 2 else [tuple(words)] if words else []


@dataclass
class EndModel:
    """Whether a sentence may end after these words: logistic regression on hashed features of its last words and its shape."""

    frequent: frozenset = frozenset()
    joints: frozenset = frozenset()
    known: frozenset = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << _HASH_BITS))

    def features(self, text: str) -> np.ndarray:
        import xxhash

        raw = _WORD.findall(_TAIL.sub("", text))
        kind = ["D" if w[0].isdigit() else w.lower() if w.lower() in self.frequent else "N" if w[0].isupper() else w[:2].lower() + "~" + w[-2:].lower() for w in raw]
        low = [w.lower() for w in raw]
        at = max((i for i, w in enumerate(low) if w in self.joints), default=-1)
        after, joint = min(len(low) - at - 1, 9), low[at] if at >= 0 else "^"
        last, first = low[-1] if low else "^", low[0] if low else "^"
        first2 = " ".join(low[:2])
        new = "new" if raw and last not in self.known and not raw[-1][0].isupper() and not raw[-1][0].isdigit() else "old"
        shape = " ".join(k for k in kind if k in self.frequent or k in "ND")
        names = [
            "w " + last, "ww " + " ".join(low[-2:]), "www " + " ".join(low[-3:]), "k2 " + " ".join(kind[-2:]), "k3 " + " ".join(kind[-3:]), "k4 " + " ".join(kind[-4:]), f"j {joint} {after}", f"jw {joint} {after} {kind[-1] if kind else '^'}",
            f"jl {joint} {after} {last}", f"f {first2} {joint} {after}", f"fn {first} {min(len(low), 30)}", f"n {min(len(low), 12)}", new, "s " + shape, f"s2 {shape} {after}", f"all {first} {joint} {kind[-1] if kind else '^'}", "one",
        ]
        return np.array([xxhash.xxh3_64_intdigest(x) >> (64 - _HASH_BITS) for x in names], np.int64)

    def broken(self, text: str) -> float:
        """Log-odds that ``text`` breaks off."""
        return float(np.clip(self.weights[self.features(text)].sum(), -8, 8))


def fit_ends(sentences: list[str], cuts: int = 3, epochs: int = 20, seed: int = 3) -> EndModel:
    """From finished sentences and the same cut short after a word or inside one."""
    rng = np.random.default_rng(seed)
    count = Counter(w.lower() for s in sentences for w in _WORD.findall(s) if w[0].islower())
    frequent = frozenset(w for w, n in count.most_common(250) if n > len(sentences) / 400)
    joints = frozenset(w for w, _ in count.most_common(70))
    known = frozenset(w for w, n in Counter(w.lower() for s in sentences for w in _WORD.findall(s)).items() if n > 1)
    model = EndModel(frequent, joints, known)
    rows, y = [], []
    for s in sentences:
        ends = [m.end() for m in _WORD.finditer(s)]
        rows.append(model.features(re.sub(r"[.!?…\s]+$", "", s)))
        y.append(0.0)
        for _ in range(cuts if len(ends) > 2 else 0):
            at = ends[rng.integers(1, len(ends) - 1)]
            if rng.random() < 0.25 and s[at - 3 : at].isalpha():
                at -= int(rng.integers(1, 3))
            rows.append(model.features(s[:at]))
            y.append(1.0)
    if not rows:
        return model
    x, y = np.array(rows), np.array(y)
    w, g2 = model.weights, np.full(1 << _HASH_BITS, 1e-6)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 2000)):
            p = 1 / (1 + np.exp(-np.clip(w[x[part]].sum(1), -30, 30)))
            g = np.bincount(x[part].ravel(), np.repeat(p - y[part], x.shape[1]), len(w)) / len(part) + 1e-6 * w
            g2 += g * g
            w -= 0.1 * g / np.sqrt(g2)
    return model


class _Words(dict):
    """Word -> place in growing tables of what the model knows of a word: language scores, odds of refusals, place among the words of refusals."""

    def __init__(self, model: PairModel) -> None:
        super().__init__()
        self.model = model
        self.scores = WordScores(model.language)
        self.rows: list[list[int]] = []
        self.odds: list[float] = []
        self.known: list[int] = []
        self._table = np.zeros((0, len(model.language.languages) + 2))

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.odds)
        self.rows.append([self.scores[w] for w in words_of(word) if w != "\n"])
        self.odds.append(self.model.refusal.get(word, -1.0))
        self.known.append(self.model.places.get(word, 0))
        return n

    def table(self) -> np.ndarray:
        if len(self._table) < len(self.odds):
            t = self.scores.table()
            new = [t[r].sum(0) for r in self.rows[len(self._table) :]]
            self._table = np.vstack([self._table, new])
        return self._table


_MULT = np.random.default_rng(19).integers(0, 1 << 62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _keys(row: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """64-bit keys of runs of words within a row."""
    h = row.astype(np.uint64) * _MULT[3]
    for m, w in zip(_MULT, words):
        h = h + (w.astype(np.uint64) + np.uint64(1)) * m
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows that end at ``ends``; runs may be empty."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=float)])
    at = total[ends]
    return at - np.concatenate([total[:1], at[:-1]]) if len(ends) else at


@dataclass
class PairModel:
    """All that tagging needs; see :func:`fit`."""

    language: LanguageModel
    refusal: dict
    ends: EndModel
    short: dict
    weights: np.ndarray
    links: np.ndarray
    asked_in: tuple = ()
    places: dict = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cache: _Words | None = None

    def __getstate__(self):
        return self.__dict__ | {"cache": None}

    def learn_refusals(self, odds: dict) -> None:
        """Take over the odds of words and pairs of words, the pairs as sorted numbers."""
        self.refusal = {w: o for w, o in odds.items() if isinstance(w, str)}
        two = {p: o for p, o in odds.items() if not isinstance(p, str)}
        self.places = {w: i + 1 for i, w in enumerate(sorted({w for p in two for w in p}))}
        key = np.array([self.places[a] << 32 | self.places[b] for a, b in two], np.int64)
        at = np.argsort(key)
        self.pairs, self.pair_odds, self.cache = key[at], np.array(list(two.values()))[at], None

    def words(self) -> _Words:
        if self.cache is None or len(self.cache) > WORD_CACHE:
            self.cache = _Words(self)
        return self.cache

    def _ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        words, ids, ends = self.words(), [], []
        for w in texts:
            ids.extend([words[x] for x in w])
            ends.append(len(ids))
        return np.array(ids, np.int64), np.array(ends, np.int64)

    def language_sums(self, texts: list[list[str]]) -> np.ndarray:
        ids, ends = self._ids(texts)
        return _sums(self.words().table()[ids], ends)

    def languages_of(self, texts: list[list[str]], among: tuple = ()) -> list[str]:
        """The likeliest language of each list of words (one of ``among`` if given), empty without words."""
        if not texts:
            return []
        s, names = self.language_sums(texts), self.language.languages
        p = self.language.probabilities(s)
        if among:
            p = np.where(np.isin(names, among), p, -1)
        return [names[k] if n > 0.5 else "" for k, n in zip(p.argmax(1), s[:, -1])]

    def features(self, prompts: list[list[str]], found: list[list[Clause]], wanted: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One row of numbers per clause of all pairs in turn, the number of words of each, and where each pair's clauses end."""
        flat = [c for f in found for c in f]
        words = self.words()
        asked, asked_ends = self._ids(prompts)
        ids, ends = self._ids([c.words for c in flat])
        k_of = {x: i for i, x in enumerate(self.language.languages)}
        n = np.diff(ends, prepend=0)
        count = np.array([len(f) for f in found], np.int64)
        pair_ends = np.cumsum(count)
        row = np.repeat(np.arange(len(found)), count)
        clause = np.repeat(np.arange(len(flat)), n)
        of = row[clause]
        asked_row = np.repeat(np.arange(len(prompts)), np.diff(asked_ends, prepend=0))

        lang = words.table()[ids]
        sums = _sums(lang, ends)
        k = np.array([k_of.get(w, -1) for w in wanted], np.int64)

        def foreign(s: np.ndarray, want: np.ndarray, size: np.ndarray) -> np.ndarray:
            if not len(s):
                return np.zeros(0)
            p = self.language.probabilities(s)
            at = np.arange(len(s))
            mine = p[at, want]
            p[at, want] = -1
            odds = np.clip(np.log(np.maximum(p.max(1), 1e-6) / np.maximum(mine, 1e-6)), -6, 6) * np.minimum(1.0, size / 4)
            return np.where((want >= 0) & (size > 0), odds, 0.0)

        n_all = _sums(n, pair_ends)
        whole = foreign(_sums(sums, pair_ends), k, n_all)
        brief = np.zeros(len(found), bool)
        for i in np.flatnonzero((n_all <= 3) & (count > 0)):
            known = self.short.get(" ".join(w for c in found[i] for w in c.words))
            if known is not None:
                brief[i], whole[i] = True, -4.0 if wanted[i] in known else 4.0
        mine = np.where(n > 3, foreign(sums, k[row], n), 0.0)

        triple = np.flatnonzero(clause[2:] == clause[:-2]) if len(ids) > 2 else np.zeros(0, np.int64)
        asked_triple = np.flatnonzero(asked_row[2:] == asked_row[:-2]) if len(asked) > 2 else np.zeros(0, np.int64)
        hit = np.isin(_keys(of[triple], ids[triple], ids[triple + 1], ids[triple + 2]), _keys(asked_row[asked_triple], asked[asked_triple], asked[asked_triple + 1], asked[asked_triple + 2]))
        echo = np.bincount(clause[triple], hit, len(flat)) / np.maximum(n - 2, 1)
        few = np.flatnonzero(n[clause] <= 2)
        told = np.isin(_keys(of[few], ids[few]), _keys(asked_row, asked))
        short_echo = (np.bincount(clause[few], ~told, len(flat)) == 0) & (n > 0) & (n <= 2)
        echo = np.where(n > 2, echo, short_echo * 0.5)

        r = np.bincount(clause, np.array(words.odds)[ids], len(flat)) / np.maximum(n, 1) if len(ids) else np.zeros(len(flat))
        rr = np.zeros(len(flat))
        two = np.flatnonzero(clause[1:] == clause[:-1])
        if len(two):
            place = np.array(words.known, np.int64)[ids]
            key = place[two] << 32 | place[two + 1]
            at = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
            odds = np.where(self.pairs[at] == key, self.pair_odds[at], -1.0) if len(self.pairs) else np.full(len(key), -1.0)
            rr = np.bincount(clause[two], odds, len(flat)) / np.maximum(n - 1, 1)
        quoted = np.array([c.quoted for c in flat], bool)
        bullet = np.array([c.bullet for c in flat], bool)

        last = np.zeros(len(flat), bool)
        shut, hang, broken = np.zeros(len(flat), bool), np.zeros(len(flat), bool), np.zeros(len(flat))
        for i in np.flatnonzero(count):
            j = pair_ends[i] - 1
            t = flat[j].text
            last[j] = True
            shut[j] = bool(_CLOSED.search(t)) or bool(_TAIL.search(t))
            hang[j] = bool(_HANGING.search(t)) or t.rfind("(") > t.rfind(")")
            if not shut[j] and not hang[j] and n[j] and not brief[i]:
                broken[j] = self.ends.broken(t) / 4
        nothing = np.array([c.text != "" and len(c.words) <= 3 and is_placeholder(c.text) for c in flat], bool)
        name = np.array([c.bullet and 0 < len(c.words) <= 2 and c.text[:1].isupper() for c in flat], bool)
        x = np.column_stack([
            np.ones(len(flat)), np.where(quoted, 0, r), np.where(quoted, 0, rr), quoted, echo, echo > 0.7, mine / 6, whole[row] / 6, broken, hang, last & shut,
            last, bullet & (n == 0), n <= 2, np.minimum(n, 12) / 12, whole[row] > 2, brief[row], name, nothing,
        ]) if flat else np.zeros((0, N_FEATURES))
        return x.astype(float), n, pair_ends

    def tags(self, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The most probable tags of all pairs' clauses (Viterbi, all pairs step by step together)."""
        s = x @ self.weights
        size = np.diff(ends, prepend=0)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        if not len(order):
            return np.zeros(0, np.int64)
        begin, size = (ends - size)[order], size[order]
        live = np.searchsorted(-size, -np.arange(size[0]), "left")  # pairs of more than t clauses come first
        best, back = s[begin], []
        for t in range(1, size[0]):
            a = live[t]
            m = best[:a, :, None] + self.links
            back.append(m.argmax(1).astype(np.int8))
            best[:a] = m.max(1) + s[begin[:a] + t]
        out = np.zeros(len(s), np.int64)
        now = best.argmax(1)
        for t in range(size[0] - 1, -1, -1):
            a = live[t]
            out[begin[:a] + t] = now[:a]
            if t:
                now[:a] = back[t - 1][np.arange(a), now[:a]]
        return out

    def defects(self, prompts: list, responses: list, tasks: list) -> list[list[str]]:
        """Defects of each pair, from the clauses' tags and the share of the words that each covers."""
        asked, texts = [plain(p) for p in prompts], [plain(r) for r in responses]
        asked_words = [_WORD.findall(p.lower()) for p in asked]
        found = [clauses(t) for t in texts]
        wanted = [wanted_language(p, t, f) for p, t, f in zip(asked, tasks, self.languages_of(asked_words, self.asked_in))]
        x, n, ends = self.features(asked_words, found, wanted)
        tags = self.tags(x, ends)
        row = np.repeat(np.arange(len(found)), np.diff(ends, prepend=0))
        k = len(TAGS)
        held = np.bincount(row * k + tags, n, len(found) * k).reshape(len(found), k)
        total = held.sum(1)
        share = held / np.maximum(total, 1)[:, None]
        out: list[list[str]] = []
        for i, f in enumerate(found):
            if total[i] == 0 or share[i, N] > 0.99:  # no clause that says anything
                out.append(["empty"])
            elif share[i, R] >= 0.6:
                out.append(["refusal"] if tasks[i] != "safety" else [])
            elif share[i, E] >= 0.5 and total[i] - held[i, E] <= 5 and self._copies(asked_words[i], f, tags[ends[i] - len(f) : ends[i]]):
                out.append(["copies_prompt"])
            else:
                wrong, cut = share[i, G] + share[i, GU] >= 0.5, tags[ends[i] - 1] in (U, GU)
                out.append([d for d, yes in (("wrong_language", wrong), ("truncated", cut)) if yes])
        return out

    def _copies(self, asked: list[str], found: list[Clause], tags: np.ndarray) -> bool:
        """Whether the echoes give most of the prompt back and the rest is no answer."""
        rest = " ".join(w for c, t in zip(found, tags) if t != E for w in c.words)
        words = set(_trigrams(asked))
        return rest not in self.short and len(words & set(_trigrams([w for c in found for w in c.words]))) >= 0.6 * len(words)


def _train_field(rows: list[tuple[np.ndarray, list[int]]], epochs: int = 100, rate: float = 0.08, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and links of the field by gradient ascent on the likelihood of whole tag sequences (forward-backward in the log domain).

    Sequences go by falling length, so that step t works on the first ones only and short sequences cost no padding.
    """
    k, f = len(TAGS), rows[0][0].shape[1]
    rows = sorted(rows, key=lambda r: -len(r[1]))
    size = np.array([len(y) for _, y in rows])
    live = [int((size > t).sum()) for t in range(size[0])]
    steps = [slice(b - a, b) for a, b in zip(live, np.cumsum(live))]
    x = np.concatenate([np.array([rows[i][0][t] for i in range(a)]) for t, a in enumerate(live)])
    y = np.concatenate([np.array([rows[i][1][t] for i in range(a)]) for t, a in enumerate(live)])
    one = np.eye(k)[y]
    seen = sum((one[steps[t - 1]][: live[t]].T @ one[steps[t]] for t in range(1, len(live))), np.zeros((k, k)))
    theta, mom, var = np.zeros(f * k + k * k), np.zeros(f * k + k * k), np.zeros(f * k + k * k)

    def lse(a, axis):
        top = a.max(axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)

    for step in range(1, epochs + 1):
        w, links = theta[: f * k].reshape(f, k), theta[f * k :].reshape(k, k)
        s = x @ w
        alpha, beta = s.copy(), np.zeros_like(s)
        z = np.empty(len(rows))
        for t, at in enumerate(steps):
            if t:
                alpha[at] += lse(alpha[steps[t - 1]][: live[t], :, None] + links, 1)
            end = live[t + 1] if t + 1 < len(live) else 0
            z[end : live[t]] = lse(alpha[at][end:], 1)
        p = np.empty_like(s)
        ga = seen.copy()
        for t in range(len(steps) - 1, -1, -1):
            at, n = steps[t], live[t + 1] if t + 1 < len(live) else 0
            if n:
                after = (s[steps[t + 1]] + beta[steps[t + 1]])[:, None, :] + links
                beta[at.start : at.start + n] = lse(after, 2)
                ga -= np.exp(np.clip(alpha[at][:n, :, None] + after - z[:n, None, None], -60, 0)).sum(0)
            p[at] = np.exp(np.clip(alpha[at] + beta[at] - z[: live[t], None], -60, 0))
        g = np.r_[(x.T @ (one - p)).ravel(), ga.ravel()] / len(rows) - l2 * theta
        mom, var = 0.9 * mom + 0.1 * g, 0.99 * var + 0.01 * g * g
        theta = theta + rate * (mom / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
    return theta[: f * k].reshape(f, k), theta[f * k :].reshape(k, k)


def _log_odds(refusing: list[list[str]], others: list[list[str]]) -> dict:
    """How much a word or pair of words speaks for a refusal, between -3 and 3."""
    a = Counter(x for w in refusing for x in {*w, *zip(w, w[1:])})
    b = Counter(x for w in others for x in {*w, *zip(w, w[1:])})
    na, nb = len(refusing) + 1, len(others) + 1
    return {x: float(np.clip(np.log(((a[x] + 0.1) / na) / ((b[x] + 0.5) / nb)), -3, 3)) for x in {*a, *b} if a[x] > 1 or b[x] > 3}


def fit(
    pairs: DataFrame, language: LanguageModel, texts: list[tuple[str, str]], most_rows: int = 8_000, most_sentences: int = 8_000, most_examples: int = 3_000, most_brief: int = 400, most_clauses: int = 30, seed: int = 11
) -> PairModel:
    """Fit to the ``most_rows`` rows of ``pairs`` with the least hash of their id; ``texts`` are ``(lang, text)`` of known language.

    A row labelled ``safety`` teaches refusals; responses in the wanted language that end with a stop and copy nothing teach
    answers, and are composed into broken-off, foreign, echoing, refusing and missing responses with known tags.  The bounds hold for training
    only: ``most_sentences`` sentences teach where a sentence may end, ``most_examples`` composed responses of at most ``most_clauses`` clauses and
    ``most_brief`` answers of a word or two train the field.
    """
    cols = hash_sample(pairs, "id", most_rows).where(F.col("response").isNotNull() & F.col("prompt").isNotNull() & F.col("id").isNotNull())
    sample = cols.select("prompt", "response", "task_type", lang_label(F.col("lang")).alias("lang")).distinct().orderBy("prompt", "response").collect()
    model = PairModel(language, {}, EndModel(), {}, np.zeros((N_FEATURES, len(TAGS))), np.zeros((len(TAGS), len(TAGS))))
    rng = np.random.default_rng(seed)
    rows = [(plain(r.prompt), plain(r.response), r.task_type) for r in sample]
    rows = [(p, r, t) for p, r, t in rows if p and not is_empty(r)]
    if not rows:
        return model
    asked, said_words = [_WORD.findall(p.lower()) for p, _, _ in rows], [_WORD.findall(r.lower()) for _, r, _ in rows]
    shared = [set(_trigrams(a)) & set(_trigrams(b)) for a, b in zip(asked, said_words)]
    safe = [r for (_, r, t), s in zip(rows, shared) if t == "safety" and not s]
    model.learn_refusals(_log_odds([_WORD.findall(r.lower()) for r in safe], [w for (_, _, t), w in zip(rows, said_words) if t != "safety"]))

    said = Counter(r.lang for r in sample if r.lang in language.languages)
    model.asked_in = tuple(sorted(k for k, n in said.items() if n >= 0.02 * said.total()))
    wants = [wanted_language(p, t, f) for (p, _, t), f in zip(rows, model.languages_of(asked, model.asked_in))]
    spoken = model.languages_of(said_words)

    def refusing(words: list[str]) -> float:
        return sum(model.refusal.get(w, -1.0) for w in words) / max(1, len(words))

    by_short: dict[str, Counter] = {}
    asks: Counter = Counter()
    good: list[tuple[str, str, str]] = []
    pool: dict[str, list[str]] = {}
    for lang, text in texts:
        if text:
            pool.setdefault(lang, []).append(text)
    finished: list[str] = []
    for (p, r, _), want, words, same, lang in zip(rows, wants, said_words, shared, spoken):
        if len(words) <= 3:
            asks[want] += 1
            by_short.setdefault(" ".join(words), Counter())[want] += 1
            continue
        if refusing(words) > 0 or len(same) > 0.3 * len(set(_trigrams(words))):
            continue
        pool.setdefault(lang, []).append(r)
        if lang == want and _CLOSED.search(r) and r.count("(") == r.count(")") and r.count("«") == r.count("»"):
            good.append((p, r, want))
        finished.extend(c.text for c in clauses(r) if _CLOSED.search(c.text) and not c.quoted and len(c.words) > 3)
    for key, c in by_short.items():
        rate = {k: n / asks[k] for k, n in c.items()}
        model.short[key] = frozenset(k for k, v in rate.items() if v >= 0.2 * max(rate.values()) and (c[k] > 1 or len(c) == 1))
    model.short = {k: v for k, v in model.short.items() if v}
    model.ends = fit_ends([finished[i] for i in rng.permutation(len(finished))[:most_sentences]])
    if not good or not safe:
        return model
    examples: list[tuple[str, list[Clause], str, list[int]]] = []

    def add(p: str, text: str, want: str, tags) -> None:
        c = clauses(text)
        if 0 < len(c) <= most_clauses:
            examples.append((p, c, want, [tags(i, len(c)) for i in range(len(c))]))

    def cut(text: str) -> str:
        c = [m.end() for m in _WORD.finditer(text)]
        start = max([m.end() for m in _SENTENCE.finditer(text)] + [0])
        inside = [e for e in c if e > start][1:-2]
        if not inside:
            return ""
        at = inside[rng.integers(len(inside))]
        if rng.random() < 0.15:
            at -= 1
        return text[:at] + ("", "", "", ",", " -", " (")[rng.integers(6)]

    def echo(p: str) -> str:
        words = p.split(" ")
        how = rng.integers(6)
        if how == 0 and len(words) > 8:
            del words[rng.integers(2, len(words) - 1)]
        q = " ".join(words)
        return (q, q.upper(), f'"{q.lower()}"', f"{q}\n{q}", q.lower().replace(" ", "  "), q.replace("?", "."))[how]

    names = sorted({w for _, r, _ in good for w in _WORD.findall(r)[1:] if w[0].isupper() and len(w) > 4}) or ["X"]
    for i in rng.permutation(len(rows)):  # answers of a word or two
        key = " ".join(said_words[i])
        if key in model.short and refusing(said_words[i]) < 1 and len(examples) < most_brief:
            add(rows[i][0], rows[i][1], wants[i], lambda j, n, right=wants[i] in model.short[key]: A if right else G)
    none = sorted(PLACEHOLDERS - {""})
    for i in rng.permutation(len(good))[:most_examples]:
        p, r, want = good[i]
        kind = rng.random()
        if kind < 0.04:
            add(p, f"{r}\n- {names[rng.integers(len(names))]}\n- {names[rng.integers(len(names))]}", want, lambda i, n: A)
        elif kind < 0.08:
            parts = [re.sub(r"[.!?…]+$", "", x.text) for x in clauses(r)]
            text = "\n".join(f"{j + 1}. {x}" for j, x in enumerate(parts))
            if rng.random() < 0.5:
                add(p, text, want, lambda i, n: A)
            elif rng.random() < 0.5:
                add(p, f"{text}\n{len(parts) + 1}.", want, lambda i, n: U if i == n - 1 else A)
            elif c := cut(parts[-1]):
                add(p, text[: len(text) - len(parts[-1])] + c, want, lambda i, n: U if i == n - 1 else A)
        elif kind < 0.33:
            add(p, r if rng.random() < 0.6 else re.sub(r"[.!?…]+\s*$", "", r), want, lambda i, n: A)
        elif kind < 0.35:
            word = none[rng.integers(len(none))]
            add(p, (word, word.upper(), f"[{word}]", word.capitalize() + ".")[rng.integers(4)], want, lambda i, n: N)
        elif kind < 0.5:
            if c := cut(r):
                add(p, c, want, lambda i, n: U if i == n - 1 else A)
        elif kind < 0.7:
            others = [k for k in pool if k and k != want]
            if others:
                f = pool[others[rng.integers(len(others))]]
                f = f[rng.integers(len(f))]
                if rng.random() < 0.3 and (c := cut(f)):
                    add(p, c, want, lambda i, n: GU if i == n - 1 else G)
                elif _CLOSED.search(f):
                    add(p, f, want, lambda i, n: G)
        elif kind < 0.8:
            add(p, safe[rng.integers(len(safe))], want, lambda i, n: R)
        elif kind < 0.86:
            s = safe[rng.integers(len(safe))]
            add(p, f"{r} « {s} », {' '.join(p.split()[-1:])} - {r}", want, lambda i, n: A)
        elif kind < 0.94:
            add(p, echo(p), want, lambda i, n: E)
        else:
            e = echo(p).split("\n")[0]
            k = len(clauses(e))
            add(p, f"{e}\n{r}", want, lambda i, n, k=k: E if i < k else A)
    x, _, ends = model.features([_WORD.findall(p.lower()) for p, _, _, _ in examples], [c for _, c, _, _ in examples], [w for _, _, w, _ in examples])
    model.weights, model.links = _train_field([(x[end - len(t) : end], t) for end, (_, _, _, t) in zip(ends, examples)])
    return model


def pair_defects(pairs: DataFrame, model: PairModel) -> DataFrame:
    """``id, defect``, one row per defect: ``empty``, ``truncated``, ``refusal``, ``copies_prompt``, ``wrong_language``.

    ``pairs`` needs ``id, prompt, response, task_type``.  A null response is empty; with a null prompt only ``empty``, ``refusal`` and
    ``truncated`` can be told; null ids have no rows; rows delivered again give their rows once; texts are read whole.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            ids, prompts, responses, tasks = (b.column(c).to_pylist() for c in ("id", "prompt", "response", "task_type"))
            at, out = 0, ([], [])
            for part in pieces([(p or "") + (r or "") for p, r in zip(prompts, responses)]):
                to = at + len(part)
                for i, found in zip(ids[at:to], m.defects(prompts[at:to], responses[at:to], tasks[at:to])):
                    out[0].extend([i] * len(found))
                    out[1].extend(found)
                at = to
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], names=["id", "defect"])

    rows = pairs.where(F.col("id").isNotNull()).select(F.col("id").cast("string").alias("id"), "prompt", "response", "task_type")
    return rows.mapInArrow(run, "id string, defect string").distinct()
