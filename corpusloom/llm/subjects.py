"""Subject areas of documents (problem 9).

Documents are embedded by term weighting (tf-idf over all documents) and truncated singular value decomposition.  The decomposition
is a subspace iteration started from the span of the labelled reference centroids: a pass over all documents multiplies that
basis by A'A, which gives words that the reference never shows the coordinates of the subject words they occur with; passes go on until held-out
reference texts are told right or the subspace settles.  A sentence is embedded in the decomposed space as the weighted sum of its subject words and gets the subject of
the nearest centroid by cosine similarity.  Seed centroids, one per subject and language, are refined from the sentences assigned to them, in passes
over all documents, until they settle.  A document has the subjects of at least ``min_share`` of its sentences.

Texts are tokenized once (:func:`tokenized`); all passes work on the hashes of their words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import SLOT_DDL, add_up, clean, pieces, slots

_TOKEN = re.compile(r"[^\W\d_]+|[.!?](?=\s|$)|\n")
_STOPS = (".", "!", "?", "\n")
#: Numbers of words within a model: unknown ones, sentence ends; and the hash that stands for a sentence end.
OTHER, END = 0, 1
END_HASH = 0
#: The column that :func:`tokenized` adds; a table that has it is taken as tokenized, so its name is none that a table of documents has.
WORDS = "_word_hashes"
#: Most words remembered per worker.
WORD_CACHE = 2_000_000


class _Hashes(dict):
    """Word -> 64-bit hash, remembered."""

    def __init__(self) -> None:
        super().__init__(dict.fromkeys(_STOPS, END_HASH))

    def __missing__(self, word: str) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        self[word] = h = h or 1
        return h


def hashed(texts: list, known: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (and sentence ends) of all texts in one array, and the length of each text."""
    out, lens = [], []
    for t in texts:
        w = _TOKEN.findall(clean(t).lower()) if t else ()
        out.extend([known[x] for x in w])
        lens.append(len(w))
    return np.array(out, np.int64), np.array(lens, np.int64)


def tokenized(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and :data:`WORDS`: the hashes of each text's words in order, 0 where a sentence ends; empty for a null text.

    Whole texts are read.  Stage the result where several passes use it.
    """
    cols = docs.select(*keep, F.col(text_col).alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for b in batches:
            at = 0
            for part in pieces(b.column("_text").to_pylist()):
                if len(known) > WORD_CACHE:
                    known = _Hashes()
                flat, lens = hashed(part, known)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)], pa.int32()), pa.array(flat))
                rest = b.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([*(rest.column(c) for c in keep), lists], names=[*keep, WORDS])
                at += len(part)

    return cols.mapInArrow(run, f"{ddl}{', ' if keep else ''}{WORDS} array<bigint>")


def _words_of(docs: DataFrame) -> DataFrame:
    """The column :data:`WORDS` of tokenized documents, or of documents with a text."""
    return docs.select(WORDS) if WORDS in docs.columns else tokenized(docs, [])


def _parts(batch: pa.RecordBatch, most: int = 20_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, hashes, lengths)`` of runs of rows of about ``most`` words, from the column :data:`WORDS`."""
    lists = batch.column(WORDS)
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    lens = np.diff(offsets) * ~lists.is_null().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lens)
    i = 0
    while i < len(lens):
        begin = ends[i] - lens[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + most, "right")))
        yield i, flat[begin : ends[j - 1]], lens[i:j]
        i = j


@dataclass
class Terms:
    """Vocabulary (hashes in order) and term weights over all documents; numbers 0 and 1 are unknown words and sentence ends."""

    hashes: np.ndarray
    idf: np.ndarray

    @property
    def size(self) -> int:
        return len(self.idf)

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.where(h == END_HASH, END, OTHER)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(h == END_HASH, END, np.where(self.hashes[at] == h, at + 2, OTHER)).astype(np.int32)


def _distinct(h: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The words of every text, once per text."""
    row = np.repeat(np.arange(len(lens)), lens)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    return h[np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]] if len(h) else h


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``word, df`` (the word as its hash) over all documents, ``END_HASH`` with the number of those that have a word; counted per partition first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, filled = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for b in batches:
            for _, h, lens in _parts(b):
                w = _distinct(h, lens)
                w, n = np.unique(w[w != END_HASH], return_counts=True)
                filled += int((lens > 0).sum())
                words, at = np.unique(np.r_[words, w], return_inverse=True)
                counts = np.bincount(at, np.r_[counts, n], len(words)).astype(np.int64)
            if len(words) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], names=["word", "df"])
                words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[words, END_HASH]), pa.array(np.r_[counts, filled])], names=["word", "df"])

    return _words_of(docs).mapInArrow(run, "word bigint, df bigint").groupBy("word").agg(F.sum("df").alias("df"))


def fit_terms(docs: DataFrame, reference: tuple[np.ndarray, np.ndarray], min_df: int, min_share: float, most_terms: int) -> Terms:
    """The words of at least ``min_df`` documents and of ``min_share`` of all, and the reference's words; idf over all documents.

    There are at most (mean distinct words of a document) / ``min_share`` such words, in practice some hundred thousand.  More than ``most_terms`` raise an error
    rather than being cut.
    """
    known = Counter(_distinct(*reference).tolist())
    known.pop(END_HASH, None)
    df = stage(document_frequencies(docs), "p9-df")
    total = df.where(F.col("word") == END_HASH).agg(F.sum("df")).first()[0] or 0
    frequent = df.where((F.col("df") >= max(min_df, min_share * total)) & (F.col("word") != END_HASH))
    if (n := frequent.count()) > most_terms:
        raise ValueError(f"{n} words of {max(min_df, min_share * total)} documents or more; raise min_share or most_terms")
    counts = {r.word: r.df for r in frequent.toLocalIterator()}
    total += len(reference[1])
    for w, n in known.items():
        counts[w] = counts.get(w, 0) + n
    words = np.array(sorted(counts), np.int64)
    idf = np.zeros(len(words) + 2, np.float32)
    idf[2:] = np.log(total / np.array([min(counts[w], total) for w in words.tolist()], np.float64)) if len(words) else []
    return Terms(words, idf)


def _rows(ids: np.ndarray, lens: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tf-idf matrix of texts with rows of unit length as (row, word, value), by row."""
    row = np.repeat(np.arange(len(lens)), lens)
    m = ids > END
    key, n = np.unique(row[m] * len(idf) + ids[m], return_counts=True)
    r, w = key // len(idf), key % len(idf)
    v = (1 + np.log(n)) * idf[w]
    norm = np.sqrt(np.bincount(r, v * v, len(lens)))
    return r, w, (v / np.maximum(norm[r], 1e-9)).astype(np.float32)


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)


def _block(a, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of the matrix ``a`` of ``n`` texts, and those columns of it."""
    r, w, v = a
    u, at = np.unique(w, return_inverse=True)
    dense = np.zeros((n, len(u)), np.float32)
    dense[r, at] = v
    return u, dense


def _iterate(docs: DataFrame, terms: Terms, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, basis.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, q = shared.value
        out = np.zeros(q.shape, np.float64)
        for b in batches:
            for _, h, lens in _parts(b):
                u, a = _block(_rows(t.ids(h), lens, t.idf), len(lens))
                out[u] += a.T @ (a @ q[u])
        yield slots(out)

    return add_up(_words_of(docs).mapInArrow(run, SLOT_DDL), basis.shape, np.float64)


@dataclass
class SubjectModel:
    """Embedding of the words near a centroid (rows of zeros for all others), and the centroids in the decomposed space, ``subject * languages + language``."""

    subjects: list[str]
    terms: Terms
    words: np.ndarray
    centroids: np.ndarray
    min_cosine: float
    languages: list[str] = field(default_factory=list)
    near: np.ndarray | None = None

    def sentences(self, h: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(row, centroid or -1, is a sentence, word ids, sentence of each word)`` of all sentences of texts given as hashes and lengths."""
        ids = self.terms.ids(h)
        if not len(ids):
            z = np.zeros(0, np.int64)
            return z, z, z.astype(bool), ids, z
        row = np.repeat(np.arange(len(lens)), lens)
        closed = ids == END
        cut = np.r_[False, closed[:-1]] | np.r_[True, row[1:] != row[:-1]]
        start = np.flatnonzero(cut)
        of = np.cumsum(cut) - 1
        hit = np.flatnonzero(self.near[ids])
        e = np.zeros((len(start), self.words.shape[1]), np.float32)
        if len(hit):
            s = _starts(of[hit])
            e[of[hit][s]] = np.add.reduceat(self.words[ids[hit]], s, axis=0)
        cosine = e @ self.centroids.T
        best = cosine.argmax(1)
        length = np.sqrt((e * e).sum(1))
        sure = (length > 1e-6) & (cosine[np.arange(len(e)), best] >= self.min_cosine * length)
        best = np.where(sure, best, -1)
        words = np.add.reduceat((~closed).astype(np.int32), start)
        stop = np.r_[start[1:], len(ids)] - 1
        real = (words > 0) & (closed[stop] | sure)
        return row[start], best, real, ids, of

    def shares_of(self, h: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Per text the share of its sentences that deal with each subject."""
        row, best, real, _, _ = self.sentences(h, lens)
        k, hit = len(self.subjects), best >= 0
        count = np.bincount(row[hit] * k + best[hit] // max(len(self.languages), 1), minlength=len(lens) * k).reshape(len(lens), k)
        return count / np.maximum(np.bincount(row[real], minlength=len(lens)), 1)[:, None]

    def shares(self, texts: list) -> np.ndarray:
        return self.shares_of(*hashed(texts, _Hashes()))


def _model(subjects: list[str], languages: list[str], terms: Terms, basis: np.ndarray, centroids: np.ndarray, min_word_cosine: float, min_cosine: float) -> SubjectModel:
    """The model of ``centroids[subject, language, :]``, taken less their language's mean; words count that are near one of them."""
    c = centroids - centroids.mean(0)
    c /= np.maximum(np.linalg.norm(c, axis=2, keepdims=True), 1e-9)
    c = c.reshape(-1, c.shape[2])
    near = (basis @ c.T).max(1) >= min_word_cosine * np.maximum(np.linalg.norm(basis, axis=1), 1e-12)
    near[:2] = False
    return SubjectModel(subjects, terms, (basis * terms.idf[:, None] * near[:, None]).astype(np.float32), c.astype(np.float32), min_cosine, languages, near)


def _refine(docs: DataFrame, model: SubjectModel) -> np.ndarray:
    """Counts of words (``word, centroid``) in the sentences assigned to each centroid, over all documents."""
    k = len(model.centroids)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        out = np.zeros((m.terms.size, k), np.int64)
        for b in batches:
            for _, h, lens in _parts(b):
                _, best, _, ids, sent = m.sentences(h, lens)
                of = best[sent]
                hit = (of >= 0) & (ids > END)
                key, n = np.unique(ids[hit].astype(np.int64) * k + of[hit], return_counts=True)
                out.reshape(-1)[key] += n
        yield slots(out)

    return add_up(_words_of(docs).mapInArrow(run, SLOT_DDL), (model.terms.size, k), np.int64)


def fit(
    docs: DataFrame, reference: DataFrame, iterations: int = 4, refinements: int = 4, settled: float = 0.01, enough: float = 0.99, min_df: int = 5, min_share: float = 1e-6, most_terms: int = 2_000_000, min_word_cosine: float = 0.75, min_cosine: float = 0.6
) -> SubjectModel:
    """Fit to all ``docs`` (with ``text``, or from :func:`tokenized`) and the labelled ``reference`` (``subject, lang, text``; a small table of fixed size, read whole).

    The decomposition takes up to ``iterations`` passes.  After each, centroids of every other reference text tell the subjects of the rest: passes end when
    ``enough`` of them are told right, when the subspace turns by less than ``settled`` (one less the mean squared cosine between the old and the new one), or
    when a pass lowers that share, and that pass is undone - further passes turn the space to what is commonest in the corpus, be it a subject or not.
    The centroids take up to ``refinements`` passes and end when they turn by less than ``settled`` (one less their mean cosine with those before).
    """
    ref = [(r.subject, r.lang, r.text) for r in reference.select("subject", "lang", "text").collect() if r.subject and r.lang and r.text]
    subjects, languages = sorted({r[0] for r in ref}), sorted({r[1] for r in ref})
    if not ref:
        none = Terms(np.zeros(0, np.int64), np.zeros(2, np.float32))
        return SubjectModel([], none, np.zeros((2, 1), np.float32), np.zeros((1, 1), np.float32), 2.0, [], np.zeros(2, bool))
    texts = hashed([r[2] for r in ref], _Hashes())
    docs = _words_of(docs)
    terms = fit_terms(docs, texts, min_df, min_share, most_terms)
    s, l = len(subjects), len(languages)
    cell = np.array([subjects.index(a) * l + languages.index(b) for a, b, _ in ref])
    u, a = _block(_rows(terms.ids(texts[0]), texts[1], terms.idf), len(ref))
    start = np.zeros((terms.size, s * l), np.float64)
    start[u] = a.T @ np.eye(s * l, dtype=np.float32)[cell]
    basis = np.linalg.qr(start)[0]

    def seeds(basis: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((s * l, basis.shape[1]))
        np.add.at(out, cell[rows], (a @ basis[u])[rows])
        out = out.reshape(s, l, -1)
        return out / np.maximum(np.linalg.norm(out, axis=2, keepdims=True), 1e-9)

    every = np.arange(len(ref))
    held = np.repeat(every % 2 == 1, texts[1])

    def told(basis: np.ndarray) -> float:
        """The share of every other reference text whose subject the centroids of the rest tell."""
        m = _model(subjects, languages, terms, basis, seeds(basis, every[::2]), min_word_cosine, min_cosine)
        return float((m.shares_of(texts[0][held], texts[1][1::2]).argmax(1) == cell[1::2] // l).mean()) if len(ref) > 1 else 1.0

    right = -1.0
    for _ in range(iterations):
        # the reference's own rows count too, so that the basis can't lose a subject
        y = _iterate(docs, terms, basis)
        y[u] += a.T @ (a @ basis[u])
        new = np.linalg.qr(y)[0]
        now, turned = told(new), 1 - np.linalg.norm(basis.T @ new) ** 2 / basis.shape[1]
        if now < right:
            break
        basis, right = new, now
        if now >= enough or turned < settled:
            break
    centroids = seeds(basis, every)
    model = _model(subjects, languages, terms, basis, centroids, min_word_cosine, min_cosine)
    for _ in range(refinements):
        found = (basis.T @ (_refine(docs, model) * terms.idf[:, None])).T.reshape(s, l, -1)
        size = np.linalg.norm(found, axis=2, keepdims=True)
        centroids = np.where(size > 0, found / np.maximum(size, 1e-9), centroids)
        old, model = model, _model(subjects, languages, terms, basis, centroids, min_word_cosine, min_cosine)
        if 1 - (old.centroids * model.centroids).sum(1).mean() < settled:
            break
    return model


def _shares(docs: DataFrame, model: SubjectModel, id_col: str, rows_of, ddl: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.where(F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), WORDS) if WORDS in docs.columns else tokenized(rows.select(F.col(id_col).alias("id"), "text"), ["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for at, h, lens in _parts(b):
                yield rows_of(m, b.column("id"), at, m.shares_of(h, lens))

    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, {ddl}")


def document_subjects(docs: DataFrame, model: SubjectModel, id_col: str = "doc_id", min_share: float = 0.25) -> DataFrame:
    """``<id_col>, subject, share``: subjects of at least ``min_share`` of a document's sentences, one row each.

    ``docs`` has ``text``, or comes from :func:`tokenized`.  Null ids have no rows; null, empty and wordless texts have no subject; a row delivered
    again gives its rows once; a very long text is used whole.
    """

    def rows_of(m, ids, at, share):
        row, subject = np.nonzero(share >= min_share - 1e-9)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(row + at)), pa.array([m.subjects[j] for j in subject], pa.string()), pa.array(share[row, subject], pa.float64())], names=["id", "subject", "share"])

    rows = _shares(docs, model, id_col, rows_of, "subject string, share double")
    return rows.groupBy(F.col("id").alias(id_col), "subject").agg(F.max("share").alias("share"))


def main_subject(docs: DataFrame, model: SubjectModel, id_col: str = "doc_id") -> DataFrame:
    """``<id_col>, topic``: the subject of most of a document's sentences, ``none`` where no sentence has one."""

    def rows_of(m, ids, at, share):
        best = share.argmax(1) if share.shape[1] else np.zeros(len(share), np.int64)
        named = [m.subjects[j] if share.shape[1] and share[i, j] > 0 else "none" for i, j in enumerate(best)]
        return pa.RecordBatch.from_arrays([ids.slice(at, len(share)), pa.array(named, pa.string())], names=["id", "topic"])

    return _shares(docs, model, id_col, rows_of, "topic string").groupBy(F.col("id").alias(id_col)).agg(F.min("topic").alias("topic"))
