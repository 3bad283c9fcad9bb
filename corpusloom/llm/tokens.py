"""Exact token counts under a public tokenizer, and their totals (problem 6).

Short texts are counted where they are read.  A text longer than ``max_chunk_chars`` is cut only where the tokenizer's own
pre-split pattern proves that no token crosses: before a single space between two letters.  Every alternative of the pattern
that may hold a space holds it first or holds white space only, so a piece always starts at such a space and what follows is split
the same with or without the text before it.  Chunks are spread over all workers and their counts summed.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ENCODINGS: dict[tuple[str, str], object] = {}
_INNER_SPACE = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")

#: Fixed value: the pre-split pattern that belongs to the rank files.
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Tokenizer:
    """A rank file and its pre-split pattern; the file must be readable at ``path`` on every worker."""

    path: str = os.environ.get("CORPUSLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
    pattern: str = BYTE_BPE_PATTERN

    def load(self):
        """The encoding, loaded once per worker process."""
        key = (self.path, self.pattern)
        if key not in _ENCODINGS:
            import tiktoken

            with open(self.path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return _ENCODINGS[key]

    def count(self, text: str | None) -> int:
        """Tokens of ``text``; 0 for null and empty."""
        return len(self.load().encode_ordinary(text)) if text else 0


def independent_chunks(text: str, size: int) -> list[str]:
    """``text`` in pieces of about ``size`` characters whose token counts add up to the whole's; one piece if it has no safe place."""
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while (m := _INNER_SPACE.search(text, at)) and not (text[m.start() - 1].isalpha() and text[m.start() + 1].isalpha()):
            at = m.end()
        if not m:
            break
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def _counter(tokenizer: Tokenizer, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer.load().encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(text_col).to_pylist()]
            rest = [c for c in b.schema.names if c != text_col]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(n, pa.int64())], names=[*rest, "n_tokens"])

    return run


def _cutter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rest = [c for c in b.schema.names if c != "text"]
            for i, t in enumerate(b.column("text").to_pylist()):
                parts = independent_chunks(t, size)
                row = b.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.concat_arrays([row.column(c)] * len(parts)) for c in rest), pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.string())],
                    names=[*rest, "chunk_no", "text"],
                )

    return run


def _ddl(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in names)


def token_counts(df: DataFrame, keep: list[str], text_col: str = "text", tokenizer: Tokenizer | None = None, max_chunk_chars: int = 20_000) -> DataFrame:
    """``keep`` columns and ``n_tokens BIGINT``, one row per row of ``df`` (rows that are equal stay as many as they were).

    Null and empty texts have 0 tokens.  Texts of any length are counted whole.  ``keep`` columns must be groupable (no maps) and
    must not be named ``n_tokens``, ``text``, ``chunk_no``, ``text_hash``.
    """
    tok = tokenizer or Tokenizer()
    cols = df.select(*keep, F.col(text_col).alias("text"))
    kept = _ddl(cols, keep)
    short = cols.where(F.col("text").isNull() | (F.length("text") <= max_chunk_chars))
    counted = short.mapInArrow(_counter(tok, "text"), f"{kept}, n_tokens bigint")
    long = cols.where(F.length("text") > max_chunk_chars).withColumn("text_hash", F.xxhash64("text"))
    chunks = long.mapInArrow(_cutter(max_chunk_chars), f"{kept}, text_hash bigint, chunk_no bigint, text string")
    spread = chunks.repartition(F.xxhash64("text_hash", "chunk_no"))
    per_chunk = spread.mapInArrow(_counter(tok, "text"), f"{kept}, text_hash bigint, chunk_no bigint, n_tokens bigint")
    key = [*keep, "text_hash"]
    once = per_chunk.groupBy(*key, "chunk_no").agg(F.max("n_tokens").alias("n"), F.count("*").alias("copies"))
    whole = once.groupBy(*key).agg(F.sum("n").alias("n_tokens"), F.max("copies").alias("copies"))
    again = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return counted.unionByName(again.select(*keep, "n_tokens"))


#: Label spellings that mean the same language.
LANG_CODES = {"rw": "kin_Latn", "en": "eng_Latn", "fr": "fra_Latn", "sw": "swh_Latn", "rn": "run_Latn", "kin": "kin_Latn", "eng": "eng_Latn", "fra": "fra_Latn", "swh": "swh_Latn", "run": "run_Latn"}


def lang_label(c):
    """A language label in its one spelling; null where it says nothing."""
    low = F.lower(F.trim(c))
    out = F.when(low.isNull() | low.isin("", "und", "unknown"), F.lit(None))
    for a, b in LANG_CODES.items():
        out = out.when((low == a) | (low == b.lower()), F.lit(b))
    return out.when(low == "zxx_latn", F.lit("zxx_Latn")).otherwise(low)


def source_label(c):
    """A source name in its one spelling: lower case, no white space around it; null if blank."""
    low = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(low != "", low)


def document_tokens(docs: DataFrame, meta: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Per document of ``docs``: its slice and exact tokens beside what ``meta`` claims.

    Columns ``doc_id, source, run_id, lang, domain, n_tokens, meta_tokens, meta_state``; ``meta_state`` is ``ok``, ``missing``
    (no row, null or not positive) or ``wrong``.  Of several deliveries the latest counts, of several meta rows the newest.  Null
    ids are left out; null texts have 0 tokens.
    """
    from .repeated_lines import domain_of

    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "source", "run_id", "lang", "fetched_at", "text")
    n = token_counts(rows, ["doc_id", "source", "run_id", "lang", "fetched_at"], tokenizer=tokenizer)
    latest = n.groupBy("doc_id").agg(F.max(F.struct("fetched_at", "n_tokens", "source", "run_id", "lang")).alias("r"))
    m = meta.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.struct("enriched_at", "token_count", "domain")).alias("m"))
    claim = F.col("m.token_count")
    return latest.join(m, "doc_id", "left").select(
        "doc_id",
        source_label(F.col("r.source")).alias("source"),
        F.col("r.run_id").alias("run_id"),
        lang_label(F.col("r.lang")).alias("lang"),
        domain_of(F.col("m.domain")).alias("domain"),
        F.col("r.n_tokens").alias("n_tokens"),
        claim.alias("meta_tokens"),
        F.when(claim.isNull() | (claim <= 0), "missing").when(claim == F.col("r.n_tokens"), "ok").otherwise("wrong").alias("meta_state"),
    )


def token_totals(per_doc: DataFrame) -> DataFrame:
    """Totals of :func:`document_tokens` over all, by source, language, domain, and their combination.

    ``slice`` names the grouping; a column outside the grouping is null, a missing label inside it is ``(none)``.
    """
    named = per_doc.select(*(F.coalesce(c, F.lit("(none)")).alias(c) for c in ("source", "lang", "domain")), "n_tokens", "meta_tokens", "meta_state")
    g = named.groupingSets([[], ["source"], ["lang"], ["domain"], ["source", "lang", "domain"]], "source", "lang", "domain").agg(
        F.grouping_id().alias("g"),
        F.count("*").alias("docs"),
        F.sum("n_tokens").alias("tokens"),
        F.sum("meta_tokens").alias("meta_tokens"),
        F.count_if(F.col("meta_state") != "ok").alias("docs_without_right_count"),
    )
    kind = F.when(F.col("g") == 7, "all").when(F.col("g") == 3, "source").when(F.col("g") == 5, "lang").when(F.col("g") == 6, "domain").otherwise("source+lang+domain")
    return g.select(kind.alias("slice"), "source", "lang", "domain", "docs", "tokens", "meta_tokens", "docs_without_right_count")


def run_totals(docs: DataFrame, reports: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Exact tokens of each run's documents beside the run's reported total.

    Reports delivered again count once and of partial reports the one with most documents seen counts.  ``state`` is ``ok`` (within a
    tenth), ``off``, ``missing`` (null or not positive report), ``no_report`` or ``no_documents``.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "run_id", "fetched_at", "text")
    n = token_counts(rows, ["doc_id", "run_id", "fetched_at"], tokenizer=tokenizer)
    latest = n.groupBy("doc_id").agg(F.max(F.struct("fetched_at", "n_tokens", "run_id")).alias("r"))
    exact = latest.groupBy(F.col("r.run_id").alias("run_id")).agg(F.count("*").alias("docs"), F.sum("r.n_tokens").alias("tokens"))
    best = reports.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.max(F.struct("docs_seen", "ended_at", "token_estimate_total", "docs_kept")).alias("r"))
    said = F.col("r.token_estimate_total")
    state = (
        F.when(F.col("r").isNull(), "no_report")
        .when(F.col("docs").isNull(), "no_documents")
        .when(said.isNull() | (said <= 0), "missing")
        .when(F.abs(said - F.col("tokens")) <= 0.1 * F.col("tokens"), "ok")
        .otherwise("off")
    )
    return exact.join(best, "run_id", "full").select("run_id", "docs", "tokens", F.col("r.docs_kept").alias("reported_docs_kept"), said.alias("reported_tokens"), state.alias("state"))
