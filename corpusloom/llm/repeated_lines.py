"""Lines repeated across the documents of one site (problem 1).

Documents are first collapsed to clusters of equal text within a domain; every line is then counted once per cluster, weighted
by the cluster's number of documents, and by the cluster's publication date.  Text is never shuffled: a document travels as the
array of its 64-bit line keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: Documents of one line that a task of the join back to documents has; a line of more is dealt to as many tasks as that takes.
DOCS_PER_TASK = 200_000


def line_keys(text: Column, min_letters: int) -> Column:
    """One key per line of ``text``: a hash of its lower-case letters, null where it has fewer than ``min_letters``."""
    letters = F.transform(F.split(F.lower(text), "\n"), lambda l: F.regexp_replace(l, r"[^\p{L}]+", ""))
    return F.transform(letters, lambda k: F.when(F.length(k) >= min_letters, F.xxhash64(k)))


def domain_of(domain: Column) -> Column:
    """Lower case, trimmed, without a leading ``www.``; null if blank."""
    d = F.regexp_replace(F.lower(F.trim(domain)), r"^www\.", "")
    return F.when(d != "", d)


def newest_domains(meta: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` of the newest row of each document; the greatest domain wins between rows of the same time."""
    newest = meta.select("doc_id", F.struct("enriched_at", "domain").alias("r")).where(F.col("doc_id").isNotNull())
    return newest.groupBy("doc_id").agg(F.max("r").alias("r")).select("doc_id", domain_of(F.col("r.domain")).alias("domain"))


def fingerprints(docs: DataFrame, meta: DataFrame, min_letters: int) -> DataFrame:
    """One row per document that has a domain: ``doc_id, domain, text_hash, day, keys``; of several deliveries the latest counts."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "fetched_at", F.xxhash64("text").alias("text_hash"), line_keys(F.col("text"), min_letters).alias("keys")
    )
    latest = rows.groupBy("doc_id").agg(F.max_by(F.struct("fetched_at", "text_hash", "keys"), F.struct("fetched_at", "text_hash")).alias("r"))
    return (
        latest.join(newest_domains(meta), "doc_id")
        .where(F.col("domain").isNotNull() & F.col("r.keys").isNotNull())
        .select("doc_id", "domain", F.col("r.text_hash").alias("text_hash"), F.to_date("r.fetched_at").alias("day"), F.col("r.keys").alias("keys"))
    )


def line_statistics(prints: DataFrame) -> DataFrame:
    """Per domain and line key (joined in ``line``): documents, clusters of equal documents, publication days of the clusters."""
    clusters = prints.groupBy("domain", "text_hash").agg(F.count("*").alias("docs"), F.min("day").alias("day"), F.first("keys").alias("keys"))
    lines = clusters.select("docs", "day", "domain", F.explode(F.array_distinct("keys")).alias("key")).where(F.col("key").isNotNull())
    by_day = lines.groupBy(F.xxhash64("domain", "key").alias("line"), "day").agg(F.sum("docs").alias("docs"), F.count("*").alias("clusters"))
    return by_day.groupBy("line").agg(F.sum("docs").alias("docs"), F.sum("clusters").alias("clusters"), F.count("day").alias("days"))


def repeated_lines(docs: DataFrame, meta: DataFrame, min_docs: int = 6, min_clusters: int = 1, min_days: int = 0, min_letters: int = 6) -> DataFrame:
    """Lines that a domain repeats: ``doc_id, line_no, docs, clusters, days``, one row per line of each document that has it.

    ``docs`` needs ``doc_id, text, fetched_at``; ``meta`` needs ``doc_id, domain, enriched_at``; other columns are ignored.
    A line is repeated if at least ``min_docs`` documents, ``min_clusters`` clusters of equal documents and ``min_days``
    publication days of one domain have it.  Lines are numbered from 0 over ``split(text, '\\n')``.

    Null ids, null texts and documents without a domain have no rows; an empty text is one empty line and has none either; a null
    time counts as the earliest; rows delivered again count once; a line twice in a document counts once but is reported twice.
    """
    # counted and joined back: documents are hashed and shuffled once for both
    prints = stage(fingerprints(docs, meta, min_letters), "p1-prints")
    hot = stage(line_statistics(prints).where((F.col("docs") >= min_docs) & (F.col("clusters") >= min_clusters) & (F.col("days") >= min_days)), "p1-lines")
    salts = max(1, -(-(hot.agg(F.max("docs")).first()[0] or 0) // DOCS_PER_TASK))
    hot = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    lines = (
        prints.select("doc_id", "domain", F.posexplode("keys").alias("line_no", "key"))
        .where(F.col("key").isNotNull())
        .select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.xxhash64("domain", "key").alias("line"), F.pmod(F.hash("doc_id"), F.lit(salts)).alias("salt"))
    )
    return lines.join(hot, ["line", "salt"]).select("doc_id", "line_no", "docs", "clusters", "days")


def without_repeated_lines(docs: DataFrame, meta: DataFrame, **limits: int) -> DataFrame:
    """``doc_id, text, removed_lines``: each document's latest text without the lines that :func:`repeated_lines` finds.

    A null text stays null; a document all of whose lines are removed gets an empty text; documents without a domain stay whole.
    """
    found = repeated_lines(docs, meta, **limits).groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "fetched_at", F.xxhash64("text").alias("text_hash"), "text")
    # which delivery counts is told without its text, which then travels once, to its document's lines
    newest = rows.groupBy("doc_id").agg(F.max(F.struct("fetched_at", "text_hash")).alias("r"))
    same = F.col("fetched_at").eqNullSafe(F.col("r.fetched_at")) & F.col("text_hash").eqNullSafe(F.col("r.text_hash"))
    latest = rows.join(newest, "doc_id").where(same).dropDuplicates(["doc_id"]).select("doc_id", "text")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda _, i: ~F.array_contains("gone", i.cast("long")))
    return latest.join(found, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("removed_lines"),
    )
