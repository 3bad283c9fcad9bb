"""Incremental runs: new files through the keep decision and deduplication against what earlier batches kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from ..functions import hashing as H
from ..operators.dedup import keep_first, new_records
from ..operators.config import Guardrails
from ..operators.filters import FilterProfile, decide_keep


class StopRun(Exception):
    """A limit was reached; the batch that would come next isn't begun, and the next run goes on with it."""


def ingest(spark: SparkSession, folder: str, schema, out: str, checkpoint: str, profile: FilterProfile = FilterProfile(), files_per_batch: int = 100, most_records_per_file: int = 1_000_000, limits: Guardrails | None = None):
    """Stream records (Parquet files of ``doc_id, text, lang, lid_score, ...`` as they arrive in ``folder``) into ``out/kept`` and ``out/rejected``.

    Each batch drops texts that it or an earlier batch has kept before, compared as normalized; hashes of kept texts stand in ``out/hashes``, partitioned by batch, and
    a batch that is run again after a failure replaces its own partition, so results don't depend on failures.  A batch decides once (its decisions are persisted) and scans
    the hash column of the history against its own hashes, so the history is never shuffled.  ``limits`` stop the run between batches.  Returns the query, which ends when no
    file is left or a limit is reached.
    """

    def batch(df: DataFrame, epoch: int) -> None:
        if limits is not None and (why := limits.reached()):
            raise StopRun(why)
        s = df.sparkSession
        decided = decide_keep(df, profile).withColumn("sha256", H.text_hash(F.col("normalized_text"))).drop("normalized_text").persist(StorageLevel.DISK_ONLY)
        try:
            seen = s.read.schema("sha256 string, epoch bigint").parquet(f"{out}/hashes").where(F.col("epoch") != epoch).select("sha256")
        except AnalysisException:  # the first batch
            seen = s.createDataFrame([], "sha256 string")
        first = keep_first(decided.where(F.col("keep")), F.col("sha256"), F.col("doc_id"))
        kept = new_records(first, seen.join(first.select("sha256"), "sha256", "left_semi")).withColumn("epoch", F.lit(epoch).cast("bigint"))
        write = lambda d, to: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", most_records_per_file).partitionBy("epoch").parquet(f"{out}/{to}")
        write(kept, "kept")
        write(decided.where(~F.col("keep")).withColumn("epoch", F.lit(epoch).cast("bigint")), "rejected")
        # the hashes come last: a batch counts as done with them
        write(read_kept(s, out, df.schema).where(F.col("epoch") == epoch).select("sha256", "epoch"), "hashes")
        if limits is not None:
            limits.add(items=decided.count())
        decided.unpersist()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_kept(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """What :func:`ingest` kept of records of ``schema``, with ``sha256`` and ``epoch``; no rows if it kept none."""
    kept = StructType([f for f in schema.fields if f.name not in ("reason", "keep")]).add("reason", "string").add("keep", "boolean").add("sha256", "string").add("epoch", "long")
    return spark.read.schema(kept).parquet(f"{out}/kept")


def event_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and values per window and type; the same on a stream and on a table."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("window_start"), "event_type", "n", "value")


#: Levels after which the visited URLs are written as one table, so that plans stay small on deep graphs.
COMPACT_LEVELS = 10


def crawl(links: DataFrame, seeds: DataFrame, allowed: DataFrame, most_pages: int | None = None, most_per_domain: int | None = None) -> DataFrame:
    """``url, depth``: breadth-first frontier over known links (``url, target``) from ``seeds`` (``url``) within ``allowed`` domains (``domain``).

    A URL is visited once, at its least depth; levels follow each other until one is empty.  ``most_per_domain`` and ``most_pages`` bound the pages of
    a domain and of the whole crawl, not of a level; None is no bound.  Where a bound cuts a level, a domain's URLs go in the order of their names and
    domains take turns.  A domain stays full, so what its bound cuts is never visited.  Every level is a written table.
    """
    from ..functions import urls as U
    from ..session import stage

    domains = allowed.select("domain").distinct()

    def inside(df: DataFrame) -> DataFrame:
        return df.where(F.col("url").isNotNull()).withColumn("domain", U.domain(F.col("url"))).join(domains, "domain", "left_semi").distinct()

    known = links.select(U.normalize_absolute(F.col("url")).alias("source"), U.normalize_absolute(F.col("target")).alias("url")).where(F.col("source").isNotNull())
    known = stage(inside(known), "frontier-links")
    found = inside(seeds.select(U.normalize_absolute(F.col("url")).alias("url")))
    visited, depth, pages = None, 0, 0
    while True:
        bounds = [n for n in (most_per_domain, None if most_pages is None else most_pages - pages) if n is not None]
        if bounds:
            w = Window.partitionBy("domain").orderBy("url")
            found = found.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= min(bounds))
            if most_per_domain is not None and visited is not None:
                used = visited.groupBy("domain").agg(F.count("*").alias("_used"))
                found = found.join(used, "domain", "left").where(F.col("_n") <= most_per_domain - F.coalesce("_used", F.lit(0)))
            if most_pages is not None:
                found = found.orderBy("_n", "domain").limit(most_pages - pages)
        front = stage(found.select("url", "domain", F.lit(depth).alias("depth")), "frontier")
        visited = front if visited is None else visited.unionByName(front)
        new = front.count()
        pages += new
        if not new or pages == most_pages:
            return visited.select("url", "depth")
        depth += 1
        if depth % COMPACT_LEVELS == 0:
            visited = stage(visited, "frontier-visited")
        next_ = known.join(front.select(F.col("url").alias("source")), "source", "left_semi").select("url", "domain").distinct()
        found = next_.join(visited.select("url"), "url", "left_anti")
