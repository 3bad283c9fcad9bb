"""The project's tables, as queries read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..session import spread
from ..sources.discovery import shard_parts

SEED = "v1-stable"
#: Tables whose rows hold texts or pages, costly to measure.
WITH_TEXT = {"documents", "wet_records", "extracted_docs", "instruction_examples", "warc_records", "page_fetches"}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    t = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(t) if name in WITH_TEXT else t


def shards_of(spark: SparkSession, d: str) -> DataFrame:
    """The manifest that the enrichment tells of."""
    m = table(spark, d, "enriched_meta").where(F.col("shard_name").isNotNull())
    i = m.groupBy(F.col("shard_name").alias("filename")).agg(F.count("*").alias("records_count"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("token_estimate"))
    return i.withColumn("p", shard_parts(F.col("filename"))).select("filename", "p.source", "p.run_id", "records_count", "bytes", "token_estimate", H.text_hash(F.col("filename")).alias("checksum"), F.lit("").alias("created_at"))
