"""What there is to read: lists of crawls and of their files, shards by source, where a shard lies, importers of datasets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: Where each source's shards lie below the store's root, and where those of an unknown source do.
SOURCE_PREFIX = {
    "commoncrawl": "cc/v1/",
    "targeted_web": "curated/v1/targeted_web/",
    "wayback": "curated/v1/wayback/",
    "cc_index": "curated/v1/cc_index/",
    "books_corpus": "curated/v1/books/",
    "parallel_web": "supervision/v1/parallel/",
    "instructions_rw": "supervision/v1/instructions/",
    "wikipedia": "wiki/v1/",
    "mbazanlp_v01.1": "external/v1/mbazanlp/",
    "kinnews": "external/v1/kinnews/",
}
UNKNOWN_PREFIX = "unknown/"
#: The classes of URLs that a harvest reads, on the portal and on institutions' sites.
HARVESTED_PORTAL = ("news", "pdf", "document", "static")
HARVESTED_SITES = ("page", "pdf", "document")
#: Categories of the news dataset by label.
NEWS_CATEGORIES = ("politics", "sport", "economy", "health", "entertainment", "history", "technology", "tourism", "culture", "fashion", "religion", "environment", "education", "relationship")


def listed(spark: SparkSession, path: str, base: str = "", most: int = 0) -> DataFrame:
    """``url`` of each line of a list that is neither blank nor a ``#`` comment, with ``base`` in front; the first ``most`` if that is positive (the list's own order)."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.trim("value").alias("v")).where((F.col("v") != "") & ~F.startswith("v", F.lit("#")))
    rows = rows.orderBy("ord").limit(most) if most > 0 else rows
    return rows.select(F.concat(F.lit(base), "v").alias("url"))


def crawls(ids: DataFrame, first: str = "", last: str = "", most: int = 0, prefix: str = "CC-MAIN-") -> DataFrame:
    """``id`` of the crawls whose name has the prefix and whose date part is from ``first`` to ``last`` (compared as text, empty is open), newest first."""
    date = F.substr("id", F.lit(len(prefix) + 1))
    kept = ids.where(F.startswith("id", F.lit(prefix)))
    kept = kept.where(date >= first) if first else kept
    kept = kept.where(date <= last) if last else kept
    kept = kept.select("id").distinct().orderBy(F.desc("id"))
    return kept.limit(most) if most > 0 else kept


def index_files(lines: DataFrame, subset: str = "warc") -> DataFrame:
    """``path`` of the columnar index's Parquet files of one subset, in order."""
    p = F.trim("path")
    return lines.where(F.contains(p, F.lit(f"subset={subset}/")) & F.endswith(p, F.lit(".parquet"))).select(p.alias("path")).orderBy("path")


def shard_parts(name: Column) -> Column:
    """``struct(source, run_id)`` of a shard's file name ``<prefix>_<source>_<run>_part-<n>...``; the source may hold underscores."""
    part = lambda n: F.regexp_extract(name, r"^[^_]+_(.+)_([^_]+)_part-", n)
    return F.struct(part(1).alias("source"), part(2).alias("run_id"))


def files_below(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, size`` of all files below a folder; names and sizes only, no content."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return f.select("path", F.col("length").alias("size"))


def resolve_shards(shards: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``path`` to rows of ``shard_name, source, run_id``: the file in ``<source>/<run_id>`` or ``<source>/run_id=<run_id>``, else in a folder of the run, else any of the name (least path); null without one."""
    named = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("shard_name"), "path")
    both = shards.join(named, "shard_name", "left")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    run = F.concat(F.lit("(?:run_id=)?"), F.col("run_id"))
    rank = F.when(folder.isNull(), 3).when(F.regexp_like(folder, F.concat(F.lit("/"), "source", F.lit("/(?:shards/)?"), run, F.lit("$"))), 0).when(F.regexp_like(folder, F.concat(F.lit("/"), run, F.lit("$"))), 1).otherwise(2)
    return both.groupBy(*shards.columns).agg(F.min(F.struct(rank.alias("rank"), "path")).alias("_b")).select(*shards.columns, F.col("_b.path").alias("path"))


def first_rows(df: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group in this order; Catalyst cuts every group before the shuffle."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def looked_up(key: Column, table: dict[str, str], default: str) -> Column:
    """The table's value for a key, the default where it has none."""
    entries = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(F.try_element_at(entries, F.coalesce(key, F.lit(""))), F.lit(default))


def store_prefix(source: Column, root: str = "") -> Column:
    return F.concat(F.lit(root), looked_up(source, SOURCE_PREFIX, UNKNOWN_PREFIX))


def with_mode(df: DataFrame, seeds: DataFrame, domain: str = "domain", default: str = "recall") -> DataFrame:
    """Adds ``mode``: that of the domain's seed, else the default."""
    s = seeds.select(F.col("domain").alias(domain), F.col("mode")).dropDuplicates([domain])
    return df.drop("mode").join(s, domain, "left").withColumn("mode", F.coalesce("mode", F.lit(default)))


def harvested(df: DataFrame, kind: str = "kind", classes: tuple[str, ...] = HARVESTED_SITES) -> DataFrame:
    return df.where(F.col(kind).isin(*classes))


def news_category(label: Column) -> Column:
    """Name of a label of the news dataset; ``unknown_<label>`` outside it."""
    names = F.array(*(F.lit(c) for c in NEWS_CATEGORIES))
    return F.when((label >= 0) & (label < len(NEWS_CATEGORIES)), F.get(names, label)).otherwise(F.concat(F.lit("unknown_"), label.cast("string")))


def title_and_text(title: Column, text: Column) -> Column:
    """Both, a blank line between, or the text alone where the title is blank."""
    t = T.strip(F.coalesce(title, F.lit("")))
    return F.when(t != "", F.concat(t, F.lit("\n\n"), T.strip(text))).otherwise(T.strip(text))


Importer = Callable[[DataFrame], DataFrame]
IMPORTERS: dict[str, Importer] = {}


def register_importer(name: str, load: Importer) -> None:
    """Add a dataset: ``load`` makes ``source_id, text, meta`` of its rows (``row_no`` numbers them from 0 in their order, blank ones included)."""
    IMPORTERS[name] = load


register_importer("mbazanlp_v01.1", lambda d: d.where(T.strip(F.col("text")) != "").select(F.col("row_no").cast("string").alias("source_id"), "text", F.struct(F.lit("01.1").alias("version")).alias("meta")))
register_importer(
    "kinnews",
    lambda d: d.where(T.strip(F.col("content")) != "").select(
        F.col("row_no").cast("string").alias("source_id"), title_and_text(F.col("title"), F.col("content")).alias("text"), F.struct("split", "label", news_category(F.col("label")).alias("category")).alias("meta")
    ),
)


def imported(rows: DataFrame, name: str) -> DataFrame:
    """``source, source_id, text, meta`` (JSON) of a registered dataset's rows."""
    return IMPORTERS[name](rows).select(F.lit(name).alias("source"), "source_id", "text", F.to_json("meta").alias("meta"))


def in_order(parts: list[DataFrame]) -> DataFrame:
    """The rows of several tables (all with ``row_no`` from 0) numbered on from one table to the next."""
    out, before = [], 0
    for p in parts:
        out.append(p.withColumn("row_no", F.col("row_no") + F.lit(before)))
        before += p.count()
    return reduce(DataFrame.unionByName, out)
