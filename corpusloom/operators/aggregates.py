"""Run statistics, histograms, dataset statistics, quality gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Histogram bounds of language scores and of text lengths.
LID_BINS = (0.80, 0.85, 0.90, 0.95, 1.0)
LENGTH_BINS = (200, 500, 1000, 2000, 5000, 10000)


def bucket(value: Column, bins: Sequence[float]) -> Column:
    """The label of the half-open interval a value is in."""
    c = F.when(value < bins[0], f"<{bins[0]}")
    for a, b in zip(bins, bins[1:]):
        c = c.when(value < b, f"{a}-{b}")
    return c.when(value >= bins[-1], f">={bins[-1]}")


def histogram(df: DataFrame, value: Column, bins: Sequence[float]) -> DataFrame:
    """``bucket, n`` without empty buckets; nulls are left out."""
    return df.where(value.isNotNull()).groupBy(bucket(value, bins).alias("bucket")).agg(F.count("*").alias("n"))


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    """a / b, 0 where b is."""
    return half_even(F.coalesce(F.try_divide(a, b), F.lit(0.0)), digits)


def run_stats(decided: DataFrame, *group: str, text: str = "text") -> DataFrame:
    """Per group (or over all): seen, kept, characters of ``text`` kept, keep ratio, mean length, estimated tokens."""
    kept = F.col("keep")
    chars = F.sum(F.when(kept, F.length(text)).otherwise(0))
    out = decided.groupBy(*group).agg(F.count("*").alias("docs_seen"), F.count_if(kept).alias("docs_kept"), F.coalesce(chars, F.lit(0)).alias("chars_kept"))
    return out.select(
        *group, "docs_seen", "docs_kept", "chars_kept", ratio(F.col("docs_kept"), F.col("docs_seen")).alias("keep_ratio"), ratio(F.col("chars_kept"), F.col("docs_kept"), 1).alias("avg_chars_kept"),
        F.floor(F.col("chars_kept") / 2.55).cast("long").alias("token_estimate"),
    )


def reasons(decided: DataFrame) -> DataFrame:
    """Records per reject reason."""
    return decided.where(~F.col("keep")).groupBy("reason").agg(F.count("*").alias("n"))


def top(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k commonest values, ties by value."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def first_of_each(df: DataFrame, group: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group (by default those with most ``docs``, ties by ``domain``); groups are cut before the shuffle."""
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(*(order or (F.desc("docs"), F.col("domain"))))
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def combine_reports(reports: DataFrame) -> DataFrame:
    """One row over all reports: sums, mean characters weighted by kept documents, distinct configurations."""
    w = F.sum(F.col("avg_doc_chars_kept") * F.col("docs_kept"))
    sums = ("docs_seen", "docs_kept", "docs_deduped", "bytes_written", "shards_written", "token_estimate_total")
    return reports.agg(
        F.count("*").alias("reports"), F.countDistinct("run_id").alias("runs"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums),
        ratio(w, F.sum(F.when(F.col("avg_doc_chars_kept").isNotNull(), F.col("docs_kept"))), 1).alias("avg_doc_chars_kept"), F.countDistinct("config_fingerprint").alias("configs"),
        (F.countDistinct("config_fingerprint") <= 1).alias("config_consistent"),
    )


def combine_maps(reports: DataFrame, col: str) -> DataFrame:
    """``key, n``: a map column of counters added up over all reports."""
    return reports.select(F.explode(col).alias("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))


def combine_domains(reports: DataFrame, k: int = 30) -> DataFrame:
    """The k domains with most kept documents over all reports, ties by name."""
    d = reports.select(F.explode("top_domains_kept").alias("d")).groupBy(F.col("d.domain").alias("domain")).agg(F.sum("d.docs").alias("docs"))
    return d.orderBy(F.desc("docs"), "domain").limit(k)


def dataset_stats(index: DataFrame) -> DataFrame:
    """Shards, bytes, records and tokens over all, per source and per run in one pass."""
    g = index.groupingSets([[], ["source"], ["run_id"]], "source", "run_id")
    return g.agg(
        F.grouping_id().alias("grouping"), F.count("*").alias("shards"), F.sum("bytes").alias("bytes"), F.sum("records").alias("records"), F.sum("token_estimate").alias("tokens")
    ).select(F.when(F.col("grouping") == 3, "all").when(F.col("grouping") == 1, "source").otherwise("run").alias("level"), "source", "run_id", "shards", "bytes", "records", "tokens")


def percentiles(df: DataFrame, value: Column, *group: str) -> DataFrame:
    """Count, mean and the values at the index positions n/20, n/4, n/2, 3n/4, 19n/20 of the sorted values (no interpolation), all in four digits."""
    from .dedup import ranked

    # positions come from ranks, so no group's values are collected into one row or task
    r = ranked(df.where(value.isNotNull()).select(*group, value.alias("v")), list(group), F.col("v")).withColumnsRenamed({"rank": "i", "size": "n"})
    at = lambda q: half_even(F.max(F.when(F.col("i") == q, F.col("v"))), 4)
    n = F.col("n")
    return r.groupBy(*group).agg(
        F.count("*").alias("n"), half_even(F.min("v"), 4).alias("min"), at(F.floor(n * 5 / 100)).alias("p5"), at(F.floor(n / 4)).alias("p25"), at(F.floor(n / 2)).alias("median"),
        at(F.floor(n * 3 / 4)).alias("p75"), at(F.floor(n * 95 / 100)).alias("p95"), half_even(F.max("v"), 4).alias("max"), half_even(F.avg("v"), 4).alias("mean"),
    )


def yields(df: DataFrame, label: Column, score: Column, target: tuple[str, ...], thresholds: Sequence[float] = (0.5, 0.65, 0.8)) -> DataFrame:
    """Records that would be kept at each threshold of the language score."""
    hit = F.coalesce(label.isin(*target), F.lit(False))
    one = df.agg(F.count("*").alias("docs"), *(F.count_if(hit & (score >= t)).alias(f"k{i}") for i, t in enumerate(thresholds)))
    pairs = ", ".join(f"{float(t)}D, k{i}" for i, t in enumerate(thresholds))
    return one.selectExpr("docs", f"stack({len(thresholds)}, {pairs}) AS (threshold, kept)").select("threshold", "docs", "kept", ratio(F.col("kept"), F.col("docs"), 6).alias("yield"))


def precision_recall(df: DataFrame, said: Column, truth: Column) -> DataFrame:
    """One row: counts of the four cases, precision, recall, F1, each 0 where undefined."""
    s, t = F.coalesce(said, F.lit(False)), F.coalesce(truth, F.lit(False))
    c = df.agg(F.count_if(s & t).alias("tp"), F.count_if(s & ~t).alias("fp"), F.count_if(~s & t).alias("fn"), F.count_if(~s & ~t).alias("tn"))
    return c.select(
        "*", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )
