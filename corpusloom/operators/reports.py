"""Reports on runs, datasets and gates; every one is a plain aggregation and can be run on any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import aggregates as A
from . import filters as L


def run_report(decided: DataFrame, *group: str, domain: str = "domain", score: str = "lid_score", text: str = "text", k: int = 20) -> DataFrame:
    """Per group: sums of :func:`aggregates.run_stats`, maps of reject reasons and of histograms, and the ``k`` domains with most kept rows.

    The score histogram holds kept rows and rejected ones with a positive score, the length histogram kept rows.  Maps are null where they would be
    empty; ties of domains go by name.  All parts are aggregations on the group, so no row is gathered.
    """
    kept, chars = F.col("keep"), F.length(text)
    out = A.run_stats(decided, *group, text=text)

    def counted(rows: DataFrame, key: Column, name: str) -> DataFrame:
        n = rows.select(*group, key.alias("_k")).where(F.col("_k").isNotNull()).groupBy(*group, "_k").agg(F.count("*").alias("_n"))
        return n.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_n")))).alias(name))

    top = decided.where(kept & F.col(domain).isNotNull() & (F.col(domain) != "")).groupBy(*group, F.col(domain).alias("domain")).agg(F.count("*").alias("docs"))
    ordered = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("docs")).alias("_o"), "domain", "docs"))), 1, k), lambda x: F.struct(x["domain"].alias("domain"), x["docs"].alias("docs")))
    parts = [
        counted(decided.where(~kept), F.col("reason"), "reject_reasons"),
        counted(decided.where(kept | (F.col(score) > 0)), A.bucket(F.coalesce(F.col(score), F.lit(0.0)), A.LID_BINS), "lid_score_histogram"),
        counted(decided.where(kept), A.bucket(chars, A.LENGTH_BINS), "doc_length_histogram"),
        A.first_of_each(top, list(group), k).groupBy(*group).agg(ordered.alias("top_domains_kept")),
    ]
    for p in parts:
        p = p.withColumnsRenamed({c: f"_g_{c}" for c in group})
        out = out.join(p, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group], "left").drop(*(f"_g_{c}" for c in group)) if group else out.join(p)
    return out


def dataset_meta(index: DataFrame, dataset: str, version: str) -> DataFrame:
    """One row: sorted sources, shards, records and tokens of a dataset's index."""
    zero = F.lit(0).cast("long")
    return index.agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.count("*").alias("total_shards"), F.coalesce(F.sum("records"), zero).alias("total_records"), F.coalesce(F.sum("token_estimate"), zero).alias("total_token_estimate")
    ).select(F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), "*")


def dedup_report(decided: DataFrame, shard: str = "shard", source: str = "source") -> DataFrame:
    """Of all rows and per source (``level``): documents, unique ones, exact and near duplicates, their share, shards and shards with duplicates.

    ``decided`` has a ``reason`` as the deduplications give it; a null source is its own.
    """
    dup = F.col("reason") != "keep"
    g = decided.groupingSets([[], [source]], source).agg(
        F.grouping_id().alias("_g"), F.count("*").alias("total_docs"), F.count_if(~dup).alias("unique_docs"), F.count_if(F.col("reason") == "reject.dedup.exact").alias("exact_dupes"),
        F.count_if(F.col("reason") == "reject.dedup.fuzzy").alias("fuzzy_dupes"), F.count_distinct(shard).alias("shards_processed"), F.count_distinct(F.when(dup, F.col(shard))).alias("shards_with_dupes"),
    )
    return g.select(
        F.when(F.col("_g") == 1, "all").otherwise("source").alias("level"), F.col(source).alias("source"), "total_docs", "unique_docs", "exact_dupes", "fuzzy_dupes",
        A.ratio(F.col("exact_dupes") + F.col("fuzzy_dupes"), F.col("total_docs")).alias("dedup_ratio"), "shards_processed", "shards_with_dupes",
    )


def near_duplicate_stats(kept: DataFrame, threshold: float, permutations: int) -> DataFrame:
    """One row about a near-duplicate pass (``kept`` has a boolean of that name): records that stand in the index, dropped ones, and its settings."""
    return kept.agg(F.count_if("kept").alias("size"), F.count_if(~F.col("kept")).alias("dropped")).select("*", F.lit(threshold).alias("threshold"), F.lit(permutations).cast("long").alias("num_perm"))


def import_report(decided: DataFrame, text: str = "text") -> DataFrame:
    """One row: seen, kept, characters kept, keep rate in four digits, reject reasons as a map."""
    one = decided.agg(F.count("*").alias("docs_seen"), F.count_if("keep").alias("docs_kept"), F.coalesce(F.sum(F.when(F.col("keep"), F.length(text))), F.lit(0)).alias("total_kept_chars"))
    why = A.reasons(decided).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reject_reasons"))
    return one.join(why).select("docs_seen", "docs_kept", "total_kept_chars", A.ratio(F.col("docs_kept"), F.col("docs_seen")).alias("keep_rate"), "reject_reasons")


def harvest_stats(decided: DataFrame, *group: str) -> DataFrame:
    """Per group: what a harvest processed and kept, and how many rows each gate of quality turned down."""
    r = F.col("reason")
    named = {"lid_not_rw": "reject.lid.not_rw", "lid_low_confidence": "reject.lid.low_confidence", "pdf_extraction_failed": "reject.pdf_extraction_failed", "extraction_failed": "reject.extraction_failed"}
    return decided.groupBy(*group).agg(
        F.count("*").alias("total_processed"), F.count_if("keep").alias("kept"), F.count_if(F.startswith(r, F.lit("reject.dedup"))).alias("duplicates"), *(F.count_if(r == v).alias(k) for k, v in named.items()),
        F.count_if(F.startswith(r, F.lit("reject.filter."))).alias("filter_rejections"),
    )


def class_counts(df: DataFrame, kind: str = "kind") -> DataFrame:
    """URLs per class."""
    return df.groupBy(F.col(kind).alias("url_class")).agg(F.count("*").alias("n"))


def shard_checks(lines: DataFrame, name: str = "file_name", line: str = "value") -> DataFrame:
    """Per file of JSON lines: records, characters of ``text``, estimated tokens, lines that are no JSON objects; blank lines don't count."""
    text = F.get_json_object(line, "$.text")
    rows = lines.where(F.trim(line) != "").withColumn("_ok", F.coalesce(F.try_parse_json(line).isNotNull() & F.startswith(F.ltrim(line), F.lit("{")), F.lit(False)))
    out = rows.groupBy(F.col(name).alias("filename")).agg(F.count_if("_ok").alias("records"), F.coalesce(F.sum(F.when(F.col("_ok"), F.length(text))), F.lit(0)).alias("total_chars"), F.count_if(~F.col("_ok")).alias("bad_lines"))
    return out.withColumn("token_estimate", F.floor(F.col("total_chars") / T.CHARS_PER_TOKEN).cast("long"))


def tokenizer_report(tokenized: DataFrame, group: str, unknown: int | None, vocabulary: int, most_unknown: float = 0.001, least_chars: int = 50) -> DataFrame:
    """Per group: what a tokenizer makes of its texts.  ``tokenized`` has ``text`` and ``ids`` (an array of token ids, from whatever tokenizer).

    Texts below ``least_chars`` and those without tokens don't count.  ``unk_rate`` is the share of ``unknown`` ids, ``vocab_coverage`` the share of the
    vocabulary that occurs; ``flagged`` tells that the rate is above ``most_unknown``.  Distinct ids are aggregated per group and id, never listed.
    """
    rows = tokenized.where((F.length("text") >= least_chars) & (F.size("ids") > 0)).withColumn("_u", F.size(F.filter("ids", lambda i: i == (-1 if unknown is None else unknown))))
    sums = rows.groupBy(group).agg(F.count("*").alias("docs_tokenized"), F.sum(F.size("ids")).alias("total_tokens"), F.sum(F.length("text")).alias("total_chars"), F.sum("_u").alias("total_unk_tokens"))
    used = rows.select(F.col(group).alias("_g"), F.explode(F.array_distinct("ids")).alias("_id")).distinct().groupBy("_g").agg(F.count("*").alias("unique_tokens_used"))
    both = sums.join(used, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    rate = F.col("total_unk_tokens") / F.col("total_tokens")
    return both.select(
        group, "docs_tokenized", "total_tokens", "total_chars", "total_unk_tokens", F.round(rate, 6).alias("unk_rate"), "unique_tokens_used", F.round(F.col("unique_tokens_used") / vocabulary, 4).alias("vocab_coverage"),
        F.floor(F.col("total_chars") / T.CHARS_PER_TOKEN).cast("long").alias("current_estimate_tokens"), (rate > most_unknown).alias("flagged"),
    )


def label_distribution(df: DataFrame, label: str, k: int = 20) -> DataFrame:
    return A.top(df, label, k)


def yield_gate(df: DataFrame, thresholds: Sequence[float] = (0.50, 0.65, 0.80), default: float = 0.80, low: float = 0.65, profile: L.FilterProfile = L.FilterProfile()) -> DataFrame:
    """``threshold, docs_seen, kept, keep_rate, decision``: what each least confidence would keep, and what that says.

    The length of a text asks for its own confidence too.  ``THRESHOLD_TOO_STRICT`` if ``low`` keeps more than three times what ``default`` does, else
    ``REAL_SCARCITY`` below 50 rows labelled with the language, else ``MODERATE_SCARCITY``.
    """
    from dataclasses import replace

    d = L.decide_keep(df, replace(profile, min_confidence=min(thresholds)))
    labelled = F.col("lang").isin(*profile.languages) & (F.col("reason") != "reject.too_short")
    counts = [F.count_if(F.col("keep") & (F.col("lid_score") >= t)).alias(f"k{i}") for i, t in enumerate(thresholds)]
    one = d.agg(F.count("*").alias("docs_seen"), F.count_if(F.coalesce(labelled, F.lit(False))).alias("_l"), *counts)
    at = lambda t: F.col(f"k{list(thresholds).index(t)}")
    decision = F.when(at(low) > at(default) * 3, "THRESHOLD_TOO_STRICT").when(F.col("_l") < 50, "REAL_SCARCITY").otherwise("MODERATE_SCARCITY")
    stacked = ", ".join(f"{float(t)}D, k{i}" for i, t in enumerate(thresholds))
    rows = one.withColumn("decision", decision).selectExpr("docs_seen", "decision", f"stack({len(thresholds)}, {stacked}) AS (threshold, kept)")
    return rows.select("threshold", "docs_seen", "kept", A.ratio(F.col("kept"), F.col("docs_seen"), 8).alias("keep_rate"), "decision")


def identifier_gate(df: DataFrame, truth: str, said: str, second: str, gap: str, target: str = "kin_Latn", close: str = "run_Latn") -> DataFrame:
    """One row: precision, recall and F1 of the target language, how often and how closely the neighbour language comes second, and whether to include it.

    Rows without a truth don't count.  The neighbour is included if more than a twentieth of the rows are in it.
    """
    rows = df.where(F.coalesce(F.col(truth), F.lit("")) != "")
    out = A.precision_recall(rows, F.col(said) == target, F.col(truth) == target)
    is_second = F.col(second) == close
    extra = rows.agg(F.count("*").alias("labeled"), F.count_if(is_second).alias("second"), F.avg(F.when(is_second, F.col(gap))).alias("_gap"), F.count_if(F.col(truth) == close).alias("neighbours"))
    return out.join(extra).select(
        *out.columns, "labeled", A.ratio(F.col("second"), F.col("labeled")).alias("second_rate"), A.half_even(F.coalesce("_gap", F.lit(0.0)), 4).alias("mean_gap"), "neighbours",
        F.when(F.col("neighbours") > F.col("labeled") * 0.05, "INCLUDE").otherwise("EXCLUDE").alias("suggestion"),
    )


def report_lines(reports: DataFrame, col: str, k: int = 10) -> DataFrame:
    """``run_id, key, n``: the ``k`` largest entries of a map of counters per report, ties by key."""
    rows = reports.select("run_id", F.explode(col).alias("key", "n"))
    return A.first_of_each(rows.groupBy("run_id", "key").agg(F.max("n").alias("n")), ["run_id"], k, F.desc("n"), F.col("key"))
