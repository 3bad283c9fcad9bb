"""Queries of the engine's own operators over the project's tables; :mod:`corpusloom.plans.sql` says the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import display as V
from ..functions import hashing as H
from ..functions import markup as M
from ..functions import text as T
from ..functions import urls as U
from ..operators import aggregates as A
from ..operators import dedup as D
from ..operators import filters as L
from ..operators import packaging as P
from ..operators import sections as X
from ..operators import identify as I
from ..operators import reports as Q
from ..session import own_folder, stage
from ..streaming import incremental as S
from .tables import SEED, WITH_TEXT, shards_of  # noqa: F401
from .tables import table as _t

#: Shares of content types in the mixed selection.
TYPE_RATIOS = {"news": 0.15, "government": 0.05, "academic": 0.10, "religious": 0.10, "wiki": 0.10, "other": 0.50}


def _decided(spark: SparkSession, d: str) -> DataFrame:
    return L.decide_keep(_t(spark, d, "wet_records"))


# --- text and filters


def filter_reasons(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.concat_ws(",", L.reject_reasons(F.col("text"))).alias("reasons"))


def filter_reasons_books(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.concat_ws(",", L.reject_reasons(F.col("text"), L.BOOKS)).alias("reasons"))


def text_measures(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select(
        "doc_id", T.word_count(t).alias("words"), T.url_ratio(t).alias("url_ratio"), T.alpha_ratio(t).alias("alpha_ratio"), T.non_latin_ratio(t).alias("non_latin_ratio"),
        T.repeated_line_ratio(t).alias("repeated_lines"), T.token_estimate(t).alias("tokens"),
    )


def ngram_repetition(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.ngram_repetitions(F.col("text")).alias("r")).select("doc_id", "r.*")


def keep_decision(spark, d):
    return _decided(spark, d).select("doc_id", "reason", "keep")


def keep_decision_targeted(spark, d):
    return L.decide_keep(_t(spark, d, "wet_records"), L.TARGETED).groupBy("reason").agg(F.count("*").alias("n"))


def normalized_text(spark, d):
    n = T.normalize_text(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", H.text_hash(n).alias("sha256"), F.length(n).alias("chars"))


def collapsed_text(spark, d):
    n = T.collapse(F.col("text"))
    return _t(spark, d, "extracted_docs").select("doc_id", H.text_hash(n).alias("sha256"), F.length(n).cast("long").alias("chars")).distinct()


def frame_lines_removed(spark, d):
    return _t(spark, d, "extracted_docs").select("doc_id", F.length(T.without_frame_lines(F.col("text"))).cast("long").alias("chars")).distinct()


def shingle_counts(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.size(T.word_shingles(F.col("text"))).cast("long").alias("shingles"))


def index_language_scan(spark, d):
    e = _t(spark, d, "extracted_docs")
    return e.where(L.index_language(F.col("lang"), F.col("url"), "kin_Latn", ".gov.")).select("doc_id", F.coalesce("url", F.lit("")).alias("url"), "lang").distinct()


def instruction_reasons(spark, d):
    return _t(spark, d, "instruction_examples").select("id", L.instruction_reason(F.col("prompt"), F.col("response")).alias("reason"))


def pair_reasons(spark, d):
    """Reasons over candidate pairs of pages, joined to the pages of both sides by their URLs.

    No page of these tables names its other language, so candidates stand in: the n-th WET page of a domain (by URL) with the n-th extracted page of it.
    Every page that has such a counterpart is tested; the score of the second side is the quality that its enrichment gives.
    """
    w = _t(spark, d, "wet_records").where(F.col("url").isNotNull()).select("url", "text", "lang", "lid_score")
    rw = D.keep_first(w, F.col("url"), F.col("text"), F.col("lang"), F.col("lid_score"))
    e = D.keep_first(_t(spark, d, "extracted_docs").where(F.col("url").isNotNull()), F.col("url"), F.col("doc_id"), F.col("fetched_at"), F.col("text")).select("url", "doc_id", "text", "lang")
    score = _t(spark, d, "enriched_meta").where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality_score").alias("score"))
    en = e.join(score, "doc_id", "left").select(F.col("url").alias("url_en"), F.col("text").alias("en"), F.col("lang").alias("en_lang"), "score")
    place = lambda t, name: D.ranked(t.select(U.domain(F.col("url")).alias("domain"), "url"), ["domain"], F.col("url")).select("domain", "rank", F.col("url").alias(name))
    candidates = place(rw, "url").join(place(e, "url_en"), ["domain", "rank"]).select("url", "url_en")
    pages = candidates.join(rw, "url").join(en, "url_en")
    r = L.pair_reason(F.col("text"), F.col("en"), F.col("lang"), F.col("lid_score"), F.col("en_lang"), F.col("score"))
    return pages.groupBy(r.alias("reason")).agg(F.count("*").alias("n"))


# --- hashes, URLs


def example_ids(spark, d):
    return _t(spark, d, "instruction_examples").select("id", H.example_id(F.col("source"), F.col("prompt"), F.col("response")).alias("example_id"))


def url_parts(spark, d):
    u = F.col("url")
    return _t(spark, d, "extracted_docs").select(
        "url", U.domain(u).alias("domain"), U.section(u).alias("section"), U.kind(u).alias("kind"), U.portal_section(u).alias("portal_section"), U.normalize_absolute(u).alias("normalized")
    ).distinct()


def url_safety(spark, d):
    """Whether a URL may be fetched, and whether the place that its fetch ended at is allowed, each by the domain of its own host."""
    allowed = _t(spark, d, "wet_records").where(F.col("domain").isNotNull()).select("domain").distinct()
    u = _t(spark, d, "page_fetches").select("capture_id", "url", "final_url").distinct()
    u = U.on_allowlist(U.on_allowlist(u, "url", allowed, "ok"), "final_url", allowed, "final_ok")
    return u.select("capture_id", U.safety(F.col("url"), F.col("ok")).alias("safety"), U.redirect_safety(F.col("url"), F.col("final_url"), F.col("final_ok")).alias("redirect")).distinct()


def capture_urls(spark, d):
    p = _t(spark, d, "page_fetches").where(F.col("capture_ts").isNotNull())
    return p.select("capture_id", U.capture_url(F.col("capture_ts"), F.col("url")).alias("capture_url"), U.done_key(F.col("url"), F.col("capture_ts")).alias("done_key")).distinct()


def page_links(spark, d):
    """All links of all pages, each capture once."""
    p = _t(spark, d, "page_fetches").where(F.col("ok")).select("capture_id", "url", F.coalesce("content", "html_bytes").alias("body"))
    p = p.unionByName(_t(spark, d, "warc_records").where(F.col("ok")).select("capture_id", F.col("target_url").alias("url"), "body"))
    p = D.keep_first(p, F.col("capture_id"), F.xxhash64("url", "body"))
    return p.select("capture_id", F.posexplode(M.extract_links(F.col("body"), F.col("url"))).alias("pos", "target"))


def language_pairs(spark, d):
    """Language versions of all fetched pages.  None of them names one, so a part of the path or query that does is put into two of three URLs."""
    p = _t(spark, d, "page_fetches").where(F.col("ok") & F.col("url").isNotNull()).select("capture_id", "url", F.coalesce("content", "html_bytes").alias("body"))
    p = D.keep_first(p, F.col("capture_id"), F.xxhash64("url", "body"))
    url = F.when(F.col("capture_id") % 3 == 0, F.regexp_replace("url", r"^([a-z]+://[^/]+)/", "$1/rw/")).when(F.col("capture_id") % 3 == 1, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("?lang=en"))).otherwise(F.col("url"))
    return p.select("capture_id", M.language_pair(F.col("body"), url).alias("p")).where(F.col("p.method").isNotNull()).select("capture_id", "p.*")


def language_sections(spark, d):
    """What is Kinyarwanda of each document, block by block, by the core's identifier."""
    model = I.fit_words(_t(spark, d, "lid_reference"))
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return X.language_sections(docs, "doc_id", "text", lambda b: I.predict(b, model, "block")).select("doc_id", F.length("text").cast("long").alias("chars"))


def identified_languages(spark, d):
    """The two likeliest languages of each document and the gap between them."""
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", "text")
    return I.predict(docs, I.fit_words(_t(spark, d, "lid_reference"))).drop("text")


def retried_sections(spark, d):
    """Documents that pass only in parts: by language of the whole, how many have sections, and their characters."""
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", "text")
    s = I.with_sections(docs, I.fit_words(_t(spark, d, "lid_reference")), "doc_id", "text")
    return s.groupBy("lang").agg(F.count("*").alias("docs"), F.count("sections").alias("with_sections"), F.coalesce(F.sum(F.length("sections")), F.lit(0)).alias("chars"))


def warc_outcomes(spark, d):
    w = _t(spark, d, "warc_records")
    return w.groupBy("warc_type", "http_status", "ok", "error", F.element_at("http_headers", "content-type").alias("content_type")).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("bytes"))


# --- joins and deduplication


def exact_dedup(spark, d):
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull())
    return D.exact_dedup(docs, F.col("text"), F.col("doc_id")).select("doc_id", "sha256", "reason")


def exact_dedup_across_runs(spark, d):
    seen = _t(spark, d, "wet_records").where(F.col("text").isNotNull() & F.col("keep")).select(H.text_hash(F.col("text")).alias("sha256"))
    docs = _t(spark, d, "extracted_docs").where(F.col("text").isNotNull())
    return D.exact_dedup(docs, F.col("text"), F.col("doc_id"), F.col("fetched_at"), seen=seen).groupBy("source", "reason").agg(F.count("*").alias("n"))


def fuzzy_dedup(spark, d):
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull())
    return D.fuzzy_dedup(docs, "doc_id", "text", "doc_id")


def combined_dedup(spark, d):
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull())
    return D.combined_dedup(docs, "doc_id", "text", "doc_id")


def pair_dedup(spark, d):
    e = _t(spark, d, "instruction_examples").select("id", "created_at", "prompt", "response").distinct()
    return D.pair_dedup(e, F.col("prompt"), F.col("response"), F.col("id")).select("id", "pair_hash", "duplicate")


def capped_sides(spark, d):
    e = D.keep_first(_t(spark, d, "instruction_examples").where(F.col("prompt").isNotNull() & F.col("response").isNotNull()), F.col("id"), F.col("prompt"), F.col("response"))
    return D.capped_sides(e.select("id", "prompt", "response"), "prompt", "response", "id", most=2).select("id", "accepted")


def pending_ids(spark, d):
    return _t(spark, d, "fuzzy_docs").select("doc_id", "source").join(_t(spark, d, "wet_records").where(F.col("text").isNotNull()).select("doc_id"), "doc_id", "left_anti")


def newest_meta(spark, d):
    return D.keep_last(_t(spark, d, "enriched_meta").select("doc_id", "enriched_at", "domain", "content_type"), "doc_id", "enriched_at").select("doc_id", "domain", "content_type")


def latest_captures(spark, d):
    """The newest archive capture of each URL that has several; a minute's captures count as of one time, and of those the first seen counts."""
    p = _t(spark, d, "page_fetches").where(F.col("capture_ts").isNotNull() & F.col("url").isNotNull()).select("url", F.substring("capture_ts", 1, 8).alias("capture_ts"), "capture_id")
    return D.latest_capture(p)


def shard_documents(spark, d):
    """Index of shards beside the documents they should hold, those without any too."""
    m = _t(spark, d, "enriched_meta").select("doc_id", "shard_name").distinct()
    e = _t(spark, d, "extracted_docs").select("doc_id").distinct().withColumn("there", F.lit(1))
    return m.join(e, "doc_id", "left").groupBy("shard_name").agg(F.count("*").alias("listed"), F.coalesce(F.sum("there"), F.lit(0)).alias("found"))


# --- aggregations


def run_stats(spark, d):
    return A.run_stats(_decided(spark, d), "run_id", text="normalized_text")


def domain_yield(spark, d):
    """Yield of each domain, those with most records first."""
    return A.run_stats(_decided(spark, d).where(F.col("domain").isNotNull()), "domain", text="normalized_text").select("domain", "docs_seen", "docs_kept", "chars_kept").orderBy(F.desc("docs_seen"), "domain")


def _entries(c: str):
    """A map of counters as text, in order of keys."""
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","), F.lit(""))


def run_reports_built(spark, d):
    """The report of every run, maps as text."""
    r = Q.run_report(_decided(spark, d), "run_id", text="normalized_text")
    tops = F.coalesce(F.array_join(F.transform("top_domains_kept", lambda x: F.concat(x["domain"], F.lit("="), x["docs"].cast("string"))), ","), F.lit(""))
    maps = ("reject_reasons", "lid_score_histogram", "doc_length_histogram")
    return r.select("run_id", "docs_seen", "docs_kept", "avg_chars_kept", *(_entries(c).alias(c) for c in maps), tops.alias("top_domains_kept"))


def import_reports(spark, d):
    """Report of an import: all records as one dataset."""
    return Q.import_report(_decided(spark, d), "normalized_text").withColumn("reject_reasons", _entries("reject_reasons"))


def harvest_stats(spark, d):
    return Q.harvest_stats(_decided(spark, d), "source")


def yield_gate(spark, d):
    return Q.yield_gate(_t(spark, d, "wet_records"))


def labelled_scores(spark, d):
    """Distribution of the scores of records labelled with the language."""
    w = _t(spark, d, "wet_records").where(F.col("lang").isin("kin_Latn", "rw"))
    return A.percentiles(w, F.col("lid_score")).drop("p5", "p95")


def top_labels(spark, d):
    return Q.label_distribution(_t(spark, d, "wet_records"), "lang")


def identifier_gate(spark, d):
    """The core's identifier, fitted to the reference, against the labels of the subject texts."""
    texts = _t(spark, d, "subject_reference").select("ref_id", "text", F.col("lang").alias("truth"))
    said = I.predict(texts, I.fit_words(_t(spark, d, "lid_reference")))
    return Q.identifier_gate(said, "truth", "lang", "lang_2", "gap")


def tokenizer_report(spark, d):
    """Characters as tokens; those beyond Latin Extended-A are the unknown token."""
    ids = F.transform(F.split("text", ""), lambda c: F.when(F.ascii(c) > 383, 0).otherwise(F.ascii(c)))
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull()).select("source", "text", ids.alias("ids"))
    return Q.tokenizer_report(docs, "source", 0, 384)


def dataset_meta(spark, d):
    """The dataset's description from its index."""
    m = Q.dataset_meta(P.build_index(shards_of(spark, d), "pretrain", "corpus/v1", "store"), "pretrain", "v1")
    return m.withColumn("sources", F.array_join("sources", ","))


def near_duplicate_stats(spark, d):
    """Size of the near-duplicate index beside all documents: only that nothing is lost can be said in SQL."""
    s = Q.near_duplicate_stats(fuzzy_dedup(spark, d), 0.8, 128)
    return s.select((F.col("size") + F.col("dropped")).alias("documents"), "threshold", "num_perm")


def discovered_classes(spark, d):
    """URLs of the portal's kind per class."""
    e = _t(spark, d, "extracted_docs").where(F.col("url").isNotNull()).select("url").distinct()
    return Q.class_counts(e.withColumn("kind", U.kind(F.col("url"), portal=True)))


def report_tops(spark, d):
    """The ten commonest reject reasons of each run."""
    return Q.report_lines(_t(spark, d, "run_reports"), "reject_reasons")


def run_ages(spark, d):
    """How long ago each run began, at one fixed time, and what it wrote, for people."""
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    r = _t(spark, d, "run_reports").select("run_id", "started_at", "bytes_written").distinct()
    return r.select("run_id", V.age_text(F.col("started_at"), now).alias("age"), V.bytes_text(F.col("bytes_written")).alias("written"))


def first_of_prompts(spark, d):
    """The first field of an example that holds text, response before prompt, and the estimate of both."""
    e = _t(spark, d, "instruction_examples").where(F.col("id").isNotNull())
    return e.select("id", F.sha2(F.coalesce(T.first_text(F.col("response"), F.col("prompt")), F.lit("")), 256).alias("first"), T.estimated_tokens_of(F.col("response"), F.col("prompt")).alias("tokens")).distinct()


def instruction_languages(spark, d):
    """Examples whose response isn't in the target language, by the core's identifier."""
    e = _t(spark, d, "instruction_examples").where(F.col("response").isNotNull()).select("id", "response").distinct()
    said = I.predict(e, I.fit_words(_t(spark, d, "lid_reference")), "response")
    return said.groupBy(L.instruction_language_reason(F.col("lang"), F.col("score")).alias("reason"), L.garbled(F.col("lang"), F.col("score")).alias("garbled")).agg(F.count("*").alias("n"))


def portal_paths(spark, d):
    """URLs by whether the portal's and the sites' exclusions drop them."""
    u = F.col("url")
    e = _t(spark, d, "extracted_docs").where(u.isNotNull()).select("url").distinct()
    return e.groupBy(U.portal_excluded(u).alias("portal"), U.excluded(u, ("/amakuru",)).alias("site")).agg(F.count("*").alias("n"))


def wiki_addresses(spark, d):
    return _t(spark, d, "extracted_docs").where(F.col("title").isNotNull()).select(U.article_url(F.col("title"), "https://w.example/").alias("url")).distinct()


def reject_reasons(spark, d):
    return A.reasons(_decided(spark, d))


def lid_histogram(spark, d):
    return A.histogram(_t(spark, d, "wet_records").where(F.col("lid_score") > 0), F.col("lid_score"), A.LID_BINS)


def length_histogram(spark, d):
    return A.histogram(_t(spark, d, "documents"), F.length("text"), A.LENGTH_BINS)


def top_domains(spark, d):
    return A.top(_t(spark, d, "wet_records"), "domain", 20)


def combined_reports(spark, d):
    return A.combine_reports(_t(spark, d, "run_reports").dropDuplicates(["run_id", "docs_seen", "docs_kept", "token_estimate_total"]))


def combined_reasons(spark, d):
    return A.combine_maps(_t(spark, d, "run_reports"), "reject_reasons")


def combined_histogram(spark, d):
    return A.combine_maps(_t(spark, d, "run_reports"), "lid_score_histogram")


def combined_domains(spark, d):
    return A.combine_domains(_t(spark, d, "run_reports"))


def dataset_index(spark, d):
    return P.build_index(shards_of(spark, d), "pretrain", "corpus/v1", "store").select("dataset", "run_id", "source", "shard_name", "s3_key", "bytes", "records", "token_estimate", "checksum_sha256")


def dataset_stats(spark, d):
    return A.dataset_stats(P.build_index(shards_of(spark, d), "pretrain", "corpus/v1", "store"))


def token_ratio_percentiles(spark, d):
    m = _t(spark, d, "enriched_meta").where((F.col("token_count") > 0) & F.col("content_type").isNotNull())
    return A.percentiles(m, (F.col("char_count") / F.col("token_count")), "content_type")


def threshold_yields(spark, d):
    return A.yields(_t(spark, d, "wet_records"), F.col("lang"), F.col("lid_score"), ("kin_Latn", "rw"))


def keep_precision(spark, d):
    w = L.decide_keep(_t(spark, d, "wet_records").withColumnRenamed("keep", "truth").drop("reason"))
    return A.precision_recall(w, F.col("keep"), F.col("truth"))


def task_counts(spark, d):
    return _t(spark, d, "instruction_examples").groupBy("task_type").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


# --- packaging


def enriched_documents(spark, d):
    e = _t(spark, d, "wet_records").where(F.col("doc_id").isNotNull())
    return P.enrich(e).distinct()


def splits(spark, d):
    return P.splits(_t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key")), SEED, "key", (0.8, 0.1, 0.1))


def majority_types(spark, d):
    return P.majority_type(_t(spark, d, "enriched_meta"))


def mixed_selection(spark, d):
    types = P.majority_type(_t(spark, d, "enriched_meta"))
    shards = shards_of(spark, d).select(F.col("filename").alias("s3_key"), "token_estimate", F.col("records_count").alias("records")).join(types.withColumnRenamed("shard_name", "s3_key"), "s3_key")
    return P.mixed_selection(shards.select("s3_key", "content_type", "token_estimate", "records"), TYPE_RATIOS, SEED).drop("records")


def mixed_splits(spark, d):
    """The mixed selection dealt into training, validation and test, as files are written: keys in order."""
    return P.splits(mixed_selection(spark, d), SEED).orderBy("split", "s3_key")


def mixed_by_records(spark, d):
    """The same mix of shards without any token count: sizes are records."""
    types = P.majority_type(_t(spark, d, "enriched_meta"))
    shards = shards_of(spark, d).select(F.col("filename").alias("s3_key"), F.lit(0).cast("long").alias("token_estimate"), F.col("records_count").alias("records")).join(types.withColumnRenamed("shard_name", "s3_key"), "s3_key")
    return P.mixed_selection(shards.select("s3_key", "content_type", "token_estimate", "records"), TYPE_RATIOS, SEED).select("s3_key", "content_type", "records")


def packed_sequences(spark, d):
    """Characters as tokens, so that the packing itself can be checked."""
    shard = F.concat_ws("-", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 5000))
    docs = _t(spark, d, "documents").where(F.length("text") > 0).select(shard.alias("shard"), "doc_id", F.transform(F.split("text", ""), lambda c: F.ascii(c)).alias("ids"))
    return P.pack_sequences(docs, "shard", "doc_id", "ids", 0).select("shard", "seq_no", "length", F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("checksum"))


def stratified_sample(spark, d):
    docs = _t(spark, d, "documents").where(F.col("domain").isNotNull()).select("doc_id", "domain")
    return P.stratified_sample(docs, "domain", "doc_id", 200)


def interleaved_domains(spark, d):
    docs = _t(spark, d, "documents").where(F.col("domain").isNotNull()).select("doc_id", "domain")
    return P.interleave(docs, "domain", "doc_id", 5, 300)


def seeded_top(spark, d):
    """The first 100 documents of a deterministic shuffle."""
    docs = _t(spark, d, "documents").select("doc_id", H.seeded_order(SEED, F.col("doc_id").cast("string")).alias("place"))
    return docs.orderBy("place").limit(100)


def index_verification(spark, d):
    """The index against a listing that lacks one shard in seven and has another size for one in five."""
    i = P.build_index(shards_of(spark, d), "pretrain", "corpus/v1", "store")
    digit = F.conv(F.substring("checksum_sha256", 1, 6), 16, 10).cast("long")
    listing = i.where(digit % 7 != 0).select(F.col("s3_key").alias("key"), (F.col("bytes") + F.when(digit % 5 == 0, 1).otherwise(0)).alias("size"))
    return P.verify(i, listing)


def dead_letters(spark, d):
    """Failed fetches by reason and whether to try again."""
    p = _t(spark, d, "page_fetches").where(~F.col("ok"))
    return p.groupBy("channel", F.col("error").alias("reason"), (~F.col("error").rlike("^http_4|content_type")).alias("retryable")).agg(F.countDistinct("capture_id").alias("n"))


def all_sources(spark, d):
    """The records of all pipelines under one another."""
    cols = ("source", "lang", "text")
    every = _t(spark, d, "wet_records").select(*cols).unionByName(_t(spark, d, "extracted_docs").select(*cols)).unionByName(_t(spark, d, "documents").select(*cols))
    return every.groupBy("source").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))


def prompts_of_templates(spark, d):
    """Templates by topics: the reference's subjects asked about in every language."""
    r = _t(spark, d, "subject_reference")
    templates = r.select("lang").distinct().select(F.concat(F.lit("["), "lang", F.lit("] {topic}?")).alias("template"))
    topics = r.select("subject").distinct()
    return templates.crossJoin(topics).select(F.replace("template", F.lit("{topic}"), F.col("subject")).alias("prompt"), "subject")


def dedup_report(spark, d):
    """Exact duplicates of documents in all and by source, with shards (of 1,000 ids) that have any; near duplicates are those of the bands' first round."""
    e = exact_dedup(spark, d).join(_t(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return Q.dedup_report(e.withColumn("shard", F.floor(F.col("doc_id") / 1000)))


def global_dedup_report(spark, d):
    """The whole pass, exact and near duplicates, by source."""
    c = combined_dedup(spark, d).join(_t(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return Q.dedup_report(c.withColumn("shard", F.floor(F.col("doc_id") / 1000)))


def fuzzy_checks(spark, d):
    """What must hold of the near-duplicate pass: no two kept documents share a band, every dropped one shares one with an earlier kept one.  Counts of documents and of violations."""
    docs = _t(spark, d, "documents").where(F.col("text").isNotNull())
    kept = stage(D.fuzzy_dedup(docs, "doc_id", "text", "doc_id"), "kept")
    bands = stage(D.signed_bands(docs, "doc_id", "text", "doc_id").select("id", F.explode("bands").alias("bucket")).join(kept.withColumnRenamed("doc_id", "id"), "id"), "bands")
    first = bands.where("kept").groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    per = bands.join(first, "bucket", "left").groupBy("id", "kept").agg(F.max(F.coalesce("n", F.lit(0))).alias("n"), F.max(F.coalesce(F.col("first") < F.col("id"), F.lit(False))).alias("earlier"))
    sums = per.agg(F.count_if(F.col("kept") & (F.col("n") > 1)).alias("kept_sharing"), F.count_if(~F.col("kept") & ~F.col("earlier")).alias("dropped_without"))
    return kept.agg(F.count("*").alias("documents")).join(sums)


def parallel_dedup(spark, d):
    """Pairs of texts, normalized, with at most two accepted pairs per side: in all, how many pairs there are of each kind of copy."""
    e = D.keep_first(_t(spark, d, "instruction_examples").where(F.col("id").isNotNull()), F.col("id"), F.col("created_at"), F.col("prompt"), F.col("response")).select("id", "prompt", "response")
    p = stage(D.parallel_dedup(e, "prompt", "response", "id", most=2), "parallel")
    again = D.first_wins(p, F.col("pair_hash"), F.col("id"))
    ok = F.col("reason") == "ok"
    return again.agg(F.count("*").alias("pairs"), F.count_if("duplicate").alias("repeated"), F.count_if(F.col("duplicate") & ok).alias("repeated_accepted"), F.count_distinct("pair_hash").alias("kinds"))


def latest_events(spark, d):
    return D.keep_last(_t(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")


def first_events(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_type", "ts", "event_id")
    return D.keep_first(e, [F.col("user_id"), F.col("event_type")], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id")


def confidence_needed(spark, d):
    return _t(spark, d, "documents").groupBy(L.required_confidence(F.length("text")).alias("confidence")).agg(F.count("*").alias("n"))


# --- streaming and iteration


def event_windows(spark, d):
    return S.event_counts(_t(spark, d, "events").withColumn("value", F.col("value").cast("decimal(18,4)")))


def streamed_keep(spark, d):
    """The WET records through the streaming ingestion, read back."""
    w = _t(spark, d, "wet_records")
    folder = own_folder(spark, "stream")
    # eight files in batches of three, so that later batches meet what earlier ones kept
    w.repartition(8, "doc_id").write.parquet(f"{folder}/in")
    S.ingest(spark, f"{folder}/in", w.schema, f"{folder}/out", f"{folder}/checkpoint", files_per_batch=3).awaitTermination()
    return S.read_kept(spark, f"{folder}/out", w.schema).select("sha256", "epoch").groupBy("sha256").agg(F.count("*").alias("times"))


def frontier(spark, d):
    """All pages from the first of each site, over links that stand in for theirs: each page links to two of its site, so levels grow with the logarithm of the largest site."""
    urls = _t(spark, d, "extracted_docs").select(U.normalize_absolute(F.col("url")).alias("url")).where(F.col("url").isNotNull()).distinct()
    pages = stage(D.ranked(urls.withColumn("domain", U.domain(F.col("url"))), ["domain"], F.col("url")).select("domain", "url", "rank"), "pages")
    from_ = pages.select("domain", F.col("url").alias("source"), F.col("rank").alias("parent"))
    links = pages.where(F.col("rank") > 0).withColumn("parent", F.floor((F.col("rank") - 1) / 2)).join(from_, ["domain", "parent"]).select(F.col("source").alias("url"), F.col("url").alias("target"))
    return S.crawl(links, pages.where(F.col("rank") == 0).select("url"), pages.select("domain"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        filter_reasons, filter_reasons_books, text_measures, ngram_repetition, keep_decision, keep_decision_targeted, normalized_text, collapsed_text, frame_lines_removed, shingle_counts, index_language_scan,
        identified_languages, retried_sections, run_reports_built, import_reports, harvest_stats, yield_gate, labelled_scores, top_labels, identifier_gate, tokenizer_report, dataset_meta, near_duplicate_stats, discovered_classes,
        report_tops, run_ages, first_of_prompts, instruction_languages, portal_paths, wiki_addresses, mixed_splits, mixed_by_records, global_dedup_report, fuzzy_checks, parallel_dedup,
        instruction_reasons, pair_reasons, example_ids, url_parts, url_safety, capture_urls, page_links, language_pairs, language_sections, warc_outcomes, exact_dedup, exact_dedup_across_runs, fuzzy_dedup, combined_dedup, pair_dedup, capped_sides, pending_ids,
        newest_meta, latest_captures, shard_documents, run_stats, domain_yield, reject_reasons, lid_histogram, length_histogram, top_domains, combined_reports, combined_reasons, combined_histogram,
        combined_domains, dataset_index, dataset_stats, token_ratio_percentiles, threshold_yields, keep_precision, task_counts, enriched_documents, splits, majority_types, mixed_selection, packed_sequences,
        stratified_sample, interleaved_domains, seeded_top, index_verification, dead_letters, all_sources, prompts_of_templates, dedup_report, latest_events, first_events, confidence_needed, event_windows, streamed_keep, frontier,
    ]
    from . import file_queries

    return {f.__name__: f for f in own} | file_queries.queries()
