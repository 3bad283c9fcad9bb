"""Queries of the training-data operators: ``pN_...`` of problem N, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.queries import WITH_TEXT
from ..session import spread, stage
from . import articles, language, mixing, near_duplicates, packing, pairs, repeated_lines, subjects, tokens


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(table) if name in WITH_TEXT else table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.repeated_lines(_t(spark, d, "extracted_docs"), _t(spark, d, "enriched_meta")).select("doc_id", "line_no")


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Boilerplate proper: lines of at least 6 clusters of documents and 2 publication days, taken out of each text."""
    return repeated_lines.without_repeated_lines(_t(spark, d, "extracted_docs"), _t(spark, d, "enriched_meta"), min_clusters=6, min_days=2)


def _languages(spark: SparkSession, d: str) -> DataFrame:
    records = _t(spark, d, "wet_records")
    return language.record_languages(records, language.fit_with_records(_t(spark, d, "lid_reference"), records))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    case = F.when(F.col("mixed"), F.col("line_no") >= 0).otherwise(F.col("label_state") != "ok")
    return _languages(spark, d).where(case).select("doc_id", "line_no", "lang")


def p2_records(spark: SparkSession, d: str) -> DataFrame:
    """Every record and every line of a mixed one, with confidence beside the given score."""
    return _languages(spark, d)


def _near(spark: SparkSession, d: str, links: str = "all") -> tuple[DataFrame, DataFrame]:
    known = _t(spark, d, "fuzzy_docs").select(F.col("doc_id").alias("id"))
    return near_duplicates.near_duplicates(_t(spark, d, "wet_records"), known, k=3, threshold=0.6, links=links)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """All similar pairs of ids."""
    return near_duplicates.id_pairs(*_near(spark, d))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every id with its class of equal texts and its group of similar ones."""
    return near_duplicates.groups(*_near(spark, d, "connected"))


def _captures(spark: SparkSession, d: str) -> DataFrame:
    return articles.captures(_t(spark, d, "warc_records"), _t(spark, d, "page_fetches"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pages = _captures(spark, d)
    return articles.article_pieces(pages, articles.fit_to(pages))


def p4_articles(spark: SparkSession, d: str) -> DataFrame:
    """The text of each capture's article."""
    pages = _captures(spark, d)
    return articles.article_texts(pages, articles.fit_to(pages))


def _pair_defects(spark: SparkSession, d: str) -> DataFrame:
    examples, reference = _t(spark, d, "instruction_examples"), _t(spark, d, "lid_reference")
    texts = [(r.lang, r.text) for r in reference.collect()]
    return pairs.pair_defects(examples, pairs.fit(examples, language.fit(reference, [(r.lang, r.text) for r in _t(spark, d, "subject_reference").collect()]), texts))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _pair_defects(spark, d)


def p5_defects(spark: SparkSession, d: str) -> DataFrame:
    """Pairs per source and defect."""
    examples = _t(spark, d, "instruction_examples").groupBy("id").agg(F.max("source").alias("source"))
    return examples.join(_pair_defects(spark, d), "id").groupBy("source", "defect").agg(F.count("*").alias("pairs"))


def p6_token_totals(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_totals(stage(tokens.document_tokens(_t(spark, d, "extracted_docs"), _t(spark, d, "enriched_meta")), "p6"))


def p6_claims(spark: SparkSession, d: str) -> DataFrame:
    """What the totals say besides the exact counts: documents and claimed tokens of every slice, and whether exact tokens were counted for all of it."""
    t = p6_token_totals(spark, d)
    return t.select("slice", "source", "lang", "domain", "docs", "meta_tokens", (F.col("tokens") > 0).alias("counted"))


def p6_document_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.document_tokens(_t(spark, d, "extracted_docs"), _t(spark, d, "enriched_meta"))


def p6_run_totals(spark: SparkSession, d: str) -> DataFrame:
    cols = ["doc_id", "run_id", "fetched_at", "text"]
    both = _t(spark, d, "extracted_docs").select(*cols).unionByName(_t(spark, d, "wet_records").where(F.col("keep")).select(*cols))
    return tokens.run_totals(both, _t(spark, d, "run_reports"))


def _document_sizes(spark: SparkSession, d: str) -> DataFrame:
    return stage(tokens.token_counts(_t(spark, d, "documents"), ["doc_id"]), "p7")


def p7_assignment(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_document_sizes(spark, d), _t(spark, d, "pack_profiles"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(packing.pack(_document_sizes(spark, d), _t(spark, d, "pack_profiles")))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the assignment, per profile: documents placed, those or containers that break a rule, and whether a hundredth and two more containers than the tokens fill is enough."""
    sizes, profiles = _document_sizes(spark, d), _t(spark, d, "pack_profiles").where("capacity_tokens > 0 AND profile IS NOT NULL")
    packed = stage(packing.pack(sizes, profiles), "p7-packed")
    one = packed.groupBy("profile", "container").agg(F.sum("tokens").alias("sum"), F.first("used").alias("used"), F.first(F.col("used") + F.col("unused")).alias("capacity"))
    full = one.groupBy("profile").agg(F.count_if(F.col("sum") > F.col("capacity")).alias("overfull"), F.count_if(F.col("sum") != F.col("used")).alias("misreported"), (F.count("*") <= 1.01 * F.ceil(F.sum("sum") / F.first("capacity")) + 2).alias("few_containers"))
    need = sizes.where("n_tokens > 0").select("doc_id", "n_tokens", F.inline(packing.profile_rows(profiles))).select("profile", "doc_id", "capacity", (F.col("n_tokens") + F.col("eos")).alias("need"))
    docs = packed.groupBy("profile", "doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("sum"))
    both = need.join(docs, ["profile", "doc_id"], "full")
    rules = both.groupBy("profile").agg(
        F.count("pieces").alias("placed"), F.count_if(F.col("pieces").isNull() | F.col("need").isNull()).alias("missing"), F.count_if(F.col("sum") != F.col("need")).alias("lost_tokens"), F.count_if((F.col("need") <= F.col("capacity")) & (F.col("pieces") > 1)).alias("split_though_fitting")
    )
    return rules.join(full, "profile")


def _subject_words(spark: SparkSession, d: str) -> tuple[DataFrame, subjects.SubjectModel]:
    """Documents tokenized once, and the model of subjects fitted to all of them."""
    words = stage(subjects.tokenized(_t(spark, d, "documents"), ["doc_id"]), "subject-words")
    return words, subjects.fit(words, _t(spark, d, "subject_reference"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return stage(mixing.sized_documents(_t(spark, d, "documents"), subjects.main_subject(*_subject_words(spark, d))), "p8")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sized(spark, d), _t(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    sized, targets = _sized(spark, d), _t(spark, d, "mix_targets")
    return mixing.shares_reached(mixing.mix(sized, targets), sized, targets)


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the mix, per target source: uses above the cap, and whether its share is off the target (dealt anew among sources that have documents) by more than a thousandth and one of the longest documents."""
    sized, targets = _sized(spark, d), _t(spark, d, "mix_targets")
    s = mixing.shares_reached(stage(mixing.mix(sized, targets), "p8-mix"), sized, targets)
    grain = sized.agg(F.max("n_tokens").alias("longest"))
    have = s.where("tokens_available > 0").agg(F.sum("target_share").alias("all"), F.sum("tokens").alias("drawn")).join(grain)
    goal = F.when(F.col("tokens_available") > 0, F.col("target_share") / F.col("all")).otherwise(0.0)
    return s.join(F.broadcast(have)).select("source", "max_repeats", "docs_available", (F.col("most_uses") > F.col("max_repeats")).alias("too_often"), (F.abs(F.col("actual_share") - goal) > 0.001 + F.col("longest") / F.col("drawn")).alias("off"))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(*_subject_words(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "subject")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and characters per subject; a document of two subjects counts in both, one of none under ``(none)``."""
    docs = _t(spark, d, "documents").select("doc_id", F.length("text").alias("chars"))
    named = docs.join(_subjects(spark, d), "doc_id", "left")
    return named.groupBy(F.coalesce("subject", F.lit("(none)")).alias("subject")).agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(f)}
