"""Queries that write the project's tables in the pipelines' file forms and read them back, and queries of what there is to read."""

from __future__ import annotations

import gzip
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import markup as M
from ..functions import text as T
from ..functions import urls as U
from ..operators import dedup as D
from ..operators import filters as L
from ..operators import packaging as P
from ..operators import reports as Q
from ..session import own_folder, stage
from ..sources import discovery as S
from ..sources import readers as R
from ..sources import writers as W
from .tables import SEED, shards_of, table


def wet_round_trip(spark, d):
    """All records with URL and text as WET, read back."""
    w = table(spark, d, "wet_records").where(F.col("url").isNotNull() & F.col("text").isNotNull())
    folder = own_folder(spark, "wet")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: "), "url", F.lit("\r\n\r\n"))
    w.select(F.concat(head, "text", F.lit("\r\n\r\n")).alias("value")).write.text(folder)
    return R.read_wet(spark, folder).select("url", F.sha2("text", 256).alias("sha256"))


@F.pandas_udf(BinaryType())
def _warc_bytes(kind: pd.Series, url: pd.Series, status: pd.Series, headers: pd.Series, body: pd.Series) -> pd.Series:
    out = []
    for k, u, s, h, b in zip(kind, url, status, headers, body):
        http = "".join(f"{a}: {v}\r\n" for a, v in dict(h or {}).items())
        head = f"WARC/1.0\r\nWARC-Type: {k}\r\nWARC-Target-URI: {u}\r\n\r\nHTTP/1.1 {'' if pd.isna(s) else int(s)} X\r\n{http}\r\n"
        out.append(gzip.compress(head.encode() + (b"" if b is None else bytes(b)), 1))
    return pd.Series(out)


def warc_round_trip(spark, d):
    """All WARC records as gzip members of a few files beside an index of their places, found through the index and parsed."""
    w = table(spark, d, "warc_records").where(F.col("capture_id").isNotNull())
    w = D.keep_first(w, F.col("capture_id"), F.xxhash64("target_url", "body"))
    folder = own_folder(spark, "warc")
    content = _warc_bytes(F.coalesce("warc_type", F.lit("")), F.coalesce("target_url", F.lit("")), F.col("http_status"), F.col("http_headers"), F.col("body"))
    cdx = stage(W.write_blobs(w.select("capture_id", content.alias("content")), folder, "records.warc.gz", ["capture_id"]), "cdx")
    got = R.parse_warc(R.read_ranges(cdx, folder).where("ok")).select("capture_id", "record.*")
    return got.select("capture_id", "warc_type", "target_url", F.octet_length("body").cast("long").alias("bytes"), "ok", "error", F.element_at("http_headers", "content-type").alias("content_type"))


def cdx_round_trip(spark, d):
    """All captures as lines of an index dump, read back with its filters."""
    w = table(spark, d, "warc_records").select(
        F.col("target_url").alias("url"), F.lit("f.warc.gz").alias("filename"), F.col("capture_id").cast("string").alias("offset"), F.octet_length("body").cast("string").alias("length"), F.col("http_status").cast("string").alias("status"),
        F.regexp_extract(F.element_at("http_headers", "content-type"), "^[^;]*", 0).alias("mime"), F.sha1("body").alias("digest"),
    )
    folder = own_folder(spark, "cdx")
    w.write.json(folder)
    return R.read_cdx(spark, folder, "c1").select("url", "offset", "length", "status", "mime", "digest", "crawl")


def archive_cdx_round_trip(spark, d):
    """Archive captures as listings, one per host, read back."""
    p = table(spark, d, "page_fetches").where(F.col("capture_ts").isNotNull() & (F.col("url").isNotNull())).select("capture_ts", "url", F.octet_length("html_bytes").cast("string").alias("n")).distinct()
    row = F.array("capture_ts", "url", F.lit("200"), F.lit("text/html"), F.coalesce("n", F.lit("-")))
    names = F.array(*(F.lit(x) for x in ("timestamp", "original", "statuscode", "mimetype", "length")))
    # a listing is one host's of one year, as an archive serves them
    lists = p.groupBy(U.host(F.col("url")).alias("h"), F.substring("capture_ts", 1, 4).alias("y")).agg(F.collect_list(row).alias("rows")).select(F.to_json(F.concat(F.array(names), "rows")).alias("value"), "h", "y")
    folder = own_folder(spark, "archive")
    lists.select(F.concat_ws("-", "h", "y").alias("list"), "value").repartition("list").write.partitionBy("list").text(folder)
    return R.read_archive_cdx(spark, folder + "/*").select("timestamp", "original_url", "mime_type", "length")


def wiki_round_trip(spark, d):
    """Extracted pages as a dump: of every page with a title, some as redirects, some in other namespaces, some without one; the articles read back."""
    e = D.keep_first(table(spark, d, "extracted_docs").where(T.strip(F.coalesce("title", F.lit(""))) != ""), F.col("doc_id"), F.col("fetched_at"), F.col("text"))
    n = F.conv(F.substring(F.sha2("doc_id", 256), 1, 4), 16, 10).cast("long")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    ns = F.when(n % 5 == 0, "<ns>1</ns>").when(n % 5 == 1, "").otherwise("<ns>0</ns>")
    page = F.concat(
        F.lit("<page><title>"), esc(F.col("title")), F.lit("</title>"), ns, F.lit("<id>"), n.cast("string"), F.lit("</id>"), F.when(n % 7 == 0, '<redirect title="x"/>').otherwise(""),
        F.lit("<revision><text>"), esc(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x{0}-\\x{8}\\x{b}\\x{c}\\x{e}-\\x{1f}]", "")), F.lit("</text></revision></page>"),
    )
    folder = own_folder(spark, "wiki")

    def rooted(batches):
        yield pa.RecordBatch.from_pydict({"value": ["<mediawiki>"]})
        yield from batches
        yield pa.RecordBatch.from_pydict({"value": ["</mediawiki>"]})

    e.select(page.alias("value")).mapInArrow(rooted, "value string").write.text(folder)
    squeezed = lambda c: F.regexp_replace(c, r"\s+", "")
    return R.read_wiki(spark, folder).select("page_id", F.sha2(squeezed(F.col("title")), 256).alias("title"), F.sha2(squeezed(F.col("wikitext")), 256).alias("text"))


def seed_round_trip(spark, d):
    """The domains of all records as a seed list with modes, read back, and looked up for each record: modes per domain, the default for the others."""
    w = table(spark, d, "wet_records").where(F.col("domain").isNotNull())
    names = w.select(U.canonical_domain(F.col("domain")).alias("domain")).where("domain <> ''").distinct()
    x = F.conv(F.substring(F.sha2("domain", 256), 1, 4), 16, 10).cast("long")
    line = F.when(x % 3 == 0, F.concat(F.lit("https://www."), "domain", F.lit("/amakuru/ precision"))).when(x % 3 == 1, F.col("domain"))
    folder = own_folder(spark, "seeds")
    names.select(line.alias("value")).where("value is not null").write.text(folder)
    seeds = stage(R.read_seeds(spark, folder), "seeds")
    keyed = S.with_mode(w.select(U.canonical_domain(F.col("domain")).alias("domain")), seeds)
    return keyed.groupBy("domain", "mode").agg(F.count("*").alias("n"))


def seeds_allow(spark, d):
    """URLs per answer of an allowlist with a path prefix for some domains."""
    e = table(spark, d, "extracted_docs").where(F.col("url").isNotNull()).select("url").distinct()
    names = e.select(U.canonical_domain(U.host(F.col("url"))).alias("domain")).where("domain <> ''").distinct()
    x = F.conv(F.substring(F.sha2("domain", 256), 1, 4), 16, 10).cast("long")
    allowed = names.select("domain", F.when(x % 2 == 0, F.lit("/amakuru/")).otherwise("").alias("path_prefix"), x.alias("x")).where("x % 5 <> 0").drop("x")
    return U.on_allowlist(e, "url", allowed, "allowed").select("url", "allowed")


def parent_domain_matches(spark, d):
    """Records per suffix of their domain: what lies on a domain or below it, joined on equality."""
    w = table(spark, d, "wet_records").where(F.col("domain").isNotNull()).select(U.canonical_domain(F.col("domain")).alias("domain"))
    seeds = w.select(F.regexp_extract("domain", r"([^.]+\.[^.]+)$", 1).alias("suffix")).where("suffix <> ''").distinct()
    return w.withColumn("suffix", F.explode(U.parent_domains(F.col("domain")))).join(seeds, "suffix").groupBy("suffix").agg(F.count("*").alias("n"))


def _shards(spark, d, folder):
    docs = table(spark, d, "wet_records").where(F.col("text").isNotNull() & F.col("keep"))
    rows = docs.select("doc_id", F.sha2("text", 256).alias("id"), "text", "source", "url", "lang", "lid_score")
    return W.write_shards(rows, folder, "corpus", "all_sources", "r1", target_bytes=200_000)


def shard_round_trip(spark, d):
    """Kept records as zstd shards, read back by Spark's own reader."""
    folder = own_folder(spark, "shards")
    stage(_shards(spark, d, folder), "manifest")
    return R.read_jsonl(spark, folder + "/*.zst", R.DOCUMENT_DDL).groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.bit_xor(F.conv(F.substring("id", 1, 15), 16, 10).cast("long")).alias("ids"))


def shard_validation(spark, d):
    """Shards against their manifest, appended and read back: records, characters, bytes and checksums that differ, in all."""
    folder, to = own_folder(spark, "shards"), own_folder(spark, "manifest")
    W.append_manifest(_shards(spark, d, folder), to)
    m = R.read_manifest(spark, to)
    lines = spark.read.text(folder + "/*.zst").select("value", F.col("_metadata.file_name").alias("file_name"))
    facts = W.file_facts(m.select("filename"), folder, "filename")
    both = m.join(Q.shard_checks(lines), "filename", "left").join(facts, "filename", "left")
    return both.agg(
        F.sum("records").alias("records"), F.sum("total_chars").alias("chars"), F.sum("bad_lines").alias("bad_lines"), F.count_if(F.col("records") != F.col("records_count")).alias("other_records"),
        F.count_if(F.col("size") != F.col("bytes")).alias("other_bytes"), F.count_if(F.coalesce(F.col("sha256") != F.col("checksum"), F.lit(True))).alias("other_checksums"),
    )


def shard_publication(spark, d):
    """Shards copied to another folder twice, resolved there, and removed here: files per state."""
    folder, to = own_folder(spark, "shards"), own_folder(spark, "published")
    m = stage(_shards(spark, d, folder), "manifest")
    first = stage(W.publish(m, folder, to + "/all_sources/r1"), "first")
    again = stage(W.publish(m, folder, to + "/all_sources/r1"), "again")
    names = m.select(F.col("filename").alias("shard_name"), "source", "run_id")
    found = S.resolve_shards(names, S.files_below(spark, to, "*.zst")).where(F.col("path").isNotNull())
    gone = stage(W.remove_published(m, folder, to + "/all_sources/r1").where("removed"), "gone")
    n = m.count()
    counts = [("copied", first.where("published = 'copied'").count()), ("there", again.where("published = 'there'").count()), ("resolved", found.count()), ("removed", gone.count())]
    return spark.createDataFrame([(k, v == n and n > 0) for k, v in counts], "step string, all_shards boolean")


def _names(m: DataFrame) -> DataFrame:
    return m.where(F.col("shard_name").isNotNull()).select("shard_name", F.col("shard_name").alias("filename")).distinct()


def shards_by_source(spark, d):
    """Shards and runs per source, from file names alone, beside where the source's shards lie in the store and which dataset it feeds."""
    m = _names(table(spark, d, "enriched_meta")).select("shard_name", S.shard_parts(F.col("filename")).alias("p")).select("shard_name", "p.*")
    n = m.groupBy("source").agg(F.count("*").alias("shards"), F.countDistinct("run_id").alias("runs"))
    return n.select("source", "shards", "runs", S.store_prefix(F.col("source"), "store/").alias("prefix"), F.coalesce(P.dataset_of(F.col("source")), F.lit("none")).alias("dataset"))


def split_files(spark, d):
    """Split files as written: keys per split, first and last, and whether they are in order."""
    named = P.splits(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key")), SEED, "key", (0.98, 0.01, 0.01))
    folder = own_folder(spark, "splits")
    W.write_splits(named, folder, "key")
    back = spark.read.text(folder)
    return back.groupBy("split").agg(F.count("*").alias("keys"), F.min("value").alias("first"), F.max("value").alias("last"))


def train_uris(spark, d):
    """Addresses of the training split's shards."""
    i = shards_of(spark, d).select(F.concat(S.store_prefix(F.col("source")), F.lit("shards/run_id="), "run_id", F.lit("/"), "filename").alias("s3_key"))
    return P.splits(i, SEED).where("split = 'train'").select(W.train_uris(F.col("s3_key"), "store").alias("uri"))


def packed_files(spark, d):
    """Packed sequences written by split and read back: sequences, tokens and their sum per split and source."""
    docs = table(spark, d, "documents").where(F.length("text") > 0).select(F.coalesce("source", F.lit("none")).alias("source"), "doc_id", F.transform(F.split("text", ""), lambda c: F.ascii(c)).alias("ids"))
    shard = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 5000))
    seq = P.pack_sequences(docs.withColumn("shard", shard), "shard", "doc_id", "ids", 0, 1024)
    folder = own_folder(spark, "packed")
    named = P.splits(seq.select("shard").distinct(), SEED, "shard", (0.8, 0.1, 0.1))
    W.write_packed(seq.join(named, "shard"), folder)
    back = spark.read.parquet(folder)
    total = F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x)
    # marks between documents are 0, so tokens that count are the documents' own
    own = F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + F.when(x > 0, 1).otherwise(0))
    return back.groupBy("split").agg(F.sum(own).alias("tokens"), F.sum(total).alias("checksum"), F.max("length").cast("long").alias("longest"))


def enrichment_round_trip(spark, d):
    """Enrichment written as JSON lines in two halves and read back: the later row of a document counts."""
    m = D.keep_first(table(spark, d, "enriched_meta").where(F.col("doc_id").isNotNull()), F.col("doc_id"), F.col("enriched_at").desc(), F.col("domain"), F.col("token_count"))
    cols = [c.split()[0] for c in R.ENRICHED_DDL.split(", ")]
    folder = own_folder(spark, "enriched")
    both = m.select(*cols, F.lit(1).alias("_at")).unionByName(m.select(*cols).withColumn("token_count", F.lit(-1).cast("long")).withColumn("_at", F.lit(0)))
    W.write_jsonl(both.repartition("doc_id").sortWithinPartitions("doc_id", "_at").drop("_at"), folder)
    return R.read_enrichment(spark, folder).select("doc_id", "shard_name", "token_count", "char_count", "content_type", "quality_score")


def dead_letter_files(spark, d):
    """Failed fetches as JSON lines beside the good ones, read back."""
    p = table(spark, d, "page_fetches").where(~F.col("ok")).select("capture_id", "url", F.col("error").alias("reason"), (~F.col("error").rlike("^http_4|content_type")).alias("retryable"), F.col("channel").alias("stage")).distinct()
    folder = own_folder(spark, "dead")
    W.write_jsonl(p, folder)
    return R.read_jsonl(spark, folder, "capture_id BIGINT, url STRING, reason STRING, retryable BOOLEAN, stage STRING")


def crawl_lists(spark, d):
    """The crawls of all records in a range of dates, newest first, with the addresses of their file lists."""
    ids = table(spark, d, "wet_records").where(F.col("crawl").isNotNull()).select(F.col("crawl").alias("id"))
    folder = own_folder(spark, "crawls")
    chosen = S.crawls(ids, "2024-10", "2025-40", 8)
    chosen.coalesce(1).select(F.concat(F.lit("crawl-data/"), "id", F.lit("/wet.paths.gz")).alias("value")).unionByName(spark.createDataFrame([("# list",), ("",)], "value string")).write.option("compression", "gzip").text(folder)
    return S.listed(spark, folder, "https://data.example/")


def columnar_index_scan(spark, d):
    """Extracted pages as a columnar index, listed and scanned for one language without a top-level domain."""
    e = table(spark, d, "extracted_docs").select(F.col("url"), F.col("lang").alias("content_languages"), F.lit("w").alias("warc_filename"), F.length("text").alias("warc_record_offset"), F.lit(None).cast("int").alias("warc_record_length"), F.lit("warc").alias("subset"))
    folder = own_folder(spark, "index")
    e.write.partitionBy("subset").parquet(folder)
    listing = S.index_files(S.files_below(spark, folder, "*.parquet"))
    scan = R.columnar_index(spark, folder + "/subset=warc", "kin_Latn", ~F.contains("url", F.lit(".news.")))
    return scan.groupBy("url").agg(F.count("*").alias("n"), F.sum("warc_record_offset").alias("chars")).join(listing.agg((F.count("*") > 0).alias("listed")))


def news_import(spark, d):
    """Extracted pages as the rows of the news dataset: title and text together, label by name, blank ones left out; then the keep decision."""
    e = table(spark, d, "extracted_docs").where(F.col("doc_id").isNotNull()).select("doc_id", "title", F.col("text").alias("content"), "lang", F.col("fetched_at").alias("at"))
    e = D.keep_first(e, F.col("doc_id"), F.col("at"), F.col("content"))
    label = (F.conv(F.substring(F.sha2("doc_id", 256), 1, 4), 16, 10).cast("int") % 17) - 1
    rows = D.ranked(e.select("doc_id", "title", "content"), [], F.col("doc_id")).select(F.col("rank").cast("long").alias("row_no"), "title", "content", F.lit("train").alias("split"), label.alias("label"))
    docs = S.imported(rows, "kinnews")
    return docs.groupBy(F.get_json_object("meta", "$.category").alias("category")).agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"), F.max(F.col("source_id").cast("long")).alias("last_id"))


def monolingual_import(spark, d):
    """Documents as the rows of the monolingual dataset, through the keep decision and deduplication to the shape of shards."""
    docs = table(spark, d, "documents").select((F.col("doc_id")).alias("row_no"), "text", "lang")
    found = S.imported(docs, "mbazanlp_v01.1")
    return found.select("source_id", F.sha2("text", 256).alias("sha256"), F.get_json_object("meta", "$.version").alias("version"))


def first_documents(spark, d):
    """The first 50 documents of each source, as a bounded scan takes them."""
    docs = table(spark, d, "documents").where(F.col("source").isNotNull()).select("source", "doc_id")
    return S.first_rows(docs, "source", "doc_id", 50)


def harvested_classes(spark, d):
    """URLs that a harvest would read, by class."""
    e = table(spark, d, "extracted_docs").where(F.col("url").isNotNull()).select("url").distinct()
    return Q.class_counts(S.harvested(e.withColumn("kind", U.kind(F.col("url"), portal=True)), classes=S.HARVESTED_PORTAL))


def shard_documents_form(spark, d):
    """Kept records in the shape that shards hold."""
    w = L.decide_keep(table(spark, d, "wet_records")).where("keep")
    docs = W.documents(w, "commoncrawl", F.col("normalized_text"), F.col("crawl"), F.col("url"), F.col("lang"), F.col("lid_score"), F.col("fetched_at"), F.struct(F.col("run_id").alias("run")))
    return docs.select("id", "source", "url", "crawl", "lang", "lid_score", F.get_json_object("meta", "$.run").alias("run")).distinct()


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _letters_only(c):
    return T.strip(F.regexp_replace(c, "[^a-zA-Z]+", " "))


def page_round_trip(spark, d):
    """All documents as pages with navigation, script and foot, and their main text taken out again."""
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    lines = F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<p>"), _escaped(x), F.lit("</p>")))
    page = F.concat(
        F.lit("<html><head><title>A &amp; B</title></head><body><nav><a href='/'>Home page of the site</a></nav><script>var a = '<p>no</p>';</script><article>"), F.array_join(lines, ""),
        F.lit("<!-- <p>neither</p> --></article><footer><p>All of this is foot</p></footer></body></html>"),
    )
    got = M.main_text(F.encode(page, "UTF-8"), F.lit(False))
    return docs.select("doc_id", got.alias("m")).select("doc_id", "m.title", F.sha2(F.regexp_replace("m.text", r"\s+", ""), 256).alias("sha256"))


def link_round_trip(spark, d):
    """A page per extracted document with six kinds of links: all of them in order, resolved."""
    e = table(spark, d, "extracted_docs").where(F.col("url").isNotNull()).select("url").distinct()
    page = F.concat(F.lit("<p><a href='/top?x=1&amp;y=2'>1</a><!-- <a href='/no'>-</a> --><A class=k HREF=\""), _escaped(F.col("url")), F.lit("\">2</A><a href='mailto:a@b'>3</a><a>4</a><a href='#part'>5</a><a href='//Other.example/z'>6</a></p>"))
    got = e.select("url", F.posexplode(M.extract_links(F.encode(page, "UTF-8"), F.col("url"))).alias("pos", "target"))
    return got.where("pos <> 2").select("url", F.col("pos").cast("long").alias("pos"), "target")


def wikitext_round_trip(spark, d):
    """All documents' words as wikitext with templates, links, tables, media and tail sections, and the text taken out again."""
    t = _letters_only(F.col("text"))
    docs = table(spark, d, "documents").where(F.col("text").isNotNull() & (t != ""))
    raw = F.concat(
        F.lit("{{Infobox|a={{b}}}}\'\'\'"), t, F.lit("\'\'\' [[x y|label]]<ref name=q>z</ref> [[Category:Y]]\n[[File:a.jpg|thumb|a [[b]] c]]\n{|\n| cell\n|}\n== Amateka ==\n* __NOTOC__"), t,
        F.lit(" <<w>> [http://x.y named]\n200px|left\n== Reba kandi ==\nmore"),
    )
    return docs.select("doc_id", F.sha2(M.wikitext(raw), 256).alias("sha256"))


@F.pandas_udf(BinaryType())
def _docx(s: pd.Series) -> pd.Series:
    import io
    import zipfile
    from xml.sax.saxutils import escape

    out = []
    for t in s:
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            z.writestr("word/document.xml", "<w:d xmlns:w='u'>" + "".join(f"<w:p><w:r><w:t>{escape(x[: len(x) // 2])}</w:t><w:t>{escape(x[len(x) // 2 :])}</w:t></w:r></w:p>" for x in t.split("\n")) + "</w:d>")
        out.append(b.getvalue())
    return pd.Series(out)


def office_round_trip(spark, d):
    """All documents as office files and pages by media type, through the extractor of their route: what comes out of each way, and why nothing does."""
    kind = F.when(F.col("doc_id") % 3 == 0, M.OFFICE_TYPES[0]).when(F.col("doc_id") % 3 == 1, "application/pdf").otherwise("text/html; charset=utf-8")
    t = F.regexp_replace("text", "[\\x{0}-\\x{8}\\x{b}\\x{c}\\x{d}\\x{e}-\\x{1f}\\x{fffe}\\x{ffff}]", "")
    docs = table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", kind.alias("kind"), t.alias("t"))
    content = F.when(F.col("doc_id") % 3 == 0, _docx(F.col("t"))).when(F.col("doc_id") % 3 == 2, F.encode(F.concat(F.lit("<nav>menu</nav>"), F.lit("<p>"), _escaped(_letters_only(F.col("t"))), F.lit("</p>")), "UTF-8")).otherwise(F.encode("t", "UTF-8"))
    got = docs.select("doc_id", M.route(F.col("kind")).alias("route"), M.extracted(content, F.col("kind")).alias("e"))
    return got.select("doc_id", "route", F.sha2(F.regexp_replace("e.text", T.WS + "+", ""), 256).alias("sha256"), F.col("e.reason").alias("reason"))


def robots_rules(spark, d):
    """Which URLs a crawler may read under a robots file that shuts two paths, for itself and for all, by the answer that the file's fetch had."""
    e = table(spark, d, "extracted_docs").where(F.col("url").isNotNull()).select("url").distinct()
    x = F.conv(F.substring(F.sha2("url", 256), 1, 4), 16, 10).cast("int")
    status = F.when(x % 5 == 0, 403).when(x % 5 == 1, 404).when(x % 5 == 2, F.lit(None).cast("int")).otherwise(200)
    rules = F.lit("User-agent: *\nDisallow: /amakuru/\n\nUser-agent: loom\nDisallow: /news/\n")
    e = e.withColumn("status", status)
    return e.select("url", M.robots_allow(F.col("url"), rules, F.col("status")).alias("anyone"), M.robots_allow(F.col("url"), rules, F.col("status"), "loom").alias("loom"))


def example_round_trip(spark, d):
    """Examples as a file of hand-written ones with comments, read back: those with both texts, ``qa`` where no task is named."""
    e = table(spark, d, "instruction_examples").select("task_type", "prompt", "response")
    folder = own_folder(spark, "gold")
    e.select(F.to_json(F.struct("task_type", "prompt", "response")).alias("value")).unionByName(spark.createDataFrame([("# comment",), ("",)], "value string")).write.text(folder)
    return R.read_gold_examples(spark, folder).groupBy("task_type").agg(F.count("*").alias("n"), F.sum(F.length("prompt")).alias("prompt_chars"), F.sum(F.length("response")).alias("response_chars"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        wet_round_trip, warc_round_trip, cdx_round_trip, archive_cdx_round_trip, wiki_round_trip, seed_round_trip, seeds_allow, parent_domain_matches, shard_round_trip, shard_validation, shard_publication, shards_by_source,
        split_files, train_uris, packed_files, enrichment_round_trip, dead_letter_files, crawl_lists, columnar_index_scan, news_import, monolingual_import, first_documents, harvested_classes, shard_documents_form, page_round_trip, link_round_trip,
        wikitext_round_trip, office_round_trip, robots_rules, example_round_trip,
    ]
    return {f.__name__: f for f in own}
