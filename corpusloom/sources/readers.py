"""Readers and writers of the file forms that the pipelines exchange."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

DOCUMENT_DDL = "id STRING, text STRING, source STRING, url STRING, crawl STRING, fetched_at STRING, lang STRING, lid_model STRING, lid_score DOUBLE, meta STRING"
PAIR_DDL = "id STRING, rw_text STRING, en_text STRING, source STRING, url_rw STRING, url_en STRING, domain STRING, fetched_at STRING, rw_lid_score DOUBLE, en_lid_score DOUBLE, meta STRING"
EXAMPLE_DDL = "id STRING, source STRING, task_type STRING, prompt STRING, response STRING, lang STRING, created_at STRING, meta STRING"
MANIFEST_DDL = "run_id STRING, source STRING, filename STRING, path STRING, bytes BIGINT, records_count BIGINT, token_estimate BIGINT, checksum STRING, created_at STRING"
ENRICHED_DDL = "doc_id STRING, shard_name STRING, token_count BIGINT, char_count BIGINT, domain STRING, content_type STRING, quality_score DOUBLE"
CDX_DDL = "url STRING, filename STRING, offset STRING, length STRING, status STRING, mime STRING, digest STRING"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or compressed; unknown keys are dropped, missing ones null, blank and broken lines skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_wet(spark: SparkSession, path: str) -> DataFrame:
    """``url, text`` of WET files (gzip or plain): records begin at lines that start with ``WARC/1.0``; those without URL or text are dropped.

    Files are read as blocks between the markers; a marker inside a line of text is no boundary and is put back together.
    """
    raw = spark.read.option("lineSep", "\nWARC/1.0").text(path)
    body = F.regexp_replace(F.regexp_replace("value", r"^(?:WARC/1\.0)?", ""), "\r", "")
    parts = F.split(body, "\n\n", 2)
    url = F.regexp_extract(F.get(parts, F.lit(0)), r"(?im)^WARC-Target-URI:\s*(.+?)\s*$", 1)
    text = F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"^\s+|\s+$", "")
    return raw.select(url.alias("url"), text.alias("text")).where((F.col("url") != "") & (F.col("text") != ""))


WARC_DDL = "warc_type string, target_url string, http_status int, http_headers map<string,string>, body binary, ok boolean, error string"


def parse_warc_record(raw: bytes | None) -> tuple:
    """One gzipped WARC record: WARC head, HTTP head, body.  A response with both heads is ``ok`` whatever its status; else the error tells what is missing."""
    kind, url, status, headers, body = "", "", 0, {}, b""
    if not raw:
        return kind, url, status, headers, body, False, "decompress_failed: empty"
    try:
        raw = gzip.decompress(raw)
    except (OSError, EOFError, zlib.error) as e:
        return kind, url, status, headers, body, False, f"decompress_failed: {e}"
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep:
        return kind, url, status, headers, body, False, "no_warc_headers"
    fields = _headers(head)
    kind, url = fields.get("warc-type", ""), fields.get("warc-target-uri", "")
    if kind != "response":
        return kind, url, status, headers, body, False, f"not_response: {kind}"
    http, sep, body = rest.partition(b"\r\n\r\n")
    if not sep:
        return kind, url, status, headers, b"", False, "no_http_headers"
    first, _, lines = http.partition(b"\r\n")
    bits = first.split()
    status = int(bits[1]) if len(bits) > 1 and bits[1].isdigit() else 0
    headers = _headers(lines)
    return kind, url, status, headers, body, True, ""


def _headers(block: bytes) -> dict[str, str]:
    out = {}
    for line in block.decode("utf-8", "replace").split("\r\n"):
        k, sep, v = line.partition(":")
        if sep:
            out[k.strip().lower()] = v.strip()
    return out


def parse_warc(df: DataFrame, raw_col: str = "content") -> DataFrame:
    """Adds ``record`` (the fields of a WARC response) to rows of raw records, e.g. of ``binaryFile`` or of byte ranges."""

    @F.pandas_udf(f"struct<{WARC_DDL.replace(' string', ':string').replace(' int', ':int').replace(' map', ':map').replace(' binary', ':binary').replace(' boolean', ':boolean')}>")
    def parse(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_warc_record(None if x is None else bytes(x)) for x in s], columns=[c.split()[0] for c in WARC_DDL.split(", ")])

    return df.withColumn("record", parse(F.col(raw_col)))


def read_cdx(spark: SparkSession, path: str, crawl: str, statuses: tuple[str, ...] = ("200",), mimes: tuple[str, ...] = ("text/html",)) -> DataFrame:
    """Captures of an index dump (JSON lines), filtered; an empty tuple filters nothing; rows without a place in a file are dropped."""
    d = read_jsonl(spark, path, CDX_DDL).select("url", "filename", F.col("offset").try_cast("bigint").alias("offset"), F.col("length").try_cast("bigint").alias("length"), "status", "mime", "digest", F.lit(crawl).alias("crawl"))
    for c, allowed in (("status", statuses), ("mime", mimes)):
        if allowed:
            d = d.where(F.col(c).isin(*allowed))
    return d.where(F.col("url").isNotNull() & F.col("offset").isNotNull() & F.col("length").isNotNull())


def read_archive_cdx(spark: SparkSession, path: str) -> DataFrame:
    """Captures of an archive's listing: one JSON array of arrays whose first row names the columns; a bad length is 0."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<array<string>>")).alias("i", "r")).where(F.col("i") > 0)
    at = lambda n: F.get("r", F.lit(n))
    return rows.select(at(0).alias("timestamp"), at(1).alias("original_url"), at(2).alias("status_code"), at(3).alias("mime_type"), F.coalesce(at(4).try_cast("bigint"), F.lit(0)).alias("length"))


def read_wiki(spark: SparkSession, path: str) -> DataFrame:
    """``title, page_id, wikitext`` of the articles of a dump: main namespace, no redirects, title and text present."""
    x = spark.read.format("xml").option("rowTag", "page").schema("title STRING, ns INT, id BIGINT, redirect STRUCT<_title: STRING>, revision STRUCT<text: STRUCT<_VALUE: STRING>>").load(path)
    t = F.col("revision.text._VALUE")
    return x.where((F.coalesce("ns", F.lit(0)) == 0) & F.col("redirect").isNull() & (F.coalesce(F.trim("title"), F.lit("")) != "") & (F.coalesce(F.trim(t), F.lit("")) != "")).select("title", F.col("id").alias("page_id"), t.alias("wikitext"))


def columnar_index(spark: SparkSession, path: str, lang: str, condition: Column | None = None) -> DataFrame:
    """Rows of a columnar crawl index whose first language is ``lang``; a further ``condition`` narrows them; five columns and both conditions reach the scan, nulls become empty."""
    from ..operators.filters import index_language

    d = spark.read.parquet(path).where(index_language(F.col("content_languages"), F.col("url"), lang))
    if condition is not None:
        d = d.where(condition)
    return d.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("url", "content_languages", "warc_filename")), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("warc_record_offset", "warc_record_length")))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``domain, path_prefix, mode`` of a seed list: one domain, URL or ``domain/path`` a line, then optionally ``precision`` or ``recall``; the first of a domain wins."""
    from ..functions import urls as U
    from ..operators.dedup import keep_first

    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.trim("value").alias("v")).where((F.col("v") != "") & ~F.startswith("v", F.lit("#")))
    bits = F.split("v", r"\s+")
    place = F.regexp_replace(F.get(bits, F.lit(0)), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    d = U.canonical_domain(F.regexp_replace(place, r"[/:?#].*$", ""))
    prefix = F.regexp_extract(place, r"^[^/]+(/.*)$", 1)
    mode = F.coalesce(F.get(bits, F.lit(1)), F.lit("recall"))
    checked = F.when(mode.isin("precision", "recall"), mode).otherwise(F.raise_error(F.concat(F.lit("bad mode: "), mode)))
    return keep_first(rows.select("ord", d.alias("domain"), prefix.alias("path_prefix"), checked.alias("mode")), F.col("domain"), F.col("ord")).drop("ord")


def read_gold_examples(spark: SparkSession, path: str) -> DataFrame:
    """``task_type, prompt, response`` of hand-written examples: JSON lines with ``#`` comments; both texts are needed, the default task is ``qa``."""
    rows = spark.read.text(path).where(~F.startswith(F.trim("value"), F.lit("#")))
    r = F.from_json("value", "task_type STRING, prompt STRING, response STRING")
    out = rows.select(r.alias("r")).select(F.coalesce("r.task_type", F.lit("qa")).alias("task_type"), T.strip(F.col("r.prompt")).alias("prompt"), T.strip(F.col("r.response")).alias("response"))
    return out.where((F.col("prompt") != "") & (F.col("response") != ""))


def read_ranges(places: DataFrame, folder: str, most_bytes: int = 100_000_000) -> DataFrame:
    """Adds ``content, ok, error`` to rows of ``filename, offset, length``: those bytes of the files below ``folder`` (any URI that pyarrow's file systems know).

    A missing file, a null or negative place, a length above ``most_bytes`` or a file that ends too early gives ``ok`` false and the reason; rows are read in the order of
    their places, so each task opens a file once.  Columns of the result's names are replaced.
    """
    from .files import opened

    rows = places.drop("content", "ok", "error")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name, file = None, None
        for b in batches:
            out, errors = [], []
            for f, o, n in zip(*(b.column(c).to_pylist() for c in ("filename", "offset", "length"))):
                data, error = None, ""
                try:
                    if f is None or o is None or n is None or o < 0 or n < 0:
                        error = "bad_range"
                    elif n > most_bytes:
                        error = "too_long"
                    else:
                        if f != name:
                            file, name = fs.open_input_file(f"{root}/{f}"), f
                        file.seek(o)
                        data = file.read(n)
                        if len(data) < n:
                            data, error = None, "short_read"
                except OSError as e:
                    name, error = None, f"read_failed: {type(e).__name__}"
                out.append(data)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary()), pa.array([not e for e in errors]), pa.array(errors, pa.string())], names=[*b.schema.names, "content", "ok", "error"])

    return rows.repartition("filename").sortWithinPartitions("filename", "offset").mapInArrow(run, f"{ddl}, content binary, ok boolean, error string")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, MANIFEST_DDL)


def read_enrichment(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each ``doc_id``, in the order of files and lines."""
    from ..operators.dedup import keep_first

    d = read_jsonl(spark, path, ENRICHED_DDL).withColumn("_at", F.monotonically_increasing_id())
    return keep_first(d.where(F.col("doc_id").isNotNull()), F.col("doc_id"), F.col("_at").desc()).drop("_at")


def read_book_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``url, title, author, language`` of a list of books: tab-separated, or a URL alone, a line; ``#`` comments and what is no http address are left out, the first line of a URL wins."""
    from ..functions import urls as U
    from ..operators.dedup import keep_first

    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.trim("value").alias("v")).where((F.col("v") != "") & ~F.startswith("v", F.lit("#")))
    bits = F.split("v", "\t")
    at = lambda n: F.coalesce(F.trim(F.get(bits, F.lit(n))), F.lit(""))
    rows = rows.select("ord", at(0).alias("url"), at(1).alias("title"), at(2).alias("author"), at(3).alias("language")).where(U.valid_seed(F.col("url")))
    return keep_first(rows, F.col("url"), F.col("ord")).drop("ord")
