"""Writers of the file forms that the pipelines exchange.

Whatever runs on executors writes below one folder that all of them share (any URI that pyarrow's file systems know), under a name of its own attempt, and
moves the file to its final name when it is closed: a lost or repeated task leaves no half file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from .files import opened
from .readers import MANIFEST_DDL

#: Shards a task may write; its part numbers begin at its own number times this.
SHARDS_PER_TASK = 1000


def _schema(ddl: str) -> pa.Schema:
    kinds = {"STRING": pa.string(), "BIGINT": pa.int64(), "BINARY": pa.binary(), "BOOLEAN": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1].upper()]) for c in ddl.split(", ")])


class _Shard:
    """One open shard: lines in, compressed bytes to a file, their SHA-256 on the way."""

    def __init__(self, system, path: str):
        import zstandard

        self.system, self.path, self.out = system, path, system.open_output_stream(path, compression=None)
        self.digest, self.bytes, self.records, self.chars = hashlib.sha256(), 0, 0, 0
        self.z = zstandard.ZstdCompressor().compressobj()

    def _put(self, data: bytes) -> None:
        self.digest.update(data)
        self.bytes += len(data)
        self.out.write(data)

    def add(self, line: str, chars: int) -> None:
        self._put(self.z.compress(line.encode() + b"\n"))
        self.records += 1
        self.chars += chars

    def close(self, final: str) -> None:
        self._put(self.z.flush())
        self.out.close()
        self.system.move(self.path, final)


def write_shards(df: DataFrame, folder: str, prefix: str, source: str, run_id: str, target_bytes: int = 200_000_000) -> DataFrame:
    """Write rows as zstd JSON lines in shards of about ``target_bytes`` compressed; returns their manifest.

    A shard is closed with the record that reaches ``target_bytes``; there are no empty shards.  Every task writes its own shards.  The result is what the
    write returns, so it must be staged or written itself before it is used twice.
    """
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import datetime

        from pyspark import TaskContext

        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        shard, rows = None, []

        def finish() -> None:
            name = f"{prefix}_{source}_{run_id}_part-{task * SHARDS_PER_TASK + len(rows):06d}.jsonl.zst"
            shard.close(f"{root}/{name}")
            now = datetime.datetime.now(datetime.UTC).isoformat()
            rows.append((run_id, source, name, f"{root}/{name}", shard.bytes, shard.records, int(shard.chars / 2.55), shard.digest.hexdigest(), now))

        for b in batches:
            for line, chars in zip(b.column("line").to_pylist(), b.column("chars").to_pylist()):
                if shard is None:
                    if len(rows) == SHARDS_PER_TASK:
                        raise ValueError(f"more than {SHARDS_PER_TASK} shards in a task; use more partitions")
                    shard = _Shard(system, f"{root}/.{task}-{attempt}-{len(rows)}.tmp")
                shard.add(line, chars)
                if shard.bytes >= target_bytes:
                    finish()
                    shard = None
        if shard is not None:
            finish()
        names = _schema(MANIFEST_DDL).names
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_schema(MANIFEST_DDL))

    return lines.mapInArrow(run, MANIFEST_DDL)


def write_blobs(df: DataFrame, folder: str, name: str, keep: list[str], content: str = "content") -> DataFrame:
    """Append the bytes of ``content`` to one file a task (``<name>-<task>``); returns ``keep`` columns with ``filename, offset, length``, what an index of them holds."""
    cols = df.select(*keep, F.col(content).alias("content")).where(F.col("content").isNotNull())
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields if f.name != "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        final, attempt, at, out = f"{name}-{TaskContext.get().partitionId():05d}", TaskContext.get().taskAttemptId(), 0, None
        for b in batches:
            if out is None:
                out = system.open_output_stream(f"{root}/.{final}-{attempt}.tmp", compression=None)
            sizes, begin = [], []
            for x in b.column("content").to_pylist():
                begin.append(at)
                sizes.append(len(x))
                at += out.write(x)
            rest = [c for c in b.schema.names if c != "content"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array([final] * len(sizes), pa.string()), pa.array(begin, pa.int64()), pa.array(sizes, pa.int64())], names=[*rest, "filename", "offset", "length"])
        if out is not None:
            out.close()
            system.move(f"{root}/.{final}-{attempt}.tmp", f"{root}/{final}")

    return cols.mapInArrow(run, f"{ddl}, filename string, offset bigint, length bigint")


def write_jsonl(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Rows as JSON lines, nulls written; committed as a whole."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(folder)


def append_manifest(manifest: DataFrame, folder: str) -> None:
    """Add shards to a manifest; a manifest is a folder of JSON lines."""
    write_jsonl(manifest, folder, "append")


def write_splits(named: DataFrame, folder: str, key: str = "s3_key") -> None:
    """One folder ``split=<name>`` per split, keys in order (``key, split`` come from the split operators)."""
    named.select(key, "split").repartitionByRange("split", key).sortWithinPartitions("split", key).write.partitionBy("split").text(folder)


def write_packed(sequences: DataFrame, folder: str, split: str = "split") -> None:
    """Packed sequences as Parquet by split; a row is one sequence and stays whole."""
    sequences.write.partitionBy(split).option("compression", "zstd").parquet(folder)


def train_uris(keys: Column, bucket: str, scheme: str = "s3") -> Column:
    return F.concat(F.lit(f"{scheme}://{bucket}/"), F.regexp_replace(keys, "^/+", ""))


def file_facts(files: DataFrame, folder: str, path: str = "path") -> DataFrame:
    """Adds ``size BIGINT, sha256 STRING`` of the files that column ``path`` names below ``folder``, read as a stream; both null for what can't be read."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for b in batches:
            sizes, sums = [], []
            for p in b.column(path).to_pylist():
                try:
                    digest, n = hashlib.sha256(), 0
                    with system.open_input_stream(f"{root}/{p}", compression=None) as f:
                        while part := f.read(1 << 20):
                            digest.update(part)
                            n += len(part)
                    sizes.append(n)
                    sums.append(digest.hexdigest())
                except OSError:
                    sizes.append(None)
                    sums.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes, pa.int64()), pa.array(sums, pa.string())], names=[*b.schema.names, "size", "sha256"])

    return files.mapInArrow(run, f"{ddl}, size bigint, sha256 string")


def publish(manifest: DataFrame, folder: str, target: str) -> DataFrame:
    """Copy the manifest's files from ``folder`` to ``target``; adds ``published``: ``copied``, ``there`` (same size already), ``conflict`` (another size; left alone), ``missing`` or ``failed``.

    A copy gets its name only when its SHA-256 is the manifest's.  Running it again copies nothing twice.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pafs

        (here, root), (there, to) = opened(folder), opened(target)
        there.create_dir(to, recursive=True)
        for b in batches:
            out = []
            for name, size, checksum in zip(*(b.column(c).to_pylist() for c in ("filename", "bytes", "checksum"))):
                old = there.get_file_info(f"{to}/{name}")
                if old.type != pafs.FileType.NotFound:
                    out.append("there" if old.size == size else "conflict")
                    continue
                if here.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
                    out.append("missing")
                    continue
                digest = hashlib.sha256()
                with here.open_input_stream(f"{root}/{name}", compression=None) as f, there.open_output_stream(f"{to}/.{name}.tmp", compression=None) as g:
                    while part := f.read(1 << 20):
                        digest.update(part)
                        g.write(part)
                if digest.hexdigest() == checksum:
                    there.move(f"{to}/.{name}.tmp", f"{to}/{name}")
                    out.append("copied")
                else:
                    there.delete_file(f"{to}/.{name}.tmp")
                    out.append("failed")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "published"])

    return manifest.mapInArrow(run, f"{ddl}, published string")


def remove_published(published: DataFrame, folder: str, target: str) -> DataFrame:
    """Delete the source file of every row whose copy in ``target`` has the manifest's size; adds ``removed``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in published.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (here, root), (there, to) = opened(folder), opened(target)
        for b in batches:
            out = []
            for name, size in zip(b.column("filename").to_pylist(), b.column("bytes").to_pylist()):
                sure = there.get_file_info(f"{to}/{name}").size == size
                if sure and here.get_file_info(f"{root}/{name}").is_file:
                    here.delete_file(f"{root}/{name}")
                out.append(sure)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.bool_())], names=[*b.schema.names, "removed"])

    return published.mapInArrow(run, f"{ddl}, removed boolean")


def documents(df: DataFrame, source: str, text: Column, crawl: Column, url: Column | None = None, lang: Column | None = None, score: Column | None = None, fetched_at: Column | None = None, meta: Column | None = None) -> DataFrame:
    """Rows in the shape that shards hold: the id is the hash of the text, ``meta`` any struct or map as JSON."""
    null = F.lit(None).cast("string")
    return df.select(
        H.text_hash(text).alias("id"), text.alias("text"), F.lit(source).alias("source"), (null if url is None else F.nullif(url, F.lit(""))).alias("url"), crawl.alias("crawl"),
        (null if fetched_at is None else fetched_at.cast("string")).alias("fetched_at"), (null if lang is None else lang).alias("lang"), (F.lit(None).cast("double") if score is None else score).alias("lid_score"),
        (null if meta is None else F.to_json(meta)).alias("meta"),
    )
