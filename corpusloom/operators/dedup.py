"""Deduplication that lets the first record win, in an order given by a column."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..session import stage


#: Parts that the rows of one key are dealt into before they compete, so that a key of a third of all rows isn't one task.
SALTS = 32


def _order_salt(order: tuple[Column, ...]) -> Column:
    return F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")


def first_wins(df: DataFrame, key: Column | list[Column], *order: Column) -> DataFrame:
    """Adds ``duplicate``: not the first row of its key in this order.  Null keys are one key; of rows equal in key and order one is first.

    The firsts of the parts of a key compete in a second window that all other rows pass in their own parts.
    """
    keys = key if isinstance(key, list) else [key]
    part = df.withColumn("_s", _order_salt(order))
    part = part.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_s").orderBy(*order)))
    last = Window.partitionBy(*keys, F.when(F.col("_n") == 1, -1).otherwise(F.col("_s"))).orderBy(*order)
    return part.withColumn("_m", F.row_number().over(last)).withColumn("duplicate", (F.col("_n") > 1) | (F.col("_m") > 1)).drop("_s", "_n", "_m")


def keep_first(df: DataFrame, key: Column | list[Column], *order: Column) -> DataFrame:
    """Only the first row of each key; Catalyst limits each group to one row before the shuffle, so hot keys cost no more than others."""
    w = Window.partitionBy(*(key if isinstance(key, list) else [key])).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def ranked(df: DataFrame, group: list[str], *order: Column) -> DataFrame:
    """Adds ``rank`` (from 0) and ``size`` of each row in its group, without any group in one task.

    Rows are range-partitioned by group and order (ties by a hash of the row), ranked within their partition, and moved on by the sizes of the group's
    earlier partitions, of which there are few.  Rows equal in everything stay together; the table is written once so that both readings agree.
    """
    tie = F.xxhash64(*df.columns)
    spread = df.repartitionByRange(*(F.col(g) for g in group), *order, tie).withColumn("_p", F.spark_partition_id())
    w = Window.partitionBy(*group, "_p").orderBy(*order, tie)
    local = stage(spread.withColumn("_r", F.row_number().over(w) - 1), "ranked")
    sizes = local.groupBy(*group, "_p").agg(F.count("*").alias("_c"))
    by = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(by), F.lit(0))).withColumn("size", F.sum("_c").over(Window.partitionBy(*group)))
    sizes = sizes.withColumnsRenamed({c: f"_of_{c}" for c in [*group, "_p"]})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*group, "_p"]]
    return local.join(sizes, same).select(*df.columns, (F.col("_r") + F.col("_before")).alias("rank"), "size")


def keep_last(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row of each key that is greatest in ``order``, then in its other columns; one hash aggregation, no sort of whole groups."""
    rest = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_r")).select(key, "_r.*").select(*df.columns)


def new_records(df: DataFrame, seen: DataFrame, hash_col: str = "sha256") -> DataFrame:
    """Rows whose hash isn't in the persisted table ``seen``, the first of equal ones only if the batch was reduced before."""
    return df.join(seen.select(hash_col).distinct(), hash_col, "left_anti")


def exact_dedup(df: DataFrame, text: Column, *order: Column, seen: DataFrame | None = None) -> DataFrame:
    """Adds ``sha256, reason``: ``reject.dedup.exact`` for texts seen in an earlier run or earlier in this order, else ``keep``."""
    hashed = first_wins(df.withColumn("sha256", H.text_hash(text)), F.col("sha256"), *order)
    if seen is not None:
        hashed = hashed.join(seen.select("sha256").distinct().withColumn("_seen", F.lit(True)), "sha256", "left")
        hashed = hashed.withColumn("duplicate", F.col("duplicate") | F.coalesce("_seen", F.lit(False))).drop("_seen")
    return hashed.withColumn("reason", F.when(F.col("duplicate"), "reject.dedup.exact").otherwise("keep")).drop("duplicate")


@lru_cache
def best_bands(threshold: float, permutations: int) -> tuple[int, int]:
    """Bands and rows whose S-curve has the least area of errors, half false positives and half false negatives."""

    def area(f, a, b, n=200):
        h = (b - a) / n
        return sum(f(a + (i + 0.5) * h) for i in range(n)) * h

    best = (math.inf, 1, 1)
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            s = lambda x, b=b, r=r: 1 - (1 - x**r) ** b
            e = 0.5 * area(s, 0, threshold) + 0.5 * area(lambda x: 1 - s(x), threshold, 1)
            best = min(best, (e, b, r))
    return best[1], best[2]


def _bands_of(k: int, permutations: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        u64 = np.uint64
        rng = np.random.default_rng(1)
        mult, plus = rng.integers(0, 1 << 62, permutations, dtype=u64) * u64(2) + u64(1), rng.integers(0, 1 << 63, permutations, dtype=u64)
        weight = rng.integers(0, 1 << 62, rows, dtype=u64) * u64(2) + u64(1)
        step = rng.integers(0, 1 << 62, k, dtype=u64) * u64(2) + u64(1)
        place: dict[str, int] = {}
        hashes: list[int] = []
        for b in batches:
            texts = b.column("text").to_pylist()
            if len(hashes) > 1_000_000:  # the words a worker remembers; their hashes stay the same
                place, hashes = {}, []
            ids, ends = [], []
            for t in texts:
                for w in (t or "").lower().split():
                    if w not in place:
                        place[w] = len(hashes)
                        hashes.append(xxhash.xxh3_64_intdigest(w))
                    ids.append(place[w])
                ends.append(len(ids))
            size = np.diff(ends, prepend=0)
            # texts of fewer than k words are one shingle: they are filled up with an empty word
            need = np.maximum(size, np.where(size > 0, k, 0))
            to = np.cumsum(need)
            h = np.zeros(int(to[-1]) if len(to) else 0, u64)
            row = np.repeat(np.arange(len(texts)), size)
            h[np.arange(len(ids)) + (to - need - (np.array(ends) - size))[row]] = np.array(hashes, u64)[np.array(ids, np.int64)]
            row = np.repeat(np.arange(len(texts)), need)
            n = len(h) - k + 1
            signed: list = [[]] * len(texts)
            if n > 0:
                s = sum((h[j : n + j] * step[j] for j in range(k)), np.zeros(n, u64))
                inside = row[:n] == row[k - 1 :]
                s, row = s[inside], row[:n][inside]
                s = (s ^ (s >> u64(31))) * u64(0x9E3779B97F4A7C15)
                s ^= s >> u64(29)
                start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                low = np.stack([np.minimum.reduceat((s * m + p) >> u64(20), start) for m, p in zip(mult[: bands * rows], plus)], 1)
                keys = (low.reshape(len(start), bands, rows) * weight).sum(2, dtype=u64) ^ (np.arange(bands, dtype=u64) << u64(56))
                for i, key in zip(row[start].tolist(), keys.view(np.int64).tolist()):
                    signed[i] = key
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rank"), pa.array(signed, pa.list_(pa.int64()))], names=["id", "rank", "bands"])

    return run


def signed_bands(df: DataFrame, id_col: str, text_col: str, order_col: str, threshold: float = 0.8, permutations: int = 128, k: int = 5) -> DataFrame:
    """``id, rank, bands``: the band keys of each text's MinHash signature, none for a text without words; null ids are left out."""
    bands, rows = best_bands(threshold, permutations)
    kind, rank = dict(df.dtypes)[id_col], dict(df.dtypes)[order_col]
    cols = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(order_col).alias("rank"), F.col(text_col).alias("text"))
    return cols.mapInArrow(_bands_of(k, permutations, bands, rows), f"id {kind}, rank {rank}, bands array<bigint>")


def fuzzy_dedup(df: DataFrame, id_col: str, text_col: str, order_col: str, threshold: float = 0.8, permutations: int = 128, k: int = 5, most_rounds: int = 100) -> DataFrame:
    """``<id_col>, kept``: a record is dropped if it shares a band of its MinHash signature with an earlier record that is kept.

    The same as going through all records in order and inserting only kept ones, but in rounds: a record is kept once it is the first
    undecided one in each of its buckets and no kept one is before it there, and dropped once a kept one is.  A round groups by bucket and by record and
    emits no pairs, so a bucket that holds a third of all rows costs a partial aggregation.  Rounds grow with the longest chain of records that
    wait for each other.  ``order_col`` must be unique; records without words are kept; null ids are left out.
    """
    rank = dict(df.dtypes)[order_col]
    signed = stage(signed_bands(df, id_col, text_col, order_col, threshold, permutations, k), "fuzzy")
    open_ = signed.where(F.size("bands") > 0).select("id", "rank", F.explode("bands").alias("bucket"))
    # buckets of one record decide nothing
    shared = open_.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("bucket")
    open_ = stage(open_.join(shared, "bucket"), "fuzzy-open")
    kept_first = None
    dropped = []
    for _ in range(most_rounds):
        if not open_.limit(1).count():
            break
        first = open_.groupBy("bucket").agg(F.min("rank").alias("first"))
        seen = open_.join(first, "bucket")
        if kept_first is not None:
            seen = seen.join(kept_first, "bucket", "left")
        else:
            seen = seen.withColumn("kept", F.lit(None).cast(rank))
        hit = F.coalesce(F.col("kept") < F.col("rank"), F.lit(False))
        state = stage(seen.groupBy("id", "rank").agg(F.max(hit).alias("drop"), F.min((F.col("rank") == F.col("first")) & ~hit).alias("keep")), "fuzzy-state")
        dropped.append(state.where(F.col("drop")).select("id"))
        now = open_.join(state.where(F.col("keep")).select("id"), "id", "left_semi").groupBy("bucket").agg(F.min("rank").alias("kept"))
        kept_first = now if kept_first is None else kept_first.unionByName(now).groupBy("bucket").agg(F.min("kept").alias("kept"))
        kept_first = stage(kept_first, "fuzzy-kept")
        open_ = stage(open_.join(state.where(F.col("drop") | F.col("keep")).select("id"), "id", "left_anti"), "fuzzy-open")
    else:
        raise RuntimeError(f"more than {most_rounds} rounds; raise most_rounds")
    every = signed.select("id")
    if dropped:
        gone = dropped[0]
        for d in dropped[1:]:
            gone = gone.unionByName(d)
        every = every.join(gone.distinct().withColumn("_gone", F.lit(True)), "id", "left")
        return every.select(F.col("id").alias(id_col), F.col("_gone").isNull().alias("kept"))
    return every.select(F.col("id").alias(id_col), F.lit(True).alias("kept"))


def combined_dedup(df: DataFrame, id_col: str, text_col: str, order_col: str, seen: DataFrame | None = None, **fuzzy) -> DataFrame:
    """``<id_col>, reason``: exact duplicates first (their hash counts even if the record is dropped later), near duplicates among the rest."""
    exact = exact_dedup(df, F.col(text_col), F.col(order_col), seen=seen)
    exact = stage(exact.select(*dict.fromkeys([id_col, text_col, order_col, "reason"])), "combined")
    near = fuzzy_dedup(exact.where(F.col("reason") == "keep"), id_col, text_col, order_col, **fuzzy)
    return exact.join(near, id_col, "left").select(id_col, F.when(F.col("reason") != "keep", F.col("reason")).when(~F.col("kept"), "reject.dedup.fuzzy").otherwise("keep").alias("reason"))


def pair_dedup(df: DataFrame, left: Column, right: Column, *order: Column) -> DataFrame:
    """Adds ``pair_hash, duplicate``: a pair of texts, taken as they are, that came before in this order."""
    return first_wins(df.withColumn("pair_hash", H.joined_hash(left, right)), F.col("pair_hash"), *order)


def capped_sides(df: DataFrame, left: str, right: str, order_col: str, most: int = 5, most_rounds: int = 200) -> DataFrame:
    """Adds ``accepted``: new pairs in order, each side at most ``most`` times among accepted ones.

    Whether a pair is accepted depends on those accepted before it that share a side with it.  In rounds: a pair is accepted once it is among as many
    first undecided pairs of each of its sides as that side has places left, and dropped once one of them has none.  Ranks above ``most`` decide
    nothing, so Catalyst cuts each side to its first rows before the shuffle and a side in a third of all pairs isn't gathered in one task.
    Rounds grow with the longest chain of pairs that wait for each other; more than ``most_rounds`` raise an error.
    """
    rows = df.withColumn("_l", F.xxhash64(left)).withColumn("_r", F.xxhash64(right))
    todo = stage(keep_first(rows.select("_l", "_r", F.col(order_col).alias("_o")), [F.col("_l"), F.col("_r")], F.col("_o")), "sides")
    accepted, rounds = None, 0
    while todo.limit(1).count():
        rounds += 1
        if rounds > most_rounds:
            raise RuntimeError(f"more than {most_rounds} rounds; raise most_rounds")
        sure = todo
        used = {}
        for side in ("_l", "_r"):
            first = todo.select(side, "_o").withColumn("_n", F.row_number().over(Window.partitionBy(side).orderBy("_o"))).where(F.col("_n") <= most)
            if accepted is not None:
                used[side] = accepted.groupBy(side).agg(F.count("*").alias("_used"))
                first = first.join(used[side], side, "left").where(F.col("_n") <= most - F.coalesce("_used", F.lit(0)))
            sure = sure.join(first.select("_o"), "_o", "left_semi")
        sure = stage(sure, "sides-sure")
        accepted = sure if accepted is None else stage(accepted.unionByName(sure), "sides-accepted")
        rest = todo.join(sure.select("_o"), "_o", "left_anti")
        for side in ("_l", "_r"):
            closed = accepted.groupBy(side).agg(F.count("*").alias("_used")).where(F.col("_used") >= most)
            rest = rest.join(closed.select(side), side, "left_anti")
        todo = stage(rest, "sides-todo")
    if accepted is None:
        return df.withColumn("accepted", F.lit(False))
    return df.join(accepted.select(F.col("_o").alias(order_col)).withColumn("accepted", F.lit(True)), order_col, "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def parallel_dedup(df: DataFrame, left: str, right: str, order_col: str, most: int = 5) -> DataFrame:
    """Adds ``pair_hash, reason``: ``reject.duplicate`` for a pair that came before, or a side accepted ``most`` times before; else ``ok``.

    Pairs and sides are compared by their normalized texts.  A pair counts as seen even if a side turned it down.  ``order_col`` must be unique
    and not null; null texts count as empty.
    """
    clean = lambda c: T.normalize_text(F.coalesce(F.col(c), F.lit("")))
    hashed = df.withColumn("_ln", clean(left)).withColumn("_rn", clean(right))
    hashed = hashed.withColumn("pair_hash", H.joined_hash(F.col("_ln"), F.col("_rn"))).withColumn("_lh", H.text_hash(F.col("_ln"))).withColumn("_rh", H.text_hash(F.col("_rn"))).drop("_ln", "_rn")
    hashed = stage(hashed, "parallel")
    first = first_wins(hashed.select("pair_hash", "_lh", "_rh", order_col), F.col("pair_hash"), F.col(order_col)).where(~F.col("duplicate"))
    taken = capped_sides(first.select("_lh", "_rh", order_col), "_lh", "_rh", order_col, most).where(F.col("accepted")).select(order_col, F.lit("ok").alias("_ok"))
    return hashed.join(taken, order_col, "left").withColumn("reason", F.coalesce("_ok", F.lit("reject.duplicate"))).drop("_lh", "_rh", "_ok")


def latest_capture(df: DataFrame, url: str = "url", timestamp: str = "capture_ts", seen: str = "capture_id") -> DataFrame:
    """The row of each URL with the greatest timestamp, compared as text; of equal ones the one that comes first by ``seen``."""
    return keep_first(df, F.col(url), F.col(timestamp).desc_nulls_last(), F.col(seen).asc_nulls_last(), F.xxhash64(*df.columns))
