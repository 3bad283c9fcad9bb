"""Filling containers of fixed capacity with documents (problem 7).

Cost-balanced packing: a document of s tokens costs ``linear * s + quadratic * s**2`` (projection and attention work).  Documents go
in descending size to the cheapest sequence that still has room, then the items of sequences with more
than a hundredth unused are packed once more into the tightest room.  Documents are dealt by a hash of their id into groups of bounded size that are packed independently, so no task sees more than
``group_items`` documents however many there are; a group wastes less than about one container.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Room:
    """Open sequences by remaining capacity: the cheapest with at least s left in O(log capacity)."""

    def __init__(self, capacity: int):
        import heapq

        self.heapq = heapq
        self.size = 1 << capacity.bit_length()
        self.best: list[tuple[float, int] | None] = [None] * (2 * self.size)
        self.leaf: dict[int, list[tuple[float, int]]] = {}

    def _lift(self, at: int) -> None:
        best, i = self.best, (at + self.size) >> 1
        while i:
            a, b = best[2 * i], best[2 * i + 1]
            new = a if b is None or (a is not None and a <= b) else b
            if best[i] == new:
                break
            best[i] = new
            i >>= 1

    def add(self, room: int, cost: float, seq: int) -> None:
        heap = self.leaf.setdefault(room, [])
        self.heapq.heappush(heap, (cost, seq))
        self.best[room + self.size] = heap[0]
        self._lift(room)

    def cheapest(self, least: int) -> tuple[float, int] | None:
        best, lo, hi, out = self.best, least + self.size, 2 * self.size, None
        while lo < hi:
            if lo & 1:
                if best[lo] is not None and (out is None or best[lo] < out):
                    out = best[lo]
                lo += 1
            if hi & 1:
                hi -= 1
                if best[hi] is not None and (out is None or best[hi] < out):
                    out = best[hi]
            lo >>= 1
            hi >>= 1
        return out

    def take(self, room: int) -> None:
        """Remove the cheapest sequence with exactly this room."""
        heap = self.leaf[room]
        self.heapq.heappop(heap)
        self.best[room + self.size] = heap[0] if heap else None
        self._lift(room)


def pack_group(sizes: list[int], capacity: int, linear: float = 1.0, quadratic: float = 1 / 4096, slack: float = 0.01) -> list[int]:
    """The sequence number of each item; every size must be in 1..capacity.  The same sizes give the same answer."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    room, free, cost, members, where = _Room(capacity), [], [], [], [0] * len(sizes)

    def open_one() -> None:
        free.append(capacity)
        cost.append(0.0)
        members.append([])
        room.add(capacity, 0.0, len(free) - 1)

    for _ in range(math.ceil(sum(sizes) / capacity)):
        open_one()
    for i in order:
        s = sizes[i]
        hit = room.cheapest(s)
        if hit is None:
            open_one()
            hit = (0.0, len(free) - 1)
        q = hit[1]
        room.take(free[q])
        free[q] -= s
        cost[q] += linear * s + quadratic * s * s
        members[q].append(i)
        where[i] = q
        if free[q]:
            room.add(free[q], cost[q], q)
    _refill(sizes, capacity, free, members, where, slack)
    number = {q: n for n, q in enumerate(sorted(set(where)))}
    return [number[q] for q in where]


def _refill(sizes: list[int], capacity: int, free: list[int], members: list[list[int]], where: list[int], slack: float) -> None:
    """Pack the items of all sequences with more than ``slack`` of the capacity unused again, each into the tightest room; keep that if it takes fewer sequences."""
    loose = [q for q, f in enumerate(free) if f > slack * capacity]
    again = sorted((i for q in loose for i in members[q]), key=lambda i: (-sizes[i], i))
    gaps: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for i in again:
        at = bisect_left(gaps, (sizes[i], -1))
        if at < len(gaps):
            g, b = gaps.pop(at)
        else:
            g, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if g > sizes[i]:
            insort(gaps, (g - sizes[i], b))
    if len(bins) < sum(bool(members[q]) for q in loose):
        for b, q in enumerate(loose):
            members[q] = bins[b] if b < len(bins) else []
            for i in members[q]:
                where[i] = q


def profile_rows(profiles: DataFrame):
    """The profiles (a dimension table of a few rows, read whole) as one array of ``profile, capacity, eos``, to be unfolded beside each document."""
    rows = profiles.where((F.col("capacity_tokens") > 0) & F.col("profile").isNotNull()).select("profile", "capacity_tokens", F.coalesce("eos_tokens", F.lit(0)).alias("eos")).distinct().collect()
    every = [F.struct(F.lit(r.profile).alias("profile"), F.lit(r.capacity_tokens).cast("long").alias("capacity"), F.lit(r.eos).cast("long").alias("eos")) for r in rows]
    return F.array(*every) if every else F.array().cast("array<struct<profile: string, capacity: bigint, eos: bigint>>")


def items(sized: DataFrame, profiles: DataFrame, id_col: str = "doc_id", tokens_col: str = "n_tokens") -> DataFrame:
    """Pieces to place: ``profile, capacity, id, piece_no, pieces, start_token, tokens``; tokens include the profile's end tokens.

    Only documents above the capacity have more than one piece; all but their last piece fill a container.
    """
    docs = sized.where(F.col(id_col).isNotNull() & (F.col(tokens_col) > 0)).select(F.col(id_col).alias("id"), F.col(tokens_col).cast("long").alias("n"))
    each = docs.select("id", "n", F.inline(profile_rows(profiles))).withColumn("need", F.col("n") + F.col("eos"))
    each = each.withColumn("pieces", F.ceil(F.col("need") / F.col("capacity")).cast("long"))
    each = each.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    start = F.col("piece_no") * F.col("capacity")
    return each.select("profile", "capacity", "id", "piece_no", "pieces", start.alias("start_token"), F.least(F.col("capacity"), F.col("need") - start).alias("tokens"))


def pack(sized: DataFrame, profiles: DataFrame, id_col: str = "doc_id", tokens_col: str = "n_tokens", group_items: int = 20_000, linear: float = 1.0, quadratic: float = 1 / 4096, n_rows: int | None = None) -> DataFrame:
    """Assign every document to containers of every profile.

    ``sized`` has one row per document (``id_col``, ``tokens_col``); ``profiles`` has ``profile, capacity_tokens, eos_tokens`` (a
    dimension table of a few rows).  Result, one row per piece: ``profile, container, <id_col>, piece_no, pieces, start_token, tokens,
    used, unused`` where ``used + unused`` is the capacity.  ``n_rows`` is the number of documents, counted if not given.

    Null ids and documents without tokens are not placed; profiles with a null or non-positive capacity are ignored, null end tokens
    are 0; an empty input gives no rows; repeated ids are separate items with equal names.
    """
    total = sized.count() if n_rows is None else n_rows
    groups = max(1, math.ceil(total / group_items))
    every = items(sized, profiles, id_col, tokens_col)
    full = every.where(F.col("tokens") == F.col("capacity")).withColumn("container", F.concat_ws("/", "profile", F.lit("full"), F.col("id").cast("string"), F.col("piece_no").cast("string")))
    rest = every.where(F.col("tokens") < F.col("capacity")).withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "id", "piece_no"], ascending=[False, True, True], kind="stable")
        seq = pd.Series(pack_group(pdf["tokens"].tolist(), int(pdf["capacity"].iloc[0]), linear, quadratic), index=pdf.index)
        head = f"{pdf['profile'].iloc[0]}/{pdf['grp'].iloc[0]}/"
        pdf["container"] = head + seq.astype(str)
        pdf["used"] = pdf["tokens"].groupby(seq).transform("sum")
        return pdf[["profile", "capacity", "id", "piece_no", "pieces", "start_token", "tokens", "container", "used"]]

    kind = dict(every.dtypes)["id"]
    placed = rest.groupBy("profile", "grp").applyInPandas(
        place, f"profile string, capacity bigint, id {kind}, piece_no bigint, pieces bigint, start_token bigint, tokens bigint, container string, used bigint"
    )
    both = placed.unionByName(full.withColumn("used", F.col("tokens")))
    return both.select("profile", "container", F.col("id").alias(id_col), "piece_no", "pieces", "start_token", "tokens", "used", (F.col("capacity") - F.col("used")).alias("unused"))


def containers(packed: DataFrame) -> DataFrame:
    """Per profile: containers, capacity in use and unused."""
    one = packed.groupBy("profile", "container").agg(F.first("used").alias("used"), F.first("unused").alias("unused"), F.count("*").alias("pieces"))
    return one.groupBy("profile").agg(
        F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("used"), F.sum("unused").alias("unused"), (F.sum("unused") / F.sum(F.col("used") + F.col("unused"))).alias("unused_share")
    )
