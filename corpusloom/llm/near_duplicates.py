"""Near-duplicate records with small edits (problem 3).

Deletion-variant signatures: a text's signature is cut into few segments, so few that in a similar pair some segment differs in at most
one position; each segment is indexed under its variants with one position left out, the index is joined on equality and every
candidate is verified against its whole shingle set.  At the similarities wanted here (Jaccard 0.6) single bits differ too often to
make a selective segment, so a position of the signature is a whole 32-bit minimum of a hash over the shingles instead of one bit of it.

Texts with the same shingle set are one class.  The index, the join and the verification work on classes, so a group of exact copies
costs as much as one text.  Shingle sets are made in a second pass and only for classes that have a candidate, which a Bloom filter of
bounded size tells; where there are too many candidates for that filter, a join on the class does.

A bucket of the index (the classes that share a variant) is joined with itself in blocks of bounded size, so none is one task's work.  All pairs of
similar texts can't be had for less than what they are; where only the groups are wanted (``links="connected"``), a bucket above the block size is
joined as a star around its first class, and only what isn't similar to that class is compared with the rest of the bucket.

Verification compares sets of 32-bit hashes of shingles.  Two different shingles of a pair of texts of a thousand words have the same hash with a
probability of about 0.0002, which moves the similarity by a thousandth.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import SLOT_DDL, add_up, pieces, slots

_WORD = re.compile(r"[^\W_]+")
_U = np.uint64

#: Most words remembered per worker; beyond it the memory starts anew (the hashes stay the same).
WORD_CACHE = 2_000_000


class _Words(dict):
    """Word -> place in a growing table of 64-bit hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: str) -> int:
        import xxhash

        self[word] = n = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return n


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def shingle_hashes(texts: list, k: int, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """All k-word sequences of all texts as 64-bit hashes with the text's number, in order."""
    ids: list[int] = []
    lens = []
    for t in texts:
        w = _WORD.findall(t.lower()) if t else ()
        ids.extend([words[x] for x in w])
        lens.append(len(w))
    lens = np.array(lens, np.int64)
    if len(ids) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.array(words.hashes, np.uint64)[np.array(ids, np.int64)]
    mult = _odd(k, 17)
    s = h[: len(h) - k + 1] * mult[0]
    for j in range(1, k):
        s = s + h[j : len(h) - k + 1 + j] * mult[j]
    row = np.repeat(np.arange(len(texts)), lens)
    inside = row[: len(s)] == row[k - 1 :]
    return _mixed(s[inside]), row[: len(s)][inside]


def signatures(texts: list, k: int, segments: int, width: int, words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, class, variants, sets, ends)`` of the texts that have a shingle.

    ``variants`` has ``segments * width`` keys per text; ``sets`` holds the distinct 32-bit shingle hashes of all texts in turn, up
    to ``ends``.
    """
    h, row = shingle_hashes(texts, k, words)
    if not len(h):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros((0, segments * width), np.int64), np.zeros(0, np.int32), z
    start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    text = row[start]
    mult, plus = _odd(segments * width, 29), _odd(segments * width, 31)
    minima = np.empty((len(start), segments * width), np.uint64)
    for i in range(segments * width):
        minima[:, i] = np.minimum.reduceat((h * mult[i] + plus[i]) >> _U(32), start)
    variants = np.empty((len(start), segments * width), np.int64)
    weight, place = _odd(width, 37), _odd(segments * width, 41)
    for s in range(segments):
        part = minima[:, s * width : (s + 1) * width] * weight
        whole = part.sum(1, dtype=np.uint64)
        for p in range(width):
            variants[:, s * width + p] = _mixed(whole - part[:, p] + place[s * width + p]).view(np.int64)
    rank = np.cumsum(np.r_[True, row[1:] != row[:-1]]) - 1
    uniq = np.unique((rank.astype(np.uint64) << _U(32)) | (h >> _U(32)))
    of = (uniq >> _U(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    small = (uniq & _U(0xFFFFFFFF)).astype(np.uint32)
    cls = np.add.reduceat(_mixed(small.astype(np.uint64) + _U(1)), first).view(np.int64)
    return text, cls, variants, small.view(np.int32), np.r_[first[1:], len(small)]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    at = F.col("fetched_at") if "fetched_at" in docs.columns else F.lit(None).cast("timestamp")
    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), at.alias("at"), F.col(text_col).alias("text"))


def _lists(values: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> pa.ListArray:
    """Rows of ``values`` up to ``ends`` where ``keep``, else null."""
    starts = np.r_[0, ends[:-1]] if len(ends) else ends
    length = (ends - starts) * keep
    pick = np.repeat(starts - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum()) if len(ends) else np.zeros(0, np.int64)
    offsets = pa.array(np.r_[0, np.cumsum(length)].astype(np.int32), mask=np.r_[~keep, False]) if len(ends) else pa.array([0], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values[pick]))


def _new(cls: np.ndarray, seen: set) -> np.ndarray:
    """Which classes are not in ``seen`` yet; adds them."""
    out = np.zeros(len(cls), bool)
    for i, c in enumerate(cls.tolist()):
        if c not in seen:
            seen.add(c)
            out[i] = True
    return out


def index(docs: DataFrame, id_col: str, text_col: str, k: int, segments: int, width: int) -> DataFrame:
    """``id, at, class, variants`` of every row whose text has at least ``k`` words; variants once per class and partition, else null."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        for b in batches:
            texts, begin = b.column("text").to_pylist(), 0
            for part in pieces(texts):
                if len(words) > WORD_CACHE:
                    words = _Words()
                row, cls, variants, _, _ = signatures(part, k, segments, width, words)
                take = pa.array(row + begin)
                begin += len(part)
                n = variants.shape[1]
                lists = _lists(variants.reshape(-1), np.arange(1, len(row) + 1) * n, _new(cls, seen))
                yield pa.RecordBatch.from_arrays([b.column("id").take(take), b.column("at").take(take), pa.array(cls), lists], names=["id", "at", "class", "variants"])

    return _rows(docs, id_col, text_col).mapInArrow(run, f"id {kind}, at timestamp, class bigint, variants array<bigint>")


#: Classes of a bucket (or copies of a text) that are joined with each other in one block.
BLOCK = 1000


def _blocks(sized: DataFrame, block: int) -> DataFrame:
    """Adds ``_m, _b``: the number of blocks of the row's key (``n`` rows) and the row's own one, dealt by a hash of ``id``."""
    m = F.ceil(F.col("n") / block).cast("int")
    return sized.withColumn("_m", m).withColumn("_b", F.pmod(F.xxhash64("id", F.lit(7)), m).cast("int"))


def pairs_within(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b`` (a < b) of all rows (``key, id``, distinct) of the same key.

    Keys of up to ``block`` rows are joined as they are.  Those of more are cut into blocks, and every two of them (and each with itself) are a task's work
    of their own; a row travels once per block of its key.  Keys of one row, mostly nearly all, are left out first; what is left is written once.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return _pairs_of(stage(rows.join(sizes, "key"), "shared-keys"), block)


def _pairs_of(sized: DataFrame, block: int) -> DataFrame:
    """:func:`pairs_within` of rows (``key, id, n``) of keys that several rows have."""
    few = sized.where(F.col("n") <= block)
    small = few.select("key", F.col("id").alias("a")).join(few.select("key", F.col("id").alias("b")), "key").where(F.col("a") < F.col("b")).select("a", "b")
    many = _blocks(sized.where(F.col("n") > block), block)
    left = many.select("key", F.col("id").alias("x"), F.col("_b").alias("i"), F.explode(F.sequence(F.col("_b"), F.col("_m") - 1)).alias("j"))
    right = many.select("key", F.col("id").alias("y"), F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("i"), F.col("_b").alias("j"))
    large = left.join(right, ["key", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("x") < F.col("y")))
    return small.unionByName(large.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def bucket_rows(indexed: DataFrame) -> DataFrame:
    """``key, id``: the variants and the classes that have them, once each."""
    keys = indexed.where(F.col("variants").isNotNull()).select(F.explode("variants").alias("key"), F.col("class").alias("id"))
    # one class may come from several partitions; this grouping and the joins all work on the one shuffle by key
    return keys.repartition("key").groupBy("key", "id").agg(F.lit(1).alias("_")).select("key", "id")


def candidate_pairs(indexed: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b`` (a < b) of the classes that share a variant."""
    return pairs_within(bucket_rows(indexed), block).distinct()


def connected_pairs(indexed: DataFrame, similar, block: int = BLOCK) -> DataFrame:
    """Similar pairs ``a, b`` that connect the same classes as all similar ones of :func:`candidate_pairs` do; ``similar`` verifies candidates.

    Buckets of up to ``block`` classes give all their pairs.  In a larger one every class is compared with the first; whatever is similar to it hangs
    together through it, and only what isn't is compared with the whole bucket.  For edits of one text that is linear in their number.
    """
    rows = bucket_rows(indexed)
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first")).where(F.col("n") > 1)
    sized = stage(rows.join(sizes, "key"), "p3-sized")
    small = _pairs_of(sized.where(F.col("n") <= block), block)
    star = sized.where((F.col("n") > block) & (F.col("id") != F.col("first")))
    hub = lambda d: d.select(F.least("first", "id").alias("a"), F.greatest("first", "id").alias("b"))
    found = stage(similar(stage(small.unionByName(hub(star)).distinct(), "p3-candidates")), "p3-star")
    ends = star.withColumn("a", F.least("first", "id")).withColumn("b", F.greatest("first", "id"))
    failed = ends.join(found.select("a", "b"), ["a", "b"], "left_anti").select("key", F.col("id").alias("x"), "n")
    whole = _blocks(sized.where(F.col("n") > block), block).select("key", F.col("id").alias("y"), "_b")
    rest = failed.select("key", "x", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / block).cast("int") - 1)).alias("_b")).join(whole, ["key", "_b"]).where(F.col("x") != F.col("y"))
    rest = stage(rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "p3-rest")
    return found.unionByName(similar(rest)) if rest.limit(1).count() else found


def _places(cls: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = cls.view(np.uint64)
    return (h & _U(bits - 1)).astype(np.int64), ((h >> _U(32)) * _U(0x9E3779B1) & _U(bits - 1)).astype(np.int64)


def _bloom(candidates: DataFrame, most_bits: int) -> np.ndarray | None:
    """A bit set in which both places of every candidate class are set, 32 bits a pair; None where that would take more than ``most_bits``."""
    pairs = candidates.count()
    bits = max(1 << 20, 1 << (32 * pairs).bit_length())
    if bits > most_bits:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(bits // 8, np.uint8)
        for b in batches:
            for c in ("a", "b"):
                for place in _places(b.column(c).to_numpy(zero_copy_only=False), bits):
                    np.bitwise_or.at(flags, place >> 3, (128 >> (place & 7)).astype(np.uint8))
        yield slots(flags.reshape(-1, 1024))

    return add_up(candidates.mapInArrow(run, SLOT_DDL), (bits // 8192, 1024), np.uint8, np.bitwise_or).reshape(-1)


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, k: int, candidates: DataFrame, most_bloom_bits: int) -> DataFrame:
    """``class, s``: the distinct 32-bit shingle hashes of every class in a candidate pair (and of a few more)."""
    bloom = _bloom(candidates, most_bloom_bits)
    shared = None if bloom is None else docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        bits = None if shared is None else shared.value

        def hit(place: np.ndarray) -> np.ndarray:
            return ((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool)

        for b in batches:
            for part in pieces(b.column("text").to_pylist()):
                if len(words) > WORD_CACHE:
                    words = _Words()
                _, cls, _, sets, ends = signatures(part, k, 0, 1, words)
                keep = np.ones(len(cls), bool)
                if bits is not None:
                    one, two = _places(cls, len(bits) * 8)
                    keep = hit(one) & hit(two)
                keep[keep] = _new(cls[keep], seen)
                lists = _lists(sets, ends, keep)
                take = pa.array(np.flatnonzero(keep))
                yield pa.RecordBatch.from_arrays([pa.array(cls).take(take), lists.take(take)], names=["class", "s"])

    found = _rows(docs, id_col, text_col).select("text").mapInArrow(run, "class bigint, s array<int>")
    if bloom is None:
        needed = candidates.select(F.col("a").alias("class")).unionByName(candidates.select(F.col("b").alias("class"))).distinct()
        found = found.join(needed, "class", "left_semi")
    return found.groupBy("class").agg(F.first("s").alias("s"))


def verified(candidates: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the candidates whose shingle sets are as similar as ``threshold``."""
    both = candidates.join(sets.select(F.col("class").alias("a"), F.col("s").alias("sa")), "a")
    both = both.join(sets.select(F.col("class").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("similarity")).where(F.col("similarity") >= threshold)


def members(indexed: DataFrame, known: DataFrame | None) -> DataFrame:
    """``id, class``: each id once, with its latest text's class; only ids in ``known`` if given."""
    one = indexed.groupBy("id").agg(F.max(F.struct("at", "class")).alias("r")).select("id", F.col("r.class").alias("class"))
    return one if known is None else one.join(known, "id", "left_semi")


def near_duplicates(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8, segments: int = 8, width: int = 4, links: str = "all", block: int = BLOCK, most_bloom_bits: int = 1 << 28
) -> tuple[DataFrame, DataFrame]:
    """Similar classes of texts and the ids in them: ``(pairs: a, b, similarity)`` and ``(members: id, class)``.

    Similarity is the number of distinct k-word sequences in both texts over the number in either; words are runs of letters and digits
    in lower case.  With the default signature a pair of similarity s is found with probability ``1 - (1 - 4 s^3 (1-s) - s^4)^8``: 0.994
    at 0.6, 0.9995 at 0.7.  ``known`` (a column ``id``) restricts the ids.

    ``links="all"`` gives every similar pair of classes; ``"connected"`` gives similar pairs that connect the same classes, fewer of them in buckets of more
    than ``block`` classes.  Neither drops a class or a bucket.

    Null ids and null texts are ignored; a text of fewer than k words has no sequence and is similar to nothing; rows delivered again
    count once, with the latest ``fetched_at``; other columns are ignored.
    """
    table = stage(index(docs, id_col, text_col, k, segments, width), "p3")

    def similar(candidates: DataFrame) -> DataFrame:
        sets = stage(shingle_sets(docs, id_col, text_col, k, candidates, most_bloom_bits), "p3-sets")
        return verified(candidates, sets, threshold)

    if links == "connected":
        return connected_pairs(table, similar, block), members(table, known)
    return similar(stage(candidate_pairs(table, block), "p3-candidates")), members(table, known)


def id_pairs(pairs: DataFrame, of: DataFrame, copies: str = "all") -> DataFrame:
    """``doc_id_a, doc_id_b`` (a < b) of similar ids.

    ``copies="all"`` pairs every two ids of similar or equal texts.  ``"first"`` pairs the first ids of similar classes, and within a class the first id with
    each other one, so that pairs grow with the copies instead of their square; together with the members that tells as much.
    """
    if copies == "first":
        first = of.groupBy("class").agg(F.min("id").alias("first"))
        a, b = first.select(F.col("class").alias("a"), F.col("first").alias("ia")), first.select(F.col("class").alias("b"), F.col("first").alias("ib"))
        within = of.join(first, "class").where(F.col("id") != F.col("first")).select(F.col("first").alias("ia"), F.col("id").alias("ib"))
    else:
        a, b = of.select(F.col("class").alias("a"), F.col("id").alias("ia")), of.select(F.col("class").alias("b"), F.col("id").alias("ib"))
        within = pairs_within(of.select(F.col("class").alias("key"), "id")).select(F.col("a").alias("ia"), F.col("b").alias("ib"))
    every = pairs.select("a", "b").join(a, "a").join(b, "b").select("ia", "ib").unionByName(within)
    return every.select(F.least("ia", "ib").alias("doc_id_a"), F.greatest("ia", "ib").alias("doc_id_b"))


def components(pairs: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``class, grp`` of every class in a pair: the least class it is linked to over any number of links.

    A round moves every class to the neighbour (or itself) that is first in an order drawn anew for the round, and the links with it, until no
    link is left.  That joins linked classes only and takes about half of the classes away, so rounds grow with the logarithm of the largest
    group, chains included, and links shrink from round to round.  Every round is a written table and only its number of links reaches the driver.
    """
    links = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(F.col("a") != F.col("b")).distinct()
    links = stage(links, "p3-links")
    moves = []
    while links.limit(1).count():
        if len(moves) == most_rounds:
            raise RuntimeError(f"more than {most_rounds} rounds; raise most_rounds")
        drawn = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves))).alias("h"), F.col(c).alias("to"))  # noqa: B023, E731
        move = links.groupBy("a").agg(F.min(drawn("b")).alias("m")).select(F.col("a").alias("class"), F.least("m", drawn("a"))["to"].alias("to"))
        move = stage(move, "p3-moves")
        moves.append(move)
        for c in ("a", "b"):
            links = links.join(move.select(F.col("class").alias(c), F.col("to").alias(f"{c}_to")), c)
        links = stage(links.select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).where(F.col("a") != F.col("b")).distinct(), "p3-links")
    if not moves:
        return links.select(F.col("a").alias("class"), F.col("b").alias("grp"))
    # from the last round back: where a class ends is where the one it moved to ends
    ends = moves.pop()
    while moves:
        later = ends.select(F.col("class").alias("to"), F.col("to").alias("end"))
        ends = stage(moves.pop().join(later, "to", "left").select("class", F.coalesce("end", "to").alias("to")), "p3-ends")
    least = ends.groupBy("to").agg(F.min("class").alias("grp"))
    return ends.join(least, "to").select("class", "grp")


def groups(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """``doc_id, class_id, group_id, copies``: every id with the first id of its texts' class, the first id of its group of linked classes, and the number of ids in its class."""
    pairs = stage(pairs.select("a", "b"), "p3-pairs")
    size = of.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    linked = components(pairs)
    first = size.join(linked, "class").groupBy("grp").agg(F.min("class_id").alias("group_id"))
    named = size.join(linked.join(first, "grp").select("class", "group_id"), "class", "left")
    return of.join(named, "class").select(F.col("id").alias("doc_id"), "class_id", F.coalesce("group_id", "class_id").alias("group_id"), "copies")
