"""Hot buckets and hot texts: the same result in blocks, candidates in proportion to the rows where only groups are wanted."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from corpusloom.llm import near_duplicates as N


def test_pairs_in_blocks(spark):
    rng = random.Random(3)
    rows = [("hot", i) for i in rng.sample(range(10**6), 45)] + [(f"k{i % 9}", i) for i in range(20)] + [("one", 5)]
    want = sorted((min(a, b), max(a, b)) for k in {k for k, _ in rows} for a, b in combinations([i for q, i in rows if q == k], 2))
    df = spark.createDataFrame(rows, "key string, id long")
    for block in (1, 2, 10, 44, 1000):
        assert sorted(map(tuple, N.pairs_within(df, block).collect())) == want
    assert N.pairs_within(df.limit(0)).count() == 0


def _edits(n: int):
    """``n`` one-word edits of one text and 40 texts of their own."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        w[rng.randrange(150)] = word()
        rows.append((f"e{i:06d}", " ".join(w)))
    return rows + [(f"o{i}", " ".join(word() for _ in range(60))) for i in range(40)]


def test_groups_of_edits_are_linear(spark):
    n, block = 3000, 100
    df = spark.createDataFrame(_edits(n), "doc_id string, text string").repartition(4)
    compared = []

    def similar(candidates):
        compared.append(candidates.count())
        sets = N.stage(N.shingle_sets(df, "doc_id", "text", 5, candidates, 1 << 28))
        return N.verified(candidates, sets, 0.6)

    table = N.stage(N.index(df, "doc_id", "text", 5, 8, 4))
    pairs = N.connected_pairs(table, similar, block)
    # at most one pair a class and key, not some four million pairs
    assert sum(compared) < 40 * n
    got = {r.doc_id: r.group_id for r in N.groups(pairs, N.members(table, None)).collect()}
    assert len(got) == n + 40 and {g for i, g in got.items() if i[0] == "e"} == {"e000000"} and all(g == i for i, g in got.items() if i[0] == "o")


def test_connected_as_all(spark):
    """Chains of edits: far ends of a bucket aren't similar to its first class, yet all groups come out as with all links."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    rows = []
    for c in range(4):
        w = [word() for _ in range(40)]
        for i in range(60):
            w = list(w)
            w[rng.randrange(40)] = word()
            rows.append((f"{c}-{i:03d}", " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id string, text string")
    groups = [{r.doc_id: (r.class_id, r.group_id, r.copies) for r in N.groups(*N.near_duplicates(df, k=3, threshold=0.6, links=links, block=block)).collect()} for links, block in (("all", 1000), ("all", 7), ("connected", 7))]
    assert groups[0] == groups[1] == groups[2] and len(groups[0]) == len(rows)


def test_copies_and_the_way_without_a_filter(spark):
    rows = [(f"a{i:02d}", "one two three four five six") for i in range(30)] + [("b", "one two three four five seven"), ("c", "x y"), (None, "one two three four"), ("d", None), ("d", "")]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("class", F.lit("x"))
    for bits in (1 << 28, 1):
        p, m = N.near_duplicates(df, k=3, threshold=0.6, most_bloom_bits=bits)
        every = {tuple(r) for r in N.id_pairs(p, m).collect()}
        assert len(every) == 30 * 29 // 2 + 30
        few = {tuple(r) for r in N.id_pairs(p, m, copies="first").collect()}
        assert few == {("a00", f"a{i:02d}") for i in range(1, 30)} | {("a00", "b")}
        got = {r.doc_id: (r.class_id, r.group_id, r.copies) for r in N.groups(p, m).collect()}
        assert got["a07"] == ("a00", "a00", 30) and got["b"] == ("b", "a00", 1) and "c" not in got
