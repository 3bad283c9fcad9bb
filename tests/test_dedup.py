import random

from pyspark.sql import functions as F

from corpusloom.operators import dedup as D
from corpusloom.operators import packaging as P


def test_exact_and_seen(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "i int, text string")
    seen = spark.createDataFrame([("b",)], "t string").select(F.sha2("t", 256).alias("sha256"))
    got = {r.i: r.reason for r in D.exact_dedup(df.where("text is not null"), F.col("text"), F.col("i"), seen=seen).collect()}
    assert got == {1: "keep", 2: "reject.dedup.exact", 3: "reject.dedup.exact"}


def test_fuzzy_is_the_sequential_result(spark):
    rng = random.Random(1)
    base = [[f"w{rng.randrange(500)}" for _ in range(60)] for _ in range(12)]
    rows = []
    for i in range(80):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(80, ""), (81, rows[0][1])]
    df = spark.createDataFrame(rows, "i int, text string").repartition(5)
    bands = {r.id: r.bands for r in df.select(F.col("i").alias("id"), F.col("i").alias("rank"), "text").mapInArrow(D._bands_of(5, 128, *D.best_bands(0.8, 128)), "id int, rank int, bands array<bigint>").collect()}
    taken, kept = set(), {}
    for i, _ in rows:
        kept[i] = not (set(bands[i]) & taken)
        if kept[i]:
            taken |= set(bands[i])
    assert {r.i: r.kept for r in D.fuzzy_dedup(df, "i", "text", "i").collect()} == kept
    assert 1 < sum(not k for k in kept.values())


def test_capped_sides_is_the_sequential_result(spark):
    rng = random.Random(2)
    rows = [(i, f"p{rng.randrange(6)}", f"r{rng.randrange(9)}") for i in range(120)]
    seen, l, r, want = set(), {}, {}, {}
    for i, a, b in rows:
        want[i] = False
        if (a, b) in seen:
            continue
        seen.add((a, b))
        if l.get(a, 0) < 3 and r.get(b, 0) < 3:
            l[a], r[b], want[i] = l.get(a, 0) + 1, r.get(b, 0) + 1, True
    got = D.capped_sides(spark.createDataFrame(rows, "i int, a string, b string"), "a", "b", "i", 3).collect()
    assert {x.i: x.accepted for x in got} == want


def test_packing(spark):
    df = spark.createDataFrame([("s", 1, [1, 2, 3]), ("s", 2, [4]), ("s", 3, [5, 6]), ("t", 1, [7] * 4), ("t", 2, [8]), ("t", 3, [])], "shard string, o int, ids array<int>")
    got = sorted((r.shard, r.seq_no, list(r.input_ids)) for r in P.pack_sequences(df, "shard", "o", "ids", 0, 4).collect())
    assert got == [("s", 0, [1, 2, 3, 0]), ("s", 1, [4, 0, 5, 6]), ("t", 0, [7] * 4), ("t", 1, [8])]


def test_empty_tables(spark):
    e = spark.createDataFrame([], "i int, text string")
    assert D.fuzzy_dedup(e, "i", "text", "i").count() == 0
    assert D.combined_dedup(e, "i", "text", "i").count() == 0
