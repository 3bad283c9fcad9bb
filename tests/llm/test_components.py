import random

import pytest

from corpusloom.llm import near_duplicates


def test_components_of_long_chains(spark):
    rng = random.Random(5)
    ids = rng.sample(range(1 << 62), 3300)
    chain, star, two = ids[:3200], ids[3200:3298], ids[3298:]
    links = [*zip(chain, chain[1:]), *((star[0], x) for x in star[1:]), tuple(two), tuple(two[::-1])]
    df = spark.createDataFrame([(min(x), max(x)) for x in links], "a long, b long")
    got = near_duplicates.components(df).collect()
    assert {r["class"]: r.grp for r in got} == {x: min(g) for g in (chain, star, two) for x in g} and len(got) == len(ids)
    assert near_duplicates.components(df.limit(0)).count() == 0


def test_components_raise_at_the_bound(spark):
    with pytest.raises(RuntimeError, match="most_rounds"):
        near_duplicates.components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"), most_rounds=1)
