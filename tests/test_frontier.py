import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import urls as U
from corpusloom.streaming import incremental as S

DATA = "/root/testdata/sf0.001"


def _crawl(spark, links, seeds, domains, **bounds):
    df = spark.createDataFrame(links, "url string, target string")
    rows = S.crawl(df, spark.createDataFrame([(s,) for s in seeds], "url string"), spark.createDataFrame([(x,) for x in domains], "domain string"), **bounds).collect()
    assert len({r.url for r in rows}) == len(rows)
    return {r.url: r.depth for r in rows}


def test_crawl_goes_on_until_nothing_is_left(spark):
    chain = [f"http://a.rw/{i:02}" for i in range(13)]
    wide = [f"http://b.rw/{i:03}" for i in range(130)]
    links = [*zip(chain, chain[1:]), (chain[-1], chain[0]), ("http://A.rw/02#x", wide[0]), *((wide[0], t) for t in wide[1:]), (chain[1], "http://c.rw/"), (wide[5], None)]
    got = _crawl(spark, links, [chain[0], "http://c.rw/x"], ["a.rw", "b.rw"])
    assert got == {u: i for i, u in enumerate(chain)} | {u: 4 for u in wide[1:]} | {wide[0]: 3}
    assert _crawl(spark, links, [], ["a.rw"]) == {}


def test_crawl_bounds_are_totals(spark):
    tree = [(f"http://{s}.rw/{i:02}", f"http://{s}.rw/{c:02}") for s in "ab" for i in range(10) for c in (2 * i + 1, 2 * i + 2)]
    seeds = ["http://a.rw/00", "http://b.rw/00"]
    got = _crawl(spark, tree, seeds, ["a.rw", "b.rw"], most_per_domain=5)
    assert sorted(got) == [f"http://{s}.rw/{i:02}" for s in "ab" for i in range(5)]
    got = _crawl(spark, tree, seeds, ["a.rw", "b.rw"], most_per_domain=5, most_pages=9)
    assert sorted(got) == [f"http://a.rw/{i:02}" for i in range(5)] + [f"http://b.rw/{i:02}" for i in range(4)]
    assert len(_crawl(spark, tree, seeds, ["a.rw", "b.rw"], most_pages=30)) == 30
    assert _crawl(spark, tree, seeds, ["a.rw", "b.rw"], most_pages=0) == {}


def test_frontier_visits_every_url(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    import __spark_entry__ as entry

    got = entry.queries()["frontier"](spark, DATA)
    pages = spark.read.parquet(f"{DATA}/extracted_docs.parquet").select(U.normalize_absolute(F.col("url")).alias("url")).where("url is not null").distinct()
    assert {r.url for r in got.collect()} == {r.url for r in pages.collect()} and got.count() == pages.count()
