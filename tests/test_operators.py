"""Semantics that the queries over the project's tables can't show."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import display as V
from corpusloom.functions import markup as M
from corpusloom.functions import text as T
from corpusloom.functions import urls as U
from corpusloom.operators import config as C
from corpusloom.operators import dedup as D
from corpusloom.operators import filters as L
from corpusloom.operators import identify as I
from corpusloom.operators import packaging as P
from corpusloom.operators import reports as Q

GOOD = " ".join(f"ijambo{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))


def test_keep_judges_the_normalized_text(spark):
    rows = [
        (1, GOOD.replace("a", "a\u200b"), "rw", 0.99),  # invisible characters go first
        (2, " " * 400 + "short", "rw", 0.99),  # long only by its spaces
        (3, None, "rw", 0.99), (4, "", None, None), (5, GOOD, None, 0.99), (6, GOOD, "rw", None), (7, GOOD, "kin_Latn", 0.90),
        (8, "ijambo ryiza " * 60, "rw", 0.99), (9, GOOD + " &amp; x", "rw", 0.99),
    ]
    df = spark.createDataFrame(rows, "i int, text string, lang string, lid_score double").withColumn("reason", F.lit("old")).withColumn("keep", F.lit(None).cast("boolean"))
    got = {r.i: (r.reason, r.normalized_text) for r in L.decide_keep(df).collect()}
    assert got[1] == ("keep", GOOD) and got[9] == ("keep", GOOD + " & x")
    assert [got[i][0] for i in (2, 3, 4)] == ["reject.too_short"] * 3 and got[2][1] is None
    assert got[5][0] == "reject.lid.not_rw" and got[6][0] == "reject.lid.low_confidence" and got[7][0] == "keep"
    assert got[8][0] == "reject.filter.word_ngram_repetition"
    assert L.decide_keep(df.limit(0)).count() == 0


def test_one_trip_to_python(spark):
    plan = L.decide_keep(spark.createDataFrame([("x", "rw", 0.9)], "text string, lang string, lid_score double"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_redirects_by_their_own_host(spark):
    allowed = spark.createDataFrame([("a.rw",), ("WWW.B.rw",), (None,)], "domain string")
    rows = [("http://a.rw/x", "http://evil.com/y"), ("http://a.rw/x", "http://www.b.rw/y"), ("http://a.rw/x", "http://a.rw/x"), ("http://a.rw/x", None), ("http://a.rw/x", "nothing"), ("http://c.rw/", "https://user@A.rw:80/")]
    df = U.on_allowlist(spark.createDataFrame(rows, "url string, final string"), "final", allowed, "ok")
    got = [r[0] for r in df.select(U.redirect_safety(F.col("url"), F.col("final"), F.col("ok"))).collect()]
    assert sorted(got) == sorted(["redirect_off_allowlist", "ok", "no_redirect", "no_redirect", "redirect_no_hostname", "ok"])


def test_parallel_pairs(spark):
    rows = [(1, "a  b", "x"), (2, "a b", "x "), (3, "a b", "y"), (4, "a b", "z"), (5, "c", "x"), (6, None, "x"), (7, "a b", "z")]
    got = {r.i: r.reason for r in D.parallel_dedup(spark.createDataFrame(rows, "i int, l string, r string"), "l", "r", "i", most=2).collect()}
    # 2 equals 1 once normalized; 4 finds its left side used twice and stays seen, so 7 repeats it; 6 finds the right side used twice
    assert got == {1: "ok", 2: "reject.duplicate", 3: "ok", 4: "reject.duplicate", 5: "ok", 6: "reject.duplicate", 7: "reject.duplicate"}


def test_latest_capture_ties(spark):
    rows = [("u", "2020", 2), ("u", "2021", 5), ("u", "2021", 3), ("v", None, 1), (None, "2020", 1)]
    got = {(r.url, r.capture_ts, r.capture_id) for r in D.latest_capture(spark.createDataFrame(rows, "url string, capture_ts string, capture_id int")).collect()}
    assert got == {("u", "2021", 3), ("v", None, 1), (None, "2020", 1)}


def test_packing(spark):
    """Against one buffer filled token by token."""
    rows = [("a", i, list(range(1, n + 1))) for i, n in enumerate((3, 1, 4, 0, 8, 9, 2, 1))] + [("b", 0, [7] * 5), ("b", 1, [8] * 30), ("c", 0, []), (None, 0, [1])]
    want = []
    for shard in ("a", "b", None):
        buffer, n = [], 0
        for _, _, ids in [r for r in rows if r[0] == shard and r[2]]:
            for t in ([0] if buffer else []) + ids:
                buffer.append(t)
                if len(buffer) == 5:
                    want.append((shard, n, tuple(buffer), 5))
                    buffer, n = [], n + 1
        if buffer:
            want.append((shard, n, tuple(buffer), len(buffer)))
    df = spark.createDataFrame(rows, "shard string, ord int, ids array<int>")
    for batch in ("10000", "2"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = [(r.shard, r.seq_no, tuple(r.input_ids), r.length) for r in P.pack_sequences(df, "shard", "ord", "ids", 0, 5).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert P.pack_sequences(df.limit(0), "shard", "ord", "ids", 0, 5).count() == 0


def test_mix_by_records(spark):
    rows = [("k1", "a", 0, 10), ("k2", "b", 0, 90), ("k3", "b", None, 90)]
    got = P.mixed_selection(spark.createDataFrame(rows, "s3_key string, content_type string, token_estimate long, records long"), {"a": 0.5, "b": 0.5}, "s").collect()
    assert {r.s3_key for r in got} >= {"k1"}
    with pytest.raises(ValueError):
        P.check_ratios({"a": 0.5})


def test_blocks(spark):
    texts = [None, "", "x", "a" * 60 + "\n\n" + "b" * 60 + "\n \n" + "c" * 10, "d" * 300]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(M.paragraph_blocks(F.col("t"), 100)).collect()]
    assert got == [None, [], [], ["a" * 60 + "\n\n" + "b" * 60], ["d" * 300]]


def test_identifier(spark):
    ref = spark.createDataFrame([("x", "one two two"), ("y", "eins zwei"), (None, "z"), ("x", None)], "lang string, text string")
    model = I.fit_words(ref)
    df = spark.createDataFrame([("two ONE",), ("zwei",), ("12 ?!",), (None,), ("unknown",)], "text string").withColumn("lang", F.lit("old"))
    got = [(r.lang, r.lang_2) for r in I.predict(df, model).collect()]
    assert got == [("x", "y"), ("y", "x"), ("zxx_Latn", None), (None, None), ("zxx_Latn", None)]
    assert I.predict(df.limit(0), model).count() == 0


def test_config():
    c = C.load_config({"filters": {"min_chars": 10, "max_url_ratio": 1}, "packing": {"split_ratios": [0.5, 0.25, 0.25]}})
    assert c.filters.min_chars == 10 and c.filters.max_url_ratio == 1.0 and c.packing.split_ratios == (0.5, 0.25, 0.25)
    assert C.fingerprint(c) == C.fingerprint(C.load_config({"packing": {"split_ratios": [0.5, 0.25, 0.25]}, "filters": {"max_url_ratio": 1.0, "min_chars": 10}})) != C.fingerprint(C.Config())
    for bad in ({"x": 1}, {"filters": 3}, {"filters": {"min_chars": "9"}}, {"filters": {"min_confidence": 1.5}}, {"filters": {"min_chars": -1}}, {"packing": {"split_ratios": [1.0]}}, {"dedup": {"exact": 1}}, {"packing": {"type_ratios": {"a": 0.2}}}):
        with pytest.raises(ValueError):
            C.load_config(bad)
    now = [0.0]
    g = C.Guardrails(C.Limits(max_items=3, max_runtime_s=10), clock=lambda: now[0])
    g.add(items=2)
    assert g.reached() == ""
    now[0] = 11.0
    assert g.reached() == "guardrail.max_runtime_s: 11 >= 10"
    g.add(items=1)
    assert g.reached() == "guardrail.max_items: 3 >= 3"
    assert C.waits(3, 2.0) == [2.0, 4.0, 8.0] and C.waits(2, 2.0, False) == [2.0, 4.0]


def test_reports_of_nothing(spark):
    decided = spark.createDataFrame([], "run_id string, domain string, text string, lid_score double, keep boolean, reason string, source string, shard string")
    assert Q.run_report(decided, "run_id").count() == 0 and Q.dedup_report(decided).where("level = 'source'").count() == 0
    one = Q.import_report(decided).first()
    assert (one.docs_seen, one.keep_rate) == (0, 0.0)
    lines = spark.createDataFrame([("f", '{"text": "abc"}'), ("f", "bad"), ("f", " "), ("f", "[1]"), ("f", '{"x": 1}')], "file_name string, value string")
    r = Q.shard_checks(lines).first()
    assert (r.records, r.total_chars, r.bad_lines, r.token_estimate) == (2, 3, 2, 1)


def test_domains_above(spark):
    assert spark.range(1).select(U.parent_domains(F.lit("a.b.c"))).first()[0] == ["a.b.c", "b.c", "c"]
    assert [r[0] for r in spark.createDataFrame([("http://a",), ("ftp://a",), (None,), ("x",)], "u string").select(U.valid_seed(F.col("u"))).collect()] == [True, False, False, False]
    assert spark.range(1).select(T.first_text(F.lit(" "), F.lit(None), F.lit("x"))).first()[0] == "x"


def test_figures_for_people(spark):
    now = F.lit("2024-01-03 12:00:00").cast("timestamp")
    rows = [("2024-01-03T11:30:30+00:00", 3), ("2024-01-03T09:00:00Z", 1536), ("2024-01-01T00:00:00", 5 << 20), ("", None), (None, 0), ("soon", 1024)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "t string, n long").select(V.age_text(F.col("t"), now), V.bytes_text(F.col("n"))).collect()]
    assert got == [("29m ago", "3 B"), ("3.0h ago", "1.5 KB"), ("2d ago", "5.0 MB"), ("—", None), ("—", "0 B"), ("soon", "1.0 KB")]
