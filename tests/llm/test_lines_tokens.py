import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import mixing, packing, repeated_lines, tokens

T0 = dt.datetime(2024, 1, 1)
DOCS = "doc_id string, text string, fetched_at timestamp, domain string, line string, salt int"
META = "doc_id string, domain string, enriched_at timestamp"


def test_repeated_lines(spark):
    rows = [(f"d{i}", f"Share  THIS, now!{i}\nown {'abcdefgh'[i]}xyzxyz\nab 1", T0, "x", "y", 1) for i in range(7)]
    rows += [rows[0], ("d0", "old", T0 - dt.timedelta(days=1), None, None, None), ("n", None, None, None, None, None), (None, "Share this now", T0, None, None, None), ("e", "", T0, None, None, None), ("far", "share this now", T0, None, None, None)]
    meta = [(f"d{i}", "www.A.rw" if i % 2 else " a.rw", T0) for i in range(7)] + [("d0", "other", T0 - dt.timedelta(days=2)), ("n", "a.rw", T0), ("e", "a.rw", T0), ("far", " ", T0), ("none", "a.rw", T0)]
    docs, m = spark.createDataFrame(rows, DOCS), spark.createDataFrame(meta, META)
    got = repeated_lines.repeated_lines(docs, m)
    assert sorted((r.doc_id, r.line_no, r.docs) for r in got.collect()) == [(f"d{i}", 0, 7) for i in range(7)]
    clean = {r.doc_id: r.text for r in repeated_lines.without_repeated_lines(docs, m).collect()}
    assert clean["d3"] == "own dxyzxyz\nab 1" and clean["n"] is None and clean["far"] == "share this now" and clean["e"] == ""
    assert repeated_lines.repeated_lines(docs.limit(0), m).count() == 0
    # copies of one text count as documents, but as one cluster
    copies = spark.createDataFrame([(f"d{i}", "the very same line", T0, None, None, None) for i in range(7)], DOCS)
    assert repeated_lines.repeated_lines(copies, m).count() == 7 and repeated_lines.repeated_lines(copies, m, min_clusters=2).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1 .'\n\té’é　", max_size=300), st.integers(1, 40))
def test_chunks_are_independent(text, size):
    t = tokens.Tokenizer()
    parts = tokens.independent_chunks(text, size)
    assert "".join(parts) == text and sum(map(t.count, parts)) == t.count(text)


def test_token_counts_of_long_and_equal_rows(spark):
    rng = random.Random(3)
    long = " ".join(rng.choice(["umuryango", "igihugu", "12", "a,b"]) for _ in range(30_000))
    rows = [("a", long), ("a", long), ("b", "x" * 50_000), ("c", None), ("d", ""), ("e", "muraho neza")]
    t = tokens.Tokenizer()
    got = sorted((r.i, r.n_tokens) for r in tokens.token_counts(spark.createDataFrame(rows, "i string, text string"), ["i"], max_chunk_chars=1000).collect())
    assert got == sorted((i, t.count(x)) for i, x in rows)


def test_totals(spark):
    docs = spark.createDataFrame([("a", " KinNews", "r", "rw", T0, "muraho"), ("a", "kinnews", "r", "rw", T0, "muraho"), ("b", None, None, None, None, None), (None, "x", "r", "rw", T0, "y")], "doc_id string, source string, run_id string, lang string, fetched_at timestamp, text string")
    meta = spark.createDataFrame([("a", 1, "www.X", T0), ("a", 99, "y", T0 + dt.timedelta(days=1))], "doc_id string, token_count long, domain string, enriched_at timestamp")
    per = tokens.document_tokens(docs, meta)
    assert {(r.doc_id, r.source, r.lang, r.domain, r.meta_state) for r in per.collect()} == {("a", "kinnews", "kin_Latn", "y", "wrong"), ("b", None, None, None, "missing")}
    all_ = tokens.token_totals(per).where("slice = 'all'").first()
    assert all_.docs == 2 and all_.tokens == tokens.Tokenizer().count("muraho")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120), st.integers(50, 90))
def test_pack_group(sizes, capacity):
    where = packing.pack_group(sizes, capacity)
    used = {}
    for s, q in zip(sizes, where):
        used[q] = used.get(q, 0) + s
    assert all(v <= capacity for v in used.values()) and set(used) == set(range(len(used)))
    assert len(used) <= 2 * -(-sum(sizes) // capacity) + 1


def test_pack_every_document_once(spark):
    sized = spark.createDataFrame([(i, n) for i, n in enumerate([5, 100, 250, 0, None, 99, 30, 30, 30])] + [(None, 3)], "doc_id long, n_tokens long")
    profiles = spark.createDataFrame([("p", 100, 1), ("q", 60, None), ("bad", 0, 1)], "profile string, capacity_tokens long, eos_tokens long")
    rows = packing.pack(sized, profiles).collect()
    for p, cap, eos in (("p", 100, 1), ("q", 60, 0)):
        mine = [r for r in rows if r.profile == p]
        per = {}
        for r in mine:
            per.setdefault(r.doc_id, []).append((r.piece_no, r.tokens))
            assert r.used + r.unused == cap and 0 <= r.unused
        want = {i: n + eos for i, n in enumerate([5, 100, 250, 0, None, 99, 30, 30, 30]) if n}
        assert {k: sum(t for _, t in v) for k, v in per.items()} == want
        assert all(len(v) == -(-want[k] // cap) for k, v in per.items())
        held = {}
        for r in mine:
            held[r.container] = held.get(r.container, 0) + r.tokens
        assert all(held[r.container] == r.used for r in mine)
    assert packing.pack(sized.limit(0), profiles).count() == 0


def test_mix(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c"]), rng.choice(["x", "y"]), rng.choice(["s", "t"]), rng.randrange(1, 200)) for i in range(3000)] + [(9000, None, "x", "s", 5), (9001, "a", "x", "s", 0)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    goal = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, None), ("none", 0.1, 2)], "source string, target_share double, max_repeats long")
    m = mixing.mix(sized, goal)
    r = {x.source: x for x in mixing.shares_reached(m, sized, goal).collect()}
    assert abs(r["a"].actual_share - 5 / 9) < 0.01 and abs(r["b"].actual_share - 3 / 9) < 0.01 and r["none"].tokens == 0
    assert r["a"].most_uses <= 1 and r["b"].most_uses <= 3 and r["c"].most_uses <= 1
    assert m.groupBy("doc_id").count().where("count > 1").count() == 0
    assert mixing.mix(sized.limit(0), goal).count() == 0
    assert [x.uses for x in mixing.mix(sized, goal).orderBy("doc_id").collect()] == [x.uses for x in m.orderBy("doc_id").collect()]


def test_labels(spark):
    df = spark.createDataFrame([("RW",), ("en",), (" ",), (None,), ("UND",), ("ZXX_LATN",), ("deu",)], "l string")
    assert [r.x for r in df.select(tokens.lang_label(F.col("l")).alias("x")).collect()] == ["kin_Latn", "eng_Latn", None, None, None, "zxx_Latn", "deu"]


if __name__ == "__main__":
    pytest.main([__file__])
