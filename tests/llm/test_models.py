import itertools
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import articles, language, near_duplicates, pages, pairs, subjects

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def _jaccard(a, b, k):
    s = [set(zip(*(w[i:] for i in range(k)))) for w in (a.lower().split(), b.lower().split())]
    return len(s[0] & s[1]) / max(1, len(s[0] | s[1]))


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 80))] for _ in range(15)]
    rows = []
    for i in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            how, at = rng.randrange(3), rng.randrange(len(w))
            w[at : at + (how != 1)] = [] if how == 2 else [f"n{rng.randrange(9999)}"]
        rows.append((f"d{i:03}", " ".join(w), "x"))
    rows += [("e", "", "x"), ("s", "two words", "x"), ("n", None, "x"), (None, rows[0][1], "x"), rows[5], ("long", " ".join(f"q{i}" for i in range(60_000)), "x")]
    df = spark.createDataFrame(rows, "doc_id string, text string, class string")
    texts = {i: t for i, t, _ in rows if i and t}
    want = {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if _jaccard(texts[a], texts[b], 3) >= 0.6}
    p, m = near_duplicates.near_duplicates(df, k=3, threshold=0.6)
    got = {(r.doc_id_a, r.doc_id_b) for r in near_duplicates.id_pairs(p, m).collect()}
    assert got <= want and len(got) >= 0.98 * len(want) > 20
    group = {r.doc_id: r.group_id for r in near_duplicates.groups(p, m).collect()}
    assert all(group[a] == group[b] for a, b in got) and "e" not in group
    p, m = near_duplicates.near_duplicates(df.limit(0))
    assert near_duplicates.id_pairs(p, m).count() == 0


@needs_data
def test_language(spark):
    ref = [(r.lang, r.text) for r in spark.read.parquet(f"{DATA}/lid_reference.parquet").orderBy("ref_id").collect()]
    model = language.fit(ref[::2])
    kept = language._verdicts(model, [t for _, t in ref[1::2]], language.WordScores(model), 0.2, 1.5)
    assert np.mean([v[0] == a for v, (a, _) in zip(kept, ref[1::2])]) > 0.93
    by = {a: " ".join(max((t for b, t in ref if b == a), key=len).split()[:30]) for a, _ in ref}
    mixed = by["eng_Latn"] + "\n\n" + by["swh_Latn"] + "\n12 34"
    got = language._verdicts(model, [mixed, "1234 5", None, " \n", by["fra_Latn"].upper()], language.WordScores(model), 0.2, 1.5)
    assert got[0][2] and {x[1] for x in got[0][3]} == {"eng_Latn", "swh_Latn", "zxx_Latn"} and got[0][3][-1][0] == mixed.count("\n")
    assert got[1][:2] == ("zxx_Latn", 1.0) and got[2] is None and got[3] is None and got[4][0] == "fra_Latn"
    rows = [("a", None, "und", 0.5, by["eng_Latn"]), ("a", None, "und", 0.5, by["eng_Latn"]), (None, None, "en", 0.5, "x"), ("b", None, "EN", None, by["eng_Latn"]), ("c", None, "rw", 0.1, None)]
    df = spark.createDataFrame(rows, "doc_id string, fetched_at timestamp, lang string, lid_score double, text string")
    out = {(r.doc_id, r.line_no): (r.lang, r.label_state) for r in language.record_languages(df, model).collect()}
    assert out == {("a", -1): ("eng_Latn", "missing"), ("b", -1): ("eng_Latn", "ok")}


PAGE = """<html><head><title>The big headline of today here - Site</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href=/a>Home</a></li></ul></nav>
<div><h1>The big headline of today here</h1><p>By A B</p><p>First <b>words</b> of &amp; it all.</p><!-- c --><ul><li>item one two</li></ul></div><footer><p>All rights kept.</p></footer></body></html>"""


def test_pieces():
    p = pages.parse(PAGE)
    assert [(u.pieces, u.text) for u in p.units] == [
        ([0], "The big headline of today here - Site"), ([1], "Home"), ([2], "The big headline of today here"), ([3], "By A B"), ([4, 5, 6], "First words of & it all."), ([7], "item one two"), ([8], "All rights kept.")
    ]
    assert pages.parse("").n_pieces == 0 and pages.parse("<p>cut off <a href='x").n_pieces == 1
    for enc in ("utf-8", "utf-16"):
        assert pages.decoded("<p>é…</p>".encode(enc)) == "<p>é…</p>"
    assert pages.decoded("<p>é…</p>".encode("cp1252"), "text/html; charset=utf-8") == "<p>é…</p>"
    assert pages.decoded("<p>é".encode()[:-1]) == "<p>"


@needs_data
def test_articles(spark):
    df = spark.read.parquet(f"{DATA}/warc_records.parquet").where("http_status = 200 AND octet_length(body) > 0").select("capture_id", "body").dropDuplicates(["capture_id"]).orderBy("capture_id").collect()
    texts = [pages.decoded(bytes(r.body)) for r in df]
    model = articles.fit(texts[::2], trees=20)
    hits = total = 0
    for t in texts[1::2]:
        if not pages.is_html(t):
            assert model.article(t) == []
            continue
        v = articles.view(pages.parse(t))
        found = set(model.article(t))
        if v.headline >= 0:
            total += 1
            hits += set(v.page.units[v.headline].pieces) <= found and not found & set(v.page.units[0].pieces)
        else:
            assert not found
    assert hits > 0.9 * total > 10
    # an article keeps its pieces under a title that says something else, and behind a long comment
    found = [(t, a) for t in texts if (a := model.article(t))]
    other = model.articles([re.sub(r"(<title[^<>]*>)[^<]*", r"\1Murakaza neza", t, count=1, flags=re.I) for t, _ in found])
    assert sum(o == a for o, (_, a) in zip(other, found)) > 0.85 * len(found) > 10
    assert all(model.article(f"<!-- {'x' * 5000} -->" + t) == a for t, a in found[:5])
    assert articles.ArticleModel().article("<p>x</p>") == [] and articles.fit([]).article("") == []
    rows = spark.createDataFrame([(1, None, bytearray(b"")), (2, "text/html", bytearray(PAGE.encode())), (2, "text/html", bytearray(PAGE.encode())), (3, None, None)], "capture_id long, content_type string, body binary")
    got = articles.article_pieces(rows, model).collect()
    assert len(got) == len(set(got)) and {r.capture_id for r in got} <= {2}


@needs_data
def test_pairs(spark):
    ref = [(r.lang, r.text) for t in ("lid_reference", "subject_reference") for r in spark.read.parquet(f"{DATA}/{t}.parquet").collect()]
    ex = spark.read.parquet(f"{DATA}/instruction_examples.parquet")
    model = pairs.fit(ex, language.fit(ref[:300], ref[300:]), ref[:300])
    eng = next(t for a, t in ref if a == "eng_Latn" and t.endswith(".") and len(t) > 150)
    swh = next(t for a, t in ref if a == "swh_Latn" and t.endswith("."))
    q = "Tell me about the harvest and the people as if I were 12 years old."

    def defects(prompt, response, task):
        return model.defects([prompt, None], [response, "x"], [task, None])[0]

    assert defects(q, eng, "qa") == []
    for empty in (None, "", " \n", "&nbsp;", "<p></p>", "N/A", "...", "​"):
        assert defects(q, empty, "qa") == ["empty"]
    assert defects(q, q.upper(), "qa") == ["copies_prompt"] and defects(q, f"{q}\n{q}", "qa") == ["copies_prompt"]
    assert defects(q, swh, "qa") == ["wrong_language"]
    assert defects("Translate this sentence into Swahili: " + eng, swh, "translate") == []
    # the language may be named after the text, however long that is
    assert defects(f"{eng} {eng}\nTranslate this text into Swahili.", swh, "translate") == []
    assert defects(f"{eng} {eng}\nTranslate this text into Swahili.", swh, None) == []
    assert "truncated" in defects(q, eng[: eng.rindex(" ", 0, 120)] + " (", "qa")
    assert "truncated" in defects(q, f"{eng} " * 40 + eng[: eng.rindex(" ", 0, 120)] + " (", "qa") and defects(q, f"{eng} " * 40 + eng, "qa") == []
    refusal = "Sorry, I can't help with that and I hope you understand."
    assert defects(q, refusal, "qa") == ["refusal"] and defects(q, refusal, "safety") == []
    assert isinstance(defects(None, eng, None), list) and model.defects([], [], []) == []
    rows = spark.createDataFrame([("1", q, None, "qa", "x"), ("1", q, None, "qa", "x"), (None, q, "", "qa", "x"), ("2", q, eng, None, "x")], "id string, prompt string, response string, task_type string, defect string")
    assert [(r.id, r.defect) for r in pairs.pair_defects(rows, model).collect()] == [("1", "empty")]


@needs_data
def test_subjects(spark):
    ref = spark.read.parquet(f"{DATA}/subject_reference.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    known, held = ref.where("ref_id % 2 = 0"), ref.where("ref_id % 2 = 1").collect()
    model = subjects.fit(docs, known)
    share = model.shares([r.text for r in held])
    assert np.mean([model.subjects[j] == r.subject for j, r in zip(share.argmax(1), held)]) > 0.9
    rows = spark.createDataFrame([(1, None), (2, ""), (3, held[0].text), (3, held[0].text), (None, "x"), (4, "12 ... !"), (5, held[0].text * 500)], "doc_id long, text string")
    got = {(r.doc_id, r.subject) for r in subjects.document_subjects(rows, model).collect()}
    assert {i for i, _ in got} == {3, 5} and {s for i, s in got if i == 3} == {s for i, s in got if i == 5}
    assert subjects.document_subjects(rows.limit(0), model).count() == 0
    # the same from words that were hashed before
    words = subjects.tokenized(rows, ["doc_id"])
    assert {(r.doc_id, r.subject) for r in subjects.document_subjects(words, model).collect()} == got
    clash = rows.withColumns({c: F.lit("x") for c in ("words", "subject", "share", "id", "topic")})
    assert {(r.doc_id, r.subject) for r in subjects.document_subjects(clash, model).collect()} == got and subjects.document_frequencies(clash).count() > 1
    topic = {r.doc_id: r.topic for r in subjects.main_subject(clash, model).collect()}
    assert topic[1] == topic[2] == topic[4] == "none" and (3, topic[3]) in got and set(topic) == {1, 2, 3, 4, 5}
    none = subjects.fit(rows, ref.limit(0))
    assert none.subjects == [] and subjects.document_subjects(rows, none).count() == 0 and {r.topic for r in subjects.main_subject(rows, none).collect()} == {"none"}
    with pytest.raises(ValueError, match="most_terms"):
        subjects.fit(docs, known, most_terms=10)


@needs_data
def test_terms_against_counting(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    want = Counter(w for r in docs.collect() if r.text for w in {h for h in subjects.hashed([r.text], subjects._Hashes())[0].tolist() if h})
    got = {r.word: r.df for r in subjects.document_frequencies(docs.repartition(3)).collect()}
    assert got.pop(subjects.END_HASH) == docs.where("length(text) > 0").count() and got == want
