from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import aggregates as A
from corpusloom.operators import filters as L


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "text string").select(expr.alias("x")).first().x


def test_normalize(spark):
    cases = {"Ａ": "A", "a\r\nb": "a\nb", "a​b": "ab", "a\x07b": "ab", "&amp;": "&", "hi!!!": "hi!", "a\n\n\n\nb": "a\n\nb", "  a \t b ": "a b", "a\n---\n===\n***\nb": "a\n\nb", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "text string")
    rows = df.select("text", T.normalize_text(F.col("text")).alias("n"), T.normalize_text(T.normalize_text(F.col("text"))).alias("again")).collect()
    for r in rows:
        assert r.n == cases[r.text] and r.again == r.n


def test_measures_of_edges(spark):
    for v, n in (("", 0), (None, None), ("  a b ", 2), ("x" * 200_000, 1)):
        assert one(spark, F.when(F.col("text").isNotNull(), T.word_count(F.col("text"))), v) == n
    assert one(spark, T.alpha_ratio(F.col("text")), "ab12") == 0.5
    assert one(spark, T.url_ratio(F.col("text")), "https://a.b c") == 11 / 13
    assert one(spark, T.non_latin_ratio(F.col("text")), "abвг") == 0.5
    assert one(spark, T.repeated_line_ratio(F.col("text")), "a\na\nb\nc") == 0.5
    assert one(spark, T.repeated_line_ratio(F.col("text")), "a\na\na") == 0.0


def test_ngram_repetition_agrees(spark):
    text = "a b c a b c d e f g h"
    native = [one(spark, T.ngram_repetition(F.col("text"), n), text) for n in (2, 3, 4)]
    r = one(spark, T.ngram_repetitions(F.col("text")), text)
    assert native == [r.rep_2, r.rep_3, r.rep_4] == [4 / 10, 2 / 9, 0.0]


def test_shingles(spark):
    assert one(spark, T.word_shingles(F.col("text"), 2), "A b a B a") == ["a b", "b a"]
    assert one(spark, T.word_shingles(F.col("text")), "a b") == ["a b"]
    assert one(spark, T.word_shingles(F.col("text")), "") == []


def test_reasons_in_order_and_keep(spark):
    assert one(spark, L.reject_reasons(F.col("text")), "1 2 3")[:3] == ["reject.filter.min_chars", "reject.filter.min_words", "reject.filter.alpha_ratio"]
    good = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)).replace("word", "ijambo")
    rows = [(1, good, "kin_Latn", 0.99), (2, good, "eng_Latn", 0.99), (3, good, "rw", 0.85), (4, None, "rw", 0.99), (5, good, None, None)]
    got = {r.i: r.reason for r in L.decide_keep(spark.createDataFrame(rows, "i int, text string, lang string, lid_score double")).collect()}
    assert got == {1: "keep", 2: "reject.lid.not_rw", 3: "keep" if len(good) >= 500 else "reject.lid.low_confidence", 4: "reject.too_short", 5: "reject.lid.not_rw"}


def test_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (0.1, 0.8, 0.94, 0.95, 1.0, 2.0, None)], "v double")
    got = {r.bucket: r.n for r in A.histogram(df, F.col("v"), A.LID_BINS).collect()}
    assert got == {"<0.8": 1, "0.8-0.85": 1, "0.9-0.95": 1, "0.95-1.0": 1, ">=1.0": 2}


def test_frame_lines(spark):
    assert one(spark, T.without_frame_lines(F.col("text")), "A\nShare this story\nLOGIN\nB") == "A\nB"
