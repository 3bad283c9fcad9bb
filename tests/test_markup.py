import io
import zipfile

from pyspark.sql import functions as F

from corpusloom.functions import markup as M
from corpusloom.operators import sections as X


def test_links():
    page = "<a href='/b#x'>1</a><A HREF=\"HTTP://C.rw/?q=1&amp;r=2\">2</A><a href='mailto:x'>3</a><a href='/b'>4</a>"
    assert M.links_of(page, "http://a.rw/d/") == ["http://a.rw/b", "http://c.rw/?q=1&r=2", "http://a.rw/b"]
    assert M.links_of("<!-- <a href='/x'>1</a> --><script>var a = '<a href=/y>';</script><a href='z'>2</a><!-- <a href='/q'>", "http://a.rw/") == ["http://a.rw/z"]


def test_pairs():
    assert M.page_pair('<link rel="alternate" hreflang="rw" href="/r"><link rel="alternate" hreflang="en-GB" href="/e">', "http://a/x") == ("http://a/r", "http://a/e", 0.95, "hreflang")
    assert M.page_pair("<a href='/k'>Ikinyarwanda</a> <a href='/e'>English</a>", "http://a/x") == ("http://a/k", "http://a/e", 0.7, "toggle")
    assert M.page_pair("", "http://a/rw/x") == ("http://a/rw/x", "http://a/en/x", 0.5, "url_pattern")
    assert M.page_pair("", "http://a/x?lang=en") == ("http://a/x?lang=rw", "http://a/x?lang=en", 0.4, "url_pattern")
    assert M.page_pair("", "http://a/x") is None


def test_wikitext():
    raw = "{{Infobox|a={{b}}}}'''Kigali''' ni [[umurwa]] wa [[Rwanda|u Rwanda]].<ref>x</ref>\n[[File:a.jpg|thumb|a [[b]] c]]\n{|\n| cell\n|}\n== Amateka ==\n* kera &amp; ubu [http://x.y izina]\n[[Category:X]]\n== Reba kandi ==\nz"
    assert M.wiki_plain(raw) == "Kigali ni umurwa wa u Rwanda.\n\nAmateka\nkera & ubu izina"
    assert M.wiki_plain("") == "" and "}}" not in M.wiki_plain("a {{b\nc }} d }}")


def test_office():
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", '<w:d xmlns:w="u"><w:p><w:r><w:t>' + "x" * 60 + "</w:t></w:r></w:p><w:p><w:t>y</w:t></w:p></w:d>")
    assert M.office_plain(b.getvalue()) == "x" * 60 + "\ny"
    assert M.office_plain(b"no") is None and M.office_plain(None) is None


def test_robots_and_sections(spark):
    rows = [("http://a/x", "User-agent: *\nDisallow: /x", 200), ("http://a/y", "User-agent: *\nDisallow: /x", 200), ("http://a/x", "", 403), ("http://a/x", None, None)]
    got = spark.createDataFrame(rows, "u string, r string, s int").select(M.robots_allow(F.col("u"), F.col("r"), F.col("s")).alias("x")).collect()
    assert [r.x for r in got] == [False, True, False, True]
    docs = spark.createDataFrame([(1, "\n\n".join(["k" * 150, "e" * 150, "k" * 150])), (2, "short"), (3, None)], "i int, text string")
    ident = lambda b: b.withColumn("lang", F.when(F.startswith("block", F.lit("k")), "kin_Latn").otherwise("eng_Latn")).withColumn("score", F.lit(0.9))
    assert {r.i: r.text for r in X.language_sections(docs, "i", "text", ident, size=100).collect()} == {1: "k" * 150 + "\n\n" + "k" * 150, 2: None, 3: None}


def test_main_text(spark):
    page = "<html><head><title>A &amp; B</title></head><body><nav>menu</nav><main><p>one<br>two</p><table><tr><td>c</td></tr></table><aside>no</aside></main><p>outside</p></body>"
    assert M.page_text(page) == ("A & B", "one\ntwo\nc") and M.page_text(page, precise=True) is None
    assert M.page_text("<p>a b c d e</p><p>x</p><script>y", precise=True) == ("", "a b c d e")
    assert M.page_text("") is None and M.page_text("<nav>only") is None and M.page_text("no tags") == ("", "no tags")
    rows = [(bytearray(b"<p>Share this page</p><p>kept</p>"), "text/html"), (bytearray(b"%PDF"), "application/pdf; x=y"), (bytearray(b"no"), M.OFFICE_TYPES[2]), (None, None), (bytearray(b""), "text/html")]
    got = [tuple(r.e) for r in spark.createDataFrame(rows, "c binary, k string").select(M.extracted(F.col("c"), F.col("k")).alias("e")).collect()]
    assert got == [("kept", None), (None, "reject.pdf_extraction_failed"), (None, "reject.office_extraction_failed"), (None, "reject.extraction_failed"), (None, "reject.extraction_failed")]


def test_wikitext_residue():
    raw = "a b Category:X y\n200px|left\nc|120x80px|d\n|- style=x\nclass=\"wikitable\" e\nf {\\ x}\n<<g>> <h i> <div class='k'>j</div> k"
    assert M.wiki_plain(raw) == "a b\n\ncd\n\ne\n\n\"g\" h i j k"
