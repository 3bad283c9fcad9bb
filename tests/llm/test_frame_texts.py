from corpusloom.llm import articles


def test_frame_is_counted_over_all_captures(spark):
    """A notice that stands on one sampled page only is frame if it recurs outside the sample."""
    page = "<html><head><title>{0} is the long headline here</title></head><body><h1>{0} is the long headline here</h1><p>Words of {0} alone.</p><p>{1}</p></body></html>"
    names = ["Alpha", "Bravo", "Charlie", "Delta"]
    texts = [page.format(x, "Our notice of this site." if x != "Delta" else "Twice only.") for x in names] + [page.format("Delta", "Twice only.")] * 2
    rows = spark.createDataFrame([(i, "text/html", bytearray(t.encode())) for i, t in enumerate(texts)] + [(9, None, bytearray(b"{}"))], "capture_id long, content_type string, body binary")
    wanted = articles._recurring(texts[0]) | articles._recurring(texts[3])
    assert articles.often_seen(rows, wanted) == {articles.letters("Our notice of this site.")}
    assert articles.often_seen(rows, set()) == set()
    seen = {}
    fit, articles.fit_views = articles.fit_views, lambda views, frame, *a: seen.update(frame=frame) or fit(views, frame, *a)
    try:
        articles.fit_to(rows.where("capture_id < 3"), most_pages=1)
    finally:
        articles.fit_views = fit
    assert seen["frame"] == {articles.letters("Our notice of this site.")}


def test_pieces_make_a_frame():
    """A unit of several pieces is frame if they are."""
    v = articles._views(["<html><body><p>Sign in <a>with your account</a></p><p>Other <b>words</b></p></body></html>"])
    assert articles._frame(v, {"signin", "withyouraccount"}) == {"signin", "withyouraccount", "signinwithyouraccount"}
