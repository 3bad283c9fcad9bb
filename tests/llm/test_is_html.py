from corpusloom.llm import pages


def test_html_after_a_long_start():
    assert pages.is_html("<!-- " + "licence " * 1000 + "--><html><body><p>x</p></body></html>")
    assert not pages.is_html("plain text, 1 < 2 " * 1000)
