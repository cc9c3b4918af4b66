import pytest

from cohortframe.llm import html as H

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def chain():
    return H.train(H.labelled_pages())


def test_blocks_end_where_html_ends_them():
    page = "<ul><li>a<li>b <i>c</i></ul><p>d<div>e<br>f</div>g<table><tr><td>h<td>i</table>&lt;j&gt; &amp;amp; <script>if (a<b) '</p>'</script>k <5<!-- x --> <a href='>'>l</a>"
    assert [b.text for b in H.blocks(page)] == ["a", "b c", "d", "e f", "g", "h", "i", "<j> &amp; k <5 l"]
    assert H.blocks("") == [] and H.blocks("<p> \n </p>") == []
    assert H.blocks("<p>x")[0].path == (("p", ""),)


def test_viterbi_is_the_best_of_all_labellings(chain):
    import itertools
    page = H.blocks(H.labelled_pages(1, seed=7)[0][0])[:9]
    s = chain.scores(page)
    score = lambda y: sum(x for x, k in zip(s, y) if k) + sum(chain.step[a, b] for a, b in zip(y, y[1:]))
    best = max(itertools.product((0, 1), repeat=len(s)), key=score)
    assert score(chain.viterbi(s)) == pytest.approx(score(best))


def test_held_out_pages(chain):
    pages = H.labelled_pages(150, seed=99)
    pairs = [(a, b) for p, labels in pages for a, b in zip(chain.viterbi(chain.scores(H.blocks(p))), labels)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.99


def test_training_is_the_same_each_time(chain):
    again = H.train(H.labelled_pages())
    assert (again.weights == chain.weights).all() and (again.step == chain.step).all()


def test_pages_of_the_test_data(chain, spark):
    import html
    import re
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S).group(1)
        parts = [re.sub(r"[ \t\n\r\f\v]+", " ", html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip(" ") for x in re.split(r"</?(?:p|h1)>", body)]
        assert chain.extract(r["html"]) == "\n".join(x for x in parts if x)


def test_broken_markup_is_read_in_linear_time(chain):
    import time
    start = time.time()
    for page in ("<a href=\"x " * 20_000, "<" * 100_000, "<p>" * 20_000 + "x", "<!--" * 50_000, "<a b='" + "c" * 500_000):
        H.blocks(page)
    assert time.time() - start < 60


def test_long_tags_are_no_text():
    texts = lambda page: [b.text for b in H.blocks(page)]
    assert texts('<div data-x="' + "j" * 5_000 + ' > REST">a</div><p>b') == ["a", "b"]
    assert texts('<p>a<img src="data:image/png;base64,' + "A" * 900_000 + '">b</p>') == ["ab"]
    page = "<div " + " ".join(f'data-{i}="{i} > x"' for i in range(300)) + ' class="story">a</div>'
    assert [(b.text, b.path) for b in H.blocks(page)] == [("a", (("div", "story"),))]
    assert texts("<p title=it's>a</p><p>don't <b c = '>'>d") == ["a", "don't d"]


def test_only_raw_text_runs_to_the_end():
    for tag in ("svg", "select", "noscript", "template", "canvas", "object", "math"):
        assert [b.text for b in H.blocks(f"<p>a</p><{tag}><p>b</p>")] == ["a", "b"]
    for tag in ("script", "style", "textarea", "title", "iframe"):
        assert [b.text for b in H.blocks(f"<p>a</p><{tag}><p>b</p>")] == ["a"]


def test_tags_without_end_are_read_in_linear_time():
    import time
    start = time.time()
    for page in ("<a x='>' " * 50_000, "<a x='y' " * 50_000 + "<b c='>'", "<a" * 100_000 + "/ x='>'", "<svg>" * 50_000, "<a b=\"c d='e " * 30_000 + "=\"'>"):
        H.blocks(page)
    assert time.time() - start < 20


def test_query_rows(spark, chain):
    page = "<nav><ul><li><a href=/>Menu</a></ul></nav><article><h1>Title</h1><p>Text  of\nit.</p></article><footer>&copy; me</footer>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<p>"), (4, "x", "<article><p>" + "word " * 200_000 + "</p></article>")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in H.extract(df, chain).collect()), key=str)
    assert got[:1] == [(0, "w", "", 0)] and got[1:3] == [(1, "u", "Title\nText of it.", 17)] * 2
    assert got[3:5] == [(2, None, "", 0), (3, "v", "", 0)] and got[5][3] == 999_999
    assert H.extract(spark.createDataFrame([], PAGES), chain).collect() == []
