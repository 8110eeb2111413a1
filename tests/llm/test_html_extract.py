import pytest

from ledgerlake.llm import html_extract as h

from .helpers import crowded

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul>{menu}</ul></nav><!-- ad --><div class="ad">Buy</div>
<div class="cookie-notice">We use cookies</div><aside>Side</aside>
<article><header><h1>{title}</h1></header>{body}<form><input> Send</form><section id="comments"><p>First!</p></section></article>
<footer>&copy; x</footer></body></html>"""
PLAIN = """<html><body><div class="top"><a href=1>Home</a> <a href=2>News</a></div><div id="wrap"><div class="col"><a href=3>Other</a></div>
<div class="body-{n}">{body}</div></div><div class="foot"><a href=4>About</a> text</div></body></html>"""


def page(title, *paragraphs, menu=3, end=True):
    whole = PAGE.format(title=title, body="".join(f"<p>{p}</p>" for p in paragraphs), menu="".join(f"<li><a>m{k}</a></li>" for k in range(menu)))
    return whole if end else whole.replace("</body></html>", "")


def test_article_without_the_rest():
    own = page("One &amp; two", "a  <b>bold</b>\n text", "x<br>y &lt;z&gt; &#233;&nbsp;.", "un<span>brok</span>en")
    wrapper = h.merge(h.pattern(own), h.pattern(page("Other", "t", menu=5, end=False)))
    assert h.main_text(own, h.main_path(wrapper)) == "One & two\na bold text\nx\ny <z> é .\nunbroken"
    assert h.main_text(own, None) == h.main_text(own, h.main_path(wrapper))


def test_wrapper_of_unmarked_pages():
    pages = [PLAIN.format(n=n, body="".join(f"<p>Paragraph {n} {k} of running text.</p>" for k in range(3 + n))) for n in range(4)]
    wrapper = h.pattern(pages[0])
    for p in pages[1:]:
        wrapper = h.merge(wrapper, h.pattern(p))
    assert h.main_path(wrapper)[-1].startswith("div.body")
    assert h.main_text(pages[2], h.main_path(wrapper)) == "\n".join(f"Paragraph 2 {k} of running text." for k in range(5))


def test_expressions():
    wrapper = h.merge(h.pattern("<ul><li>a</li><li>b</li></ul><p>same</p>"), h.pattern("<ul><li>c</li></ul><hr><p>same</p><dl><dt>1<dd>2<dt>3<dd>4</dl>"))
    assert h.expression(wrapper) == "<ul> (<li> #)+ (<hr>)? <p> 'same' (<dl> (<dt> # <dd> #)+)?"


def test_merging_in_any_grouping_gives_one_expression():
    parts = [h.pattern(page(f"t{k}", *["p"] * k, menu=k)) for k in range(1, 6)]
    left = parts[0]
    for p in parts[1:]:
        left = h.merge(left, p)
    right = h.merge(h.merge(parts[0], parts[1]), h.merge(h.merge(parts[2], parts[3]), parts[4]))
    assert h.expression(left) == h.expression(right) and h.main_path(left) == h.main_path(right)


@pytest.mark.parametrize("text", ["", None, "plain text", "<", "<p", "a < b > c", "<!-- open", "<script>never closed", "</div></p>x", "<p><b>x<br><p>y</p>",
                                  "<div>" * 3000 + "deep" + "</div>" * 3000, "<table><tr><td>1<td>2<tr><td>3</table>", "<a href='x>y'>q</a>", "\x00<p>\x00"])
def test_broken_pages(text):
    out = h.main_text(text, None)
    assert isinstance(out, str) and ("deep" in out if text and "deep" in text else True)
    assert h.main_text("<p><b>x<br><p>y</p>", None) == "x\ny"


def test_table(spark):
    rows = [(k, f"http://h{k % 2}.org/{k}", page(f"t{k}", f"words {k}", "more")) for k in range(9)]
    rows += [(20, None, page("n", "b")), (21, "http://h1.org/", None), (22, "http://h1.org/", ""), (23, "nohost", page("n", "c")), (3, *rows[3][1:]),
             (24, "http://long.org", page("L", *["many words " * 200] * 400))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(tuple, h.extract(crowded(df)).collect()), key=repr)
    assert got == sorted(((i, u, h.main_text(t, None)) for i, u, t in rows), key=repr)
    assert h.extract(df.limit(0)).count() == 0


def test_given_pages(spark):
    """On the given pages the text is all of the article and nothing else."""
    import re
    from html import unescape
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in h.extract(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"<(?:/?p|/?h1|br)>", inner)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("whole", [
    "<body class='no-sidebar'><article><p>{t}</p></article></body>", "<body class='home sidebar'><div><p>{t}</p></div></body>",
    "<body><main class='content has-sidebar'><p>{t}</p></main></body>", "<body><article class='post category-social'><p>{t}</p></article></body>",
    "<body><div id='page' class='with-nav'><article><p>{t}</p></article></div></body>", "<body><div class='sidebar-left'><div><p>{t}</p></div></div></body>",
    "<body><form action=x><div><p>{t}</p></div></form></body>", "<body><div class='widget'><main><p>{t}</p></main></div></body>"])
def test_names_do_not_exclude_the_article(whole):
    text = "Running text of the article. " * 5
    own = whole.format(t=text)
    assert h.main_text(own, None) == text.strip() == h.main_text(own, h.main_path(h.pattern(own)))


def test_comments_stay_out():
    own = "<body><article><p>Short.</p></article><div id='comments'><article><p>" + "A long comment. " * 20 + "</p></article></div></body>"
    assert h.main_text(own, None) == "Short."
