import html
import random
import re

import pytest

from ratingloom.llm import dom, wrappers

LAYOUT = "page_id long, url string, html string, host string, seed string, text string, n string"


def text_of(page):
    return "\n".join(leaf.text for leaf in dom.content_leaves(dom.parse(page)))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], LAYOUT).repartition(4)


def extracted(spark, rows):
    return {r.page_id: r for r in wrappers.extract(table(spark, rows)).collect()}


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple &copy", "plain & simple ©"),
        ("<p>one<p>two <b>bold</b>er<br>line\n\t end&nbsp;.</p>three", "one\ntwo bolder line end .\nthree"),
        ("<title>T</title><p>a</p><script>var x='<p>no</p>'</script><style>p{}</style><p>b", "a\nb"),
        ("<nav><a href=x>m</a></nav><header>h</header><main><header><h1>t</h1></header><p>x</p></main><footer>f</footer>", "t\nx"),
        ("<div class='cookie-notice'>c</div><div class='no-sidebar'><p>x</p></div><aside>s</aside><div id=comments>r</div>", "x"),
        ("<div class='content-with-comments has_menu'><p>x</p><div class='post-comments'>r</div></div>", "x"),
        ("<article><p>x <span class=ad>ad</span>y</p><form>f<p>g</p></form><section class='reader comments'>c</section></article>", "x y"),
        ("<div><article><h2>a</h2><p>b</article></div><p>teaser</p><article>c</article>", "a\nb\nc"),
        ("<ul class=m><li><a>a</a><li><a>b</a><li><a>c</a></ul><p>text with <a href=x>one link</a></p>", "text with one link"),
        ("<ul><li>one<ul><li>in</ul><li>two</ul><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl>", "one\nin\ntwo\na\nb\nc\nd\ne"),
        ("<!-- <p>no</p> --><p>a < b</p><p>5 &lt; 6 &#8364; &#x1F642;</p><![CDATA[x]]>", "a < b\n5 < 6 € 🙂"),
        ("<p>a</b></i></p></article><p>b</div></p>", "a\nb"),
        ("<head><meta charset=x><title>t<body><p>x", "x"),
        ("<div role=navigation>m</div><div hidden>h</div><div style='display: none'>n</div><p>x", "x"),
        ("<pre>a\n  b</pre><hr><blockquote>c</blockquote><figure><img src=x><figcaption>d</figcaption></figure>", "a b\nc\nd"),
        ("a\0b<p>　 </p>", "a�b"),
    ],
)
def test_blocks_of_a_page(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "<p>core</p>" + "</div>" * 5000 + "<p>end"
    assert text_of(deep) == "core\nend"
    assert text_of("<b>" * 5000 + "x") == "x"
    many = "".join(f"<p>block {i}</p>" for i in range(30000))
    assert text_of(many).split("\n") == [f"block {i}" for i in range(30000)]
    template = dom.unpacked(dom.packed(dom.parse(many)))
    assert len(dom.align(template, dom.parse(many))) > 200


def plain_matching(a, b):
    """Simple tree matching by plain recursion: nodes, leaves of equal text twice."""
    if a.mark != b.mark:
        return 0
    if a.tag == "#":
        return 1 + (a.hash == b.hash)
    table = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, x in enumerate(a.kids):
        for j, y in enumerate(b.kids):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + plain_matching(x, y))
    return 1 + table[-1][-1]


def test_alignment_is_the_greatest_and_keeps_order():
    rng = random.Random(4)

    def page(depth):
        if depth == 0:
            return rng.choice("abc")
        return "".join(f"<{t}>{page(depth - 1)}</{t}>" for t in rng.choices(["div", "section", "p"], k=rng.randrange(4)))

    for _ in range(150):
        a, b = dom.parse(page(3)), dom.parse(page(3))
        template = dom.unpacked(dom.packed(a))
        order, stack = [], [template]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(reversed(node.kids))
        found = dom.align(template, b)
        assert all(order[i].mark == node.mark for i, node in found.items())
        weight = sum(1 + (node.tag == "#" and node.hash == order[i].hash) for i, node in found.items())
        assert weight == plain_matching(template, b)


def site(i, extra="", body=None):
    body = body or "".join(f"<p>Story {i} part {k} told here.</p>" for k in range(1 + i % 4))
    return f"<html><body><div class=top>The Daily</div><div class=story><h1>Title {i}</h1>{body}</div>{extra}<div class=end>Call us</div>"


def story(i):
    return "\n".join([f"Title {i}", *(f"Story {i} part {k} told here." for k in range(1 + i % 4))])


def test_constant_blocks_of_a_host_are_template(spark):
    rows = [(i, f"https://WWW.Site.example/{i}", site(i)) for i in range(40)]
    rows += [(100 + i, "http://site.other:80/x", site(i, "<div class=end>Now and then</div>" if i % 2 else "")) for i in range(30)]
    got = extracted(spark, rows)
    assert all(got[i].text == story(i) and got[i].n_template == 2 for i in range(40))
    assert all(got[100 + i].text == story(i) + ("\nNow and then" if i % 2 else "") for i in range(30))


def test_few_pages_copies_and_pages_without_host_keep_their_blocks(spark):
    same = site(3)
    rows = [(i, "http://small.example/", site(i)) for i in range(3)]
    rows += [(100 + i, "http://copies.example/", same) for i in range(50)]
    rows += [(200 + i, url, site(i)) for i, url in enumerate([None, "", "no host", "mailto:x@y"] * 6)]
    rows += [(300, "http://null.example", None), (300, "http://null.example", ""), (None, None, None)]
    frame = wrappers.extract(table(spark, rows))
    assert frame.columns[:4] == ["page_id", "url", "text", "n_chars"]
    for r in frame.collect():
        if r.page_id is None or r.page_id == 300:
            assert (r.text, r.n_chars) == ("", 0)
        else:
            i = 3 if 100 <= r.page_id < 200 else r.page_id % 100
            assert r.text == f"The Daily\n{story(i)}\nCall us" and r.n_template == 0 and r.n_chars == len(r.text)
    assert frame.count() == len(rows)


def test_empty_table(spark):
    assert wrappers.extract(table(spark, []).limit(0)).count() == 0


def test_driver_pages_against_a_plain_reading(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    rows = wrappers.extract(pages).collect()
    assert len(rows) == len(raw)
    for r in rows:
        # The driver's pages hold their text between one pair of tags, in paragraphs and headings.
        inner = re.sub("<(br|b)>", " ", re.search("<article>(.*)</article>", raw[r.page_id], re.S)[1])
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in re.split("</?(?:p|h1)>", inner))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_template_block_amid_very_many_siblings_is_aligned(spark):
    def long_site(i):
        parts = [f"<p>Line {k} of story {i}.</p>" for k in range(300)]
        parts.insert(150, "<div class=mid>Subscribe today</div>")
        return site(i, body="".join(parts))

    rows = [(i, "https://long.example/", long_site(i)) for i in range(30)]
    got = extracted(spark, rows)
    for i in range(30):
        lines = [f"Title {i}", *(f"Line {k} of story {i}." for k in range(300))]
        assert got[i].text == "\n".join(lines) and got[i].n_template == 3


def test_pages_are_not_parsed_a_third_time_for_their_text(spark):
    rows = [(i, f"https://a.example/{i}", site(i)) for i in range(30)]
    frame = wrappers.extract(table(spark, rows))
    # Seeds and alignment parse each page; the text comes from what the alignment kept.
    assert "MapInArrow" not in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 30
