import json

import pytest

from nutrilake.llm import html_text
from nutrilake.llm.html_text import SIG, fold, main_text, merge, parse


def text(page):
    return main_text(page, None, 0)


def test_blocks_references_and_white_space():
    assert text("<article><h1>A &amp; B</h1><p>x \n\t y<br>z</p><ul><li>one<li>two</ul></article>") == "A & B\nx y z\none\ntwo"
    assert text("<main>loose <b>bold</b>er &#233;&eacute;&nbsp;&lt;b&gt;<p>p1<p>p2</main>") == "loose bolder éé <b>\np1\np2"
    assert text("<table><tr><td>1<td>2<tr><th>3</table>") == "1\n2\n3"


def test_what_is_no_article_goes():
    page = """<html><head><title>t</title><style>p{}</style><script>if (a<b) "</p>";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li>menu</ul></nav><div class="cookie-notice">cookies</div>
      <div id="sidebar"><p>side</p></div><article><header><h1>Title</h1></header><p>Text.</p><div class="ad">buy</div>
      <form><p>f</p><button>go</button></form><aside>by the way</aside><p>More.<!-- gone --></p>
      <section class="comments"><article class="comment"><p>first!</p></article></section></article>
      <footer>foot</footer></body></html>"""
    assert text(page) == "Title\nText.\nMore."


def test_broken_pages():
    assert [text(x) for x in ("", "<", "<p", "a<1", "<p>x<!-- y", "<script>x", "</p></div>y", "<p>a</b></i>b")] == [
        "", "<", "", "a<1", "x", "", "y", "ab"]
    assert text("<div>" * 300 + "deep" + "</div>" * 300) == "deep"


def test_a_part_of_a_name_drops_no_page():
    for page in ("<body class='has-sidebar'><p>Text.</p></body>", "<div id=page class='with-cookie-banner'><p>Text.</p></div>",
                 "<article class='post no-comments'>Text.</article>", "<main class='layout-sidebar-left'>Text.</main>",
                 "<html class='no-menu'><body class='menu widget'>Text.</body></html>", "<body class='has-header'><p>Text.</p>",
                 "<div class='page-widget'><article>Text.</article></div><p>outside, and longer than the article</p>",
                 "<span class='main-widget'>Text.</span>"):
        assert text(page) == "Text.", page
    assert text("<div class='site-menu'>menu</div><div class=page>Text of the page.</div>") == "Text of the page."
    assert text("<div class='site_header'>name</div><span class='ad-x'>ad</span><p>Text of the page.</p>") == "Text of the page."
    assert text("<div class=post><div class='post-comments'><article class=comment>yes</article></div>Text of it.</div>") == "Text of it."


def test_values_of_other_attributes_are_not_read():
    for tag in ("p data-id='comment'", "div data-role=form", "p title='the class=ad of'", "p data-x='a' data-class=menu", "p id=''"):
        assert text(f"<article><{tag}>Text.</article>") == "Text.", tag
    assert text('<article><p>One <a href="/x?id=menu">link</a> and <a href=/x?id=menu>two</a>.</article>') == "One link and two."
    assert text("<article>Text.<p ID = 'Comments' >no</p><p x=1 Class=ad>no</p><p class=\"ad\"id=b>no</p></article>") == "Text."


def test_a_name_that_is_dropped_on_some_pages_only(spark):
    light = lambda i: f"<div class='top-menu'>menu {i}</div><article>Text of page {i}.</article>"
    heavy = "<div class='top-menu'><article>Kept.</article><p>outside</p></div>"
    out = extract(spark, [(i, f"http://h.example/{i}", light(i)) for i in range(9)] + [(99, "http://h.example/99", heavy)])
    assert out[(3, "http://h.example/3")] == "Text of page 3." and out[(99, "http://h.example/99")] == "Kept."


def test_trees_are_aligned_in_order():
    a = fold(parse("<div class=x>1</div><p>a</p><div class=y>same</div>"))
    merge(a, fold(parse("<p>b</p><p>c</p><table></table><div class=y>same</div>")))
    assert [(k[SIG], k[1]) for k in a[html_text.KIDS]] == [("div.x", 1), ("p", 2), ("table", 1), ("div.y", 2)]
    assert a[html_text.KIDS][1][html_text.TEXT] is None and a[html_text.KIDS][3][html_text.TEXT]


def pages(n):
    return [(i, f"http://h.example/{i}", f"<body><div class=top>Our site</div><div class=body><p>First of {i}.</p>"
             f"<div class=more>Read the rules</div><p>Second of {i}.</p></div><div class=bottom>Legal</div></body>")
            for i in range(n)]


def extract(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {(r.page_id, r.url): r.text for r in html_text.extract_text(df).collect() if r.n_chars == len(r.text)}


def test_constant_nodes_are_template(spark):
    out = extract(spark, pages(9) + [(50, None, None), (51, "odd", ""), (52, "http://other.example/", "<article>a</article>")])
    assert out[(3, "http://h.example/3")] == "First of 3.\nSecond of 3."
    assert out[(50, None)] == out[(51, "odd")] == "" and out[(52, "http://other.example/")] == "a"
    assert len(out) == 12


def test_copies_of_one_page_are_no_evidence(spark):
    rows = [(i, f"http://h.example/{i}", "<article><h1>T</h1><p>Body</p></article>") for i in range(20)]
    assert set(extract(spark, rows).values()) == {"T\nBody"}


def test_another_layout_on_the_host(spark):
    rows = pages(8) + [(99, "http://h.example/99", "<table><tr><td>cell</table>")]
    assert extract(spark, rows)[(99, "http://h.example/99")] == "cell"


def test_empty_table_and_extra_columns(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, text string, host string")
    assert html_text.extract_text(none).count() == 0
    one = spark.createDataFrame([(1, "u", "<p>x</p>", "t", "h")], none.schema)
    assert [tuple(r) for r in html_text.extract_text(one).collect()] == [(1, "u", "x", 1)]


def test_templates_are_plain_data():
    tree = fold(parse("<article><p>x</p></article>"))
    assert json.loads(json.dumps(tree)) == tree


def test_names_of_single_pages_add_no_template_nodes(spark):
    page = (lambda i: f"<body class='postid-{i} single'><div class='top t{i}'>Our site</div><article class='post post-{i}'>"
            f"<p>First of {i}.</p><div class=more>Read the rules</div><p>Second of {i}.</p></article></body>")
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(120)]
    df = spark.createDataFrame([("h", r[2]) for r in rows] + [("one", page(1))], "host string, html string").repartition(3)
    sizes = {r.host: (len(json.loads(r.template)), r.n_distinct) for r in html_text.induce_templates(df).collect()}
    assert sizes == {"h": (7, 5), "one": (7, 1)}
    assert set(extract(spark, rows).items()) == {((i, u), f"First of {i}.\nSecond of {i}.") for i, u, _ in rows}


def test_deep_pages(spark):
    deep = lambda i: "<article>" + "<div>" * 3000 + f"<p>Text {i}.</p>"
    assert text(deep(0)) == "Text 0."
    out = extract(spark, [(i, f"http://h.example/{i}", deep(i)) for i in range(6)])
    assert sorted(out.values()) == [f"Text {i}." for i in range(6)]


def test_dumped_templates_load_again():
    tree = fold(parse("<article><p>x</p><div><ul><li>y</ul></div><table></table></article><div></div>"))
    assert html_text.load(html_text.dump(tree)) == tree


@pytest.mark.parametrize("page, want", [
    # reader comments go, however long, also as articles and inside the article
    ("<p>The post.</p><div class='comment-list'>" + "<p>A reader says something long.</p>" * 50 + "</div>", "The post."),
    ("<article><p>The post.</p></article><article class='comment-body'><p>Me too</p></article>", "The post."),
    ("<article><p>The post.</p><section class='responses'><p>Me too</p></section></article>", "The post."),
    ("<article><p>The post.</p><ol class='comment-list'><li>Me too</ol></article>", "The post."),
    ("<main><p>The post.</p><section id='comments'><p>Me too</p></section></main>", "The post."),
    # an article's own headings and sections stay
    ("<article><h1>T</h1><section id='discussion'><p>We discuss.</p></section></article>", "T\nWe discuss."),
    ("<article><h2 id='related'>Related work</h2><p>a</p></article>", "Related work\na"),
    ("<article><div class='market-share'>Ten percent.</div><p class='notice-period'>A month.</p></article>",
     "Ten percent.\nA month."),
    ("<article class='post no-comments'><p>a</p></article>", "a"),
    # a page wrapped in one form keeps its text, other forms go
    ("<form id='aspnetForm'><header>Site</header><div><p>The post.</p><input value=x></div></form>", "The post."),
    ("<form><div><p>The post.</p></div></form>", "The post."),
    ("<div><p>The post.</p></div><form><p>Your name</p><input></form>", "The post."),
    # names that tell the state of the page
    ("<body class='has-sidebar'><div id='page' class='with-cookie-banner'><p>a</p></div>", "a"),
    ("<div class='ad-free-page'><p>All of the text.</p></div>", "All of the text."),
    ("<div><p>a</p></div><div class='sidebar-left'><p>b</p></div><div class='site-footer'>c</div>", "a"),
])
def test_boilerplate_by_structure_and_name(page, want):
    assert text(page) == want


def test_hostile_pages_are_linear():
    import time
    for page in ("<div>" * 20000 + "<p>Text.</p>", "<div>" * 20000 + "</x></ul>" * 20000 + "<p>Text.</p>",
                 "<article>" + "<div><p>Text.</p>" * 10000):
        start = time.process_time()
        assert text(page).startswith("Text.")
        assert time.process_time() - start < 5
