import html
import re

from common import SF, clashing, empty, odd, sentence  # noqa: F401
from pyspark.sql import functions as F
from quotelake.llm import html_text as op

NAV = "<nav><ul><li>Home<li>News</ul></nav>"


def _texts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in op.with_main_text(df).collect()}


def test_query_equals_brute_force(spark):
    found = {r.page_id: r for r in op.op5_html_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?(?:b|br)>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        text = "\n".join(x for x in blocks if x)
        r = found[page.page_id]
        assert (r.url, r.text, r.n_chars) == (page.url, text, len(text))


def test_what_an_article_has_around_and_inside(spark):
    page = (f"<html><head><title>no</title><style>p{{}}</style></head><body class='has-sidebar'><header>Site</header>{NAV}"
            "<div class='cookie-notice'>We use cookies</div><div id='page-header'>Top</div><main><article><header><h1>Title &amp; more</h1></header>"
            "<p>One\n  two<br>three <b>bo</b>ld &eacute;&#233;<p>Second<ul><li>a<li>b</ul><form>x<input></form>"
            "<div class='share'>Share</div><script>if (a<b) '</p>'</script><!-- <p>no</p> -->"
            "<table><tr><td>1<td>2</table><aside>aside</aside>tail</article>"
            "<section class='comments'><article class='comment'>Nice!</article></section></main>"
            "<div class='sidebar'>side</div><footer>foot</footer></body></html>")
    assert _texts(spark, [(1, "http://a.b/x", page)])[1] == (
        "Title & more\nOne two three bold éé\nSecond\na\nb\n1\n2\ntail")


def test_site_style_tree_finds_noise_that_no_name_tells(spark):
    pages = [(i, "http://h.example/p", f"<body><div class='a1'>Best site ever</div><div class='b2'>"
              f"{sentence(i, 20)}</div><div class='c3'>{sentence(i % 2, 4)}</div></body>") for i in range(20)]
    pages += [(100, "http://other.example/", pages[0][2])]
    found = _texts(spark, pages)
    assert all(found[i] == sentence(i, 20) for i in range(20))
    assert found[100] == "\n".join(("Best site ever", sentence(0, 20), sentence(0, 4)))


def test_articles_that_pages_repeat_stay(spark):
    page = f"{NAV}<article><h1>T</h1><p>{sentence(1, 30)}</article><footer>f</footer>"
    found = _texts(spark, [(i, "https://u@h.example:80/", page) for i in range(30)])
    assert set(found.values()) == {"T\n" + sentence(1, 30)}


def test_odd_pages(spark):
    pages = [(1, None, None), (2, "", ""), (3, "x", "just text"), (4, None, "<"), (5, "http://a", "<a href='x>open"),
             (6, "http://a", "<p>" * 3000 + "deep"), (7, "http://a", "<div>" * 3000 + "deep"), (None, "http://a", "<p>no id"),
             (8, "http://a", "a&nbsp;&lt;b&gt;   c"), (9, "http://a", "<script>never closed"),
             (10, "http://a", "<div class=ad>open<article>inside</article>"), (11, "http://a", "w " * 200000)]
    found = _texts(spark, pages)
    assert found == {1: "", 2: "", 3: "just text", 4: "<", 5: "open", 6: "deep", 7: "deep", None: "no id", 8: "a <b> c",
                     9: "", 10: "inside", 11: ("w " * 200000).strip()}
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "*", "'mine' host", "'mine' noise", "1 node", "'mine' c0", "'mine' text")
    out = op.with_main_text(df)
    assert out.columns == ["page_id", "url", "host", "noise", "node", "c0", "text"] and out.count() == len(pages)
    assert op.with_main_text(empty(df)).count() == 0


def test_states_topics_and_anchors_mark_nothing(spark):
    text = sentence(1, 30)
    pages = [f"<article class='post {c}'><p>{text}</article>" for c in (
        "category-social", "tag-search", "comments-open", "has-sidebar", "related-work")]
    pages += [f"<div class='content no-sidebar'><p>{text}</div>", f"<section id='related-work'><p>{text}</section>"]
    pages = [NAV + p for p in pages]
    heading = f"{NAV}<article><h2 id='social-impact'>T</h2><p>{text}</article>"
    gone = [f"<p>{text}<div class='{c}'>gone</div>" for c in ("sidebar", "cookie-notice", "related-posts", "nav-item")]
    gone += [f"<p>{text}<section id='comments'>gone</section>", f"<p>{text}<article class='comment'>gone</article>"]
    found = _texts(spark, [(i, f"http://h{i}.b/", p) for i, p in enumerate([heading, *pages, *gone])])
    assert found[0] == "T\n" + text and all(found[i] == text for i in range(1, len(found)))


def test_copies_of_a_page_without_an_article_stay(spark):
    pages, expected = [], {}
    for copies in (7, 8, 30):
        text = sentence(copies, 30)
        page = f"<body>{NAV}<div class='content'><p>{text}</div></body>"
        for k in range(copies):
            pages.append((100 * copies + k, f"http://h{copies}.example/{k}", page))
            expected[100 * copies + k] = text
    for k in range(12):     # copies beside pages that only share a line without a name
        body = sentence(k // 2 if k < 4 else k, 20)
        pages += [(9000 + 10 * k + j, "http://m.example/", f"<div class='a1'>Best site ever</div><div class='b2'>{body}</div>")
                  for j in range(8 if k == 0 else 1)]
        expected |= {9000 + 10 * k + j: body for j in range(8 if k == 0 else 1)}
    assert _texts(spark, pages) == expected


def test_names_that_only_partly_tell_are_judged_by_the_site(spark):
    pages, expected = [], {}
    for n in (1, 2, 7, 8, 30):
        for k in range(n):
            own, i = sentence(100 * n + k, 25), 100 * n + k
            parts = [f"<section class='social-impact'><p>{own} a</section>", f"<div class='share-price'>{own} b</div>",
                     f"<p class='notice-period'>{own} c</p>", f"<div class='login-guide'>{own} d</div>"]
            same = "<div class='widget-weather'>Sunny today</div><div class='x1'>Best site ever</div>"
            pages.append((i, f"http://n{n}.example/{k}", f"<body>{NAV}{''.join(parts)}{same}</body>"))
            lines = [f"{own} {x}" for x in "abcd"] + (["Sunny today", "Best site ever"] if n == 1 else [])
            expected[i] = "\n".join(lines)
    assert _texts(spark, pages) == expected


def test_presentation_that_differs_counts(spark):
    shapes = ("<b>x</b>", "<i>x</i>", "<u>x</u><b>y</b>", "<em>x</em>", "<tt>x</tt><i>y</i>", "<b>x</b><i>y</i>")
    pages = [(i, "http://v.example/", f"<div class='v'>{shapes[i % 6]}</div><div class='w'>"
              f"<b>x</b></div><div class='z'>{sentence(i, 9)}</div>") for i in range(24)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = sorted((round(r.presentation, 2), r.pages) for r in op.importance(df).collect())
    assert rows == [(0.0, 24), (0.0, 24), (0.56, 24)]


def test_numbered_elements_share_a_node_and_comments_differ(spark):
    pages = [(i, "http://c.example/", f"<div class='body-{i}'>{sentence(i, 20)}</div>" + "".join(
        f"<div id='comment-{50 * i + k}' class='comment depth-{k}'>{sentence(7 * i + k, 9)}</div>" for k in range(20)))
        for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert op.importance(df).count() == 2
    assert _texts(spark, pages) == {i: sentence(i, 20) for i in range(30)}


def test_drawings_formulas_objects_and_what_is_left_open(spark):
    found = _texts(spark, [(i, f"http://d{i}.example/", f"<article>{page}</article><footer>f</footer>") for i, page in enumerate((
        '<p>one</p><svg><path d="x"><p>two</p><p>three</p>', "<p>Let <math><mi>x</mi><mo/></math> be</p>",
        "<p>a <svg viewBox='0'><circle/><text>no</text></svg> b</p>", "<p>x</p><object data=f><p>instead</p></object><p>y</p>",
        "<p>k</p><object data=f><p>open", "<p>v <video src=a>No player <p>here</p></video> w</p>",
        "<p>s <select><option>1<option>2</select> t</p>", "<p>s <select><option>1<div>u</div>",
        "<p>n</p><noscript><p>Turn it on</p></noscript><p>m</p>", "<div><canvas>old</div><p>new</p>"))])
    assert [found[i] for i in range(10)] == [
        "one\ntwo\nthree", "Let x be", "a b", "x\ninstead\ny", "k\nopen", "v w", "s t", "s\nu", "n\nm", "new"]


def test_columns_with_clashing_names(spark, clashing):
    pages = clashing.withColumn("url", F.lit("http://k.example/")).withColumn("html", F.concat(
        F.lit("<nav>n</nav><p>"), F.col("text"))).withColumn("__noise", F.lit("mine")).withColumn("value", F.lit(1))
    out = op.with_main_text(pages)
    assert set(out.columns) == set(pages.columns) - {"html"} and out.count() == pages.count()
    assert {r["__noise"] for r in out.collect()} == {"mine"}
