import hashlib
import random
import tracemalloc

import pytest

from quarrylight.llm import html_extract, warc


def test_warc_round_trip(spark, tmp_path):
    rnd = random.Random(2)
    big = "é" * 700
    rows = [(i, f"http://x.de/ä b\n{i}", rnd.choice([big, "short", "", None, big + str(i), "<p>" + "y" * 300_000])) for i in range(60)] + [(None, None, big), (59, "u", big), (59, "u", big), (61, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'d' AS digest", "0 AS file")
    got = warc.round_trip(df, folder=f"file://{tmp_path}/a").collect()
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", -1), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = last[h or ""] if len(b) >= 1000 and i != last[h or ""] else None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, want)) == sorted(key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)


def test_warc_index_reads_single_records(spark, tmp_path):
    rows = [(i, f"http://x.de/{i}?q=ü", f"<p>{i}" * 5000) for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    index, folder = warc.write(df.repartition(3), f"file://{tmp_path}/b")
    assert index.count() == 50 and max(r.frame for r in index.collect()) > 0
    got = warc.fetch(index.filter("page_id in ('7', '42')"), folder).collect()
    for r in got:
        head, block, _ = warc.parse(bytes(r.record))
        assert head["WARC-Record-ID"] == f"<urn:page:{r.page_id}>" and block.endswith((f"<p>{r.page_id}" * 5000).encode())
    urls = {r.page_id: r.url for r in warc.read(index, folder).collect()}
    assert urls["7"] == rows[7][1] and len(urls) == 50
    assert warc.round_trip(df.limit(0)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="page sidebar-right"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article class="post"><h2>Tom &amp; Jerry&nbsp;&#233;</h2><p>First   line
goes on<p>Second <b>bold</b> &lt;tag&gt;<div class="ad">Buy</div><ul><li>one<li>two</ul><form><p>mail</p></form><script>var a="</p>";</script>
<section id="comments"><p>nice post</p></section><table><tr><td>a<td>b</table><!-- hidden --></article><aside>side</aside><footer>&copy; 2024</footer>"""


def test_main_text_of_one_page():
    assert html_extract.extract(PAGE) == "Tom & Jerry é\nFirst line goes on\nSecond bold <tag>\none\ntwo\na\nb"


@pytest.mark.parametrize("html,text", [(None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("a<br>b", "a b"), ("<p>x &am", "x &am"), ("<div><p>cut <b", "cut"), ("<p>5 < 6 & 7", "5 < 6 & 7"), ("<article><p>a</article>after", "a"), ("<p title='a>b'>t</p>", "t"), ("<div hidden>x</div>y", "y")])
def test_extract_cases(html, text):
    assert html_extract.extract(html) == text


def test_marked_words_inside_an_article():
    kept = ['<p class="follow-up">a</p>', '<p class="share-price">b</p>', '<p class="form-of-government">c</p>', '<section id="related-work"><p>d</p></section>', '<h2 class="section-header">e</h2>', "<p hidden>f</p>"]
    gone = ['<div class="ad-box">x</div>', '<div class="newsletter">x</div>', '<p class="advert">x</p>', '<ul class="comment-list"><li>x</ul>', '<aside>x</aside>', '<div id="cookie-notice">x</div>']
    assert html_extract.extract(f"<article>{''.join(kept + gone)}</article>") == "a\nb\nc\nd\ne\nf"
    assert html_extract.extract('<div class="site-header">x</div><p>a</p><div class="follow-us">y</div>') == "a"


def test_deep_and_long_pages():
    deep = "<div class='a'>" * 100_000 + "deep" + "</div>" * 100_000
    tracemalloc.start()
    assert html_extract.extract(deep) == "deep"
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()
    long = "".join(f"<p>paragraph {i}</p>" for i in range(100_000))
    assert html_extract.extract(f"<article>{long}</article>").count("\n") == 99_999


def test_archives_are_read_by_a_task_each(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(40)], "page_id long, url string, html string").repartition(5)
    index, folder = warc.write(df, f"file://{tmp_path}/c")
    out = warc.read(index, folder)
    assert out.rdd.getNumPartitions() == index.select("file").distinct().count() == 5 and out.count() == 40


def test_text_of_formulas_and_fallbacks_is_kept():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold</p><object data='a'><param name='n'>no plugin</object><noscript><p>plain form</p></noscript><p><svg><title>t</title><path d='M0'/><text>label</text></svg></p><canvas>chart</canvas><script>var s</script><template>t</template></article>"
    assert html_extract.extract(page) == "Let x=2 hold\nno plugin\nplain form\nlabel\nchart"


def test_style_tree_cuts_what_all_pages_say(spark):
    rows = [(i, f"http://h.de/{i}", f"<body><div class='zq1'><span>Shop the best deals</span></div><div class='k9'><p>Story number {i} with its own words</p></div>") for i in range(20)]
    rows += [(100, "http://h.de/copy", rows[0][2]), (101, None, "<p>alone"), (102, "http://few.de/", rows[3][2]), (103, "http://h.de/x", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'n' AS node", "'h' AS host", "1 AS page")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.main_text(df).collect()}
    assert got[5][0] == "Story number 5 with its own words" == got[5][0] and got[100][0] == got[0][0]
    assert got[101] == ("alone", 5) and got[103] == ("", 0)
    assert got[102][0].startswith("Shop the best deals\n")
    assert html_extract.main_text(df.limit(0)).count() == 0


def test_articles_are_not_menus(spark):
    rows = [(i, "http://h.de/a", f"<article><p>The same story everywhere</p></article><i>{i}</i>") for i in range(30)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {"The same story everywhere"}


def test_the_style_tree_is_built_of_whole_pages(spark):
    page = "<body><nav><p>Home</p></nav><div class='w'><p>Shop the best deals</p><article><h2>Story</h2><p>Number {0}</p></article></div><article><p>Second {0}</p></article><div class='x'><menu><li>{0}</menu>Open today</div><i>{0}</i>"
    rows = [(i, f"http://h.de/{i}", page.format(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = html_extract.parse(rows[0][2])
    body = next(c for c in root.children if c.tag == "body")
    nav, wrap, article, side, _ = (c for c in body.children if not isinstance(c, str))
    shop, inner = wrap.children
    held = {style for style, _, _ in html_extract._branches(root)}
    assert {n.style for n in (nav, nav.children[0], wrap, shop, inner, *inner.children, article, side, side.children[0])} <= held
    low = {r.node for r in html_extract.style_tree(df.selectExpr("'h.de' AS host", "html")).collect()}
    assert {nav.style, shop.style, inner.children[0].style, side.style} <= low and low.isdisjoint((wrap.style, inner.style, article.style, side.children[0].style))
    assert {r.text for r in html_extract.main_text(df).collect()} == {f"Story\nNumber {i}\nSecond {i}" for i in range(20)}


@pytest.mark.parametrize("html,text", [
    ("<p>a <button><p>x</p><div>y</div></button> b</p>", "a b"), ("<ul><li>a<menu><li>x</menu>b</ul>", "a\nb"), ("<article><aside>x</article>y", "y"),
    ("<section><div class='ad'>x</section><p>y", "y"), ("<nav><ul><li><a>x</ul><div>y</div></nav>z", "z"), ("<select><option>x<option>y</select>z", "z"),
])
def test_furniture_is_read_as_browsers_do(html, text):
    assert html_extract.extract(html) == text
