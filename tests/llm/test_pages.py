"""Main text of pages: hand cases."""

import pytest
from pyspark.sql import functions as F

from weeksignal.llm import pages

LONG = "A paragraph with a good number of words, as articles have them, and a full stop at its end."
CASES = {
    "plain": ("plain text only", ["plain text only"]),
    "article": (
        f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=x>Home</a></nav><article><h1>Head &amp; line</h1><p>{LONG}<p><b>short<br>line</b>"
        f"</article><footer>&copy; f</footer></body></html>",
        ["Head & line", LONG, "short line"],
    ),
    "cut off": (f"<body><article><p>{LONG}</p><p>{LONG} and &amp", [LONG, f"{LONG} and &"]),
    "wrappers": (
        f'<body class="has-sidebar"><div class="page with-sidebar"><header><h1>Site</h1></header><div class="cookie-notice">We use</div><main><article><header><h2>T</h2></header>'
        f'<p>{LONG}</p><aside>see</aside><div class="ad">buy</div><form><input><p>mail</p></form><section id="comments"><article class="comment"><p>{LONG} {LONG}</p></article></section>'
        f"</article></main><div class=sidebar>{LONG}</div></div></body>",
        ["T", LONG],
    ),
    "divs": (f"<div id=top><h1>Title</h1><div class=content><p>{LONG}<p>no</div><div class=related>rel <a href=x>y</a></div></div>", ["Title", LONG, "no"]),
    "references": ("<p>&lt;b&gt; &#65;&#x42; &eacute;  x\n\t y</p>", ["<b> AB é x y"]),
    "lists": ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
    "silent": ("<script>var a='<p>x</p>'</script><noscript>n</noscript><!-- c -->", []),
    "broken": ("<<<>>> </p></div><p", None),
}


@pytest.mark.parametrize("name", CASES)
def test_hand_cases(name):
    html, want = CASES[name]
    got = pages.main_text(html)
    assert want is None or got == "\n\n".join(want)


def test_short_paragraphs_between_long_ones_stay():
    body = "".join(f"<p>{LONG}</p><p>x</p>" for _ in range(30))
    assert pages.main_text(f"<article>{body}</article>") == "\n\n".join([LONG, "x"] * 30)


@pytest.mark.parametrize("kind", ["div", "section", "td", "blockquote", "center"])
@pytest.mark.parametrize("share", [(6, 4), (4, 6), (95, 1), (4, 3, 3)])
def test_all_containers_of_a_page_without_article_stay(kind, share):
    parts = [[f"{LONG} {k}.{n}." for n in range(count)] for k, count in enumerate(share)]
    boxes = "".join(f"<{kind}>{''.join(f'<p>{p}</p>' for p in part)}</{kind}>" for part in parts)
    boxes = f"<table><tr>{boxes}</tr></table>" if kind == "td" else boxes
    html = f"<body><ul><li><a href=a>Home</a><li><a href=b>News</a></ul><div id=content><h1>T</h1>{boxes}</div><ul><li><a href=c>Imprint</a></ul></body>"
    assert pages.main_text(html) == "\n\n".join(["T", *[p for part in parts for p in part]])


@pytest.mark.parametrize("name", ['class="page with-sidebar"', "id=header-and-content", 'class="content widget-area"', "class=menu-page", 'class="post share-box" id=p', 'class="post comments-open"', "class=widget"])
@pytest.mark.parametrize("times", [1, 2])
def test_names_of_wrappers_drop_no_content(name, times):
    body = [f"{LONG} {n}." for n in range(6)]
    boxes = "".join(f"<div {name}>{''.join(f'<p>{p}</p>' for p in body)}<div class=sidebar><p>{LONG}</p></div></div>" for _ in range(times))
    html = f"<body><div class=menu><a href=a>Home</a></div>{boxes}<div class=footer>imprint</div></body>"
    assert pages.main_text(html) == "\n\n".join(body * times)


def test_dense_boilerplate_beside_content_is_dropped():
    notice = f"<div class=cookie-text><p>{LONG}</p><p>{LONG}</p></div>"
    assert pages.main_text(f"<body><div><p>{LONG} 1.</p></div>{notice}</body>") == f"{LONG} 1."
    side = f"<div class=left-sidebar><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>"
    assert pages.main_text(f"<body><article><p>{LONG} 1.</p></article>{side}</body>") == f"{LONG} 1."


def test_smoothing_and_threshold():
    values = pages.smoothed(pages.np.array([0.0, 0, 100, 0, 0]))
    assert values.argmax() == 2 and 0 < values[1] < values[2] and values[1] == pytest.approx(values[3])
    assert 1 < pages.threshold(pages.np.array([0.0, 1, 0, 90, 100])) < 90


def test_null_empty_and_deep_pages(spark):
    deep = "<div>" * 3000 + LONG
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, deep, "c"), (3, deep, "c")], "page_id long, html string, text string")
    rows = df.select("page_id", pages.extract(F.col("html")).alias("t")).collect()
    assert [r["t"] for r in rows] == ["", "", LONG, LONG]
    assert df.limit(0).select(pages.extract(F.col("html"))).count() == 0
