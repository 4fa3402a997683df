from __future__ import annotations

import html
import re
import time

import duckdb
import numpy as np

from tessera.llm import html_text as h

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";if(a<b)track(0);</script></head><body>
<header><a href=/>Home</a> Site</header><nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><!-- x <p>no</p> -->
<div class="ad">Buy now</div><article><h1>A &amp; B</h1><p>One   <b>bold</b>
two &lt;3 &#233;.<br>three</p><p>Short.</p><div class="cookie-notice">We use cookies</div><p>Last one<table><tr><td>x<td>y</table>
<form>Name <input name=n></form></article><section id="comments"><article class="comment"><p>First!</p></article></section>
<aside>Related</aside><footer>&copy; all</footer></body></html>"""


def test_a_page_of_all_kinds():
    assert h.main_text(PAGE) == "A & B\nOne bold two <3 é. three\nShort.\nLast one\nx\ny"


def test_truncated_and_broken_pages():
    assert h.main_text("<article><h1>H</h1><p>cut off he") == "H\ncut off he"
    assert h.main_text("<article><p>a < b and c > d <i>x</article") .startswith("a < b and c > d")
    assert h.main_text("<p" * 50) == "" and h.main_text(None) == "" and h.main_text("") == ""
    assert h.main_text("<article><p>a</b></div></p>b</article>") == "a\nb"


def test_pages_without_an_article():
    text = " ".join(["word"] * 60)
    page = f"<body><div><a href=x>Home</a></div><h1>Title</h1><div>{text}</div><div>and a closing line</div><div class=footer>imprint</div>"
    assert h.main_text(page) == f"Title\n{text}\nand a closing line"


def test_tree_fits_its_pages_and_held_out_ones():
    x, y = h.labelled()
    assert (h.default_tree().labels(x) == y).all()
    right = []
    for k in range(len(h.PAGES)):
        tree = h.grow(*h.labelled(h.PAGES[:k] + h.PAGES[k + 1 :]))
        rows, labels = h.labelled(h.PAGES[k : k + 1])
        right += list(tree.labels(rows) == labels)
    assert np.mean(right) > 0.95


LONG = " ".join(["long"] * 40)


def test_no_article_is_lost_by_a_name():
    inner = f"<h1>Title</h1><p>{LONG}</p><p>short</p>"
    for name in ("post comments-open", "share", "search-results", "related", "header", "social", "sidebar-left"):
        for page in (
            f'<nav><a href=/>Home</a></nav><article class="{name}">{inner}</article><footer>x</footer>',
            f'<div class="{name}"><article>{inner}</article></div><div class=ad>Buy</div>',
            f'<body class="{name}"><div id="{name}-wrapper"><main>{inner}</main></div>',
            f'<div id="{name}">{inner}</div>',
            f'<form id={name}><article><div class="{name}-body">{inner}</div></article></form>' if "comment" not in name else f"<main>{inner}",
        ):
            assert h.main_text(page) == f"Title\n{LONG}\nshort", page


def test_no_controls_notices_or_comments():
    extra = (
        "<noscript>Enable scripts</noscript>", "<button>Copy</button>", "<label>Mail</label>", "<select><option>One<option>Two</select>",
        "<svg><title>Icon</title><text>Drawn</text></svg>", "<template><p>Later</p></template>", f"<div class=cc-window>We track you {LONG}</div>",
        f"<section class=user-feedback><p>{LONG}</p><p>Me too</p></section>", "<p hidden>unseen</p>", "<div style='display: none'>unseen</div>",
        f"<ol class=comment-list><li><p>First</p><p>{LONG}</p></ol>", "<aside><p>Aside</p></aside>", "<textarea>typed</textarea>", "<iframe>frame</iframe>",
    )
    for more in extra:
        assert h.main_text(f"<article><h1>T</h1><p>{LONG} a</p>{more}<p>b {LONG}</p></article>") == f"T\n{LONG} a\nb {LONG}", more
    assert h.main_text(f"<article><p>{LONG} <button>Copy</button>on</p></article>") == f"{LONG} on"


def test_short_lines_of_pages_without_an_article():
    page = "<div><a href=/>Home</a> <a href=/a>About</a></div><h1>Small title</h1><p>One line of text.<p>Two.<p>The end.<div class=footer>Imprint</div>"
    assert h.main_text(page) == "Small title\nOne line of text.\nTwo.\nThe end."


def test_quotes_references_and_implied_ends():
    assert h.main_text("<article><p title='a > b' don't>x<p class=\"y>z\">y &lt;p&gt; &amp;amp; &nbsp; z</article>") == "x\ny <p> &amp; z"
    assert h.main_text("<article><ul><li>a<li class=ad>b<p>c</p><li>d</ul><table><tr><td>e<td></div>f</table>g</article>") == "a\nd\ne\nf\ng"
    assert h.main_text("<article><p>a <!-- <p>no --> b <!--> c<script>if(a<b)'</p>'</script> d</p><p title='open>e</p></article>") == "a b c d\ne"


def test_bad_pages_take_time_by_their_length():
    for piece, n in (("<a ", 350_000), ('<p class="', 100_000), ("<div>", 100_000), ("<!--", 250_000), ("<title>", 140_000), ("<", 500_000), ("<b x>", 200_000)):
        for rest in ("", "</span>" * 50_000, "</div>" * 50_000):
            began = time.perf_counter()
            h.main_text(piece * n + rest)
            assert time.perf_counter() - began < 8, piece


def test_sql_gives_the_same(spark, data):
    pages = duckdb.read_parquet(f"{data}/pages.parquet")  # noqa: F841
    want = {r[0]: r[2:] for r in duckdb.sql(h.SQL).fetchall()}
    got = h.main_texts(spark.read.parquet(f"{data}/pages.parquet")).collect()
    assert {r.page_id: (r.text, r.n_chars) for r in got} == want


def test_all_test_pages_give_their_article(spark, data):
    rows = duckdb.sql(f"SELECT page_id, html FROM '{data}/pages.parquet'").fetchall()
    want = {}
    for i, page in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1|br)>", inner)]
        want[i] = "\n".join(p for p in parts if p)
    got = {r.page_id: r for r in h.main_texts(spark.read.parquet(f"{data}/pages.parquet")).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, None, "t"), (1, "u", "", "t"), (None, "u", "<p>" + "long " * 50000, "t"), (2, "u", PAGE, None), (2, "u", PAGE, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out, names = h.extract(df)
    assert names == ["_text", "n_chars"] and out.count() == 5
    assert sorted(r.n_chars for r in h.main_texts(df).collect()) == [0, 0, *[len(h.main_text(PAGE))] * 2, 249999]
    assert h.main_texts(df.limit(0)).count() == 0
