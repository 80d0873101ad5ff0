import html as html_module
import re

from flowplan.llm.html_text import extract_pages, main_text
from flowplan.llm.queries import QUERIES, table

FOLDER = "/root/testdata/sf0.001"
LONG = "A long enough paragraph of plain text that talks about things and goes on for some time."


def test_article_page():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="ad">Buy</div>
    <div class="cookie-notice">We use cookies {LONG}</div>
    <article><h1>Head &amp; line</h1><p><b>{LONG}<br><p>short.</p><p>two\n  lines&nbsp;&eacute;</p>
    <aside>side {LONG}</aside><form><label>Mail</label><input></form></article>
    <section id="comments"><p>{LONG} says a reader</p></section><footer>&copy; x</footer></body></html>"""
    assert main_text(page) == f"Head & line\n{LONG}\nshort.\ntwo lines é"


def test_page_without_article():
    page = f"<body><div id=top><a href=1>one</a> <a href=2>two</a></div><div class=content><h2>Title</h2><p>{LONG}</p><p>No.</p><p>{LONG}</p></div><div class=sidebar>{LONG}</div><div><a href=3>x</a></div></body>"
    assert main_text(page) == f"Title\n{LONG}\nNo.\n{LONG}"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>only</nav>") == main_text("<script>x") == ""
    assert main_text("plain  words\n only") == "plain words only"
    assert main_text("<article><p>cut off") == "cut off"
    assert main_text(f"<article><p>{LONG}</p><nav><ul><li>m</article><footer>f") == LONG
    assert main_text("<p>1 &lt; 2 &#233; &bogus; <!-- c --></p>") == "1 < 2 é &bogus;"
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert len(main_text("<article>" + f"<p>{LONG}</p>" * 20000)) == 20000 * (len(LONG) + 1) - 1
    assert main_text("<div>x" * 30000).startswith("x\nx")  # linear in depth


def test_names_of_furniture_do_not_hide_content():
    article = f"<article><h1>Head</h1><p>{LONG}</p><p>No.</p><p>{LONG}</p></article>"
    text = f"Head\n{LONG}\nNo.\n{LONG}"
    for name in ("content has-sidebar", "no-sidebar", "page sidebar-right", "widget", "menu_open"):
        assert main_text(f"<body><nav>x</nav><div class='{name}'>{article}<div class=sidebar>{LONG}</div></div></body>") == text, name
        assert main_text(f"<div class='{name}'><p>{LONG}</p><p>No.</p><p>{LONG}</p></div>") == text.removeprefix("Head\n"), name
    for head in ("<div class=post-header><h1>Head</h1></div>", "<div id=entry-header><h1>Head</h1></div>", "<h1 class=header>Head</h1>"):
        assert main_text(f"<article>{head}<p>{LONG}</p><p>No.</p><p>{LONG}</p></article>") == text, head
    extra = f"<p>{LONG}</p><section id=related-work><h2>Related</h2><p>{LONG}</p></section><p>where <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p>"
    assert main_text(f"<main>{extra}<p>a <span class=share>b</span> c</p></main>") == f"{LONG}\nRelated\n{LONG}\nwhere x=1\na c"
    comments = f"<section id=comments><article><p>{LONG * 9}</p></article></section>"
    assert main_text(f"<main>{article}<div class=ad>Buy</div>{comments}</main>") == text
    assert main_text(f"{article}{comments}<div class=sidebar><article>{LONG * 9}</article></div>") == text


def test_region_holds_every_cluster():
    body = " ".join([LONG] * 6)
    assert main_text(f"<body><div><h1>Title</h1><p>lead</p></div><div>{body}</div></body>") == f"Title\nlead\n{body}"
    assert main_text(f"<body><div><h1><a href=x>Title</a></h1><p>lead</p></div><div>{body}</div></body>") == f"Title\nlead\n{body}"
    parts = [f"<section><p>{LONG}</p></section>", f"<section>{f'<p>{body}</p>' * 9}</section>", f"<section><p>{LONG}</p></section>"]
    assert main_text(f"<body><div id=top><a href=1>one</a> <a href=2>two</a></div><div>{''.join(parts)}</div></body>") == "\n".join([LONG, *[body] * 9, LONG])
    blocks = [f"<article><h2>{k}</h2><p>{LONG * (1 + 8 * (k == 1))}</p></article>" for k in range(4)]
    assert main_text(f"<body><nav>x</nav>{'<hr>'.join(blocks)}<footer>f</footer></body>") == "\n".join(f"{k}\n{LONG * (1 + 8 * (k == 1))}" for k in range(4))
    assert main_text(f"<h1>Title</h1><p>{LONG}</p><article><p>{body}</p></article>") == f"Title\n{LONG}\n{body}"
    items = "".join(f"<p><a href=x>{LONG}</a></p>" for _ in range(3))
    assert main_text(f"<body>{items}</body>") == "\n".join([LONG] * 3)


def test_query_against_the_pages_markup(spark):
    pages = table(spark, FOLDER, "pages")
    rows = {r.page_id: r for r in pages.collect()}
    found = QUERIES["op7_html_text"](spark, FOLDER).collect()
    assert len(found) == len(rows)
    for r in found:
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", rows[r.page_id].html, re.S)[1]
        blocks = (" ".join(html_module.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


def test_nulls_and_empty_table(spark):
    rows = [(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>")]
    made = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    assert sorted(map(str, (tuple(r) for r in extract_pages(made).collect()))) == ["(1, 'u', 'x', 1)", "(1, 'u', 'x', 1)", "(None, None, '', 0)"]
    assert extract_pages(made.limit(0)).count() == 0
