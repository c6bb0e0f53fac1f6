import html
import re
import time

import pytest

from cadenza.llm.html_extract import extract, main_text

PROSE = "The house of the river is in the valley and it was there for as long as any of the people can say."


def brute(page):
    """For the sample pages' one layout: what stands in article, cut at its paragraphs."""
    inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", inside))
    return "\n".join(b for b in blocks if b)


def test_sample_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: brute(r.html) for r in pages.collect()}
    rows = extract(pages).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("page, text", [
    (f"<body><header>Site of the day</header><nav><a href=x>Home</a></nav><main><h1>Title</h1><p>{PROSE}<p>Short.</main><footer>the end</footer>", f"Title\n{PROSE}\nShort."),
    (f"<div class='cookie-notice'>{PROSE}</div><div class=content><h2>Head</h2><p>{PROSE}</p><ul><li>One</li><li>Two</li></ul></div><div id=comments><p>{PROSE}</p></div>", f"Head\n{PROSE}\nOne\nTwo"),
    (f"<p>{PROSE}</p><p><a href=1>the of and</a> <a href=2>more of the same in all of it</a></p><p>{PROSE}</p>", f"{PROSE}\n{PROSE}"),
    (f"<article><p>{PROSE}</p><aside>{PROSE}</aside><form><label>Name of</label><input></form><p>Fin</p><section class='reader-comments'>{PROSE}</section></article>", f"{PROSE}\nFin"),
    ("<article><p>Only short.</p></article><div>Other short.</div>", "Only short."),
    (f"<p>{PROSE} a &lt; b &amp; c &#233;&nbsp;d<br>e\n\n f</p>", f"{PROSE} a < b & c é d e f"),
    (f"<script>var a='<p>{PROSE}</p>'</script><style>p>a{{}}</style><!-- <p>{PROSE}</p> --><p title='a > b'>{PROSE}</p>", PROSE),
    (f"<article><p>{PROSE}</p><p>cut <b", f"{PROSE}\ncut"),
    (f"<p hidden>{PROSE}</p><div style='display: none'>{PROSE}</div><p>{PROSE} 5 < 6 and 7>6</p>", f"{PROSE} 5 < 6 and 7>6"),
    ("", ""), ("<nav>the menu of the site</nav>", ""),
])
def test_rules(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    *((f"<body>menu<article {a}><p>{PROSE}</p></article>", PROSE) for a in ('title="The hidden valley"', "onclick=\"toggle('hidden')\"", 'data-id="comments"', 'data-hidden="x"', "data-href=/x/")),
    *((f"<body><p {a}>{PROSE}</p>", PROSE) for a in ('data-hidden="false"', 'data-id="comments"', 'title="class=sidebar"')),
    (f"<p>out of it</p><article data-href=/x/><p>{PROSE}</p></article><div>{PROSE}</div>", PROSE),
    (f"<article><p>{PROSE}</p><figure><img src=x><figcaption>The river.</figcaption></figure><p>{PROSE}</p></article>", f"{PROSE}\nThe river.\n{PROSE}"),
    (f"<main><p>{PROSE}</p></main><article><h3><a href=x>Other</a></h3><p>{PROSE}</p></article>", PROSE),
    (f"<article><p>{PROSE}</p><p><a href=x>The report of the year</a>.</p><p>{PROSE}</p></article>", f"{PROSE}\nThe report of the year.\n{PROSE}"),
    (f"<article><p>{PROSE}</p><ul><li><a href=x>More of it</a></li></ul></article><nav><a href=x>Home</a></nav>", PROSE),
    (f"<article><p>{PROSE} AT&<i>copy</i> and &am<b>p;</b> &amp;amp;</p></article>", f"{PROSE} AT&copy and &amp; &amp;"),
    (f"<article><svg/><img/><p/>{PROSE}</article>", PROSE),
    (f"<div hidden=''>{PROSE}</div><div aria-hidden=TRUE>{PROSE}</div><p>{PROSE}</p>", PROSE),
])
def test_attributes_cards_links_and_references(page, text):
    assert main_text(page) == text


def seconds(page):
    start = time.process_time()
    main_text(page)
    return time.process_time() - start


def test_hostile_pages_end():
    for page in ("<div " * 50_000, "<a href='" * 20_000, "<!--" * 50_000, "<p>" * 50_000 + PROSE, "<" * 100_000, "<script>" * 10_000):
        main_text(page)


@pytest.mark.parametrize("unit, end", [("<div>x</b></q></section>", ""), ("<div class=menu>", PROSE), (f"<div class=menu><p>{PROSE}</p>", ""), ("<article>", PROSE), ("<li class=nav>x", "")])
def test_time_grows_with_the_page(unit, end):
    seconds(unit * 200 + end)
    assert seconds(unit * 16_000 + end) < 10 * max(0.1, seconds(unit * 4_000 + end))
    assert seconds(unit * 16_000 + end) < 8


def test_edge_rows_and_empty_table(spark):
    ddl = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "X", "Y"), (None, "u", "", "X", "Y"), (2, "u", f"<p>{PROSE}</p>" * 3000, "X", "Y"), (2, "u", f"<p>{PROSE}</p>", "X", "Y")]
    got = extract(spark.createDataFrame(rows, ddl)).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 0), ("2", len(PROSE)), ("2", 3000 * (len(PROSE) + 1) - 1), ("None", 0)]
    assert extract(spark.createDataFrame([], ddl)).count() == 0


RUSSIAN = "Река течёт через старую долину, и люди живут здесь очень давно. Каждое утро рыбаки выходят на берег. Потом они идут домой."
CHINESE = "这条河流经过古老的山谷，人们在这里生活了很久。每天早晨渔夫来到岸边。"
ITALIAN = "Ogni mattina i pescatori scendono verso il fiume vecchio, poi tornano a casa quando fa buio. Nessuno ricorda quando arrivarono."


@pytest.mark.parametrize("page, text", [
    (f"<div class='layout has-sidebar'><div class=sidebar>Links of today</div><article><h1>Head</h1><p>{PROSE}</p></article></div>", f"Head\n{PROSE}"),
    (f"<div id=page class='site social-page'><div class=content><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p></div><div class=newsletter>{PROSE}</div></div>", f"Head\n{PROSE}\n{PROSE}"),
    (f"<div class='post comments-open'><h1>Head</h1><p>{PROSE}</p></div><div class=comments><p>{PROSE}</p><p>{PROSE}</p></div>", f"Head\n{PROSE}"),
    (f"<div class='post comments-open'><p>{PROSE}</p><div class=comments><p>{PROSE}</p></div></div>", PROSE),
    (f"<div class='layout has-sidebar'><div><p>{PROSE}</p><p>{PROSE}</p></div><div class=sidebar>{PROSE}</div></div>", f"{PROSE}\n{PROSE}"),
    (f"<div>{''.join(f'<div class=text-widget><p>{PROSE}</p></div>' for _ in range(3))}<div class=cookies>{PROSE}</div></div>", f"{PROSE}\n{PROSE}\n{PROSE}"),
    ("<div class='page no-banner'><article><p>Only short.</p></article></div>", "Only short."),
    *((f"<nav><a href=x>Home</a></nav><div><h2>A</h2><p>{t}</p><p>{t}</p></div><footer>2020</footer>", f"A\n{t}\n{t}") for t in (RUSSIAN, CHINESE, ITALIAN)),
])
def test_wrappers_and_other_languages_keep_their_articles(page, text):
    assert main_text(page) == text
