"""HTML extraction: exact texts of hand-written pages, and the host vote."""

import random
import time
import tracemalloc

from rollwise.llm import html
from rollwise.llm.html import Page


def text(page):
    return Page(page).extract(None)


def test_article_without_boilerplate():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body class="page">
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav><div id="cookie-notice"><p>We use cookies</p></div>
    <article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>&nbsp;three<br>four
    <p>Five &lt;six&gt;<div class="ad-slot">Buy</div><ul><li>a<li>b</ul><pre>x   y</pre><aside>Side</aside>
    <div class="share-buttons"><a>Share</a></div><form><input>Mail</form></article>
    <section class="comments"><p>First! a very long comment that goes on and on and on and on and on and on and on and on and on</p></section>
    <footer>&copy; me</footer></body></html>"""
    assert text(page) == "Title & more\n\nOne two three four\n\nFive <six>\n\na\n\nb\n\nx y"


def test_broken_and_empty_pages():
    assert text("") == "" and text("<html><body></body></html>") == ""
    assert text("just text &amp; 1 < 2") == "just text & 1 < 2"  # no markup: the text itself
    assert text("<body>plain body text, long enough</body>") == "plain body text, long enough"
    assert text("<div><p>cut off &am") == "cut off &am"
    assert text("<div><p>cut off<p clas") == "cut off"
    assert text("<div><p>a<!-- x <p>no</p> --> b</p><!-- open") == "a b"
    assert text("<div><p>unclosed <b>bold<br><p>next</div>") == "unclosed bold\n\nnext"
    assert text("<div><p>" + "long " * 50_000 + "</p></div>") == ("long " * 50_000).strip()


def test_host_vote_corrects_a_page(spark):
    good = "<html><body><div class='story7'><p>{}</p></div><div class='extra'><p>{}</p></div></body></html>"
    rows = [(i, "http://A.com/x", good.format("main text " * 20, "short"), "q") for i in range(5)]
    rows.append((9, "https://a.com/y?z", good.format("main", "longer than the story " * 9), "q"))  # alone it would pick the extra
    rows += [(10, "http://b.com", "<main><p>b</p></main>", None), (11, None, None, None), (12, "http://a.com/z", "<article><p>no such path</p></article>", "q")]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "page_id long, url string, html string, win string")
    out = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(df).collect()}
    assert html.extract(df).count() == len(rows)
    assert out[9] == ("main", 4) and out[10] == ("b", 1) and out[11] == ("", 0) and out[12][0] == "no such path"
    assert out[0][0] == ("main text " * 20).strip()
    assert html.extract(df.limit(0)).count() == 0


def test_names_that_hold_the_article_do_not_lose_it():
    story = "<p>" + "story text " * 30 + "</p>"
    want = ("story text " * 30).strip()
    for around in ("div class='content has-sidebar'", "div class='no-sidebar'", "div class='layout-header-fixed'", "div id='login-guide'", "form id='aspnetForm'"):
        for inner in (story, f"<article>{story}</article>"):
            page = f"<html><body><{around}><nav><a>Home</a></nav>{inner}</{around.split()[0]}><div class='sidebar'><p>side</p></div></body></html>"
            assert text(page) == want, page
    nested = f"<form id='aspnetForm'><div class='page has-sidebar'>{story}<div class='ad-slot'>Buy</div></div><section class='comments'><p>{'long ' * 200}</p></section></form>"
    assert text(nested) == want
    assert text(f"<div hidden>{story}</div><div><p>seen</p></div>") == "seen"


def test_candidate_gathers_text_rich_siblings():
    page = "<body><div class='wrap'><div class='part-one'><p>{}</p></div><div class='part-two'><p>{}</p></div><div class='x'><p>tiny</p></div></div><div class='y'>z</div></body>"
    got = text(page.format("a " * 350, "b " * 150))
    assert got.split("\n\n")[:2] == [("a " * 350).strip(), ("b " * 150).strip()] and "z" not in got


STORY = "<p>" + "This is the article's text, a sentence or two. " * 4 + "</p>"
REPLY = "<p>a reader's comment here, long enough to count</p>"


def test_reader_comments_never_come_back():
    for page in (
        f"<article>{STORY}<div class='comments-list'>{REPLY * 60}</div></article>",
        f"<div class='content'>{STORY}</div><ol class='commentlist'><li>{REPLY * 40}</li></ol>",
        f"<div><div class='content'>{STORY}</div><div id='responses'>{REPLY * 40}</div></div>",
        f"<main>{STORY}</main><section id='post-comments'><article class='comment'>{REPLY * 30}</article></section>",
    ):
        assert "comment" not in text(page) and "article's text" in text(page)
    for around in ("div class='has-comments content'", "div class='comments-open'", "section class='commentary'"):
        assert "article's text" in text(f"<{around}>{STORY}</{around.split()[0]}>")


def test_ambiguous_names_inside_an_article():
    part = "<div class='{}'><p>Then search engines index the pages, one sentence after the other.</p></div>"
    page = "<article>" + STORY + "{}" + STORY + "</article>"
    assert "Then search" in text(page.format(part.format("search-engines"))) and "Then search" in text(page.format(part.format("notice-board")))
    assert "Then search" not in text(page.format(part.format("ad-slot"))) and "Then search" not in text(page.format(part.format("related-posts")))
    links = "<div class='menu-items'>" + "<a href='x'>a link to some other page</a> " * 9 + "</div>"
    assert "a link" not in text(page.format(links))


def test_deep_nesting_is_linear():
    for deep in ("<div>" * 50_000 + STORY, "<div class='x1'>" * 50_000 + STORY, "<span>" * 50_000 + STORY * 50, "<div><p>x" * 25_000, "<article><div class='menu'>" * 20_000 + STORY):
        began = time.process_time()
        assert text(deep)
        assert time.process_time() - began < 4
    tracemalloc.start()
    Page("<div class='some-name'>" * 50_000 + STORY)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_generated_pages_match_their_own_blocks(spark):
    """Pages put together from known article blocks and boilerplate: the blocks, and nothing else, come back."""
    r = random.Random(3)
    words = lambda n: " ".join("".join(r.choices("abcdefghijklmno", k=r.randint(2, 9))) for _ in range(n))
    junk = [
        "<nav><ul><li><a href='/'>nav{0}</a></ul></nav>", "<div class='sidebar'><p>side{0}</p></div>", "<aside>aside{0}</aside>", "<footer>foot{0}</footer>",
        "<div id='cookie-notice'>cookie{0}</div>", "<div class='ad'>ad{0}</div>", "<form><input>form{0}</form>", "<script>var x = '<p>script{0}</p>';</script>",
        "<style>p{{}} /* style{0} */</style>", "<div class='comments'><p>comment{0} " + "long " * 30 + "</p></div>", "<!-- hidden{0} -->", "<div hidden>hid{0}</div>",
    ]
    rows, want = [], {}
    for i in range(120):
        blocks = [words(r.randint(8, 40)) for _ in range(r.randint(2, 8))]
        shape = r.choice(["<p>{}</p>", "<p>{}", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<ul><li>{}</ul>", "<p><b>{}</b></p>", "<pre>\n{}\n</pre>"])
        inside = [shape.format(b.replace(" ", r.choice([" ", "\n ", "&nbsp;", "&#32;"]), 3)) for b in blocks]
        for _ in range(r.randint(0, 3)):
            inside.insert(r.randint(0, len(inside)), r.choice(junk[:1] + junk[2:3] + junk[5:9] + junk[10:]).format(i))
        around = [r.choice(junk).format(i) for _ in range(r.randint(0, 6))]
        cut = r.randint(0, len(around))
        tag = r.choice(["article", "main", "div class='post12'"])
        rows.append((i, f"http://h{i % 5}.com/{i}", f"<html><body>{''.join(around[:cut])}<{tag}>{''.join(inside)}</{tag.split()[0]}>{''.join(around[cut:])}</body></html>"))
        want[i] = "\n\n".join(blocks)
    assert {i: text(page) for i, _, page in rows} == want
    assert {x["page_id"]: x["text"] for x in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == want
