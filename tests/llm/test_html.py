from __future__ import annotations

import html
import re

from kiln.llm.html_extract import extract, main_text


def article(page):
    """The article element of the generated pages, block by block."""
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(b for b in blocks if b)


def test_generated_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    rows = extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_page_without_an_article_element():
    page = ("<body><header>Site</header><div class='content'><h2>T &amp; U</h2><p>Some long text,\n here. More <b>of</b> it, yes.</p>"
            "<p>Hi.</p><ul><li>First, one.<li>Second one.</ul></div><div class='sidebar'><p>Other, news.</p></div>"
            "<div class=cookie-notice>We use, cookies. All of them, yes.</div><form>Name <input> Send</form>"
            "<section id=comments><p>Nice, post. Really, good.</p></section><div><a href=x>Older</a> <a href=y>Newer</a></div>")
    assert main_text(page) == "T & U\n\nSome long text, here. More of it, yes.\n\nHi.\n\nFirst, one.\n\nSecond one."


def test_links_inside_an_article():
    page = ("<main><h1>Head</h1><p>A sentence, with <a href=x>a link</a> in it. And more, of course.</p>"
            "<ul class=x><li><a href=a>Next story</a></li><li><a href=b>Last story</a></li></ul></main>")
    assert main_text(page) == "Head\n\nA sentence, with a link in it. And more, of course."


def test_odd_pages():
    assert main_text("") == "" and main_text("<nav>x</nav>") == "" and main_text("<script>var a='</p>';") == ""
    assert main_text("plain &lt;b&gt; text") == "plain <b> text"
    assert main_text("<p>a<p>b<div>c</p>d") == "a\n\nb\n\nc\n\nd"
    assert main_text("<article><p>x&nbsp;y<br>z<!-- no --></p><style>p{}</style></article") == "x y z"
    assert main_text("<p>" + "word, " * 200_000).startswith("word, word")
    main_text("<div>" * 2_000 + "deep, text." + "<b" * 100)


def test_awkward_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>One.</p>"), (2, "u", "<p>One.</p>")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in extract(df).collect())
    assert got == [("1", "", 0), ("2", "One.", 4), ("2", "One.", 4), ("None", "", 0)]
    assert extract(df.where("url = 'none'")).count() == 0


def test_content_is_never_a_single_block():
    long, short = "Many words, of a long story. " * 30, "Few words, here."
    assert main_text(f"<body><div><h1>T</h1><p>{long}</p><p>{short}</p></div>") == f"T\n\n{long.strip()}\n\n{short}"
    assert main_text(f"<body><div><h1>T</h1><div>{long}</div><p>{short}</p></div>") == f"T\n\n{long.strip()}\n\n{short}"
    # paragraphs of unlike size in two elements
    parts = [("Many words, of a long story. " * k).strip() for k in (20, 20, 20, 20, 14)]
    two = "".join(f"<p>{p}</p>" for p in parts[:4]) + "</div><div class=b>" + f"<p>{parts[4]}</p>"
    assert main_text(f"<body><div class=a>{two}</div>") == "\n\n".join(parts)
    # a list between paragraphs, a heading beside the element of the text
    assert main_text(f"<div><p>{short}</p><ul><li>{long}<li>{long}</ul><p>{short}</p></div>") == "\n\n".join(
        [short, long.strip(), long.strip(), short])
    assert main_text(f"<div><h1>T</h1><div class=x><p>{long}</p><p>{long}</p></div></div>") == "\n\n".join(
        ["T", long.strip(), long.strip()])


def test_names_do_not_outvote_the_content():
    story = ["Many words, of a long story. " * 20 + f"End {k}." for k in range(4)]
    body = "".join(f"<p>{p}</p>" for p in story)
    teaser = "A teaser, of some words. " * 9
    cards = "".join(f"<article class=card><a href=x>Next {k}</a><p>{teaser}</p></article>" for k in range(3))
    got = main_text(f"<body><div class=story><h1>T</h1>{body}</div><div class=cards>{cards}</div>")
    assert got.startswith("\n\n".join(["T", *story]))
    # teasers inside a named element stay with it, a page of equal articles is whole
    assert main_text(f"<body><p>Other.</p><main>{body}</main>") == "\n\n".join(story)
    equal = "".join(f"<article><h2>T</h2><p>{p}</p></article>" for p in story)
    assert main_text(f"<body>{equal}") == "\n\n".join(f"T\n\n{p}" for p in story)
    # one article with most of the text does not push out the others
    unlike = f"<article><p>{story[0]}</p><p>{story[1]}</p></article><article><p>{story[2]}</p></article>"
    assert main_text(f"<body>{unlike}") == "\n\n".join(story[:3])


def test_no_name_discards_the_text():
    story = ["Many words, of a long story. " * 20 + f"End {k}." for k in range(3)]
    body, want = "".join(f"<p>{p}</p>" for p in story), "\n\n".join(story)
    for wrapper in ("div id=page class='no-sidebar'", "div class=has-sidebar", "div class='content with-nav'", "div class=search-result",
                    "div class=sidebar", "form method=post action=x", "div role=dialog", "div style='display:none'"):
        assert main_text(f"<body><{wrapper}>{body}") == want, wrapper
    # a part that names no other matter stays, a footer and a sidebar in a form go
    assert main_text(f"<div class=a><p>{story[0]}</p></div><div class='search-result'><p>{story[1]}</p></div>") == "\n\n".join(story[:2])
    assert main_text(f"<body><form>{body}<div class=sidebar><p>Other, news.</p></div><footer>Foot, note.</footer></form>") == want
    # nothing but other matter, none of it most of the text: the largest of it
    rest = f"<div class=sidebar><p>{story[0]}</p></div><footer>{'Foot, note. ' * 45}</footer><aside>{'Aside, too. ' * 40}</aside>"
    assert main_text(f"<body>{rest}") == story[0]
    assert main_text(f"<body><div class=sidebar><p>Other, news.</p></div>{body}<div class='share-widget'>Tell, others.</div>") == want


def test_head_ends_where_the_text_begins():
    for page in ("<head><meta x><body><p>A, b.</p>", "<html><head><title>T</title><p>A, b.</p>", "<head><link x><div>A, b.</div></head>",
                 "<head><script>x</script>A, b.", "<head><style>p{}</style></head><body>A, b.", "<head><noscript><img x></noscript><body>A, b."):
        assert main_text(page) == "A, b.", page
