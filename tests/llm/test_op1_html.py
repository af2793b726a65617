from finmart.llm.html_extract import extract_main_text, main_text

PROSE = "Prose that goes on for quite a while, with commas, and without a single link in it. "


def test_article_without_furniture():
    page = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style>
    <script>var a = "</p><p>no";</script></head><body class="menu-open"><header><h1>Site</h1></header>
    <nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><article><header><h1>Head &amp; line</h1></header><p>{PROSE * 4}</p>
    <p>Second&nbsp;<b>bold</b>\n   words.<br>After.</p><ul><li>One<li>Two</ul>
    <div class="ad">Buy!</div><form><p>Name</p></form><!-- <p>hidden</p> --></article></main>
    <aside><p>{PROSE}</p></aside><div id="comments"><p>{PROSE * 9}</p></div>
    <footer>&copy; all</footer></body></html>"""
    assert main_text(page).split("\n") == [
        "Head & line", (PROSE * 4).strip(), "Second bold words. After.", "One", "Two"]


def test_text_in_plain_containers_and_broken_html():
    menu = "<div><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></div>"
    assert main_text(f"{menu}<div><div><p>{PROSE * 3}<p>{PROSE * 2}</div></div>") == \
        f"{(PROSE * 3).strip()}\n{(PROSE * 2).strip()}"
    assert main_text(f"<body><p><b>{PROSE}<br><p>{PROSE}") == f"{PROSE.strip()}\n{PROSE.strip()}"
    assert main_text("just text &lt;3") == "just text <3"
    assert main_text("<p>unclosed <a href='x>y") in ("unclosed <a href='x>y", "unclosed y", "unclosed")
    assert main_text("<!-- never closed <p>x</p>") == ""
    assert main_text("<script>only script") == ""
    deep = "<div>" * 30_000 + PROSE + "</div>" * 30_000
    assert main_text(deep) == PROSE.strip()


def test_main_text_beside_the_largest_container():
    p = lambda n, c="x": f"<p>{(c * 9 + ' ') * (n // 10)}</p>"
    line = lambda n, c="x": ((c * 9 + " ") * (n // 10)).strip()
    ten = "<div>" + p(400) * 10 + "</div>"
    menu = "<div><a href=1>One of the links</a> <a href=2>Another of the links</a></div>"
    body = [line(400)] * 10
    assert main_text(f"<body><article><header><h1>T</h1></header>{ten}</article>").split("\n") == ["T"] + body
    assert main_text(f"<body>{menu}<article><h1>T</h1>{p(800, 'l')}{ten}<p>End.</p></article>{menu}").split("\n") == [
        "T", line(800, "l"), *body, "End."]
    assert main_text(f"<body>{menu}<div><h1>T</h1>{p(800, 'l')}{ten}</div>{menu}").split("\n") == [
        "T", line(800, "l"), *body]
    two = f"<section><h2>A</h2>{p(400) * 5}</section><p>Short.</p><section><h2>B</h2>{p(300, 'y') * 5}</section>"
    want = ["A", *[line(400)] * 5, "Short.", "B", *[line(300, "y")] * 5]
    assert main_text(f"<body>{menu}{two}{menu}").split("\n") == want
    assert main_text(f"<body>{menu}<main>{two}</main>{menu}{p(300, 'z')}").split("\n") == want
    assert main_text(f"<body>{menu}<article>{two}</article>{menu}<article>{p(200, 'z')}</article>").split("\n") == [
        *want, line(200, "z")]


def test_names_are_evidence_only():
    long, more = f"<p>{PROSE * 4}</p>" * 5, f"<p>{PROSE * 3}</p>" * 2
    want, other = [(PROSE * 4).strip()] * 5, [(PROSE * 3).strip()] * 2
    for name in ("content has-sidebar", "no-sidebar", "layout-with-menu", "comments-open", "sidebar", "menu"):
        assert main_text(f'<body><div class="{name}">{long}</div></body>').split("\n") == want, name
        assert main_text(f'<body><div id="x" class="{name}"><article>{long}</article></div>').split("\n") == want
        assert main_text(f"<body><article>{more}<div class='{name}'>{long}</div></article>").split("\n") == other + want
    paper = f'<section id="results">{long}</section><section id="discussion"><h2>Discussion</h2>{more}</section>'
    for page in (f"<body><article>{paper}</article>", f"<body>{paper}"):
        assert main_text(page).split("\n") == [*want, "Discussion", *other]
    for name in ("sidebar", "sidebar-left", "comments", "comments-area", "site-ad", "cookie-bar", "related"):
        assert main_text(f"<body><article>{long}</article><div class={name}>{more}</div>").split("\n") == want, name
        assert main_text(f"<body><div>{long}</div><div class={name}>{more}</div>").split("\n") == want, name


def test_reader_comments_adverts_and_notices_in_an_article_go():
    long, talk = f"<p>{PROSE * 4}</p>" * 5, f"<p>{PROSE * 5}</p>"
    want = "\n".join(["Head", *[(PROSE * 4).strip()] * 5])
    head, said = "<h1>Head</h1>", f"<div class=c><b class=author>Ann</b> <time>1 May</time>{talk}</div>"
    inside = [f'<section class="comments">{talk * 9}</section>', f'<div id="comments"><ul>{f"<li>{talk}</li>" * 9}</ul></div>',
              f'<article class="advert"><h1>Buy</h1>{talk * 2}</article>', f'<article class="promo">{talk}</article>',
              f'<p class="notice">{PROSE}</p>', f'<section class="related"><h2>Related</h2>{talk}</section>',
              f"<section><h2>Comments (9)</h2>{talk * 9}</section>", f"<h3>12 responses</h3>{talk * 3}",
              f"<div><h4>Leave a reply</h4>{talk}</div>", f"<section id=discussion>{said * 4}</section>",
              f"<section class=discussion><h2>Reader comments</h2>{talk * 4}</section>"]
    for extra in inside:
        assert main_text(f"<body><article>{head}{long}{extra}</article></body>") == want, extra
        assert main_text(f"<body><main>{head}{long}{extra}</main></body>") == want, extra
    one = f'<article class="comment">{talk}</article>'
    for around in ("<div class=comments>{}</div>", "<section class=comments><h2>Comments</h2>{}</section>",
                   "<section><h2>Comments</h2>{}</section>", "<div class=x>{}</div>", "{}"):
        page = f"<body><article>{head}{long}</article>{around.format(one * 7)}</body>"
        assert main_text(page) == want, around
    assert main_text(f"<body><article>{head}{long}<h3>Comments</h3>{talk}<h3>Sources</h3><p>{PROSE * 3}</p></article>") == \
        f"{want}\nSources\n{(PROSE * 3).strip()}"
    # what only looks like it stays
    assert main_text(f"<body><article>{head}<h2>Comments</h2>{long}</article>") == want.replace("Head", "Head\nComments")
    assert main_text(f"<body><div class=comments>{long}</div>") == want.removeprefix("Head\n")
    paper = f'<section id="related-work"><h2>Related work</h2>{long}</section>'
    assert "Related work" in main_text(f"<body><article>{head}{long}{paper}</article>")
    assert main_text(f'<body><article class="post has-comments">{head}{long}</article>') == want


def test_malformed_pages_take_linear_time():
    import time
    for piece in ("<a ", "x <y ", "<!", "</", "<a '", '<a "b', "<p><b>", "<header>", "<!-- ", "<li><b>", "&amp;<", "<h2>Comments</h2>"):
        page = piece * (1_000_000 // len(piece))
        if piece in ("<p><b>", "<li><b>", "<header>", "<h2>Comments</h2>"):  # one node or more a piece
            page = page[:200_000]
        start = time.time()
        main_text(page)
        assert time.time() - start < 4, piece
    assert main_text("x <y z") == "x <y z" and main_text("<p>a <b") == "a <b"
    assert main_text("<p>1 < 2 > 0</p>") == "1 < 2 > 0"


def test_rows(llm):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>"), (None, None, None), (2, "v", ""),
            (2, "v", ""), (3, "w", "<p>a 😀</p>")]
    df = llm.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr(
        "*", "1 AS text", "2 AS n_chars")
    got = sorted(map(tuple, extract_main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", PROSE.strip(), len(PROSE.strip())), (None, None, "", 0), (2, "v", "", 0),
                          (2, "v", "", 0), (3, "w", "a 😀", 3)], key=str)
    assert extract_main_text(df.limit(0)).count() == 0


def test_every_page_gives_its_article(llm):
    import html
    import re
    pages = llm.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split())
                 for x in re.split(r"</?(?:h1|p)>", inner)]
        assert got[r.page_id] == "\n".join(filter(None, parts))
