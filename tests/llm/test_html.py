import random

from folioforge.llm import html


def test_articles():
    page = '<body><header><h1>Site</h1></header><nav>menu</nav><main><div class="cookie-notice">We use</div><h1>T &amp; x</h1><p>A&nbsp; b <i>c</i>d</p><ul><li>one</li><li>two</li></ul><aside>side</aside><form><p>f</p></form></main><section id="comments"><article class="comment"><p>I disagree</p></article></section><footer>f</footer>'
    assert html.main_text(page) == "T & x\n\nA b cd\n\none\n\ntwo"
    assert html.main_text("<article><p>a < b and <b>c") == "a < b and c"
    assert html.main_text("<article><p>x</p><script>var t='</p>'</script><p>y<!-- c --></p></article>") == "x\n\ny"
    assert html.main_text("<head><title>t</title></head><article><h1>H</h1><p><b>B.<br><p>P</p></article><footer>&copy; f") == "H\n\nB.\n\nP"
    assert html.main_text("") == "" and html.main_text("<p>short</p>") == "short"  # a page's only text is its main text


def test_surge_and_dive_without_an_article():
    page = "<div>" + "word " * 40 + "</div><div class='sidebar'><div>x</div>links</div><p>tail</p><footer>end</footer>"
    assert html.main_text(page) == ("word " * 40).strip()
    assert html.between([0, 0, 50, 60, 0, 0, 0, 9], 86) == [(1, 4)]


def test_wrappers_and_two_articles():
    body = "<p>" + "true text of the page " * 9 + "</p>"
    page = f"<div class='social widget'><h1>Head</h1>{body}<p>end</p></div><div class='ad'>buy</div><p>&copy; me</p>"
    assert html.main_text(page).startswith("Head\n\ntrue") and html.main_text(page).endswith("\n\nend")
    two = f"<nav>{body}</nav><article><p>a</p></article><p>{'between ' * 20}</p><article><p>b</p><div class=promo>p</div><p>c</p></article>"
    assert html.main_text(two) == "a\n\nb\n\nc"


def test_true_text_inside_articles_stays():
    for kind in ("class='social-history'", "id=notice-of-appeal", "class='chapter comment-law'", "role=note"):
        assert html.main_text(f"<article><p>One.</p><div {kind}><p>A chapter.</p></div></article>") == "One.\n\nA chapter."
    for kind in ("class='x cookie-notice'", "id=ad_box-2", "class=AD", "role=complementary"):
        assert html.main_text(f"<article><p>One.</p><div {kind}><p>Buy.</p></div><p>Two.</p></article>") == "One.\n\nTwo."
    assert html.main_text("<article><p>Text</p><aside>x</aside><ul><li><a>Ref one</a></li><li><a>Ref two</a></li></ul></article>") == "Text\n\nRef one\n\nRef two"
    long = "The text of the page. " * 20
    assert html.main_text(f"<main><p>Teaser</p></main><div><p>{long}</p></div>") == long.strip()
    assert html.main_text(f"<main><p>{long}</p></main><p>below</p>") == long.strip()
    assert html.main_text(f"<div>{long}</div><main><article>short</article></main>") == "short"


def windows_by_definition(lengths, limit, window):
    """Every start of a window over the limit surges, unless a stretch is open; it dives at the first window of nothing."""
    full = lambda i: sum(lengths[i : i + window])
    inside, stretches = None, []
    for i in range(len(lengths) + 1):
        if inside is not None and (i == len(lengths) or full(i) == 0):
            stretches.append((inside, i))
            inside = None
        elif inside is None and i < len(lengths) and full(i) > limit:
            inside = i
    return stretches


def test_windows_against_their_definition():
    rnd = random.Random(4)
    for _ in range(500):
        lengths = [rnd.choice((0, 0, 0, rnd.randint(1, 90))) for _ in range(rnd.randint(0, 30))]
        limit, window = rnd.choice((0, 20, 86)), rnd.randint(1, 4)
        assert html.between(lengths, limit, window) == windows_by_definition(lengths, limit, window)


def page_of(rnd, article):
    """A page and its main text: paragraphs of any length among link lists, marked containers, forms and scripts."""
    words = lambda n: " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 8))) for _ in range(n))
    links = lambda: "<ul>" + "".join(f'<li><a href="/{i}">{words(rnd.randint(1, 9))}</a></li>' for i in range(rnd.randint(1, 9))) + "</ul>"
    noise = [lambda: f"<nav>{links()}</nav>", lambda: f'<div class="x ad-box">{words(30)}<div>{words(9)}</div></div>', lambda: f"<aside><p>{words(20)}</p></aside>", lambda: f"<form><p>{words(15)}</p><button>{words(1)}</button></form>", lambda: f"<script>'<p>{words(40)}</p>'</script>", lambda: f'<section id="comments"><article class="comment"><p>{words(40)}</p></article></section>', lambda: f"<!-- <p>{words(50)}</p> -->"]
    some = lambda: "".join(rnd.choice(noise)() for _ in range(rnd.randint(0, 3)))
    paragraphs = [words(rnd.randint(1, 4)) for _ in range(rnd.randint(0, 3))] + [words(rnd.randint(40, 90)) for _ in range(rnd.randint(1, 5))] + [words(rnd.randint(1, 4)) for _ in range(rnd.randint(0, 3))]
    body = "".join(f"<p>{p.replace(' ', ' <b>', 1) + '</b>' if rnd.random() < 0.3 and ' ' in p else p}</p>" for p in paragraphs)
    if article:  # inside a marked article short text after a container counts too
        late = words(2)
        paragraphs.append(late)
        body = f"<article>{body}{some()}<p>{late}</p></article>"
    menu = f"<nav>{links()}</nav>" if rnd.random() < 0.5 else f"<div><div>{links()}</div></div><hr><div role=banner>{words(3)}</div>"
    return f"<html><head><title>{words(9)}</title></head><body><header>{words(5)}</header>{menu}{some()}{body}{some()}<footer>{words(30)}</footer></body></html>", "\n\n".join(paragraphs)


def test_random_pages_give_their_paragraphs():
    rnd, inert = random.Random(2), 0
    for i in range(300):
        page, want = page_of(rnd, i % 2)
        assert html.main_text(page) == want, page
        lines, by_tag = html.lines_of(page)
        inert += "\n\n".join(line.text for line in lines if line.text) == want
    assert inert == 0  # every page has something to leave out; filter and windows aren't told apart here


def test_link_lists_do_not_surge():
    links = "".join(f"<li><a href=/{i}>{'a long headline of a story ' * 3}</a></li>" for i in range(20))
    assert html.main_text(f"<ul>{links}</ul><aside>x</aside><p>{'text ' * 40}</p>") == ("text " * 40).strip()


def test_repeated_and_long_pages(spark):
    long = "<p>" + "</p><p>".join(f"paragraph {i} " + "w " * 30 for i in range(20_000)) + "</p>"
    pages = spark.createDataFrame([(1, long), (1, long), (2, "<" * 50_000), (3, "<div>" * 20_000 + "deep"), (4, None)], "page_id int, html string")
    got = {(r["page_id"], r["n"]) for r in html.extract(pages).selectExpr("page_id", "length(text) AS n").collect()}
    assert len(got) == 4 and (4, 0) in got and (3, 4) in got


def test_messy(messy, nothing):
    pages = messy.withColumnRenamed("text", "html")
    assert html.extract(pages).count() == messy.count() and html.extract(nothing.withColumnRenamed("text", "html")).count() == 0
    assert html.extract(pages).where("doc_id = 2 and text = ''").count() == 1
