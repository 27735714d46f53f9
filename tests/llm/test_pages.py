import random

from loomgraph.llm import pages

WEIGHTS = pages.fit(pages.labelled_pages())

PAGE = """<!DOCTYPE html><html><head><title>Skip me</title><style>p{margin:0}</style><script>var t="</p><p>no";</script></head><body>
<header><h1>Site name here</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- <p>gone</p> -->
<div class="ad">Buy ten now or never again at all, really do</div><div id="cookie-banner">We use cookies for many many reasons that are good</div>
<article><h1>The&nbsp;title</h1><p><b>First &amp; fore</b>most,<br>a  line
 break<p>Second &lt;p&gt; &#233;&#x1F642; para</p><aside>An aside in the middle of it</aside><ul><li>item one</li><li>item two</ul>
<form>Your name <input> please</form><p>Last one.</p></article>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this text very much, it was the best that I have read.</p></div></section>
<footer>&copy; somebody &middot; all sorts of words that go on and on</footer></body></html>"""


def test_a_page():
    want = ["The title", "First & foremost, a line break", "Second <p> é🙂 para", "item one", "item two", "Last one."]
    assert pages.main_text(PAGE, WEIGHTS).split("\n\n") == want
    cut = PAGE[: PAGE.index("para</p>") + 2]
    assert pages.main_text(cut, WEIGHTS).split("\n\n") == [*want[:2], "Second <p> é🙂 pa"]


def test_names():
    page = '<div class="post has-comments no-sidebar"><article class="no-comments"><div class="article-header"><h1>Title here</h1></div><p>One two three four.</p><div class="ad-slot">Buy</div><div role="alert">Careful</div></article></div><div id="respond">Write a reply to this text now</div>'
    assert pages.main_text(page, WEIGHTS).split("\n\n") == ["Title here", "One two three four."]


def test_names_around_and_inside_an_article():
    words = "One two three four five six seven eight nine ten eleven twelve."
    whole = f"<h1>Title here</h1><p>{words}</p>"
    want = ["Title here", words]
    menu = "<div class='site-footer'>About us and all</div>"
    for around in ('<div class="overflow-hidden">', '<div class="layout right-sidebar">', '<div id="page" class="header-fixed">', '<div class="content-side">', '<div class="sidebar">', '<div class="social">'):
        for inner in (f"<article>{whole}</article>", whole):
            assert pages.main_text(f"<body>{around}{inner}</div>{menu}</body>", WEIGHTS).split("\n\n") == want, (around, inner)
    part = '<section id="discussion"><p>All of this was argued at length.</p></section><div class="related-work"><p>Others did the same before us.</p></div><section id="search"><p>How we looked for it.</p></section>'
    end = ["All of this was argued at length.", "Others did the same before us.", "How we looked for it."]
    for left, right in (("<article>", "</article>"), ("<div>", "</div>")):
        assert pages.main_text(f"<body>{left}{whole}{part.replace('search', 'method')}{right}{menu}</body>", WEIGHTS).split("\n\n") == want + end
    assert pages.main_text(f"<body><article>{whole}{part}</article></body>", WEIGHTS).split("\n\n") == want + end
    replies = f"<div id='comments'><article><p>{words}</p></article></div>"
    assert pages.main_text(f"<body><article>{whole}<p>{words}</p></article>{replies}</body>", WEIGHTS).split("\n\n") == [*want, words]


def test_attributes_are_read_as_html_does():
    words = "One two three four five six seven eight."
    for tag in ("<p title=it's>", '<p title="a > b">', "<p title='the hidden valley'>", "<p data-x=\"class='ad'\">", '<p title="never closed>', "<p class=a/b x=''y>", "<p = =x>", "<p title=\"the class = ad thing\">"):
        page = f"<body><nav>Menu here</nav><article><h1>Title</h1>{tag}{words}</p><p>It's the next one.</p><p>Don't lose this one either.</p></article></body>"
        assert pages.main_text(page, WEIGHTS).split("\n\n") == ["Title", words, "It's the next one.", "Don't lose this one either."], tag
    for around in ('<div class="page sidebar-left">', '<div class="layout-right-rail">'):
        page = f'<body>{around}<article><h1>Title</h1><p>{words}</p><div class="share-price">The price fell by a tenth.</div><div hidden>Not seen at all</div><div style="display : none">Nor this one here</div></article></div></body>'
        assert pages.main_text(page, WEIGHTS).split("\n\n") == ["Title", words, "The price fell by a tenth."], around


def test_whole_pages_made_from_known_blocks():
    """Pages of random blocks and furniture: the text must be exactly the article's blocks."""
    r = random.Random(11)
    words = lambda a, b: " ".join(r.choice(["river", "it's", "über", "漢字", "a&amp;b", "so,", "then"]) for _ in range(r.randrange(a, b)))
    shapes = ["<p>{}</p>", "<p class=lead>{}</p>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<p><b>{}</b></p>", "<div><p>{}</p></div>", "<ul><li>{}</li></ul>"]
    furniture = [lambda: f"<nav><ul><li><a href=x>{words(1, 4)}</a></li></ul></nav>", lambda: f"<aside><p>{words(3, 20)}</p></aside>", lambda: f"<footer>{words(3, 20)}</footer>", lambda: f"<div class='cookie-banner'>{words(3, 20)}</div>", lambda: f"<script>var a = '<p>{words(2, 9)}</p>';</script>", lambda: f"<form><input>{words(2, 9)}</form>", lambda: f"<section id='comments'><p>{words(4, 30)}</p></section>"]
    for _ in range(150):
        blocks = [words(6, 40) for _ in range(r.randrange(2, 12))]
        inside = "".join(r.choice(shapes).format(b) + ("<div class=ad>Buy this now</div>" if r.random() < 0.1 else "") for b in blocks)
        around = [f() for f in r.choices(furniture, k=r.randrange(0, 6))]
        cut = r.randrange(len(around) + 1)
        page = "<html><head><title>x</title></head><body>" + "".join(around[:cut]) + f"<article><h1>A title</h1>{inside}</article>" + "".join(around[cut:]) + "</body></html>"
        assert pages.main_text(page, WEIGHTS).split("\n\n") == ["A title", *(b.replace("&amp;", "&") for b in blocks)], page


def test_region_is_the_best_of_all():
    r = random.Random(3)
    weights = {"word": 1.0, "link": 0.2, "skip": -1.0, "p": -0.5, "div": -2.0, "other": -0.7}
    for _ in range(300):
        found = [(r.choice(["word", "link", "skip", "p", "div", "x"]), r.randrange(1, 4), "") for _ in range(r.randrange(0, 14))]
        score = lambda a, b: sum(n * weights.get(f, weights["other"]) for f, n, _ in found[a:b])  # noqa: B023, E731
        best = max((score(a, b) for a in range(len(found) + 1) for b in range(a, len(found) + 1)), default=0)
        assert abs(score(*pages.region(found, weights)) - max(best, 0)) < 1e-9


def test_labelled_pages_not_learnt_from():
    right = total = 0
    for page in pages.labelled_pages(200, seed=99):
        start, stop = pages.region([(f, n, "") for f, n, _ in page], WEIGHTS)
        for i, (f, n, inside) in enumerate(page):
            if f.endswith(("word", "link")):
                total += n
                right += n * ((start <= i < stop) == inside)
    assert right / total > 0.97, right / total


def test_operator(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>only words"), (5, "x", "<nav>menu"), (6, "y", "<" * 50 + " a < b"), (7, "z", "<p>" + "long words " * 50_000)]
    got = pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as key")).collect()
    assert pages.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[2] == by[3] == by[5] == "" and by[None] == "only words" and by[1] == pages.main_text(PAGE, WEIGHTS) and len(by[7]) == 549_999
    assert by[6].endswith("a < b")
