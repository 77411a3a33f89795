from odd_rows import ODD
from panelkit.llm import html_extract as hx

PAGE = """<!DOCTYPE html><html><head><title>not this</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body class="home"><header class="site-header"><h2>Site name</h2><nav><a href="/">Home</a> <a href="/a">About</a></nav></header>
<div class="cookie-notice">We use cookies on all pages here.</div>
<div class="post-content"><h1>Big  title</h1><p>Some <a href=x>linked</a> wo<b>rd</b>s: a &lt; b &amp; c.<p>Second
 paragraph&nbsp;with more words in it.<div class="advertisement"><p>Buy this thing now</p></div>
<p>Third paragraph after the advert, long enough.</p><form><label>Mail</label><input type=text></form><ul><li>An item</li></ul></div>
<aside class="sidebar"><h3>Related</h3><ul><li><a>one thing</a><li><a>other</a></ul></aside>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I liked this very much, it was good.</p></article></section>
<footer>copyright, all rights</footer></body></html>"""
TEXT = ("Big title Some linked words: a < b & c. Second paragraph with more words in it. "
        "Third paragraph after the advert, long enough. An item")


def test_article_without_the_rest():
    assert hx.main_text(PAGE) == TEXT


def test_cut_off_pages():
    full = "<html><body><nav><a>m</a></nav><article><h1>Head</h1><p>First words here.</p><p>Last ones &amp; more</p></article><footer>f</footer>"
    assert hx.main_text(full) == "Head First words here. Last ones & more"
    assert hx.main_text(full[:full.index("</article>") + 5]) == "Head First words here. Last ones & more"
    assert hx.main_text(full[:full.index("&amp;") + 3]) == "Head First words here. Last ones &am"
    for n in range(len(PAGE)):
        hx.main_text(PAGE[:n])


def test_odd_markup():
    assert hx.main_text(None) == hx.main_text("") == hx.main_text("<p></p>") == ""
    assert hx.main_text("just words, no markup") == "just words, no markup"
    assert hx.main_text("<p>a<!-- <p>hidden</p> -->b</p>") == "ab"
    assert hx.main_text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert hx.main_text("<div><p title='a>b'>kept</p></div><script>never closed") == "kept"
    assert hx.main_text("<article><p>" + "word " * 50_000 + "</p></article>").count("word") == 50_000


def test_names_that_only_look_like_other_purposes():
    words = "These are the words of the article itself."
    for outer in ("<body class='responsive has-sidebar'><article>%s</article>", "<div class='responsive'><article>%s</article></div>",
                  "<article class='post tag-politics'>%s</article>", "<article class='post-7 post category-comment tag-2024 comments-open'>%s</article>",
                  "<div class='post tag-search'>%s</div>", "<article class='research'>%s</article>", "<div class='research'>%s</div>",
                  "<div class='entry-content has-sidebar'>%s</div>", "<div class='layout-with-sidebar'>%s</div>",
                  "<div class='article-header'>%s</div>", "<header class='entry-header'>%s</header>", "<main class='page-header meta'>%s</main>",
                  "<div class='table-responsive'>%s</div>", "<div class='commentary'>%s</div>"):
        assert hx.main_text(outer % f"<p>{words}</p>") == words, outer


def test_names_of_other_purposes():
    for name in ("advertisement", "adbox ad", "site-header", "pagefooter", "sidebarRight", "rightsidebar", "commentlist", "comment-list", "commentList",
                 "responses", "subscription-box", "newsletterSignup", "sponsored", "promotions", "cookiebar", "pop-up", "related-posts",
                 "tag-cloud", "search", "site-search", "breadcrumbs", "post-comments"):
        page = f"<body><article><p>Words of the article.</p></article><div class='{name}'><p>Not of it at all.</p></div></body>"
        assert hx.main_text(page) == "Words of the article.", name
    assert hx.main_text("<article class='comment'><p>Not an article.</p></article>") == ""


def test_article_on_both_sides_of_a_long_block():
    first, other, last = "one " * 100, "not this " * 250, "two " * 80
    text = (first + last).strip()
    for outer in ("<body><article>%s</article></body>", "<body><main><section>%s</section></main></body>", "<body><div class='entry-content'>%s</div></body>",
                  "<body><div>%s</div></body>", "<body>%s</body>"):
        for block in ("<aside>%s</aside>", "<div class='advert'><p>%s</p></div>", "<form><p>%s</p></form>", "<div class='related'><ul><li><a>%s</a></li></ul></div>"):
            page = outer % (f"<p>{first}</p>" + block % other + f"<p>{last}</p>")
            assert hx.main_text(page) == text, (outer, block)
            assert hx.main_text(page.replace(f"<p>{last}</p>", f"<ul><li>{last}</li></ul>")) == text, (outer, block)
    nested = f"<article><div class='entry-content'><p>{first}</p></div><aside>{other}</aside><div><p>{last}</p></div></article>"
    assert hx.main_text(nested) == text
    for tags in ("<br>" * 400, "<p><img src=x></p>" * 400, "<table><tr>" + "<td></td>" * 400 + "</tr></table>"):
        assert hx.main_text(f"<article><p>{first}</p>{tags}<p>The three last.</p></article>") == first + "The three last."


def test_long_block_outside_the_article():
    page = f"<body><p>Welcome here</p><nav>{'menu ' * 300}</nav><article><p>{'one ' * 100}</p></article><aside>{'not ' * 300}</aside><p>Go up</p></body>"
    assert hx.main_text(page) == ("one " * 100).strip()


def test_math():
    page = "<p>So <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x = 2</annotation></semantics></math> holds.</p>"
    assert hx.main_text(page) == "So x=2 holds."


PROSE = "<h1>A heading here</h1><p>The first paragraph has more than ten words, and it ends with a stop.</p><p>So does the second one: it goes on for a while, then it stops.</p>"
PROSE_TEXT = ("A heading here The first paragraph has more than ten words, and it ends with a stop. "
              "So does the second one: it goes on for a while, then it stops.")


def test_hidden_elements_left_open_hide_nothing_after_them():
    for name in ("button", "select", "object", "canvas", "audio", "video", "template", "svg", "noscript"):
        shut = f"<article>{PROSE}<div><{name}>not this</{name}></div><p>The last words.</p></article><footer>f</footer>"
        assert hx.main_text(shut) == PROSE_TEXT + " The last words.", name
        left = f"<article>{PROSE}<div><{name} x=y></div><p>The last words.</p></article><footer>f</footer>"
        assert hx.main_text(left) == PROSE_TEXT + " The last words.", name
        both = f"<article><div><{name}></div>{PROSE}<p>The last words.</p><{name}>not this</{name}></article><footer>f</footer>"
        assert hx.main_text(both) == PROSE_TEXT + " The last words.", name
    assert hx.main_text(f"<article>{PROSE}<video><source src=x><p>Your browser is old.</p></video><p>The last words.</p></article>") == PROSE_TEXT + " The last words."


def test_a_slash_closes_no_script():
    assert hx.main_text("<script src=x/>code()</script><article><p>Words of it.</p></article>") == "Words of it."
    assert hx.main_text("<article><p>Words <svg/>of it.</p><style/>p{}</style></article>") == "Words of it."


def test_names_around_most_of_the_prose_say_nothing():
    for outer in ('<body><form id="aspnetForm" method=post><input type=hidden>%s</form></body>', '<article><div class="elementor-widget">%s</div></article>',
                  '<div class="elementor-widget-container">%s</div>', '<div class="form-guide">%s</div>', '<div class="story legal">%s</div>',
                  '<div class="sidebar-layout"><div class="widget">%s</div></div>'):
        assert hx.main_text(outer % PROSE) == PROSE_TEXT, outer
        page = outer % (PROSE + "<nav><a>Home</a> <a>About</a></nav><div class='advert'><p>Buy it now.</p></div>")
        assert hx.main_text(page) == PROSE_TEXT, outer
    parts = "".join(f"<div class='elementor-widget'>{x}</div>" for x in PROSE.replace("><p", ">|<p").split("|"))
    assert hx.main_text(f"<body>{parts}<div class='elementor-widget'><ul><li><a>Shop</a></li></ul></div></body>") == PROSE_TEXT


def test_firm_names_hold_whatever_they_surround():
    for outer in ("<nav>%s</nav>", "<div class='ad'>%s</div>", "<div class='promo'>%s</div>", "<footer>%s</footer>", "<aside>%s</aside>", "<div class='cookie-consent'>%s</div>", "<section id='comments'>%s</section>"):
        assert hx.main_text(f"<body><article><p>Short text.</p></article>{outer % PROSE}</body>") == "Short text.", outer
    assert hx.main_text(f"<body><article>{PROSE}</article><form><p>Only a few words in this form, they ask for your address.</p></form></body>") == PROSE_TEXT


def test_lines_that_say_what_they_are():
    for line in ("All rights reserved 2024", "© 2024 Example", "3 replies", "12 comments on this post", "Advertisement", "Leave a reply", "Share this"):
        assert hx.main_text(f"<body><div>{PROSE}</div><div>{line}</div></body>") == PROSE_TEXT, line
    assert hx.main_text(f"<article>{PROSE}<p>All rights reserved.</p></article>") == PROSE_TEXT + " All rights reserved."
    for line in ("Copyright is a right.", "There were 3 replies to the letter, and more came in later.", "They share this with others."):
        assert hx.main_text(f"<body><div>{PROSE}<p>{line}</p></div></body>") == f"{PROSE_TEXT} {line}", line


def test_a_megabyte_is_read_in_linear_time():
    import time

    def seconds(page):
        begin = time.perf_counter()
        hx.main_text(page)
        return time.perf_counter() - begin

    for piece in ("<div><p>w</section>", "<button><p>w", "<object><div>w", "<script>w", "<select><option>w</div>", "</article><video>w", "<a><b>w<!-- "):
        small, large = piece * (100_000 // len(piece)), piece * (1_000_000 // len(piece))
        # quadratic work would take a hundred times as long
        assert seconds(large) < 30 * max(seconds(small), 0.02), piece


def labelled(seed):
    """A page of blocks (text, whether it is content) in one of several site layouts."""
    import random

    rng = random.Random(seed)
    sentence = lambda n: " ".join(rng.choice("the of and city river old new people found water house year they there with".split()) for _ in range(n))
    label = lambda: sentence(rng.randrange(1, 4)).title()
    content, parts = [], []

    def add(markup, text, kept):
        if kept:
            content.append(text)
        return markup.format(text)

    def links(n):
        return "".join(f"<li><a href=/{i}>{label()}</a></li>" for i in range(n))

    body = add("<h1>{}</h1>", label(), True)
    for i in range(rng.randrange(3, 9)):
        kind = rng.random()
        if kind < 0.7:
            body += add("<p>{}</p>", ". ".join(sentence(rng.randrange(6, 25)).capitalize() for _ in range(rng.randrange(1, 5))) + ".", True)
        elif kind < 0.8:
            body += add("<h2>{}</h2>", label(), True)
        elif kind < 0.9:
            body += "<ul>" + "".join(add("<li>{}</li>", sentence(rng.randrange(3, 12)), True) for _ in range(3)) + "</ul>"
        else:
            body += rng.choice([f"<div class='ad-slot'><p>{sentence(6)}</p></div>", f"<aside><h3>{label()}</h3><ul>{links(3)}</ul></aside>",
                                f"<button>{label()}", f"<div class='share-bar'><a>{label()}</a></div>", f"<script>x='{sentence(4)}'</script>"])
    wrap = rng.choice(["<article>%s</article>", "<main><div class='entry-content'>%s</div></main>", "<div id='content'>%s</div>", "<div class='x1'>%s</div>",
                       "<form id='aspnetForm'><div>%s</div></form>", "<div class='elementor-widget-container'>%s</div>", "<td>%s</td>"])
    head = rng.choice([f"<nav><ul>{links(6)}</ul></nav>", f"<div class='top-menu'><ul>{links(5)}</ul></div>", f"<header><a>{label()}</a><ul>{links(4)}</ul></header>", ""])
    tail = rng.choice([f"<footer>&copy; {label()}. {sentence(6)}.</footer>", f"<div class='site-footer'><ul>{links(4)}</ul></div>", "<div>All rights reserved 2024</div>",
                       f"<section id='comments'><h2>2 replies</h2><article class='comment'><p>{sentence(15)}.</p></article></section>"])
    parts = [head, wrap % body, tail]
    return "<html><head><title>t</title></head><body>" + "".join(parts) + "</body></html>", " ".join(" ".join(c.split()) for c in content)


def test_held_out_layouts():
    hit = given = wanted = whole = 0
    for seed in range(400):
        page, want = labelled(seed)
        got = hx.main_text(page)
        a, b = got.split(), want.split()
        from collections import Counter
        hit += sum((Counter(a) & Counter(b)).values())
        given, wanted, whole = given + len(a), wanted + len(b), whole + (got == want)
    f1 = 2 * hit / (given + wanted)
    print(f"word F1 {f1:.4f}, whole pages {whole / 400:.3f}")
    assert f1 > 0.97 and whole / 400 > 0.8


def test_best_region():
    assert hx.best_region([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert hx.best_region([-1, -2]) == (0, 0) == hx.best_region([])
    assert hx.best_region([1, -3, 1]) == (0, 1)


def test_weights_come_from_the_labelled_pages():
    w = hx.learn_weights()
    assert w.base > 0 > w.tag and w.linked < 0
    assert all(w.purpose[p] < 0 for p in ("nav", "ad", "comment", "footer")) and w.purpose["article"] > 0


def test_query_rows(spark):
    rows = [(1, "u", PAGE), (None, None, None), (2, "u", ""), (2, "u", "")] + [(10 + n, "u", t) for n, (_, t) in enumerate(ODD)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = {}
    for r in hx.extract_pages(pages).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    assert got[1] == [(TEXT, len(TEXT))] and got[None] == [("", 0)] and got[2] == [("", 0)] * 2
    assert sum(map(len, got.values())) == len(rows)
    assert hx.extract_pages(pages.limit(0)).count() == 0
