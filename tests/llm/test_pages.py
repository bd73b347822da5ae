import html
import random
import re

import pytest

from tallyweave.llm import wrappers

FOLDER = "/root/testdata/sf0.01"


def article(page):
    """Text of the article element of a page in the driver's template."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not inner:
        return ""
    plain = re.sub(r"</?(?:p|h1|br|ul|li|div)\b[^>]*>", " ", inner.group(1))
    return " ".join(html.unescape(re.sub(r"</?(?:b|i|a)\b[^>]*>", "", plain)).split())


def test_driver_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = wrappers.main_text(pages).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


WORDS = "stone river light bread winter garden letter window morning silver".split()


def site(seed, count, layout):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n)) + "."
    for _ in range(count):
        paragraphs = [say(rng.randint(20, 60)) for _ in range(rng.randint(1, 6))]
        yield layout(say(5), paragraphs, rng, say), paragraphs


def plain_divs(title, paragraphs, rng, say):
    """No article element: the wrapper has to find the changing container."""
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    extra = "<div class=ad>Buy now</div>" if rng.random() < 0.5 else ""
    return (
        f"<html><head><title>{title}</title></head><body><div class='topbar'>Site name</div><div class='c1'><ul><li>Home<li>News</ul></div>"
        f"<div class='c2'>{extra}{body}<div class='share'>Share this</div></div><div class='c3'><p>Latest: {say(4)}</p></div>"
        f"<form><input name=q><button>Search</button></form><div class='comments'><p>{say(30)}</p></div><div class='footer'>Rights</div></body></html>"
    )


def semantic(title, paragraphs, rng, say):
    body = "".join(f"<p>{p}" for p in paragraphs)
    notice = '<div class="cookie-notice">We use cookies</div>' if rng.random() < 0.5 else ""
    return (
        f"<!DOCTYPE html><body>{notice}<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><main><article>{body}"
        f"<aside>{say(20)}</aside><section id='comments'><p>{say(40)}</p></section></article></main><footer>end</footer>"
    )


@pytest.mark.parametrize("layout", [plain_divs, semantic])
def test_other_layouts(spark, layout):
    made = list(site(7, 12, layout))
    rows = [(i, f"https://www.site.example/{i}", page) for i, (page, _) in enumerate(made)]
    got = {r.page_id: r.text for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, (_, paragraphs) in enumerate(made):
        assert got[i] == " ".join(paragraphs)


def test_names_that_only_describe_the_page():
    page = (
        '<body class="has-sidebar"><main class="content with-sidebar"><article class="post share-on"><header><h1>Title</h1></header><p>One.</p></article>'
        '<article class="comment"><p>Reader</p></article><div class="no-comments"></div></main><div class="sidebar">x</div></body>'
    )
    assert wrappers.extract(page, None) == "Title One."
    two = "<body><article><p>First.</p></article><article><p>Second.</p></article><footer>f</footer></body>"
    assert wrappers.extract(two, None) == "First. Second."
    one = "<body><article><p>Alone.</p></article><p>elsewhere</p></body>"
    merged = wrappers._join(*(wrappers.fold(wrappers.parse(p)) for p in (two, one)))
    path = wrappers.article_path(merged, 2)
    assert [wrappers.read(p, path) for p in (two, one)] == ["First. Second.", "Alone."]


def test_alignment_finds_slots_options_and_repeats():
    pages = ["<div><h2>News</h2><p>one</p><i>x</i></div>", "<div><h2>News</h2><p>two</p><p>three</p><table>t</table></div>"]
    a, b = (wrappers.fold(wrappers.parse(p)) for p in pages)
    joined = wrappers._join(a, b)[4][0]
    by_label = {c[0]: c for c in joined[4] if len(c) == 5}
    assert by_label["h2"][4] == [["News", 8]]
    assert by_label["p"][1] and by_label["p"][4][0][0] is None
    assert by_label["table"][2] and not by_label["h2"][2]


def test_template_text_needs_many_pages():
    page = "<body><main><p>{}</p><h4>Read more stories</h4></main></body>"
    for count, dropped in ((3, []), (12, ["Read more stories"])):
        trees = [wrappers.fold(wrappers.parse(page.format(f"text {i} of the day"))) for i in range(count)]
        merged = trees[0]
        for t in trees[1:]:
            merged = wrappers._join(merged, t)
        path = wrappers.article_path(merged, count)
        assert path[-1] == "main"
        assert wrappers.template_texts(merged, path, count) == dropped


def test_edge_cases(spark):
    long = "<article>" + "<p>word &amp; more</p>" * 20000 + "</article>"
    rows = [
        (1, "http://a.example/", None), (2, None, "<p>lonely &lt;text&gt;"), (3, "", ""), (4, "http://a.example/", long), (None, "x", "no tags  at\n all"),
        (1, "http://a.example/", None), (5, "http://b.example", "<script>var x = '<p>no</p>'</script><!-- <p>no</p> --><p>a<b>b</b>c&nbsp;d<br>e</p>"), (6, "http://b.example", "<div <p> < 3 <"),
    ]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = wrappers.main_text(frame).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "" and texts[3] == "" and texts[2] == "lonely <text>" and texts[None] == "no tags at all"
    assert texts[4] == " ".join(["word & more"] * 20000)
    assert texts[5] == "abc d e"
    assert wrappers.main_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize("count", [7, 8, 100])
def test_article_text_stays_whole_on_a_host_of_near_copies(spark, count):
    page = "<body><article><h1>T</h1><p>a1</p><h2>S</h2><p>{}</p></article><footer>end</footer></body>"
    rows = []
    for name, says in (("copies", lambda i: "other" if i else "a2"), ("versions", lambda i: f"version {i} of this"), ("equal", lambda i: "a2")):
        rows += [(f"{name} {i}", f"https://{name}.example/{i}", page.format(says(i if name == "versions" else i == 0)), f"T a1 S {says(i if name == 'versions' else i == 0)}") for i in range(count)]
    frame = spark.createDataFrame([r[:3] for r in rows], "page_id string, url string, html string")
    assert {r.page_id: r.text for r in wrappers.main_text(frame).collect()} == {r[0]: r[3] for r in rows}


def say(count, word):
    return " ".join(f"{word}{k}" for k in range(count)) + "."


SPLIT = {
    "lead and story": (f"<div class=lead><p>{say(40, 'lead')}</p></div><div class=story><p>{say(60, 'story')}</p></div>", f"{say(40, 'lead')} {say(60, 'story')}"),
    "continued": (f"<article><p>{say(55, 'a')}</p></article><section class=continued><p>{say(45, 'a')}</p></section>", f"{say(55, 'a')} {say(45, 'a')}"),
    "three levels": (
        f"<div class=x><div class=y><div class=z><p>{say(70, 'z')}</p></div><div class=w><p>{say(30, 'z')}</p></div></div><div class=v><p>{say(30, 'z')}</p></div></div>",
        f"{say(70, 'z')} {say(30, 'z')} {say(30, 'z')}",
    ),
    "labelled articles": (f"<div><article class=first><p>{say(30, 'a')}</p></article><article class=second><p>{say(20, 'b')}</p></article></div><div class=rest>of it</div>", f"{say(30, 'a')} {say(20, 'b')}"),
}


@pytest.mark.parametrize("name", SPLIT)
def test_split_containers_are_read_whole(name):
    inner, want = SPLIT[name]
    page = f"<html><body><nav>Home</nav>{inner}<div class=footer>end</div></body></html>"
    assert wrappers.extract(page, None) == want
    assert wrappers.extract(page, (wrappers.article_path(wrappers.fold(wrappers.parse(page)), 1), frozenset())) == want


def test_page_of_another_layout_is_read_by_its_own_wrapper(spark):
    rows = [(i, f"https://www.site.example/{i}", f"<body><div class=story><p>{say(50, f'w{i}x')}</p></div></body>", say(50, f"w{i}x")) for i in range(9)]
    other = f"<body><div class=story><p>{say(15, 'short')}</p></div><section class=report><p>{say(60, 'long')}</p></section></body>"
    rows.append((9, "https://www.site.example/9", other, f"{say(15, 'short')} {say(60, 'long')}"))
    frame = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.main_text(frame).collect()} == {r[0]: r[3] for r in rows}


@pytest.mark.parametrize("depth", [150, 199, 200, 201, 400, 10_000])
def test_deeply_nested_pages_are_read_whole(spark, depth):
    body = "".join(f"<div>w{i} " if i % 50 == 0 else "<div>" for i in range(depth)) + "core<aside>gone<div>too</div></aside>"
    body += "".join(f"</div>v{i} " if i % 50 == 0 else "</div>" for i in range(depth))
    asides = "<aside>" * depth + "x" + "</aside>" * depth
    page = f"<html><body><article>{body}{asides}end</article></body></html>"
    want = " ".join([*(f"w{i}" for i in range(0, depth, 50)), "core", *(f"v{i}" for i in range(0, depth, 50)), "end"])
    frame = spark.createDataFrame([(1, "http://a.example/1", page), (2, "http://a.example/2", "<p>plain</p>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(frame).collect()}
    assert got == {1: want, 2: "plain"}
