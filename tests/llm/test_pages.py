import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from twinledger.llm import pages

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit("h")).withColumn("slot", F.lit(1))
    got = pages.main_text(df, settings=pages.Settings(**settings)).collect()
    assert len(got) == len(rows)
    return {r.page_id: r.text for r in got}


def article(body, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><article>x';</script></head><body>{before}<article>{body}</article>{after}</body></html>"


def test_menus_and_markup_go(spark):
    page = article(
        "<header><h1>A &amp; B</h1></header><p>One\n  two<br>three <b>bold</b>&nbsp;&lt;x&gt;<p>Next<!-- gone --> <i>p</i>ara"
        "<ul><li>first<li>second</ul><div class='share-buttons'>Share</div><section id=comments><p>Me too</p></section>"
        "<form><p>Name</p><input><button>Send</button></form>tail <button>Go</button> end",
        "<nav><ul><li>Home</ul></nav><div class=\"ad\">Buy > now</div><header>Site</header><aside>More</aside>",
        "<footer>&copy; x</footer><div id='cookie-notice'>Cookies</div>",
    )
    got = texts(spark, [(1, "http://a.b/c", page), (2, None, None), (3, "", ""), (4, "x", "no tags &amp; all"), (None, "http://a.b/d", page)])
    main = "A & B\nOne two three bold <x>\nNext para\nfirst\nsecond\ntail end"
    assert got == {1: main, 2: "", 3: "", 4: "no tags & all", None: main}


def test_constant_slots_are_template_and_varying_ones_content(spark):
    def page(i):
        return f"<body><div><p>Welcome to our site</p></div><div><h1>Story {i}</h1><p>Text {i} of it</p><p>{'Same' if i % 2 else i}</p></div><div><p>Call us</p></div></body>"

    rows = [(i, f"https://x.org/{i}", page(i)) for i in range(20)] + [(99, "https://other.org/", page(1))]
    got = texts(spark, rows)
    assert got[1] == "Story 1\nText 1 of it\nSame" and got[2] == "Story 2\nText 2 of it\n2"
    assert got[99] == "Welcome to our site\nStory 1\nText 1 of it\nSame\nCall us"  # one page says nothing about its host


def test_copies_of_a_page_make_no_template(spark):
    rows = [(i, "https://x.org/", article("<h1>Same</h1><p>story</p>")) for i in range(30)]
    assert set(texts(spark, rows).values()) == {"Same\nstory"}


def test_broadcast_and_joined_exemplars_agree(spark):
    rows = [(i, f"https://h{i % 3}.org/{i}", article(f"<p>{i}</p><p>fixed</p>")) for i in range(60)]
    one, other = texts(spark, rows), texts(spark, rows, broadcast_bytes=0)
    assert one == other and one[4] == "4"


def test_odd_markup(spark):
    rows = [
        (1, "u", "<article><p>a<p>b</div></p></section>c"),
        (2, "u", "<p class='x>y'>q</p><table><tr><td>1<td>2<tr><td>3</table>"),
        (3, "u", "<article><p>5 < 6 and <b>7</article>after"),
        (4, "u", "<script>never closed <p>x"),
        (5, "u", "<div hidden>h</div><main><p>m</p></main><p>out</p>"),
        (6, "u", "<article>one</article><div class=comments><article>no</article></div><article>two</article>"),
        (7, "u", "<p>" * 500 + "deep" + "<div>" * 500 + "er"),
        (8, "u", "<a href=\"" + "x" * 50_000),
    ]
    got = texts(spark, rows)
    assert got[1] == "a\nb\nc" and got[2] == "q\n1\n2\n3" and got[3] == "5 < 6 and 7" and got[4] == ""
    assert got[5] == "m" and got[6] == "one\ntwo" and got[7] == "deep\ner"


def test_simple_tree_matching():
    a, own, _ = pages.parse("<div><p>1</p><ul><li>2</ul><p>3</p></div>")
    b, other, _ = pages.parse("<div><h1>0</h1><p>x</p><ul><li>y<li>z</ul><p>w</p></div>")
    pairs = {(own[i].text, other[j].text) for i, j in pages.align(a, b)}
    assert ("1", "x") in pairs and ("3", "w") in pairs and len(pairs) == 3
    assert pages.align(a, a) and len(pages.align(a, a)) == 3


def test_no_rows(spark):
    assert pages.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_inline_elements_that_never_close(spark):
    rows = [
        (1, "u", "<article><p><label>Note<p>long <button>Go</button>article<p>end</article>"),
        (2, "u", "<article><div>a <button>b</div><p>c</p><label>d</label><div>e <button>f</button> g</div></article>"),
        (3, "u", "<article><label>Note<p>one</p><p>two</p></article><p>out</p>"),
        (4, "u", "<article><button><p>Go</button>text</p>after <label><div>in</div></label></article>"),
    ]
    got = texts(spark, rows)
    assert got == {1: "long article\nend", 2: "a\nc\ne g", 3: "one\ntwo", 4: "text\nafter"}


def test_templates_of_small_hosts_and_of_layouts(spark):
    def story(i):
        return f"<body><div><p>Call us</p></div><div><h1>Story {i}</h1>{'<p>More</p>' * (i % 3)}<p>Text {i}</p></div></body>"

    def listing(i):
        return f"<body><section><p>All items</p><p>Item {i}</p></section></body>"

    def teaser(i):
        return f"<body><article><p>Read our paper</p></article><div><p>Story {i}</p></div></body>"

    rows = [(i, "https://small.org/", story(i)) for i in (1, 3)]
    rows += [(10 + i, "https://two.org/", story(i)) for i in range(10)] + [(20 + i, "https://two.org/", listing(i)) for i in range(10)]
    rows += [(30 + i, "https://tease.org/", teaser(i)) for i in range(3)] + [(40, "https://one.org/", teaser(0))]
    for settings in ({}, {"broadcast_bytes": 0}):
        got = texts(spark, rows, **settings)
        assert got[1] == "Story 1\nMore\nText 1" and got[13] == "Story 3\nText 3" and got[14] == "Story 4\nMore\nText 4"
        assert got[24] == "Item 4" and got[31] == "Story 1" and got[40] == "Read our paper"


def leaf_pairs(one, other):
    return pages.align(pages.parse(one)[0], pages.parse(other)[0])


def naive_weight(x, y):
    """Matched nodes by the plain recursion over all children."""
    if x.tag != y.tag:
        return 0
    best = {(i, j): 0 for i in range(len(x.children) + 1) for j in range(len(y.children) + 1)}
    for i, p in enumerate(x.children, 1):
        for j, q in enumerate(y.children, 1):
            best[i, j] = max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + naive_weight(p, q))
    return 1 + best[len(x.children), len(y.children)]


def drawn_page(draw, depth):
    parts = []
    for _ in range(draw.randrange(1, 5)):
        tag = draw.choice(["div", "p", "ul", "section", "h2"])
        inner = drawn_page(draw, depth - 1) if depth and tag in ("div", "section") else f"t{draw.randrange(9)}"
        parts.append(f"<{tag}>{inner}</{tag}>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(40))
def test_alignment_matches_the_most_nodes(seed):
    draw = random.Random(seed)
    one, other = (pages.parse(drawn_page(draw, 3))[0] for _ in range(2))
    matching = pages._Matching()
    matching.settle(one, other)
    assert matching.weight(one, other) == naive_weight(one, other)


def test_cut_lists_are_still_matched_in_order(monkeypatch):
    monkeypatch.setattr(pages, "PIECE", 3)
    draw = random.Random(5)
    for cells in (1, 10**6):
        monkeypatch.setattr(pages, "CELLS", cells)
        for _ in range(30):
            pairs = sorted(leaf_pairs(drawn_page(draw, 2) * 3, drawn_page(draw, 2) * 4))
            assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))


def drawn_list(draw, size):
    """Children of few shapes, many of which both of two lists have."""
    tags = ("p", "h2", "ul", "section")
    return "".join(f"<{tag}>{'<p>x</p>' * draw.randrange(3)}t</{tag}>" for tag in (draw.choice(tags) for _ in range(size)))


@pytest.mark.parametrize("sizes", [(63, 70), (150, 90), (90, 220), (1, 300)])
def test_long_lists_match_the_most_nodes(sizes):
    draw = random.Random(sum(sizes))
    one, other = (pages.parse(drawn_list(draw, size))[0] for size in sizes)
    matching = pages._Matching()
    matching.settle(one, other)
    assert matching.weight(one, other) == naive_weight(one, other)
    placed = {(one.children[i].tag, other.children[j].tag) for i, j in _faced(one, other)}
    assert all(a == b for a, b in placed)


def _faced(one, other):
    of = [{leaf.number: n for n, child in enumerate(tree.children) for leaf in pages._inside([child])} for tree in (one, other)]
    return {(of[0][a], of[1][b]) for a, b in pages.align(one, other)}


def test_what_is_kept_in_memory_changes_no_match(monkeypatch):
    draw = random.Random(7)
    drawn = [[drawn_list(draw, 130), drawn_list(draw, 170)] for _ in range(4)]
    drawn += [[drawn_page(draw, 2) * 30, drawn_page(draw, 2) * 40] for _ in range(4)]
    found = [leaf_pairs(*both) for both in drawn]
    for piece, cells in ((3, 10**6), (10**6, 10**6), (64, 1), (3, 50)):
        monkeypatch.setattr(pages, "PIECE", piece)
        monkeypatch.setattr(pages, "CELLS", cells)
        assert [leaf_pairs(*both) for both in drawn] == found


ODD = {
    "nested": "<div>" * 20_000 + "{}", "siblings": "<p>{}" + "<p>a" * 20_000,
    "quotes": "<a \"'" * 20_000 + "{}", "quote": "<a \"<p>t</p>" * 20_000 + "{}", "bangs": "<!" * 50_000 + "{}>",
    "ends": "<div>" * 20_000 + "</p>" * 20_000 + "{}", "items": "<blockquote>" * 20_000 + "<li>" * 20_000 + "{}",
}


@pytest.mark.parametrize("kind", ODD)
def test_odd_pages_take_little_time(kind):
    start = time.perf_counter()
    leaf_pairs(ODD[kind].format("one"), ODD[kind].format("<p>another"))
    assert time.perf_counter() - start < 5


def test_odd_pages_in_the_whole_operator(spark):
    rows = [(n, "https://a.b/x", page.format(f"<p>word {n}")) for n, page in enumerate(ODD.values())]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and "word 0" in next(r.text for r in got if r.page_id == 0)


class Plain(HTMLParser):
    """The text of sound pages by an independent parser: blocks inside the article that no list hides."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks, self.piece, self.raw = [], [], [], 0

    def hides(self, tag, attributes):
        inside = any(t == "article" for t, _ in self.stack)
        words = {w.lower() for name, v in attributes if name in ("class", "id") for w in re.findall("[a-z]+|[A-Z][a-z]*", v or "")}
        return (
            tag not in ("html", "body", "article", "main")
            and (
                tag in pages.NOT_CONTENT - ({"header"} if inside else set())
                or bool(words & (pages.HINTS - ({"header"} if inside else set())))
                or any(n == "hidden" or n == "role" and v in pages.ROLES or (n, v) == ("aria-hidden", "true") for n, v in attributes)
                or any(n == "style" and "display:none" in (v or "").replace(" ", "") for n, v in attributes)
            )
        )

    def flush(self):
        text = " ".join("".join(self.piece).split())
        if text and any(t == "article" for t, _ in self.stack) and not any(h for _, h in self.stack):
            self.blocks.append(text)
        self.piece = []

    def handle_starttag(self, tag, attributes):
        if tag in pages.RAW:
            self.raw += 1
        elif tag == "br":
            self.piece.append(" ")
        elif tag in pages.BLOCKS:
            self.flush()
            if tag not in pages.VOID:
                self.stack.append((tag, self.hides(tag, attributes)))
        elif tag in pages.NOT_CONTENT:
            self.raw += 1

    def handle_endtag(self, tag):
        if tag in pages.RAW or tag in pages.NOT_CONTENT and tag not in pages.BLOCKS:
            self.raw = max(0, self.raw - 1)
        elif tag in pages.BLOCKS and any(t == tag for t, _ in self.stack):
            self.flush()
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.raw:
            self.piece.append(data)


def test_the_given_pages_against_an_independent_parser(spark, middle):
    table = spark.read.parquet(f"{middle}/pages.parquet")
    got = {r.page_id: r.text for r in pages.main_text(table).collect()}
    sound = 0
    for row in table.collect():
        if "<article" in (row.html or ""):
            plain = Plain()
            plain.feed(row.html)
            plain.close()
            assert got[row.page_id] == "\n".join(plain.blocks)
            sound += 1
    assert sound > 0.5 * len(got)
