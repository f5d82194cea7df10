import random
import time

import numpy as np
import pytest

from brute import chosen_blocks, warc_rows
from lexloom.llm import html_text, warc
from lexloom.llm.html_text import extract, main_text

PAGE = "page_id long, url string, html string, digest string, text string"


def test_warc_round_trip(spark, rows, small):
    data = [(1, "http://a/ b\n", "x" * 2000, "d", "t"), (2, None, "x" * 2000, None, None), (5, "u", "x" * 2000, "d", "t"), (3, "u", "small", "d", "t"), (4, "u", "small", "d", "t"), (6, "u", None, "d", "t"), (7, "u", "", "d", "t"), (8, "u", "é" * 600, "d", "t"), (9, "u", "WARC/1.1\r\n\r\n" * 90, "d", "t")]
    got = {r.page_id: tuple(r)[1:] for r in warc.round_trip(spark, rows(data, PAGE)).collect()}
    assert got == warc_rows([(r[0], r[2]) for r in data])
    assert warc.round_trip(spark, rows([], PAGE)).collect() == []
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: tuple(r)[1:] for r in warc.round_trip(spark, pages).collect()}
    assert got == warc_rows([(r.page_id, r.html) for r in pages.select("page_id", "html").collect()])


def test_both_joins_of_repeated_payloads(rows):
    data = [(i, "u", f"{i % 7} " * 600 if i % 3 else "small", "d", "t") for i in range(60)] + [(None, "u", "x" * 1500, "d", "t"), (None, "u", "0 " * 600, "d", "t")]
    found = [sorted(map(str, warc.with_revisits(rows(data, PAGE), "page_id", "url", "html", 1000, sent).collect())) for sent in (0, 99)]
    assert found[0] == found[1] and len(found[0]) == 62


def test_archive_layout(tmp_path):
    w = warc.ArchiveWriter(f"file://{tmp_path}", "a", "2000-01-01T00:00:00Z")
    rng = random.Random(1)
    bodies = [" ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(500)).encode() for _ in range(300)]
    for i, b in enumerate(bodies):
        w.add(warc.page_record(i, "u", b, len(b), warc.hashlib.sha1(b).hexdigest(), None, w.date))
    (path, count, size) = w.close()[0]
    data = open(path, "rb").read()
    assert len(data) == size and data[:4] == b"\x5d\x2a\x4d\x18" and count == 300
    records = list(warc.read_archive(data))
    assert records[0][0]["WARC-Type"] == "warcinfo" and [warc.page_row(*r)[0] for r in records[1:]] == list(range(300))


CASES = {
    "<html><body><nav><a href=x>Menu</a></nav><article><h1>Title</h1><p>One &amp; two.<p>Three <b>bold</b>\n four.</article><footer>f</footer>": "Title\nOne & two.\nThree bold four.",
    "<body><div class='sidebar'><p>Side text is long, very long, longer.</p></div><main><p>Short.</p><div class='comments'><p>Comment, nice.</p></div></main>": "Short.",
    "<div id=header>Top</div><div class=content><h2>Head here</h2><p>Long text, with words, and so on, and on.</p><ul><li>one item<li>two</ul></div><div>Imprint</div>": "Head here\nLong text, with words, and so on, and on.\none item\ntwo",
    "<article><p>a &amp;lt; b&nbsp;c</p><script>var x='</p>'</script><form><p>Name</p></form><!-- <p>no</p> --><p>end": "a &lt; b c\nend",
    "<form id=aspnetForm><div><h1>Head</h1><p>The whole page is in one form, as some servers make it, and counts.</p></div></form>": "Head\nThe whole page is in one form, as some servers make it, and counts.",
    "<article><p>A text of some length, with a comma or two.</p><article><p>I like it, thank you, really.</p></article></article>": "A text of some length, with a comma or two.",
    "<article><p>A text of some length, with a comma or two.</p><p><a href=x>Share</a> <a href=y>Tweet</a></p></article>": "A text of some length, with a comma or two.",
    "<body data-x=don't><p>Quotes in a value, it's fine.<p title='a>b'>So, is that.</p><p hidden>No, not this.": "Quotes in a value, it's fine.\nSo, is that.",
    "<nav><a href=x>Menu, only, a menu.</a></nav>": "",
    "": "",
    "<p": "",
    "<script>only</script>": "",
}


@pytest.mark.parametrize("page", CASES)
def test_main_text(page):
    assert main_text(page) == CASES[page]


def test_extract_odd_rows(rows):
    got = extract(rows([(1, None, None, "d", "t"), (2, "u", "<p>hi", "d", "t"), (2, "u", "<p>hi", "d", "t")], PAGE)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0), (2, "hi", 2), (2, "hi", 2)]
    assert extract(rows([], PAGE)).collect() == []


def test_articles_of_the_tables(spark, small):
    import html
    import re

    for r in extract(spark.read.parquet(f"{small}/pages.parquet")).join(spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1])
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body.replace("<br>", " "))]
        assert r.text == "\n".join(x for x in lines if x)


PROSE = "Rain fell on the old town, and the river rose; by noon, as the mayor said, nobody could cross the bridge. "


def _plain_page(rng):
    """A page without semantic tags or names, and its article."""
    lines = [f"Part {i}" if rng.random() < 0.2 else (PROSE * rng.randint(1, 4)).strip() for i in range(rng.randint(3, 12))]
    body = "".join(f"<h2>{x}</h2>" if x.startswith("Part") else f"<p>{x}</p>" for x in lines)
    menu = "".join(f"<li><a href=x>Item {i}</a></li>" for i in range(rng.randint(3, 9)))
    return f"<body><div class=k1><ul>{menu}</ul></div><div class=k2><div class=k3>{body}</div></div><div class=k4><div>Imprint</div><div>Press</div></div></body>", "\n".join(lines)


def test_scores_decide_without_semantic_tags(monkeypatch):
    rng = random.Random(3)
    pages = [_plain_page(rng) for _ in range(60)]
    assert all(main_text(p) == want for p, want in pages)
    monkeypatch.setattr(html_text, "fused", lambda a, b: np.ones(len(a)))
    assert not any(main_text(p) == want for p, want in pages)


def _random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 5)):
        kind = rng.random()
        if kind < 0.5:
            tag = rng.choice(("p", "li", "h2", "div", "td"))
            out.append(f"<{tag}>{'word, ' * rng.randint(0, 12)}{rng.choice(('', '<a href=x>link text</a> <a>b</a>', 'end.'))}</{tag}>")
        elif depth < 4:
            tag, name = rng.choice(("div", "section", "article", "nav", "ul", "form")), rng.choice(("", " class=ad", " class=box", " id=main", " class='x y'"))
            out.append(f"<{tag}{name}>{_random_page(rng, depth + 1)}</{tag}>")
    return "".join(out)


def test_picked_blocks_against_a_plain_reading():
    rng = random.Random(12)
    met = 0
    for _ in range(300):
        found = html_text.blocks(f"<body>{_random_page(rng)}</body>")
        if found.text:
            got = html_text.picked(found).tolist()
            met += 0 < sum(got) < len(got)
            assert got == chosen_blocks(found, html_text)
    assert met > 100


@pytest.mark.parametrize("page", ["<div>x", "<b>", "<i>x", "<b><div>", "<article>x", "<a href=x>y", "<p>x<li>", "<div class=ad>x", "<td>x", '<x y="', "</div>", "<!--", "&amp;"])
def test_deep_and_broken_markup_is_linear(page):
    began = time.process_time()
    main_text(page * 100000)
    assert time.process_time() - began < 8
