import html
import itertools
import re
import time

import numpy as np

from orderloom.llm import catalog
from orderloom.llm import html_text as h
from tests.llm.conftest import SMALL


def article(page):
    """Main text of a page of the test tables, read off their known layout."""
    found = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    inner = re.sub(r"<[^>]*$", "", found[1]) if found else ""
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in parts if x)


def test_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = catalog.QUERIES["op9_html_extraction"](spark, SMALL).collect()
    assert len(found) == len(pages)
    for r in found:
        assert (r["url"], r["text"]) == (pages[r["page_id"]]["url"], article(pages[r["page_id"]]["html"]))
        assert r["n_chars"] == len(r["text"])


LONG = "This is a sentence of the article, with commas, clauses and a proper end. It goes on for a while, as articles do. "
PAGE = f"""<html><head><title>T</title><script>if (a < b) {{ x = "<p>no</p>"; }}</script></head><body>
<header><a href=/>Home</a> <a href=/b>Shop</a></header>
<div class="cookie-notice"><p>We use cookies. Accept?</p></div>
<div id="main-content"><h1>Title &amp; more</h1><p>{LONG}<b>bold</b> text<p>Short one.<p>{LONG * 2}</p>
<div class="comments"><p>Nice article, thanks! I really liked it, it was good.</p></div></div>
<aside><p>Related: {LONG}</p></aside>
<form><label>Name</label><input name=x><textarea>typed</textarea><button>Send</button></form>
<footer>&copy; 2024 All rights</footer></body></html>"""
WANTED = f"Title & more\n{(LONG + 'bold text').strip()}\nShort one.\n{(LONG * 2).strip()}"


def test_other_layouts():
    assert h.main_text(PAGE, h._PRIOR) == WANTED
    assert h.main_text(PAGE.replace('<div id="main-content">', "<article>"), h._PRIOR) == WANTED
    plain = f"<div><a href=1>One</a></div><div><a href=2>Two</a></div><div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><div><a href=3>Three</a></div>"
    assert h.main_text(plain, h._PRIOR) == "\n".join([LONG.strip(), "Yes.", LONG.strip()])


def test_what_is_never_closed_hides_nothing():
    body = f"<article><p>{LONG}</p><p>{LONG * 2}</p></article>"
    wanted = f"{LONG.strip()}\n{(LONG * 2).strip()}"
    for head in ("<head><title>T</title>", "<head><title>T", "<head><noscript><link href=x>", '<head><script>var s="<!--";</script>', "<!--><head><meta charset=x>"):
        for start in ("<body>", ""):
            assert h.main_text(f"<html>{head}{start}{body}", h._PRIOR) == wanted, head + start
            assert h.main_text(f"<html>{head}{start}{body}</body></html>", h._PRIOR) == wanted, head + start
    for tag in ("noscript", "button", "select", "svg", "textarea", "iframe", "video", "template", "option"):
        for page in (f"<div><{tag}>no</div>{body}", f"<div><{tag}>no{body}</div>", f"<{tag}>no{body}<div><{tag}>no</{tag}></div>", f"<div><{tag}>no<div>no</div>no</{tag}></div>{body}"):
            assert h.main_text(page, h._PRIOR) == wanted, page
    for tag in ("math", "object", "map"):
        assert h.main_text(f"<article><p>{LONG}<{tag}>x = 1</{tag}></p></article>", h._PRIOR) == f"{LONG}x = 1"
    for script in ("script", "style"):
        assert h.main_text(f"<article><p>{LONG}</p><{script}>a = '<!--'</{script}><p>{LONG * 2}</p></article><!-- open <p>{LONG}", h._PRIOR) == wanted


def test_edge_rows(spark):
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "no markup at all, but a sentence that reads like text. " * 3), (4, "u", f"<article><p>{LONG}</p><p>cut &amp; <b>of"),
        (4, "u", f"<article><p>{LONG}</p><p>cut &amp; <b>of"), (None, "u", f"<article><p>{LONG}<!-- open"), (5, "u", f"<article><p>{LONG}</p></art"), (6, "u", f"<article>{'<p>' + LONG}" * 300),
        (7, "u", "<article><p>a b&nbsp;c&lt;d&#x41;</p></article>"),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    found = [(r["page_id"], r["text"]) for r in h.extracted(pages, h.fit(pages)).collect()]
    texts = dict(found)
    assert len(found) == 9 and texts[1] == texts[2] == ""
    assert texts[3].startswith("no markup") and texts[None] == texts[5] == LONG.strip()
    assert texts[4] == f"{LONG.strip()}\ncut & of" and texts[6].count("\n") == 299 and texts[7] == "a b c<dA"
    none = pages.limit(0)
    assert h.extracted(none, h.fit(none)).count() == 0


def test_cut_is_minimal():
    """Against every labelling of small random graphs."""
    r = np.random.default_rng(0)
    for _ in range(120):
        n = int(r.integers(1, 8))
        gain = r.normal(0, 2, n).round(2).tolist()
        edges = [(a, b, 2 * r.random()) for a, b in itertools.combinations(range(n), 2) if r.random() < 0.5]

        def cost(keep, gain=gain, edges=edges):
            return sum(max(0, g) if not k else max(0, -g) for g, k in zip(gain, keep, strict=True)) + sum(c for a, b, c in edges if keep[a] != keep[b])

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert abs(cost(h.separate(gain, edges)) - best) < 1e-9


def test_long_pages_take_time_in_proportion():
    n = 100_000
    for gain in ([1.0 if i % 2 else -0.9 for i in range(n)], np.random.default_rng(2).normal(size=n).tolist()):
        edges = [(i, i + 1, 1.5) for i in range(n - 1)] + [(i, i + 2, 0.75) for i in range(n - 2)]
        start = time.process_time()
        h.separate(gain, edges)
        assert time.process_time() - start < 10
    start = time.process_time()
    found = h.main_text("<table>" + f"<tr><td><p>{LONG}</p></td><td><a href=1>next</a></td></tr>" * 20_000 + "</table>", h._PRIOR)
    assert found.count(LONG.strip()) == 20_000 and time.process_time() - start < 30


def test_cut_of_larger_graphs_by_another_method():
    """The value of the cut against one augmenting path at a time."""
    r = np.random.default_rng(7)
    for n in (30, 80):
        gain = r.normal(0, 0.6, n).tolist()
        edges = [(i, int(j), float(c)) for i in range(n) for j, c in zip(r.integers(0, n, 3), r.random(3), strict=True) if i != j]
        keep = h.separate(gain, edges)
        cost = sum(max(0, g) if not k else max(0, -g) for g, k in zip(gain, keep, strict=True)) + sum(c for a, b, c in edges if keep[a] != keep[b])
        assert abs(cost - _largest_flow(gain, edges)) < 1e-9


def _largest_flow(gain, edges):
    room = {}
    for a, b, c in edges:
        room[a, b], room[b, a] = room.get((a, b), 0) + c, room.get((b, a), 0) + c
    for i, g in enumerate(gain):
        room["s", i], room[i, "t"], room[i, "s"], room["t", i] = max(g, 0), max(-g, 0), 0, 0
    total = 0.0
    while True:
        before, queue = {"s": None}, ["s"]
        for a in queue:
            for (x, y), c in room.items():
                if x == a and c > 1e-12 and y not in before:
                    before[y] = a
                    queue.append(y)
        if "t" not in before:
            return total
        path, at = [], "t"
        while before[at] is not None:
            path.append((before[at], at))
            at = before[at]
        flow = min(room[x] for x in path)
        total += flow
        for a, b in path:
            room[a, b] -= flow
            room[b, a] += flow


def test_training_takes_a_bounded_part_of_each_page(spark):
    pages = [(1, f"<article>{('<p>' + LONG) * 900}</article>"), (1, f"<article>{('<p>' + LONG) * 900}</article>"), (2, "<nav><p>Home</p></nav>" * 3)]
    frame = spark.createDataFrame([(i, "u", x) for i, x in pages], "page_id long, url string, html string")
    counts = [len(r["features"]) for r in frame.select("html").mapInArrow(h._training_rows, "content double, features array<double>").collect()]
    assert len(counts) <= 2 * h.TRAINING_BLOCKS + 3
    assert (h.fit(frame) == h.fit(frame.repartition(5))).all()


def test_unknown_sections_and_very_long_numbers_are_read():
    for section in ("<![foo[x]>", "<![ x]>", "<![>", "<![1]>", "<![ändif]>"):
        assert [x.text for x in h.blocks(f"<p>before {section}after</p><p>next</p>")] == ["before after", "next"], section
    assert [x.text for x in h.blocks("<p>a<![CDATA[b]]>c<![if !IE]>d<![endif]>e</p>")] == ["acde"]
    assert [x.text for x in h.blocks("<p>a</p><![fo")] == [x.text for x in h.blocks("<p>a</p><![foo[ b")] == ["a"]
    assert [x.text for x in h.blocks(f"<p>a&#{'9' * 5000};b &#{'0' * 5000}65; &#65;</p>")] == ["a\ufffdb A A"]
