"""Main text of pages, and web archives."""

import gzip
import hashlib
import io
import random
import time

import pytest

from tramline.llm import warc
from tramline.llm.html_text import Model, extract, main_text, ordered, parse
from tramline.llm.labelled_pages import PAGES

LINE = "The quick brown fox jumps over the lazy dog while the sun sets behind the hills. "


@pytest.fixture(scope="module")
def model():
    return Model(PAGES)


def test_labelled_pages_are_told_apart(model):
    wrong = total = 0
    for page in PAGES:
        nodes = ordered(parse(page))
        for node, p in zip(nodes, model.marginals(nodes)):
            if not node.tag:
                total += 1
                wrong += (p >= 0.5) != node.main
    assert wrong <= 0.02 * total


def test_pages_left_out_of_the_training(model):
    wrong = total = 0
    for k in range(0, len(PAGES), 4):
        other = Model(PAGES[:k] + PAGES[k + 1:])
        nodes = ordered(parse(PAGES[k]))
        for node, p in zip(nodes, other.marginals(nodes)):
            if not node.tag:
                total += 1
                wrong += (p >= 0.5) != node.main
    assert wrong <= 0.08 * total


def test_marginals_equal_enumeration(model):
    page = f"<body><nav><a href=x>a</a></nav><div class=content><p>{LINE}<p>b</div></body>"
    nodes = ordered(parse(page))
    got = model.marginals(nodes)
    import itertools
    import math

    from tramline.llm.html_text import TEMPER, features, kind
    place = {id(n): i for i, n in enumerate(nodes)}
    sums = [[0.0, 0.0] for _ in nodes]
    for states in itertools.product((0, 1), repeat=len(nodes)):
        w = 1.0
        for i, (node, s) in enumerate(zip(nodes, states)):
            x = sum(model.odds.get(f, 0.0) for f in features(node)) * (1 if node.tag else TEMPER)
            p = 1 / (1 + math.exp(-x))
            w *= (p if s else 1 - p) * (1e-6 if i == 0 and s else 1)
            if node.parent is not None:
                w *= model.follow[kind(node)][states[place[id(node.parent)]]][s]
        for i, s in enumerate(states):
            sums[i][s] += w
    assert got == pytest.approx([b / (a + b) for a, b in sums], abs=1e-9)


def test_unseen_layouts(model):
    page = f"""<html><head><title>x</title><script>var a = "<p>no</p>";</script></head><body><div class="site-header"><h1>Brand</h1></div>
    <div class="main-menu"><a href=a>One</a> <a href=b>Two</a></div><main><h1>Head</h1><p>{LINE}<p>AT&amp;T &lt;b&gt;  &#233;<br>next
    <b>bold</b> word{LINE}</p></main><section class="user-comments"><p>{LINE * 2}</p></section><div class="cookie-banner">{LINE}</div>
    <form><p>Enter</p><select><option>no</select></form><!-- {LINE} --></body></html>"""
    assert main_text(page, model) == f"Head\n\n{LINE.strip()}\n\nAT&T <b> é next bold word{LINE.strip()}"


@pytest.mark.parametrize("html", ["", "<", "<p", "</p></div>", "<a<b<c>", "<script>never ended", "<!-- never ended", "&amp", "<p>" * 3000, "<div>" * 3000 + "x", "a\0b"])
def test_broken_pages(model, html):
    assert isinstance(main_text(html, model), str)


BROKEN = {
    "open tags": lambda n: "<a " * n, "open quotes": lambda n: '<a "' * n, "open values": lambda n: '<a b="' * n,
    "quoted ends": lambda n: '<a b=">"' * n, "stray ends": lambda n: "<b>" * n + "</i>" * n, "open noscript": lambda n: "<noscript>" * n,
    "open end tags": lambda n: "<noscript></noscript " * n, "blocks in inline": lambda n: "<b>" * n + "<div></div>" * n,
    "ends behind a wall": lambda n: "<b><td>" + "<i>" * n + "</b>" * n, "items in boxes": lambda n: "<ul>" + "<div>" * n + "<li></li>" * n,
    "sections": lambda n: "<![CDATA[" * n, "references": lambda n: "&#1" * n, "digits": lambda n: "&#" + "1" * n + ";&#" + "0" * n + "65;"}


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_pages_take_time_in_proportion(model, kind):
    page = BROKEN[kind](1)
    start = time.perf_counter()
    main_text(BROKEN[kind](1_000_000 // len(page)), model)
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("html, text", [
    ("just plain text, AT&amp;T\n and more", "just plain text, AT&T and more"), ("if a < b and c <d then e", "if a < b and c <d then e"),
    ("&#0000000065;&#x00041;&#00;", "AA\ufffd"), ("", ""), ("<a href=x>only a link</a>", ""), ("a<!-->b<!--->c<!-- x -->d", "abcd"),
    ("a<![CDATA[ x > y ]]>b", "ab"), ("cut off <a hre", "cut off"), ("cut off <a href=\"x", "cut off"), ("it<b title=it's>'s</b> so", "it's so")])
def test_pages_without_elements(model, html, text):
    assert main_text(html, model) == text


@pytest.mark.parametrize("inside, text", [
    ("Euler showed that <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> holds. ", "Euler showed that x=1 holds. "),
    ("Press the <button>red</button> knob. ", "Press the red knob. "), ("<template> Words. ", "Words. "),
    ("<noscript> Words. ", "Words. "), ("<noscript>no</noscript>Words. ", "Words. "), ("<select> Words. ", "Words. "), ("<svg> Words. ", "Words. "),
    ("<svg><text>no</text></svg>Words. ", "Words. "), ("<iframe src=x> Words. ", "Words. "), ("a <b title=\"x>y\">b</b> c. ", "a b c. ")])
def test_no_words_are_lost(model, inside, text):
    page = f"<body><nav><a href=x>a</a></nav><article><h1>Head</h1><p>{LINE}{inside}{LINE}</p><p>{LINE}</p></article></body>"
    assert main_text(page, model) == f"Head\n\n{LINE}{text}{LINE.strip()}\n\n{LINE.strip()}"


def test_buttons_at_the_edge_of_a_block_give_no_text(model):
    page = f"<body><article><h1>Head <button>Share</button></h1><p><button>Play</button> {LINE}<button>More</button> <button>Less</button></p></article></body>"
    assert main_text(page, model) == f"Head\n\n{LINE.strip()}"


def test_cut_off_pages(model):
    page = f"<body><nav><a href=x>a</a></nav><article><h1>Head</h1><p>{LINE}</p><p>{LINE}</p></article></body>"
    whole = main_text(page, model)
    for n in range(90, len(page)):
        assert whole.startswith(main_text(page[:n], model).rstrip("&")[:60][:20])


@pytest.mark.parametrize("attribute", [
    'aria-hidden="false"', 'title="a hidden gem"', 'data-x=\'hidden\'', 'data-hidden', 'data-x = hidden', 'class="x hidden y"', 'data-x="a > hidden >"',
    'x=y/hidden', "data-id='hidden'"])
def test_only_an_attribute_named_hidden_hides(model, attribute):
    page = f"<body><article {attribute}><h1>Head</h1><p {attribute}>{LINE}<a {attribute} href=/blog/hidden/x>link</a></p></article></body>"
    assert main_text(page, model) == f"Head\n\n{LINE}link"


@pytest.mark.parametrize("attribute", ["hidden", 'HIDDEN=""', "class=a hidden", "class='a'hidden id=b", "hidden=hidden", 'a="hidden" hidden/', "a/hidden"])
def test_hidden_elements_give_no_text(model, attribute):
    assert main_text(f"<body><article><h1>Head</h1><p {attribute}>{LINE}no</p><p>{LINE}</p></article></body>", model) == f"Head\n\n{LINE.strip()}"


@pytest.mark.parametrize("start", ["<body>", "<BODY class=x>", "", "</head>", "<head>", "<header><p>x</header>"])
def test_a_head_need_not_be_closed(model, start):
    head = "<html><head><meta charset=utf-8><title>no</title>\n<script>no()</script><link rel=x> <style>no</style>\n"
    assert main_text(f"{head}{start}<article><h1>Head</h1><p>{LINE}</p></article>", model).endswith(f"Head\n\n{LINE.strip()}")
    seen = lambda html: [n.text for n in ordered(parse(html)) if n.text]
    assert seen(f"{head}Some <b>text</b>") == ["Some text"] and seen(f"{head}<b>text</b>") == ["text"] and seen(head) == []


def test_all_words_of_a_class_count(model):
    words = "wp block group alignfull has background is layout flow container core entry related posts sidebar widget".split()
    box = parse(f'<body><div class="{" ".join(words)}" id="{"7" * 30}" role="{"8" * 20}"><p>x</p></div></body>').children[0].children[0]
    assert box.names == tuple(sorted([*words, "7" * 30, "8" * 20]))
    page = f"<body><article class=content><h1>Head</h1><p>{LINE * 3}</p></article><div class=\"{' '.join(words)} share social sponsored\"><p>{LINE * 2}</p></div></body>"
    assert main_text(page, model) == f"Head\n\n{(LINE * 3).strip()}"


def test_extract(spark):
    rows = [(1, "u", f"<article><h1>T</h1><p>{LINE}</p></article>", 5), (2, None, None, 6), (3, "u", "", 7), (3, "u", "", 7), (None, None, "<p>", 8)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [
        (1, "u", f"T\n\n{LINE.strip()}", len(LINE) + 2), (2, None, "", 0), (3, "u", "", 0), (3, "u", "", 0), (None, None, "", 0)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")


def test_archives_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    rng = random.Random(1)
    long = "".join(rng.choice("abcé\r\n\0 ") for _ in range(300_000))
    same, small = "s" * 100, "s" * 99
    rows = [(5, "http://a/ b\r\nX: y", same), (3, "http://b", same), (9, None, same), (1, "u", small), (2, "u", small), (4, "", None), (6, "u", ""),
            (7, "u", long), (8, "u", long), (None, "u", same), (None, "u", "t" * 200), (10, "u", "WARC/1.1\r\n\r\n" * 20), (3, "http://b", same)]
    got = warc.archive_round_trip(pages(spark, rows).repartition(3), with_payload=True).collect()
    payload = {(r.page_id, r.payload_digest): bytes(r.payload) for r in got if r.payload is not None}
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = min((j for j, _, h in rows if j is not None and (h or "") == (html or "")), default=None)
        again = len(data) >= 100 and first is not None and i != first
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
        assert payload[first if again else i, hashlib.sha256(data).hexdigest()] == data
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert {r.url for r in got if r.page_id in (5, 9)} == {"http://a/%20b%0D%0AX:%20y", None}


def test_empty_archives(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def one(payload=b"p" * 5000, page_id=1):
    return warc.record(page_id, "u", payload, hashlib.sha256(payload).hexdigest(), "response", None, "2024-01-01T00:00:00Z")


def test_members_are_plain_gzip():
    assert gzip.decompress(one()).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    records = list(warc.read_records(io.BytesIO(one() + one(b"", 2) + one(b"x", 3)), True))
    assert [(r.headers["x-page-id"], r.payload_bytes) for r in records] == [("1", 5000), ("2", 0), ("3", 1)]


@pytest.mark.parametrize("broken", [
    one()[:-5], one() + b"junk", gzip.compress(b"no record\r\n\r\n"),
    gzip.compress(gzip.decompress(one()).replace(b"ppp", b"qqq", 1)), gzip.compress(gzip.decompress(one())[:-9]),
    gzip.compress(gzip.decompress(one()) + b"more")])
def test_broken_archives_are_refused(broken):
    with pytest.raises(warc.BrokenArchive):
        list(warc.read_records(io.BytesIO(broken)))
