"""Article text on several page layouts; archives round trip, also through plain files of other writers."""

import base64
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from strataflow.llm import html_text, warc

P1, P2, P3 = ("This is the first long paragraph of the article, with enough words to count as text.",
              "Short.", "And a third paragraph &amp; more: caf&eacute; &#x2014; with   <i>inline</i> <a href='/x'>links</a>\n and so on.")
WANT = ["Headline", P1, P2, "And a third paragraph & more: café — with inline links and so on."]
NAV = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
NOISE = ("<script>var x = '<p>no</p>';</script><style>p{}</style><div class='ad-banner'>Buy this great thing now, it is very cheap today.</div>"
         "<div id=cookie-notice>We use cookies to make this long sentence appear.</div><form><label>Mail</label><input><button>Go</button></form>")
COMMENTS = "<section class='comments'><article class=comment><p>First! I think that this article is really rather good to read.</p></article></section>"
BODY = f"<h1>Headline</h1><p>{P1}<p>{P2}<p>{P3}"
PAGES = {
    "article": f"<html><head><title>T</title></head><body><header>Site name</header>{NAV}{NOISE}<article>{BODY}</article><aside>See also this</aside>{COMMENTS}<footer>&copy; me</footer></body>",
    "divs": f"<body><div class=header><div>Site</div></div>{NAV}<div id=content><div>{BODY}</div></div><div class=sidebar><p>Some other long story that is not wanted here at all.</p></div>{COMMENTS}{NOISE}<div class=footer>About us, contact, imprint</div>",
    "main": f"<body>{NAV}<main><div class=breadcrumb>Home &gt; News</div>{BODY}</p>{NOISE}</main>{COMMENTS}",
    "unclosed": f"<body><div class=ad>Ad text</div><article><h1>Headline</h1><p><b>{P1}<br><p>{P2}</p><p>{P3}</article><footer>f",
}


@pytest.mark.parametrize("name", PAGES)
def test_article_text(name):
    assert html_text.main_text(PAGES[name]).split("\n") == WANT


SIDE = "<div class=sidebar><p>Some other long story that is not wanted here at all.</p></div>"
WRAPPERS = {
    "has-sidebar": f"<body>{NAV}<div class='layout has-sidebar'><article>{BODY}</article>{SIDE}</div>{COMMENTS}<footer>f</footer>",
    "main in has-sidebar": f"<body>{NAV}<div class='has-sidebar'><div id=x class=no-header><main>{BODY}</main>{SIDE}</div></div>{COMMENTS}",
    "has-sidebar in main": f"<body>{NAV}<main><div class='layout has-sidebar'><article>{BODY}</article>{SIDE}</div></main>{COMMENTS}",
    "headline beside has-sidebar": f"<body>{NAV}<main><h1>Headline</h1><div class='layout has-sidebar'><div>{BODY[17:]}</div>{SIDE}</div></main>{COMMENTS}",
    "no-header, no article": f"<body>{NAV}<div id=page class=no-header><div>{BODY}</div>{SIDE}</div>{COMMENTS}",
    "page-wide form": f"<body><form id=aspnetForm>{NAV}<div class=content>{BODY}</div>{SIDE}{COMMENTS}</form><footer>f</footer>",
    "form around article": f"<body><form>{NAV}<article>{BODY}</article>{NOISE.replace('form', 'nav')}</form>",
    "parts of the article": f"<body><article><div class=entry-header><h1>Headline</h1></div><p class=notice>{P1}</p><p class=disclaimer>{P2}</p><p>{P3}</p>{NOISE}</article>{COMMENTS}",
}


@pytest.mark.parametrize("name", WRAPPERS)
def test_names_do_not_skip_the_article(name):
    assert html_text.main_text(WRAPPERS[name]).split("\n") == WANT


LAST = "And here is a closing paragraph of the article, outside the element that holds nearly all."
MANY = [f"{P1} {i}" for i in range(14)]
INNER = "".join(f"<p>{m}</p>" for m in MANY)
REGIONS = {
    "divs": f"<body>{NAV}<div id=content><h1>Headline</h1><div class=body>{INNER}</div><div><p>{LAST}</p></div></div>{SIDE}{COMMENTS}{NOISE}<footer>f</footer>",
    "section": f"<body>{NAV}<div id=content><h1>Headline</h1><section>{INNER}</section><section><p>{LAST}</p></section></div>{COMMENTS}",
    "main": f"<body>{NAV}<main><h1>Headline</h1>{''.join(f'<p>{m}</p>' for m in MANY[:5])}<article>{''.join(f'<p>{m}</p>' for m in MANY[5:])}<p>{LAST}</p></article></main>{COMMENTS}",
    "articles": f"<body>{NAV}<div><article><h1>Headline</h1>{INNER}</article>{SIDE}<article><p>{LAST}</p></article></div>{COMMENTS}",
    "headline only": f"<body>{NAV}<div id=content><h1>Headline</h1><div>{INNER}<p>{LAST}</p></div></div>{COMMENTS}<div class=footer>f</div>",
    "headline before article": f"<body>{NAV}<div><h1>Headline</h1></div><article>{INNER}<p>{LAST}</p></article>{COMMENTS}",
}


@pytest.mark.parametrize("name", REGIONS)
def test_headline_and_closing_paragraph_outside_the_largest_container(name):
    assert html_text.main_text(REGIONS[name]).split("\n") == ["Headline", *MANY, LAST]


LINKS = "<h3>Read next</h3><ul>" + "".join(f"<li><a href=/{i}>Another story number {i}</a>" for i in range(5)) + "</ul>"
QUIET = {       # no article element and no telling name: the ratios alone tell what is text
    "links in an article": f"<body>{NAV}<article>{BODY}{LINKS}</article>{COMMENTS}",
    "links between paragraphs": f"<body>{NAV}<article><h1>Headline</h1><p>{P1}{LINKS}<p>{P2}<p>{P3}</article>",
    "links in divs": f"<body><div><div>{LINKS}</div><div>{BODY}</p>{LINKS}</div></div><div>{LINKS}</div>",
    "no containers": f"<p><a href=/>Home</a> <a href=/n>News</a></p>{BODY}<p>Terms Privacy</p>",
    "plain edges": f"<body><p>Home News<p>Log in{BODY}</p><p>Terms Privacy<p>Imprint</body>",
}


@pytest.mark.parametrize("name", QUIET)
def test_clusters_decide_lines_inside_the_region(name):
    assert html_text.main_text(QUIET[name]).split("\n") == WANT


def test_text_with_links_stays():
    """Paragraphs with links in them, a single line that is a link, and long linked titles in a cluster."""
    cited = "".join(f"<li><a href=/{i}>{P1} {P1} part {i}</a>" for i in range(3))
    page = f"<body>{NAV}<article>{BODY}<p><a href=/m>More of this</a><p>{P1}<h2>Sources</h2><ul>{cited}</ul></article>"
    assert html_text.main_text(page).split("\n") == [*WANT, "More of this", P1, "Sources", *[f"{P1} {P1} part {i}" for i in range(3)]]


def labelled(rnd):
    """A page of lines that are labelled as they are made: (html, text lines). Content stands in an unnamed div."""
    def words(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    def links():
        return "<ul>" + "".join(f"<li><a href=/x>{words(rnd.randint(1, 3))}</a></li>" for _ in range(rnd.randint(4, 8))) + "</ul>"
    want, body = [words(5)], []
    body.append(f"<h1>{want[0]}</h1>")
    for k in range(rnd.randint(3, 8)):
        if k and rnd.random() < 0.3:
            want.append(words(3))
            body.append(f"<h2>{want[-1]}</h2>")
        want.append(words(rnd.randint(40, 90)))
        body.append(f"<p>{want[-1]}</p>")
        if rnd.random() < 0.3:
            want.append(words(2))
            body.append(f"<p>{want[-1]}</p>")
            want.append(words(rnd.randint(40, 90)))
            body.append(f"<p>{want[-1]}</p>")
        if rnd.random() < 0.4:
            body.append(f"<h3>{words(2)}</h3>{links()}")
            want.append(words(rnd.randint(40, 90)))
            body.append(f"<p>{want[-1]}</p>")
    if rnd.random() < 0.5:
        body.append(links())
    around = [f"<div>{links()}</div>" for _ in range(2)]
    return f"<html><body>{around[0]}<div><div>{''.join(body)}</div></div>{around[1]}</body></html>", want


def test_labelled_pages_without_telling_names():
    import random
    rnd = random.Random(8)
    for _ in range(60):
        page, want = labelled(rnd)
        assert html_text.main_text(page).split("\n") == want


def test_without_the_ratios_the_result_is_another(monkeypatch):
    """Ablation: a threshold of zero, or random numbers for the smoothed ratios, lose the link lists."""
    import random

    import numpy as np
    rnd = random.Random(9)
    pages = [(h, w) for h, w in (labelled(rnd) for _ in range(40))] + [(h, WANT) for h in QUIET.values()]
    right = sum(html_text.main_text(h).split("\n") == w for h, w in pages)
    flat = sum(html_text.main_text(h, threshold=0).split("\n") == w for h, w in pages)
    gen = np.random.default_rng(1)
    monkeypatch.setattr(html_text, "smooth", lambda x, sigma: gen.permutation(x))
    shuffled = sum(html_text.main_text(h).split("\n") == w for h, w in pages)
    assert right == len(pages) and flat < 0.5 * len(pages) and shuffled < 0.5 * len(pages)


def test_columns_with_odd_names_pass_through(spark):
    df = spark.createDataFrame([(1, PAGES["article"], 2, 3)], "page_id long, html string, `a-b c` int, `x:y` int")
    assert html_text.extract(df).first().asDict() == {"page_id": 1, "a-b c": 2, "x:y": 3, "text": "\n".join(WANT)}


def test_long_advert_beside_a_short_article():
    assert html_text.main_text(f"<body><div class=ad>{P1}</div><article><h1>Hi</h1><p>Short.</p></article>") == "Hi\nShort."


def test_html_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<html><body></body></html>"), (4, "u", "just text"), (None, "u", "<p>one</p><p>two</p>"),
            (5, "u", PAGES["main"]), (5, "u", PAGES["main"]), (6, "u", "<div" + "<p>x" * 5000), (7, "u", "</p></div><!-- <p>no</p> --> <p>&lt;b&gt; a\x00b")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, row string")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "row", "text"]
    out = sorted(((r.page_id is not None, r.page_id or 0, r.text) for r in got.collect()))
    assert len(out) == len(rows) and (True, 1, "") in out and (True, 3, "") in out and (True, 4, "just text") in out
    assert (False, 0, "one\ntwo") in out and out.count((True, 5, "\n".join(WANT))) == 2
    assert html_text.extract(df.limit(0)).count() == 0


def expected(rows, least):
    first, out = {}, []
    for i, u, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        b = (h or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        again = len(b) >= least and d in first
        out.append((str(i), len(b), d, "revisit" if again else "response", str(first[d]) if again else "None"))
        first.setdefault(d, i)
    return sorted(out)


@pytest.mark.parametrize("least", [0, 20])
def test_archives_round_trip(spark, tmp_path, least):
    rows = [(3, "http://a/1", "<p>same payload, long enough</p>"), (1, "http://a/2", "<p>same payload, long enough</p>"),
            (2, None, None), (4, "http://a/3", ""), (5, "http://a/\r\nX: y", "short"), (6, "u", "short"), (7, "ü", "äöü \r\n\r\nWARC/1.1\r\n" * 40),
            (8, "u", "x" * 3_000_000), (9, "u", "same id a"), (9, "v", "same id a"), (10, "u", "repeat this row please"),
            (10, "u", "repeat this row please"), (None, "u", "no id"), (None, "u", "<p>same payload, long enough</p>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, key string")
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(df, folder, min_bytes=least)
    captures = warc.assemble(warc.read_archives(spark, folder, with_payload=True))
    assert captures.filter(F.col("request").isNull() | F.col("response").isNull() | F.col("metadata").isNull()).count() == 0
    flat = warc.resolve_revisits(captures).collect()
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in flat)
    assert got == expected(rows, least)
    full = captures.filter("response.type = 'response'").select("response.payload", "response.payload_digest").collect()
    assert all(warc.base32_sha1(bytes(r.payload)) == r.payload_digest for r in full)
    empty = f"file://{tmp_path}/none"
    warc.write_archives(df.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_reads_plain_archives():
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\r\n\r\nmore"
    record = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    rows = list(warc.parse_archive(io.BytesIO(info + record), with_payload=True))
    assert [r[1] for r in rows] == ["warcinfo", "response"] and rows[1][-1] == b"body\r\n\r\nmore"
    with pytest.raises(ValueError):
        list(warc.parse_archive(io.BytesIO(record[:-30])))
