"""op3, op4 and op6: archives, URL rules and page texts."""
import base64
import hashlib
import random
import re
import time
from html import unescape

import pytest
from pyspark.sql import types as T

from tests.oracle_compare import compare, duck_connection
from tidystar.llm import html_extract, queries, url_filter, warc
from tidystar.llm.common import read_table
from tidystar.session import scratch_path

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField(n, T.StringType() if n != "page_id" else T.LongType())
                       for n in ("page_id", "url", "html", "host", "path", "payload", "digest", "text")])


def make(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


PAYLOADS = [None, "", "a", "a", "é中\U0001f600", "x\r\n\r\ny", "ends\r\n", "\r\n\r\n", "WARC/1.1\r\n", "a" * 300_000,
            "one\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n",
            "WARC/1.\r\nA\r\n1\r\nWARC/1.1\r\né", "a"]


@pytest.mark.parametrize("min_bytes", [0, 2])
def test_archives_read_back(spark, min_bytes):
    rows = [(i, f"http://h{i}.org/p?q={i}", p) for i, p in enumerate(PAYLOADS)]
    rows += [(None, None, "no id"), (40, "http://a b\r\nWARC/1.1\r\n", "z"), (41, "no scheme", "z")]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark, make(spark, rows), path, min_bytes)
    captures = warc.assemble_captures(warc.read_records(spark, path))
    got = {r["page_id"]: r for r in warc.capture_digest(captures).collect()}
    assert len(got) == len(rows)
    full = {r["metadata"]["fields"]: r for r in captures.collect()}
    for page_id, _, html in rows:
        raw = (html or "").encode()
        row = got[page_id]
        assert row["payload_bytes"] == len(raw)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = min((i for i, _, h in rows if i is not None and (h or "").encode() == raw), default=None)
        stored = page_id is None or page_id == first or len(raw) < min_bytes
        assert row["record_type"] == ("response" if stored else "revisit")
        assert row["refers_to"] == (None if stored else first)
        capture = full["" if page_id is None else f"page-id: {page_id}\r\n"]
        assert capture["request"] is not None
        assert capture["response"]["payload"] == (bytearray(raw) if stored else None)


def test_rows_that_repeat_an_id(spark):
    got = warc.capture_digest(warc.archive_round_trip(spark, make(spark, [(1, "http://a/", "x")] * 3 + [(2, "http://a/", "x")])))
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got.collect()) == \
        [(1, "response", None)] * 3 + [(2, "revisit", 1)]


def test_short_record_is_an_error(spark):
    path = scratch_path(spark, "warc-short")
    spark.createDataFrame([("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nabc",)], "value string") \
        .write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(Exception, match="shorter"):
        warc.read_records(spark, path).collect()


def brute_rule(host, path):
    best = None
    for action, text in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
                         ("allow", "com/fr/"), ("block", "com/de/")):
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[1])):
            best = (action, text)
    return best


def test_url_rules_on_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://ORG/", "http://a.org", "http://a.org/", "http://aorg/", "http://a.org?x=/",
            "http://evil.com?x.org/", "http://x.example.org/es/1", "http://example.org/ES/1", "http://example.org/en/12#f",
            "http://example.org/en/2", "ftp://com/fr/", "http://A.CoM/de/", "http://com/de", "http://user@a.com:80/fr/",
            "http://cheap-pills.net/", "http://xcheap-pills.net/", "http://a.net/CHEAP-PILLS", "http://a.net/?free-bets",
            "a://b://c.org/", "http://ex.org/\n/x", "http://É.org/"]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(None, "http://a.org/", None), (6, "http://a.org/", None)]
    got = url_filter.judge_urls(spark, make(spark, rows), queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for row, (page_id, url, _) in zip(got, rows):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        rule = brute_rule(host, path)
        bad = any(re.search(rf"(^|[^a-z0-9]){w}([^a-z0-9]|$)", rest.lower()) for w in ("cheap-pills", "free-bets", "spam-farm"))
        assert (row["page_id"], row["host"], row["path"]) == (page_id, host, path)
        assert row["rule"] == (rule[1] if rule else None), url
        assert row["verdict"] == (rule[0] if rule else "block" if bad else "allow"), url


def test_rules_are_posted_under_their_rarest_token():
    rules = [url_filter.host_rule("block", "example.org/en/1"), url_filter.pattern_rule("block", "^a^b*c"),
             url_filter.pattern_rule("block", "*x*")]
    assert rules[0].tokens == ("example", "org", "en")
    assert rules[1].tokens == ("a",)
    index = url_filter.RuleIndex(rules, {"example": 9, "org": 20, "en": 2, "a": 1})
    assert set(index.by_token) == {"en", "a"} and len(index.always) == 1


def test_many_rules_only_compile_what_their_tokens_fetch(spark):
    rules = [url_filter.pattern_rule("block", f"^word{i}^") for i in range(20_000)] + [url_filter.host_rule("block", "org/")]
    index = url_filter.RuleIndex(rules, {})
    assert index.judge("a.org/word17/x") == ("org/", "block", None) and index.judge("a.com/word17") == (None, "block", "^word17^")
    assert len(index._compiled) == 2
    pages = make(spark, [(1, "http://a.com/word19999?", ""), (2, "http://a.com/word20000", ""), (3, "http://b.org/", "")])
    got = {r["page_id"]: (r["rule"], r["verdict"], r["pattern"]) for r in url_filter.judge_urls(spark, pages, rules).collect()}
    assert got == {1: (None, "block", "^word19999^"), 2: (None, "allow", None), 3: ("org/", "block", None)}
    counts = url_filter.token_counts(spark, pages.selectExpr("url AS target"), ["a", "word20000", "none"])
    assert counts == {"a": 2, "word20000": 1}


@pytest.mark.parametrize("name", ["op3_warc_transactions", "op4_rarest_token_url_rules"])
def test_against_sql(spark, name):
    con = duck_connection(SF)
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    result = compare(queries.queries()[name](spark, SF), con, queries.oracle_sql()[name])
    assert result["values_match"] and result["types_match"], result


def article(html):
    """The article of the given pages, by their own layout."""
    inside = html[html.index("<article>") + 9:]
    inside = inside.split("</article>")[0]
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b.replace("<b>", "").replace("</b>", ""))).split())
              for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(b for b in blocks if b)


def test_texts_of_all_pages(spark):
    pages = read_table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark, pages).collect()}
    for row in pages.collect():
        assert got[row["page_id"]] == article(row["html"])


def test_consensus_and_odd_pages(spark):
    body = "<div class='post-{i}'><h1>Title {i}</h1><p>Some words of page {i} that are read.</p></div>"
    menu = "<div class='menu'>" + "<a href='/'>a long link to somewhere else on the site</a>" * 3 + "</div>"
    side = "<div class='box'><p>{s}</p></div>"
    rows = [(i, "http://Host.org/x", f"<html><body>{menu}{body.format(i=i)}{side.format(s='short')}</body>") for i in range(8)]
    # alone, this page's longer box would win; the host's pages outvote it
    rows.append((8, "http://host.org/y", f"<body>{menu}{body.format(i=8)}{side.format(s='box words ' * 12)}</body>"))
    rows += [(20, None, None), (21, "http://b.org/", ""), (22, "http://c.org/", "plain &lt;text&gt;"), (None, "u", "<p>x"),
             (23, "http://d.org/", "<p>a</p>" * 50_000)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark, make(spark, rows)).collect()}
    for i in range(9):
        assert got[i] == f"Title {i}\n\nSome words of page {i} that are read."
    assert (got[20], got[21], got[22], got[None]) == ("", "", "plain <text>", "x")
    assert got[23] == "\n\n".join(["a"] * 50_000)
    assert html_extract.extract(spark, make(spark, [])).count() == 0


@pytest.mark.parametrize("html,text", [
    ("<article><h1>T</h1><p>Hello <a title='a>b' href=x>li</a>nk w&eacute;&nbsp;&#65;</p><section class=comments><p>no</p>"
     "</section><form><p>no</p></form><div class='ad-box'>no</div></article>", "T\n\nHello link wé A"),
    ("<header><p>no</p></header><main><ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table><pre> a\n b </pre>tail<br>more"
     "</main><footer>no</footer>", "x\n\ny\n\n1\n\n2\n\n3\n\na b\n\ntail more"),
    ("<body><div class='cookie-notice'><p>we use cookies</p></div><p>a<!-- <p>no --> b</p><script>if (a<b) '<p>no'</script>"
     "<aside>no</aside><p>c", "a b\n\nc"),
    ("<p>a<script>never closed <p>no", "a"),
    ("<article class='has-sidebar'><p>kept</p></article>", "kept"),
    ("<p>x < y & z</p>", "x < y & z"),
])
def test_markup(html, text):
    assert html_extract.main_text(html, None) == text


PROSE = "long prose of the page " * 20


@pytest.mark.parametrize("html,text", [
    *[(f"<div class='box'><p>x</p></div><{tag} class='{names}'><p>{PROSE}</p></{tag.split()[0]}>", PROSE.strip()) for tag, names in (
        ("article", "post category-promo"), ("article", "post tag-notice"), ("article", "comment"), ("div", "entry elementor-widget"),
        ("div", "entry tag-notice"), ("div", "search-results"), ("div id=related", "social"), ("div", "page-with-sidebar"))],
    ("<article><p class='byline'>by A</p><ul class='toc'><li>one</ul><figure><img src=x><figcaption>cap</figcaption></figure>"
     "<fieldset>set</fieldset><p>e <math><mi>x</mi></math> <object>o</object> <noscript>n</noscript></p></article>",
     "by A\n\none\n\ncap\n\nset\n\ne x o n"),
    ("<div class='notice'><p>only text</p></div>", "only text"),
    (f"<div class='ad-frame'><h1>T</h1><p>{PROSE}</p><div class='ads'>no</div></div><div class='box'><p>end</p></div>", "T\n\n" + PROSE.strip()),
    (f"<article><p>a</p></article><div id='comments'><article class='comment'>{PROSE}</article></div>", "a"),
    ("<div hidden>no</div><nav><p>no</p></nav>", ""),
])
def test_names_do_not_drop_content(html, text):
    assert html_extract.main_text(html, None) == text


LINKS = "<p>" + "<a href=x>a link to elsewhere</a> " * 6 + "</p>"


@pytest.mark.parametrize("html,text", [
    (f"<div class='box'><p>x</p></div><div class='post'><h1>T</h1><p>lead</p><div class='body'><p>{PROSE}</p></div></div>",
     f"T\n\nlead\n\n{PROSE.strip()}"),
    (f"<h1>T</h1><p>lead</p><div class='body'><p>{PROSE}</p></div>", f"T\n\nlead\n\n{PROSE.strip()}"),
    (f"<div class='post'><section class='a'>short</section><div><section class='b'><p>{PROSE}</p></section></div></div>",
     f"short\n\n{PROSE.strip()}"),
    (f"<table><tr><td class='t'>T<tr><td class='b'>{PROSE}</table>", f"T\n\n{PROSE.strip()}"),
    (f"<div class='page'><div class='links'>{LINKS}</div><div class='post'><p>{PROSE}</p></div></div>", PROSE.strip()),
    (f"<article><p>see</p>{LINKS}</article>", "see\n\n" + ("a link to elsewhere " * 6).strip()),
    ("<div>" * 3000 + "deep", "deep"),
])
def test_containers_are_whole(html, text):
    assert html_extract.main_text(html, None) == text
    path, size = html_extract.best_path(html)
    assert html_extract.main_text(html, path) == text and size in (0, len(text))


def test_lead_beside_the_winning_path_is_kept(spark):
    inner = f"<div class='body'><p>{PROSE}</p></div>"
    rows = [(i, "http://h.org/", f"<div class='post'>{'<h1>T</h1>' * (i == 0)}{inner}</div>") for i in range(4)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark, make(spark, rows)).collect()}
    assert got == {i: "T\n\n" * (i == 0) + PROSE.strip() for i in range(4)}


def test_random_markup_never_fails():
    rng = random.Random(5)
    parts = ["<p>", "</p>", "<div class='a1'>", "</div>", "<b>", "</b>", "<a href=x>", "</a>", "t ", "&amp;", "<li>", "</ul>", "<ul>",
             "<table><tr><td>", "</td>", "<!--", "-->", "<", ">", "<script>", "</script>", "<article>", "</article>", "<br/>",
             "<p", "class=\"", "<nav>", "</nav>", "<span hidden>", "</span>", "<svg/>", "<h1>"]
    for _ in range(3000):
        html = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        path, size = html_extract.best_path(html)
        assert len(html_extract.main_text(html, path)) >= size * (size > 0)


@pytest.mark.parametrize("html,text", [
    (f"<article><h1 class='page-header'>T</h1><p>{PROSE}</p></article>", f"T\n\n{PROSE.strip()}"),
    (f"<article><div class='post-header'><h1>T</h1></div><p>{PROSE}</p></article>", f"T\n\n{PROSE.strip()}"),
    (f"<article><header><h1>T</h1><nav>no</nav></header><p>{PROSE}</p></article>", f"T\n\n{PROSE.strip()}"),
    (f"<header><h1>site</h1></header><article><p>{PROSE}</p></article>", PROSE.strip()),
    *[(f"<article><p>{PROSE}</p><{tag}>kept</{tag.split()[0]}></article>", f"{PROSE.strip()}\n\nkept") for tag in (
        "p class='ad-hoc'", "p class='notice-period'", "section id='form-of-words'", "table class='table-header'")],
    *[(f"<article><p>{PROSE}</p><div class='{name}'>gone</div></article>", PROSE.strip()) for name in (
        "ad", "top-ad-slot", "cookie_notice", "comments-area", "sidebar-left", "main-menu")],
])
def test_only_whole_names_of_furniture_drop(html, text):
    assert html_extract.main_text(html, None) == text


@pytest.mark.parametrize("html", [
    "<div>" * 50_000 + "</i>" * 50_000, "<i>" * 50_000 + "<div>" * 50_000 + "</i>" * 50_000,
    "<b>" * 50_000 + "<p>x</p>" * 50_000, "<b>" * 50_000 + "x<hr>" * 50_000,
    "<ul><li><ul>" + "<blockquote>" * 50_000 + "<li>x</li>" * 50_000,
    "".join(f"<div class='c{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}q'>x" for i in range(50_000)),
], ids=range(6))
def test_extraction_is_linear(html):
    begun = time.perf_counter()
    path, _ = html_extract.best_path(html)
    html_extract.main_text(html, path)
    assert time.perf_counter() - begun < 8  # both passes; quadratic work takes minutes
