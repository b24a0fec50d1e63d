"""Column functions, sources and a whole run on hand-made inputs."""

import dataclasses
import datetime as dt
import json
from pathlib import Path
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from crawlcat.config import ConfigurationError, FeedIdentity, HostPolicy, Settings, Thresholds
from crawlcat.functions import http, text, urls
from crawlcat.operators import publish
from crawlcat.plans import update
from crawlcat.sources import decode, fetch, html

POLICY = HostPolicy()


def values(spark, schema, rows, *columns):
    names = [f"c{i}" for i in range(len(columns))]
    return [tuple(r[n] for n in names) for r in spark.createDataFrame(rows, schema).select(*(c.alias(n) for c, n in zip(columns, names))).collect()]


@pytest.mark.parametrize("base", ["https://a.example.com/x/y.html?q=1#f", "https://example.com", "http://example.org/d/"])
def test_resolve_is_that_of_the_standard_library(spark, base):
    hrefs = ["foo.html", "/a/b", "../up/./x", "../../../z", "?p=2", "#frag", "", "//other.example.net/p?q#r", "https://h.example.com/a/../b", "a/b/../../c?d=e#f", "./", "..", "g;x=1/../y"]
    got = values(spark, "b string, h string", [(base, h) for h in hrefs], urls.resolve(F.col("b"), F.col("h")))
    for h, (g,) in zip(hrefs, got):
        want = h if h.startswith("https:") else urljoin(base, h)
        assert g == want or g == want + "/" or (g.rstrip("/"), h) == (want.rstrip("/"), h), (h, g, want)


def test_canonical_and_identity(spark):
    rows = [("https://WWW.Example.com:443/a#x",), ("https://user@x.example.net/p?t=9",), ("http://example.com/a",), ("https://evil.test/",), ("https://example.org",), ("https://notexample.com/",), (None,), (" ",)]
    got = values(spark, "u string", rows, urls.canonical(F.col("u"), POLICY), urls.url_error(F.col("u"), POLICY))
    assert [g[0] for g in got] == ["https://example.com/a", "https://x.example.net/p", None, None, "https://example.org/", None, None, None]
    assert [g[1] for g in got][2:4] == ["not https", "host not allowed"]
    import uuid

    u = "https://x.example.net/p/é.txt"
    (name, other), = values(spark, "u string", [(u,)], urls.stable_id(F.col("u"), POLICY), urls.stable_id(F.lit("https://example.com/a"), POLICY))
    assert name == f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, u)}" and other == "https://example.com/a"


def test_text(spark):
    rows = [("  a\n\tb  ",), ("x\x00y",), ("é z ",), (None,)]
    assert [g[0] for g in values(spark, "s string", rows, text.normalized(F.col("s")))] == ["a b", "xy", "é z", None]
    cut = values(spark, "s string", [("y" * 80,), ("one two three",), ("short",)], text.truncated(F.col("s"), 10))
    assert [c[0] for c in cut] == ["y" * 9 + "…", "one two…", "short"]
    worst = "Subscribe: want to start a startup? click here �"[:39]
    got = values(spark, "s string", [(None,), (" ",), ("Want to start a startup? Subscribe now. Click here.",)], *text.summary_quality(F.col("s")))
    assert got[0] == (0.0, ["empty"]) and got[1] == (0.0, ["empty"]) and got[2][0] < 0.5 and "click_here" in got[2][1] and worst
    hint = values(spark, "s string", [("In mARCH 1999 x",), ("Marches 2001",), (("a" * 400) + " May 2000",)], text.published_hint(F.col("s")))
    assert [h[0] for h in hint] == ["March 1999", None, None]


def test_transport(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = [("0",), ("  45  ",), ("+10",), ("9999",), ("12.5",), ("not-a-date",), ("Mon, 01 Jan 2024 00:00:30 GMT",), ("Mon, 01 Jan 2023 00:00:30 GMT",), (None,), ("9" * 40,)]
    assert [g[0] for g in values(spark, "h string", rows, http.retry_after(F.col("h"), now))] == [0, 45, 10, 120, None, None, 30, 0, None, 120]
    assert [g[0] for g in values(spark, "n int", [(1,), (5,), (10,), (0,)], http.jitter_bound(F.col("n")))] == [0.4, 6.4, 8.0, 0.4]
    assert [g[0] for g in values(spark, "n int", [(0,), (1,), (2,), (8,), (9,), (500,)], http.backoff_hours(F.col("n")).cast("int"))] == [1, 1, 2, 128, 168, 168]


@pytest.mark.parametrize(
    "body, charset, want",
    [
        ("café".encode(), None, ("café", "utf-8", "utf8_strict", False, 0)), (b"\xef\xbb\xbfhello", None, ("hello", "utf-8", "bom", True, 0)), (b"\x93 hi \x94", "windows-1252", ("“ hi ”", "windows-1252", "transport", False, 0)),
        (b'<meta charset="windows-1252">\x93x\x94', None, ('<meta charset="windows-1252">“x”', "windows-1252", "meta", False, 0)), (b"plain", "koi8-r", ("plain", "utf-8", "utf8_strict", False, 0)), (b"\xff\xfe\x93", None, ("ÿþ“", "windows-1252", "windows_1252_fallback", False, 0)),
    ],
)
def test_decode(body, charset, want):
    assert decode.decode(body, charset) == want


def test_markers_bind_to_the_next_anchor_of_their_scope():
    marker = f'<img src="https://x{html.MARKER}?v=1">'
    rows = lambda h: [(a, m) for a, _, m in html.anchors(html.tree(h))]
    assert rows(f"<table><tr><td>{marker}</td><td><a href=a>A</a></td></tr><tr><td><a href=b>B</a></td></tr></table>")[1] == ("b", False)
    assert rows(f"<div>{marker}<a>no</a><a href=a>A</a><a href=b>B</a></div>") == [("a", True), ("b", False)]
    assert rows(f"<ul><li>{marker}</li><li><a href=a>A</a></li></ul>") == [("a", False)]


def test_page_metadata(spark):
    pages = [
        (1, "https://example.com/a/", '<title>T &amp; t</title><meta name="Description" content="Said by meta, which is long enough to be a good summary."><meta property="og:description" content="og"><link rel="canonical prefetch" href="../c"><p>Posted June 2026 by somebody.'),
        (2, "https://example.com/b", '<div class="promo"><p>Want to start a startup? Get funded now, everybody here.</p></div><nav><p>Nav paragraph that is long enough to be taken.</p></nav><p>Short.</p><p>The first real paragraph, relentlessly resourceful, with <b>bold<br>words.<p>Next'),
        (3, "https://example.com/c", "<title>Head</title><body>Head Subscribe to us. Loose words that go on and on until they are long enough. More."), (4, "https://example.com/d", None),
    ]
    got = {r["page_id"]: r for r in html.metadata(spark.createDataFrame(pages, "page_id int, url string, html string"), POLICY).collect()}
    assert got[1]["summary_source"] == "meta_description" and got[1]["quality_score"] >= 0.9 and got[1]["published_hint"] == "June 2026" and got[1]["page_title"] == "T & t" and got[1]["canonical_url"] == "https://example.com/c"
    assert got[2]["summary_source"] == "content_paragraph" and got[2]["summary"].startswith("The first real paragraph") and "bold words" in got[2]["summary"]
    assert got[3]["summary"].startswith("Loose words") and got[4]["summary"] is None


def test_page_metadata_by_its_rules(spark):
    long = "A paragraph that has enough characters to count as said, number {}."
    pages = [
        (1, "https://example.com/a", f'<title>Head</title><body>Head -|: Subscribe now! Short one. Then more words.'),
        (2, "https://example.com/a", "<body>Want to start a startup? Tiny."),
        (3, "https://example.com/a", '<meta property="og:image" content="http://evil.test/i.png"><meta name="twitter:image" content="https://example.com/t.png"><meta name="description" content="Posted in May 1999.">'),
        (4, "https://example.com/a", '<meta name="twitter:image" content="t.png"><meta name="description" content="Cafe\u0301\u00a0 au  lait"><meta name="news_keywords" content=" a,\n b ">'),
        (5, "https://example.com/a", "".join(f"<p>Paragraph {k}.</p>" for k in range(8)) + "<p>March 2003 in the ninth paragraph, which the hint doesn't look at.</p>loose April 2004"),
        (6, "https://example.com/a", "<body>" + "x" * 3_000), (6, "https://example.com/b", "<p>" + long.format(6)), (None, None, "<p>" + long.format(7)), (8, "https://example.com/a", ""),
        (9, "https://example.com/a", '<meta property="og:description" content="Said in June 2010"><p>Subscribe here'),
    ]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    rows = html.metadata(frame, POLICY).collect()
    assert len(rows) == len(pages)
    got = {r["page_id"]: r for r in rows}
    assert got[1]["summary"] == "Short one. Then more words." and got[2]["summary"] == "Tiny."
    assert got[3]["image_url"] is None and got[3]["published_hint"] == "May 1999" and got[4]["image_url"] == "https://example.com/t.png"
    assert got[4]["summary"] == "Caf\u00e9 au lait" and got[4]["keywords"] == "a, b" and got[5]["published_hint"] == "April 2004"
    assert sorted(len(r["summary"]) for r in rows if r["page_id"] == 6) == [len(long.format(6)), 400] and got[None]["summary"] == long.format(7) and got[8]["summary"] is None
    assert got[9]["published_hint"] == "June 2010"
    paragraph = html.parsed(frame.where("page_id = 6 and url like '%a'")).select(html.first_paragraph().alias("p")).head()["p"]
    assert len(paragraph) == 2_000
    words = spark.createDataFrame([("\t\u00a0 \n",), (" a\u00a0",), ("e\u0301\u1161\u212b",), (None,), ("plain é",)], "s string").select(text.non_empty(F.col("s")).alias("e"), text.nfc(F.col("s")).alias("n")).collect()
    assert [w["e"] for w in words] == [None, "a", "e\u0301\u1161\u212b", None, "plain é"] and words[2]["n"] == "é\u1161\u00c5" and words[4]["n"] == "plain é" and words[3]["n"] is None


def test_marked_anchors_decide_if_they_are_enough(spark):
    from crawlcat.operators import discovery

    mark = f'<img src="i{html.MARKER}">'
    body = lambda k: "<ul>" + "".join(f"<li>{mark if marked else ''}<a href='{href}'>{title}</a></li>" for href, title, marked in k) + "</ul>"
    pages = [(1, body([("/a", "A", False), ("/b", "B", True), ("/c", "C", True), ("/b", "B2", True), ("/", "home", True), ("/d", "D", False)])), (2, body([("/a", "A", True), ("/a", "A", False), ("/b", "B", False), ("http://x.test/", "x", False)])), (3, body([("/", "home", True)]))]
    anchors = html.page_anchors(spark.createDataFrame([(i, "https://example.com/", h) for i, h in pages], "index_id int, base_url string, html string"), "index_id", "html", "base_url")
    for fallback in (True, False):
        found, report = discovery.discover(anchors, POLICY, 2, fallback)
        said = {r["index_id"]: tuple(r)[1:6] for r in report.collect()}
        items = sorted((r["index_id"], r["position"], r["title"]) for r in found.collect())
        assert said[1] == ("marker", 4, 2, 1, 1) and items[:2] == [(1, 1, "B"), (1, 2, "C")]
        assert said[2] == (("fallback", 1, 2, 1, 1) if fallback else ("none", 1, 0, 0, 0)) and items[2:] == ([(2, 1, "A"), (2, 2, "B")] if fallback else [])
        assert said[3][:3] == ("fallback" if fallback else "none", 1, 0)
    plan = discovery.discover(anchors, POLICY, 2, True)[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") <= 3


def index(n, marker=html.MARKER):
    return "<table>" + "".join(f'<tr><td><img src="i{marker}"></td><td></td></tr><tr><td><img src="i{marker}"><a href="essay-{k}.html">Essay {k}</a></td></tr>' for k in range(n)) + "</table>"


def test_a_whole_run(spark, tmp_path):
    s = Settings(thresholds=Thresholds(min_items=5), identity=FeedIdentity())
    base, root = "https://example.com/", Path(tmp_path)
    first = update.update(spark, root, index(8), base, "2024-01-01 00:00:00", s)
    assert first.action == "updated" and first.changes == {"added": 8} and update.check(spark, root, s) == 8
    pages = spark.createDataFrame([(f"https://example.com/essay-{k}.html", 200, f"<p>Paragraph number {k}, long enough to be the summary of its page.</p>", None) for k in range(8)], "url string, status int, html string, etag string")
    second = update.update(spark, root, index(8), base, "2024-01-02 00:00:00", s, pages)
    assert second.action == "updated" and "Paragraph number 3" in (root / "rss.xml").read_text() and "Paragraph" not in (root / "rss.simple.xml").read_text()
    assert update.update(spark, root, index(8), base, "2024-01-03 00:00:00", s).action == "unchanged"
    third = update.update(spark, root, index(9), base, "2024-01-04 00:00:00", s, pages)
    assert third.changes == {"added": 1, "unchanged": 8} and update.check(spark, root, s) == 9
    with pytest.raises(update.UpdateError):
        update.update(spark, root, index(3), base, "2024-01-05 00:00:00", s)
    with pytest.raises(update.UpdateError):
        update.update(spark, root, index(8, "/other.gif"), base, "2024-01-05 00:00:00", s)
    text_now = (root / "feed.json").read_text().replace("Essay 4", "Essay X", 1)
    (root / "feed.json").write_text(text_now)
    with pytest.raises(update.UpdateError):
        update.check(spark, root, s)


def test_publication_recovers(tmp_path):
    files = {"a.txt": b"1", "catalog.json": b"{}"}
    folder = publish.stage(tmp_path, files)
    publish.write_atomic(tmp_path / "PENDING.json", f'{{"generation": "{folder.name}"}}'.encode())
    assert publish.recover(tmp_path, "catalog.json") and (tmp_path / "a.txt").read_bytes() == b"1" and not (tmp_path / "PENDING.json").exists()
    folder = publish.stage(tmp_path, files)
    (folder / "a.txt").write_bytes(b"2")
    with pytest.raises(ValueError):
        publish.materialize(tmp_path, folder, "catalog.json")
    publish.write_atomic(tmp_path / "PENDING.json", b'{"generation": "none"}')
    assert not publish.recover(tmp_path, "catalog.json")
    publish.publish(tmp_path, files, "catalog.json")


def test_fetch_follows_permitted_hops_only():
    seen = []

    class Answer:
        def __init__(self, status, headers, body=b""):
            self.status, self.headers, self.body = status, headers, body

        def read(self, n):
            return self.body[:n]

    class Opener:
        def __init__(self, *answers):
            self.answers = list(answers)

        def open(self, request, timeout):
            seen.append(request)
            a = self.answers.pop(0)
            if isinstance(a, Exception):
                raise a
            return a

    waits = []
    client = lambda *a: fetch.Client(POLICY, opener=Opener(*a), sleep=waits.append, chance=lambda: 0.5, now=lambda: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    go = lambda *a, **k: fetch.fetch("https://example.com/x", client(*a), **k)
    made = go(Answer(302, {"Location": "/y"}), Answer(200, {"Content-Type": "text/html"}, b"hi"))
    assert (made.final_url, made.hops, made.status, made.content_type, made.body) == ("https://example.com/y", ["https://example.com/x"], 200, "text/html", b"hi")
    assert go(Answer(302, {"Location": "https://evil.test/"})).error_kind == "host" and go(*[Answer(302, {"Location": "/x"})] * 9).error_kind == "redirects"
    assert go(Answer(503, {}), OSError("gone"), Answer(200, {}, b"ok")).body == b"ok" and waits == [0.2, 0.4]
    waits.clear()
    assert go(Answer(429, {"Retry-After": "7"}), Answer(503, {"Retry-After": "Mon, 01 Jan 2024 00:00:30 GMT"}), Answer(503, {"Retry-After": "9999"}), Answer(503, {})).error_message == "HTTP 503" and waits == [7.0, 30.0, 120.0]
    assert go(*[OSError("gone")] * 4).error_kind == "transport" and fetch.fetch("http://example.com/", client()).error_kind == "host"
    assert go(Answer(200, {"Content-Length": str(10**9)}, b"x")).error_kind == "size" and go(Answer(404, {})).error_kind == "status"
    go(Answer(304, {}), etag="e", last_modified="m")
    assert {k.lower(): v for k, v in seen[-1].header_items()} == {"user-agent": "crawlcat/0.1", "if-none-match": "e", "if-modified-since": "m"}
    assert fetch.probe("https://example.com/x", client(Answer(405, {}), Answer(200, {}))) is None and [r.get_method() for r in seen[-2:]] == ["HEAD", "GET"]
    assert fetch.probe("https://example.com/x", client(Answer(404, {}))) == "https://example.com/x → HTTP 404"


class Site:
    """A site by path, for runs in one process."""

    def __init__(self):
        self.pages, self.asked = {}, []

    def open(self, request, timeout):
        import email.message

        path = request.full_url.removeprefix("https://example.com")
        self.asked.append((request.get_method(), path))
        body = self.pages.get(path)
        tag = f'"{len(body)}"' if body is not None else None

        class Answer:
            status = 404 if body is None else 304 if request.get_header("If-none-match") == tag else 200
            headers = email.message.Message()

            def read(self, n):
                return (body or b"")[:n] if self.status == 200 else b""

        Answer.headers["Content-Type"] = "text/html; charset=utf-8"
        if tag:
            Answer.headers["ETag"] = tag
        return Answer()


def test_live_runs_go_round_and_ask_conditionally(spark, tmp_path, monkeypatch):
    """The live source runs in this process here: its rows are made by the same functions, beside Spark's workers."""
    site, root = Site(), Path(tmp_path)
    site.pages = {"/articles.html": index(6).encode()} | {f"/essay-{k}.html": f"<p>Paragraph number {k}, long enough to be the summary of its page.</p>".encode() for k in range(5)}
    client = fetch.Client(POLICY, opener=site, sleep=lambda s: None, gap=0)
    here = lambda links, ask, schema: spark.createDataFrame([tuple(ask(*r)) for r in links.collect()], schema)
    monkeypatch.setattr(fetch, "fetch_pages", lambda links, c: here(links.select("url", "etag", "last_modified"), lambda *r: fetch.fetch(r[0], c, *r[1:]), fetch.SCHEMA))
    monkeypatch.setattr(fetch, "probe_links", lambda links, c: here(links.select("url"), lambda u: (u, fetch.probe(u, c)), "url string, failure string"))
    s = Settings(thresholds=Thresholds(min_items=5), max_page_fetches=2, validate_links=True, max_link_validations=3, public_base_url="https://feeds.example.com/x/")
    go = lambda day, **k: update.update(spark, root, None, "https://example.com/", f"2024-01-{day:02d} 00:00:00", k.pop("settings", s), live=True, client=client, **k)
    served = lambda: [p for m, p in site.asked if m == "GET" and "essay" in p]
    first = go(1)
    assert first.action == "updated" and first.n_fetched == 2 and first.probes[:2] == (3, 0) and len(served()) == 2
    one = set(served())
    site.asked.clear()
    second = go(2)
    assert second.n_fetched == 2 and not one & set(served()) and ("GET", "/articles.html") in site.asked
    site.asked.clear()
    third = go(3)
    failed = update.load(spark, root, s).where("failure_count = 1").head()
    assert third.probes[0] == 3 and failed["url"].endswith("essay-5.html") and (failed["status_code"], failed["last_error_kind"], failed["last_error_message"]) == (404, "status", "HTTP 404")
    site.pages["/essay-5.html"] = b"<p>The last page has come after all, with a paragraph of its own.</p>"
    assert go(3).action == "updated"
    files = {p.name: p.read_bytes() for p in root.glob("*.*")}
    again = go(3)
    assert again.action == "unchanged" and {p.name: p.read_bytes() for p in root.glob("*.*")} == files
    state = json.loads((root / "catalog.json").read_text())
    assert state["index"]["etag"] and state["index"]["decoded_sha256"] and len(list((root / "catalog").iterdir())) == 2
    feed = json.loads((root / "feed.simple.json").read_text())
    assert feed["feed_url"] == "https://feeds.example.com/x/feed.simple.json" and feed["_catalog"]["index_hash"] == state["index"]["decoded_sha256"] and len(feed["_catalog"]["index_fingerprint"]) == 64
    assert 'href="https://feeds.example.com/x/rss.xml"' in (root / "rss.xml").read_text() and 'href="https://feeds.example.com/x/atom.simple.xml"' in (root / "atom.simple.xml").read_text()
    stale = dataclasses.replace(s, max_page_fetches=None, validate_links=False, thresholds=Thresholds(min_items=5, freshness_days=1))
    clocks = go(20, settings=stale)
    row = update.load(spark, root, s).where("url like '%essay-0.html'").head()
    assert clocks.action == "state_changed" and row["status_code"] == 304 and row["summary"].startswith("Paragraph number 0") and str(row["last_success_at"]).startswith("2024-01-20") and row["etag"]
    site.pages.pop("/articles.html")
    with pytest.raises(update.NetworkError):
        go(21)


def test_first_catalog_from_feeds_old_versions_and_damage(spark, tmp_path):
    s, root = Settings(thresholds=Thresholds(min_items=5)), Path(tmp_path)
    update.update(spark, root, index(6), "https://example.com/", "2024-01-01 00:00:00", s)
    state = json.loads((root / "catalog.json").read_text())
    old = update.load(spark, root, s).withColumns({"last_checked_at": F.lit("2023-12-01").cast("timestamp"), "status_code": F.when(F.col("position") == 0, 500).otherwise(200)}).collect()
    spark.createDataFrame(old, update.ENTRY).write.mode("overwrite").parquet(str(root / "catalog" / "v1"))
    (root / "catalog.json").write_text(json.dumps(state | {"generation": "v1", "version": 1}))
    rows = {r["position"]: r for r in update.load(spark, root, s).collect()}
    assert rows[0]["last_success_at"] is None and rows[1]["last_success_at"] == rows[1]["last_checked_at"] == rows[0]["last_attempted_at"]
    for broken in ("{", "[]", '{"generation": "x"}', '{"generation": "x", "version": 9}'):
        (root / "catalog.json").write_text(broken)
        with pytest.raises(update.UpdateError):
            update.load(spark, root, s)
    (root / "catalog.json").unlink()
    done = update.update(spark, root, index(7), "https://example.com/", "2024-02-01 00:00:00", s)
    assert done.changes == {"unchanged": 6, "added": 1}
    assert update.update(spark, root, index(7), "https://example.com/", "2024-02-02 00:00:00", s, from_feeds=True).changes == {"unchanged": 7}
    with pytest.raises(update.UpdateError):
        update.update(spark, root, index(5).replace("essay-3.html", "https://example.com/https://x.test/"), "https://example.com/", "2024-02-03 00:00:00", s)


@pytest.mark.parametrize("wrong", [{"source_url": "ftp://x.test/"}, {"source_url": "https://a:b@x.test/"}, {"source_url": "/x"}, {"public_base_url": "http://x.test/"}])
def test_settings_refuse_addresses(wrong):
    with pytest.raises(ConfigurationError):
        Settings(**wrong)
    assert Settings(public_base_url=" ").public_base_url is None and Settings(public_base_url="http://localhost/x").public_base_url


def test_command_line(spark, tmp_path, monkeypatch):
    from crawlcat import cli

    env = {"CRAWLCAT_MIN_ITEMS": "7", "CRAWLCAT_ENRICH": "no", "CRAWLCAT_RETRIES": "9"}
    s = cli.settings(cli.parser().parse_args(["update", "x", "--retries", "1"]), env)
    assert (s.thresholds.min_items, s.enrich, s.retries) == (7, False, 1)
    for wrong in ({"CRAWLCAT_MIN_ITEMS": "many"}, {"CRAWLCAT_FORCE": "perhaps"}, {"CRAWLCAT_TIMEOUT": "0"}, {"CRAWLCAT_SOURCE_URL": "x"}):
        with pytest.raises(ConfigurationError):
            cli.settings(cli.parser().parse_args(["update", "x"]), wrong)
    source, out = tmp_path / "index.html", tmp_path / "out"
    source.write_bytes(index(6).encode())
    monkeypatch.setenv("GITHUB_OUTPUT", str(tmp_path / "ci"))
    run = lambda *a: cli.main([*a, "--min-items", "5"])
    at = ("update", str(out), "--index", str(source), "--base-url", "https://example.com/", "--offline", "--result-file", str(tmp_path / "r"))
    assert run(*at) == cli.OK and (tmp_path / "ci").read_text() == (tmp_path / "r").read_text() == "action=updated\nitems=6\nchanged=true\n"
    assert run("check", str(out)) == cli.OK and run(*at, "--max-bytes", "9") == cli.USAGE and cli.main([*at, "--min-items", "50"]) == cli.FAILED
    (out / "feed.json").write_text("{}")
    assert run("check", str(out)) == cli.VERIFICATION
    assert run("update", str(out), "--source-url", "https://127.0.0.1:1/x", "--hosts", "127.0.0.1", "--retries", "0") == cli.NETWORK


def test_a_stale_lock_is_taken_over_by_one(tmp_path):
    import os
    import threading

    path, held, most = tmp_path / ".lock", [], []
    path.touch()
    os.utime(path, (1, 1))

    def one():
        with publish.write_lock(path, timeout=20):
            held.append(1)
            most.append(len(held))
            held.pop()

    threads = [threading.Thread(target=one) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert most == [1] * 8 and not path.exists()
    path.touch()
    with pytest.raises(TimeoutError), publish.write_lock(path, timeout=0.1):
        pass
