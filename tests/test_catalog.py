"""Registered queries against DuckDB on the smallest tables, and properties against brute force."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from crawlcat.operators import catalog, discovery
from crawlcat.plans import catalog_queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    return None if v is None else round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = q.QUERIES[name](spark, sf_dir)
    names = sorted(got.columns)
    rows = sorted((tuple(map(plain, r)) for r in got.select(*names).collect()), key=str)
    other = duck.sql(q.ORACLE_SQL[name])
    assert sorted(other.columns) == names
    pick = [other.columns.index(n) for n in names]
    assert rows == sorted((tuple(plain(r[i]) for i in pick) for r in other.fetchall()), key=str)


def test_budget_goes_round(spark):
    r = random.Random(1)
    for budget in (0, 2, 5):
        rows, want = [], set()
        for c in range(30):
            n, cursor = r.randint(1, 12), r.randint(0, 40)
            due = [r.random() < 0.6 for _ in range(n)]
            rows += [(c, p, due[p], cursor) for p in range(n)]
            walk = [(cursor + k) % n for k in range(n)]
            want |= {(c, p) for p in [p for p in walk if due[p]][:budget]}
        got = catalog.grant(spark.createDataFrame(rows, "catalog_id int, position int, due boolean, cursor int"), budget, F.col("cursor"))
        assert {(x["catalog_id"], x["position"]) for x in got.where("granted").collect()} == want


def test_position_alone_is_no_change_and_missing_is_removed(spark):
    schema = "catalog_id int, stable_id string, url string, title string, position int"
    prior = spark.createDataFrame([(0, "a", "ua", "A", 0), (0, "b", "ub", "B", 1), (0, "c", "uc", "C", 2)], schema)
    found = spark.createDataFrame([(0, "b", "ub", "B", 0), (0, "a", "ua", "A2", 1), (0, "d", "ud", "D", 2)], schema)
    assert {r["stable_id"]: r["change"] for r in catalog.change(prior, found).collect()} == {"a": "updated", "b": "unchanged", "c": "removed", "d": "added"}


def test_anomaly_thresholds(spark):
    ids = lambda r: spark.createDataFrame([(0, i) for i in r], "catalog_id int, stable_id int")
    reason = lambda a, b, f=False: discovery.anomaly(ids(a), ids(b), F.lit(f)).head()["reason"]
    assert reason(range(25), range(100, 125)) == "removed"
    assert reason(range(20), range(19)) is None
    assert reason(range(40), range(61)) == "added"
    assert reason(range(20), range(2, 20), True) == "fallback"


def test_plans_scan_only_what_they_need(spark, sf_dir):
    plan = q.QUERIES["canonicalize_urls"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan
    plan = q.QUERIES["reconcile_diff"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def cut_pages(spark, folder):
    """A folder with pages whose titles, headings and texts hold references without their semicolon."""
    said = ["The&amp;&amp;&amp; end&amp", "a &amp&amp; b &copy", "R&D &am &quot; &quo", "one &amp;lt; two &lt", "AT&ampT &copyx; &;"]
    page = '<!DOCTYPE html><html><head><title>{0}</title><script>var t="&amp";</script></head><body><nav><a href="/a?b&amp">x</a></nav><div class="ad">{0}</div><article><h1>{0}</h1>{1}</article></body></html>'
    paragraphs = ["", "<p>Tiny {0}</p>", "<p>Long enough to be what the page says, posted in June 2001, {0}</p>"]
    rows = [(i, f"https://example.com/{i}", page.format(s, p.format(s))) for i, (s, p) in enumerate((s, p) for s in said for p in paragraphs)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["enrich_pages", "page_metadata", "page_paragraphs", "first_paragraph"])
def test_references_without_semicolon_are_those_of_the_sql(spark, tmp_path, name):
    folder = cut_pages(spark, tmp_path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{folder}/pages.parquet/*.parquet')")
    other = con.sql(q.ORACLE_SQL[name])
    want = sorted((tuple(map(plain, r)) for r in other.fetchall()), key=str)
    got = sorted((tuple(map(plain, r)) for r in q.QUERIES[name](spark, folder).select(*other.columns).collect()), key=str)
    assert len(got) == 15 and got == want


def test_references_without_semicolon_are_read_in_live_pages(spark):
    from crawlcat.sources import html

    frame = spark.createDataFrame([(1, "https://example.com/a", "<title>AT&ampT &lt;&amp</title><p>R&D &copy")], "page_id int, url string, html string")
    assert html.metadata(frame, q.POLICY).head()["page_title"] == "AT&T <&"
    assert html.metadata(frame, q.POLICY, unclosed=False).head()["page_title"] == "AT&ampT <&amp"
    assert [tuple(r) for r in html.parsed(frame, unclosed=False).select("title", "paragraphs").collect()] == [("AT&ampT <&amp", ["R&D &copy"])]
