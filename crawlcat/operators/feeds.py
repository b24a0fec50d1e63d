"""Feed projection and rendering.

Items are rendered as XML or JSON fragments by column functions; a document is
a header, the fragments in order and a footer, put together per feed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from crawlcat.config import FeedIdentity, Thresholds
from crawlcat.functions import text, urls

# Namespaces and versions of the three formats.
ATOM_NS = "http://www.w3.org/2005/Atom"
DC_NS = "http://purl.org/dc/elements/1.1/"
JSON_FEED_VERSION = "https://jsonfeed.org/version/1.1"
RSS_DOCS = "https://www.rssboard.org/rss-specification"


def snapshot(entries: DataFrame, identity: FeedIdentity, t: Thresholds = Thresholds()) -> DataFrame:
    """Items of both variants: catalog_id, variant, position, id, url, title, summary, observed_updated_at, published_at.

    ``enriched`` carries the entry's summary, ``simple`` the blurb.  An entry
    without any update clock is an error the caller sees as a null in
    ``observed_updated_at`` (see ``require_clocks``).
    """
    observed = F.coalesce("observed_updated_at", "first_seen_at")
    both = entries.withColumn("variant", F.explode(F.array(F.lit("enriched"), F.lit("simple"))))
    enriched = text.feed_summary(F.col("summary"), F.lit(None).cast("string"), F.col("title"), identity.author, t.summary_chars)
    simple = text.truncated(text.blurb(F.col("title"), identity.author), t.summary_chars)
    return both.select("catalog_id", "variant", "position", F.col("stable_id").alias("id"), "url", "title", F.when(F.col("variant") == "enriched", enriched).otherwise(simple).alias("summary"), observed.alias("observed_updated_at"), "published_at")


def require_clocks(items: DataFrame) -> None:
    bad = items.where("observed_updated_at is null").limit(1).collect()
    if bad:
        raise ValueError(f"entry {bad[0]['id']} has no update clock")


def header(items: DataFrame, identity: FeedIdentity) -> DataFrame:
    """One row a feed: its clock is the latest of its items, never the wall clock."""
    feed_id = F.when(F.col("variant") == "simple", identity.feed_id_simple).otherwise(identity.feed_id)
    return items.groupBy("catalog_id", "variant").agg(F.max("observed_updated_at").alias("logical_updated_at"), F.count("*").alias("n_items")).withColumn("feed_id", feed_id)


def _element(name: str, value: Column, indent: str, attributes: str = "") -> Column:
    return F.concat(F.lit(f"{indent}<{name}{attributes}>"), text.xml_text(value), F.lit(f"</{name}>\n"))


def rss_item(author: str) -> Column:
    """``<item>`` of a row of ``snapshot``."""
    permalink = F.col("id") == F.col("url")
    guid = F.concat(F.lit('      <guid isPermaLink="'), F.when(permalink, "true").otherwise("false"), F.lit('">'), text.xml_text(F.when(permalink, F.col("url")).otherwise(F.col("id"))), F.lit("</guid>\n"))
    date = F.coalesce(_element("pubDate", text.rfc822(F.col("published_at")), "      "), F.lit(""))
    return F.concat(F.lit("    <item>\n"), _element("title", F.col("title"), "      "), _element("link", F.col("url"), "      "), guid, date, _element("description", F.col("summary"), "      "), _element("dc:creator", F.lit(author), "      "), F.lit("    </item>\n"))


def atom_entry(author: str) -> Column:
    """``<entry>`` of a row of ``snapshot``."""
    link = F.concat(F.lit('    <link rel="alternate" type="text/html" href="'), text.xml_attribute(F.col("url")), F.lit('" />\n'))
    published = F.coalesce(_element("published", text.rfc3339(F.col("published_at")), "    "), F.lit(""))
    return F.concat(F.lit("  <entry>\n"), _element("title", F.col("title"), "    "), _element("id", F.col("id"), "    "), link, _element("updated", text.rfc3339(F.col("observed_updated_at")), "    "), published, _element("summary", F.col("summary"), "    "), F.lit("    <author>\n"), _element("name", F.lit(author), "      "), F.lit("    </author>\n  </entry>\n"))


def json_item() -> Column:
    """JSON object of a row of ``snapshot``; a missing date has no member."""
    published = F.when(F.col("published_at").isNotNull(), text.rfc3339(F.col("published_at")))
    return F.to_json(F.struct("id", "url", "title", F.col("summary").alias("summary"), F.col("summary").alias("content_text"), text.rfc3339(F.col("observed_updated_at")).alias("date_modified"), published.alias("date_published")))


def documents(items: DataFrame, identity: FeedIdentity, feed_urls: dict[str, str | None] | None = None, index_hash: str | None = None, index_fingerprint: str | None = None) -> DataFrame:
    """(catalog_id, variant, rss, atom, json): whole documents, items in order.

    ``feed_urls`` has the public address of each variant's JSON feed; the other
    formats link to themselves beside it.  What isn't known has no element.
    """
    known = {v: u for v, u in (feed_urls or {}).items() if u}
    feed_url = F.coalesce(F.lit(None).cast("string"), *(F.when(F.col("variant") == v, F.lit(u)) for v, u in known.items()))
    self_of = lambda kind, indent, ns, form: F.coalesce(F.concat(F.lit(f'{indent}<{ns}link rel="self" type="application/{form}" href="'), text.xml_attribute(urls.self_link(feed_url, kind)), F.lit('" />\n')), F.lit(""))
    rows = items.select("catalog_id", "variant", "position", rss_item(identity.author).alias("r"), atom_entry(identity.author).alias("a"), json_item().alias("j"))
    body = rows.groupBy("catalog_id", "variant").agg(*(F.expr(f"listagg({c}, '{sep}') within group (order by position)").alias(c) for c, sep in (("r", ""), ("a", ""), ("j", ","))))
    head = header(items, identity)
    clock, i = F.col("logical_updated_at"), identity
    rss = F.concat(
        F.lit(f"<?xml version=\"1.0\" encoding=\"UTF-8\"?>\n<rss {f'xmlns:atom="{ATOM_NS}" ' if known else ''}xmlns:dc=\"{DC_NS}\" version=\"2.0\">\n  <channel>\n"),
        _element("title", F.lit(i.title), "    "), _element("link", F.lit(i.home_page_url), "    "), _element("description", F.lit(i.description), "    "),
        _element("language", F.lit(i.language), "    "), _element("lastBuildDate", text.rfc822(clock), "    "), _element("category", F.lit(i.category), "    "), _element("generator", F.lit(i.generator), "    "),
        _element("docs", F.lit(RSS_DOCS), "    "), _element("ttl", F.lit(str(i.ttl_minutes)), "    "), self_of("rss", "    ", "atom:", "rss+xml"), F.col("r"), F.lit("  </channel>\n</rss>\n"),
    )
    atom = F.concat(
        F.lit(f"<?xml version=\"1.0\" encoding=\"UTF-8\"?>\n<feed xmlns=\"{ATOM_NS}\" xml:lang=\"en\">\n"), _element("title", F.lit(i.title), "  "), _element("id", F.col("feed_id"), "  "),
        _element("updated", text.rfc3339(clock), "  "), _element("subtitle", F.lit(i.description), "  "), F.lit("  <author>\n"), _element("name", F.lit(i.author), "    "), _element("uri", F.lit(i.author_url), "    "), F.lit("  </author>\n"),
        F.lit('  <link rel="alternate" type="text/html" href="'), text.xml_attribute(F.lit(i.home_page_url)), F.lit('" />\n'), _element("generator", F.lit(i.generator), "  "), self_of("atom", "  ", "", "atom+xml"), F.col("a"), F.lit("</feed>\n"),
    )
    said = lambda s: F.lit(json.dumps(s, ensure_ascii=False))
    as_json = F.concat(
        F.lit('{"version":'), said(JSON_FEED_VERSION), F.lit(',"title":'), said(i.title), F.lit(',"home_page_url":'), said(i.home_page_url), F.lit(',"description":'), said(i.description),
        F.lit(',"authors":[{"name":'), said(i.author), F.lit(',"url":'), said(i.author_url), F.lit('}],"language":'), said(i.language), F.coalesce(F.concat(F.lit(',"feed_url":'), F.to_json(F.array(feed_url)).substr(F.lit(2), F.length(F.to_json(F.array(feed_url))) - 2)), F.lit("")), F.lit(","), said(i.meta_key), F.lit(':{"generator":'), said(i.generator), F.lit(',"item_count":'),
        F.col("n_items").cast("string"), F.lit(',"logical_updated_at":"'), text.rfc3339(clock), F.lit('"' + "".join(f',"{n}":{json.dumps(v)}' for n, v in (("index_hash", index_hash), ("index_fingerprint", index_fingerprint)) if v) + '},"items":['), F.col("j"), F.lit("]}\n"),
    )
    return body.join(head, ["catalog_id", "variant"]).select("catalog_id", "variant", rss.alias("rss"), atom.alias("atom"), as_json.alias("json"))
