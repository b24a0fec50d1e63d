"""Verification: the three formats read back and held against each other.

Item views are rows (feed_id, fmt, idx, item_id, title, url, summary,
content_text); violations are rows (feed_id, code, fmt, idx).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from crawlcat.functions import text

_RSS = "channel struct<item: array<struct<guid: struct<_VALUE: string, _isPermaLink: string>, title: string, link: string, description: string>>>"
_ATOM = "entry array<struct<id: string, title: string, summary: string, link: array<struct<_rel: string, _href: string>>>>"
_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "attributePrefix": "_", "valueTag": "_VALUE"}
VIEW = ("feed_id", "fmt", "idx", "item_id", "title", "url", "summary", "content_text")


def _view(rows: DataFrame, fmt: str, items, item_id, title, url, summary, content=None) -> DataFrame:
    flat = rows.select("feed_id", F.posexplode(items).alias("idx", "i"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    return flat.select("feed_id", F.lit(fmt).alias("fmt"), "idx", empty(item_id).alias("item_id"), empty(title).alias("title"), empty(url).alias("url"), empty(summary).alias("summary"), (F.lit(None).cast("string") if content is None else content).alias("content_text"))


def parse_rss(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, unreadable feeds) of (feed_id, body)."""
    rows = feeds.select("feed_id", F.from_xml("body", f"{_RSS}, _corrupt string", _OPTIONS).alias("x"))
    i = F.col("i")
    return _view(rows, "rss", F.col("x.channel.item"), i["guid"]["_VALUE"], i["title"], i["link"], i["description"]), rows.where("x._corrupt is not null or x.channel is null").select("feed_id", F.lit("UNPARSEABLE_XML").alias("code"), F.lit("rss").alias("fmt"), F.lit(None).cast("int").alias("idx"))


def parse_atom(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``parse_rss``; the link is the first alternate one with an address, else the first with one."""
    rows = feeds.select("feed_id", F.from_xml("body", f"{_ATOM}, _corrupt string", _OPTIONS).alias("x"))
    i = F.col("i")
    with_href = F.filter(i["link"], lambda x: F.coalesce(x["_href"], F.lit("")) != "")
    alternate = F.filter(with_href, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    url = F.coalesce(F.get(alternate, 0)["_href"], F.get(with_href, 0)["_href"])
    return _view(rows, "atom", F.col("x.entry"), i["id"], i["title"], url, i["summary"]), rows.where("x._corrupt is not null").select("feed_id", F.lit("UNPARSEABLE_XML").alias("code"), F.lit("atom").alias("fmt"), F.lit(None).cast("int").alias("idx"))


def parse_json(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``parse_rss``; a summary that isn't a string is empty, a content_text that isn't one is null."""
    rows = feeds.select("feed_id", F.try_parse_json("body").alias("v"))
    items = F.expr("try_variant_get(v, '$.items', 'array<variant>')")
    sound = rows.withColumn("items", items)
    kind = lambda p: F.expr(f"schema_of_variant(try_variant_get(i, '$.{p}', 'variant'))")
    said = lambda p: F.expr(f"try_variant_get(i, '$.{p}', 'string')")
    only = lambda p: F.when(kind(p) == "STRING", said(p))
    i = _view(sound.where("items is not null"), "json", F.col("items"), said("id"), said("title"), said("url"), only("summary"), only("content_text"))
    return i, sound.where("items is null").select("feed_id", F.lit("UNPARSEABLE_JSON").alias("code"), F.lit("json").alias("fmt"), F.lit(None).cast("int").alias("idx"))


def duplicates(views: DataFrame) -> DataFrame:
    """Every repeat of an identity within a feed's format, with the first place; empty ones don't count."""
    first = F.min("idx").over(Window.partitionBy("feed_id", "fmt", "item_id"))
    return views.where("item_id <> ''").withColumn("first_idx", first).where("idx > first_idx").select("feed_id", F.lit("DUPLICATE_ID").alias("code"), "fmt", "idx", "first_idx")


def field_faults(views: DataFrame, limit: int = 400) -> DataFrame:
    blank = text.blank
    damaged = F.col("title").contains(text.REPLACEMENT) | F.col("summary").contains(text.REPLACEMENT) | F.coalesce(F.col("content_text").contains(text.REPLACEMENT), F.lit(False))
    codes = F.array_compact(
        F.array(
            F.when(blank(F.col("item_id")), "EMPTY_ID"), F.when(blank(F.col("title")), "EMPTY_TITLE"), F.when(blank(F.col("url")), "EMPTY_URL"), F.when(blank(F.col("summary")), "EMPTY_SUMMARY"),
            F.when(~blank(F.col("summary")) & (F.length("summary") > limit), "SUMMARY_LENGTH"), F.when(damaged, "UNICODE_REPLACEMENT"),
            F.when((F.col("fmt") == "json") & ~F.col("content_text").eqNullSafe(F.col("summary")), "CONTENT_TEXT_MISMATCH"),
        )
    )
    return views.select("feed_id", "fmt", "idx", F.explode(codes).alias("code")).select("feed_id", "code", "fmt", "idx")


def parity(views: DataFrame, min_items: int = 1) -> DataFrame:
    """Violations across the formats: counts first; only equal counts are asked for the floor and the order of ids, only equal ids for titles, addresses and summaries."""
    formats, fields = ("rss", "atom", "json"), ("item_id", "title", "url", "summary")
    sides = [F.max(F.when(F.col("fmt") == f, F.struct(*fields))).alias(f) for f in formats] + [F.count_if(F.col("fmt") == f).alias(f"n_{f}") for f in formats]
    differ = lambda c: ~(F.col(f"rss.{c}").eqNullSafe(F.col(f"atom.{c}")) & F.col(f"atom.{c}").eqNullSafe(F.col(f"json.{c}")))
    # Dealt by feed once: places, then whole feeds, are put together where they are.
    places = views.repartition("feed_id").groupBy("feed_id", "idx").agg(*sides).withColumns({f"bad_{c}": differ(c) for c in fields})
    feed = Window.partitionBy("feed_id")
    known = places.withColumns({**{f"s_{f}": F.sum(f"n_{f}").over(feed) for f in formats}, "bad": F.bool_or("bad_item_id").over(feed), "first": F.min("idx").over(feed)})
    level = (F.col("s_rss") == F.col("s_atom")) & (F.col("s_atom") == F.col("s_json"))
    none = F.lit(None).cast("int")
    fault = lambda on, code, at: F.when(on, F.struct(F.lit(code).alias("code"), at.alias("idx")))
    once = F.col("idx") == F.col("first")
    whole = [fault(once & ~level, "COUNT_MISMATCH", none), fault(once & level & (F.col("s_rss") < min_items), "BELOW_MIN_ITEMS", none), fault(once & level & F.col("bad"), "ID_ORDER_MISMATCH", none)]
    each = [fault(level & ~F.col("bad") & F.col(f"bad_{c}"), f"{c.upper()}_ORDER_MISMATCH", F.col("idx")) for c in fields[1:]]
    return known.select("feed_id", F.explode(F.array_compact(F.array(*whole, *each))).alias("f")).select("feed_id", "f.code", F.lit("all").alias("fmt"), "f.idx")


def order_parity(entries: DataFrame, views: DataFrame) -> DataFrame:
    """(catalog_id, position) where a feed's id isn't the catalog's; both sides by place."""
    e = entries.select("catalog_id", F.col("position").alias("idx"), F.col("stable_id").alias("want"))
    v = views.select(F.col("feed_id").alias("catalog_id"), "idx", F.col("item_id").alias("got"))
    return e.join(v, ["catalog_id", "idx"], "full_outer").where(~F.col("want").eqNullSafe(F.col("got"))).select("catalog_id", "idx")


def raise_on_failure(violations: DataFrame, most: int = 5) -> None:
    few = violations.limit(most + 1).collect()
    if few:
        more = f" (+{violations.count() - most} more)" if len(few) > most else ""
        raise ValueError("; ".join(f"{r['code']} in {r['fmt']} at {r['idx']}" for r in few[:most]) + more)
